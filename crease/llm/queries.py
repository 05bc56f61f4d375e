"""Registered queries of this subpackage, over the whole tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crease.llm import collocations, decontaminate, html_text, jaccard_join, licence_scan, mixing, ppm, quality, secret_scan
from crease.llm import sharding, token_files, toxicity, vector_codes
from crease.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return sharding.place(docs, "doc_id", sharding.lookup_table(spark)).select("doc_id", "slot", "shard")


def op3_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.totals(mixing.mix(table(spark, sf_dir, "documents")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_secret_scan,
        op2_shard_table,
        op3_ppm_score,
        op4_jaccard_join,
        op5_token_files,
        op6_toxicity,
        op7_quality_rules,
        op8_main_text,
        op9_source_mix,
        op10_decontaminate,
        op11_collocations,
        op12_licence_scan,
        op13_vector_codes,
    )
}

_LEAST = " ".join(
    f"when {' or '.join(f'{rule} > {cuts[level]!r}' for rule, cuts in quality.RULES.items())} then {level}"
    for level in range(quality.LEVELS)
)

_ROUNDS = """b0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, part as entry from parts
  qualify row_number() over (partition by p order by vec_id) <= 256),
""" + "".join(
    f"""a{i} as materialized (
  select x.vec_id, x.p, x.part, arg_min(b.e, (dist, b.e)) as e, min(dist) as d
  from parts x join b{i} b on b.p = x.p,
    lateral (select list_sum(list_transform(list_zip(x.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as dist)
  group by x.vec_id, x.p, x.part),
"""
    + (
        f"""m{i} as (
  select p, e, j, cast(floor(sum(part[j]) / count(*)) as bigint) as mean
  from (select p, e, part, unnest(range(1, len(part) + 1)) as j from a{i}) group by p, e, j),
b{i + 1} as materialized (
  select b.p, b.e, coalesce(m.entry, b.entry) as entry
  from b{i} b left join (select p, e, list(mean order by j) as entry from m{i} group by p, e) m on m.p = b.p and m.e = b.e),
"""
        if i < 4
        else ""
    )
    for i in range(5)
)

ORACLE: dict[str, str] = {
    "op7_quality_rules": r"""
with split_up as (
  select doc_id, lang, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
threes as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as three
  from split_up where len(w) > 2),
twice as (select doc_id, i from threes qualify count(*) over (partition by doc_id, three) > 1),
covered as (select doc_id, unnest([i, i + 1, i + 2]) as place from twice),
repeated as (select doc_id, count(distinct place) as n from covered group by doc_id),
counts as (
  select s.doc_id, lang, len(w) as n_words, len(list_distinct(w)) as n_distinct, len(lines) as n_lines,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
  from split_up s left join repeated r on r.doc_id = s.doc_id),
shares as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    coalesce(n_symbols / nullif(word_chars, 0), 0e0) as symbol_share, coalesce(n_upper / nullif(word_chars, 0), 0e0) as upper_share,
    coalesce(n_repeat_words / nullif(n_words, 0), 0e0) as repeat_share, coalesce(n_dup_lines / nullif(n_lines, 0), 0e0) as dup_line_share,
    coalesce((n_words - n_distinct) / nullif(n_words, 0), 0e0) as reuse_share,
    case when lang in ('en', 'de', 'fr', 'es') then lang else 'other' end as stratum
  from counts),
ranked as (select *, case @LEAST@ else 10 end as least from shares),
known as (select doc_id, max(quality) as quality from labels where quality in (0, 1) group by doc_id),
held as (select r.stratum, r.least, k.quality from ranked r join known k on k.doc_id = r.doc_id where not base_failed),
tests as (
  select stratum, level, count(*) filter (quality = 1) as n, count(*) filter (quality = 1 and least <= level) as k,
    count(*) filter (quality = 0 and least <= level) as junk
  from held, range(10) l(level) group by stratum, level),
bounds as (
  select *, case when k >= n * 0.05e0 then 1e0 else list_sum([exp(lgamma(n + 1) - lgamma(j + 1)
    - (case when n - j > 0 then lgamma(n - j + 1) else 0 end) + j * ln(0.05e0) + (n - j) * ln(0.95e0)) for j in range(k + 1)]) end as p
  from tests),
stops as (select stratum, coalesce(min(level) filter (p > 0.1e0 / 5), 10) as stop from bounds group by stratum),
used as (
  select b.stratum, b.level from bounds b join stops s on s.stratum = b.stratum where b.level < s.stop and b.junk > 10 * b.k
  qualify row_number() over (partition by b.stratum order by b.junk - 10 * b.k desc, b.level) = 1)
select r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(r.least <= u.level, false) as kept,
  symbol_share, upper_share, repeat_share, dup_line_share, reuse_share
from ranked r left join used u on u.stratum = r.stratum
""".replace("@LEAST@", _LEAST),
    "op4_jaccard_join": r"""
with recursive split_up as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else [array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)] end) as shingle
  from split_up),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as both
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 100 * c.both >= 85 * (x.n + y.n - c.both)),
reach as (
  select doc_id, doc_id as root from documents
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.root)
select r.doc_id, cast(coalesce(max(s.n), 0) as bigint) as n_shingles, min(r.root) as component_id
from reach r left join sizes s on s.doc_id = r.doc_id group by r.doc_id
""",
    "op11_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as doc, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, n, array_to_string(w[i : i + n - 1], ' ') as phrase
  from (select lang, w, n, unnest(range(1, len(w) - n + 2)) as i from cut, range(1, 5) s(n))),
counts as materialized (
  select lang, n as m, phrase, string_split(phrase, ' ') as w, cast(count(*) as bigint) as f from grams group by lang, n, phrase),
often as materialized (select * from counts where f >= 30),
inner_ones as (
  select lang, array_to_string(w[i : i + k - 1], ' ') as phrase, max(f) as longest
  from (select *, unnest(range(1, m - k + 2)) as i from (select *, unnest(range(2, m)) as k from often where m > 2)) group by all),
candidates as (
  select o.* from often o left join inner_ones x on x.lang = o.lang and x.phrase = o.phrase
  where o.m > 1 and not coalesce(100 * x.longest >= 80 * o.f, false)),
cuts as (
  select c.lang, c.phrase, c.f as a, k, l.f as l, r.f as r,
    cast((2000000::hugeint * c.f) // (l.f + r.f) as bigint) as score
  from (select *, unnest(range(1, m)) as k from candidates) c
  join often l on l.lang = c.lang and l.phrase = array_to_string(c.w[1 : k], ' ')
  join often r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1 : ], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
totals as (select lang, cast(sum(f) as bigint) as n from counts where m = 1 group by lang),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank, phrase, a, l, r, t.n, score from ranked join totals t using (lang) where rank <= 2000
""",
    "op13_vector_codes": r"""
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] as part from kept, range(4) t(p)),
@ROUNDS@
coded as (
  select vec_id, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error from a4 group by vec_id)
select c.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) from b4) as codebooks_sha256
from coded c join kept k on k.vec_id = c.vec_id
""".replace("@ROUNDS@", _ROUNDS),
    "op9_source_mix": r"""
with sizes as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
  from documents),
per as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as src
  from sizes group by source),
weighed as (
  select *, ([3, 1, 2])[(src - 1) % 3 + 1] as weight, cast(sum(source_size) over () as bigint) as total from per),
levels as (
  select *, coalesce(sum(source_size) over (order by source_size / weight, src
      rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (order by source_size / weight, src rows between current row and unbounded following) as rest
  from weighed),
full_ones as (select *, 2e0 * source_size / weight <= (1.5e0 * total - 2 * before) / rest as is_full from levels),
open_ones as (
  select *, sum(case when is_full then 2 * source_size else 0 end) over () as gone,
    sum(case when is_full then 0 else weight end) over () as left_over from full_ones),
goals as (
  select *, case when is_full then 2e0 * source_size else weight * (1.5e0 * total - gone) / left_over end as target from open_ones),
whole as (select *, cast(floor(target) as bigint) as words from goals),
cut as (
  select *, sum(words) over (order by src) as upto, sum(words) over () as goal,
    greatest(1, least(4096, total // 1048576)) as block_words from whole),
parts as (
  select *, ((upto - words) * 262144) // goal as lo, (upto * 262144) // goal as hi,
    cast(ceil(source_size / block_words) as bigint) as blocks from cut),
cells as (
  select p.src, p.blocks, p.hi - p.lo as n, list_sum([((c.cell >> b) & 1) << (17 - b) for b in range(18)]) as turn
  from parts p join range(262144) c(cell) on c.cell >= p.lo and c.cell < p.hi),
ranked as (select *, row_number() over (partition by src order by turn) - 1 as place from cells),
line as (
  select r.src, r.blocks, (s.slot // 262144) * r.n + r.place as nth
  from (select unnest(range(cast((select round_even(max(goal) / max(block_words), 0) from parts) as bigint))) as slot) s
  join ranked r on r.turn = s.slot % 262144),
slots as (select src, nth % blocks as block from line where nth // blocks < 2),
times as (select src, block, count(*) as n from slots group by src, block),
laid as (
  select d.doc_id, d.size, p.src, p.source_size, p.target, p.block_words,
    cast(sum(d.size) over (partition by p.src order by d.h, d.doc_id, d.size rows unbounded preceding) as bigint) - d.size as start
  from sizes d join parts p on d.source is not distinct from p.source),
pieces as (
  select *, unnest(range(start // block_words, (start + size - 1) // block_words + 1)) as block from laid where size > 0),
taken as (
  select q.src, q.start, sum((least(q.start + q.size, (q.block + 1) * q.block_words) - greatest(q.start, q.block * q.block_words)) * t.n) as words
  from pieces q join times t on t.src = q.src and t.block = q.block group by q.src, q.start)
select l.doc_id, l.size, cast(l.source_size as bigint) as source_size, l.target, cast(coalesce(t.words, 0) as bigint) as taken
from laid l left join taken t on t.src = l.src and t.start = l.start and l.size > 0
""",
}
