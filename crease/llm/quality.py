"""Quality rules whose cutoffs carry a risk guarantee.

Each rule is a share of the text that junk has much of. The levels go from mild to strict;
a level is one cutoff for each rule, and it rejects what is above any of them. On labelled
documents, for each stratum, the levels are tested from the mildest on: the hypothesis that
a level rejects more than ``risk`` of the good documents falls if the binomial probability
of so few rejections, summed exactly, is at most ``delta / strata``. The sequence stops at
the first level that does not pass, so testing many levels costs nothing (fixed-sequence
testing), and the division by the strata is the correction for the rest: with probability
``1 - delta`` no stratum loses more than ``risk`` of its good documents. Of the levels that
pass, the one is used that rejects most labelled junk for the good it costs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import SPACES, let, words
from crease.session import staged

#: Largest false rejection of a stratum, and the probability that any stratum exceeds it.
RISK, DELTA = 0.05, 0.1
#: Ids of labelled documents that may be sent to every task (16 MB); beyond that the join is shuffled.
MOST_SENT = 1_000_000
#: Strata by language; all other languages, and none, are one more. Their number bounds the table of cutoffs.
LANGUAGES = ("en", "de", "fr", "es")
#: Rule: its cutoff at each level. A value above the cutoff rejects.
RULES = {
    "symbol_share": (0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02),
    "upper_share": (0.9, 0.75, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.22, 0.2),
    "repeat_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25),
    "reuse_share": (0.97, 0.95, 0.92, 0.9, 0.87, 0.84, 0.8, 0.75, 0.7, 0.65),
}
LEVELS = len(RULES["symbol_share"])
#: A level must reject this many times more junk than good documents to be worth more than a milder one.
WORTH = 10


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = let(
            ordered,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda e, j: F.when(
                        F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)),
                        e["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    counted = let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)
    )
    return F.when(F.size(w) < 4, 0).otherwise(counted)


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with one struct ``__q``: the counts, the rule shares and the base verdict.

    A null text has no words. Windows are compared by a 64-bit hash of their words.
    """
    whole = F.coalesce(df[text], F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    upper = F.length(whole) - F.length(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    counts = let(
        words(df[text]),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    raw = df.withColumn(
        "__raw",
        F.struct(
            counts.alias("w"),
            of_lines.alias("l"),
            F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            upper.cast("long").alias("n_upper"),
        ),
    )
    n, repeated, dup = F.col("__raw.w.n_words"), F.col("__raw.w.n_repeat_words"), F.col("__raw.l.n_dup_lines")
    chars, symbols = F.col("__raw.word_chars"), F.col("__raw.n_symbols")
    return raw.withColumn(
        "__q",
        F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            dup.alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            ((n < 50) | (100 * repeated > 50 * n)).alias("base_failed"),
            _share(symbols, chars).alias("symbol_share"),
            _share(F.col("__raw.n_upper"), chars).alias("upper_share"),
            _share(repeated, n).alias("repeat_share"),
            _share(dup, F.col("__raw.l.n_lines")).alias("dup_line_share"),
            _share(n - F.col("__raw.w.n_distinct"), n).alias("reuse_share"),
        ),
    ).drop("__raw")


def _log_gamma(x: Column) -> Column:
    """Stirling's series at x + 8, and back by the recurrence; exact to about 1e-12."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    below = F.lit(0.0)
    for i in range(8):
        below = below + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - below


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed from the k-th term down; 1 where k is not below n * p.

    Terms shrink all the way, so the sum ends where they are lost in a double.
    """
    x, m = k.cast("double"), n.cast("double")
    top = F.exp(
        _log_gamma(m + 1) - _log_gamma(x + 1) - _log_gamma(m - x + 1) + x * F.log(F.lit(p)) + (m - x) * F.log(F.lit(1 - p))
    )
    terms = F.least(k, F.ceil(200 + 40 * F.sqrt(m * p * (1 - p)))).cast("long")
    series = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(1).cast("long"), terms)).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, j: let(
            s["term"] * (x - j + 1) * (1 - p) / ((m - x + j) * p),
            lambda t: F.struct(t.alias("term"), (s["sum"] + t).alias("sum")),
        ),
        lambda s: s["sum"],
    )
    return F.when(x >= m * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * series))


def stratum(lang: Column) -> Column:
    return F.when(lang.isin(*LANGUAGES), lang).otherwise(F.lit("other"))


def cutoffs(features: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row for each stratum with labels: a cutoff for each rule, null where no level is used.

    ``features`` has doc_id, lang and ``__q``; ``labels`` doc_id and quality (1 good, 0 junk).
    Rows without id or label do not count; of several labels of a document the highest does.
    What fails the base is rejected anyway, so it is no evidence for or against a level.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    held = features.where(~F.col("__q.base_failed")).join(known, "doc_id")
    good = F.col("quality") == 1
    # The mildest level that rejects the document: its levels are nested.
    least = F.lit(LEVELS)
    for level in reversed(range(LEVELS)):
        above = F.lit(False)
        for rule, cuts in RULES.items():
            above = above | (F.col(f"__q.{rule}") > cuts[level])
        least = F.when(above, level).otherwise(least)
    held = held.select(stratum(F.col("lang")).alias("stratum"), good.alias("good"), least.alias("least"))
    sums = [F.count(F.when(F.col("good"), 1)).alias("n")]
    for level in range(LEVELS):
        hit = F.col("least") <= level
        sums.append(F.count(F.when(hit & F.col("good"), 1)).alias(f"good_{level}"))
        sums.append(F.count(F.when(hit & ~F.col("good"), 1)).alias(f"junk_{level}"))
    per = held.groupBy("stratum").agg(*sums)
    tested = per.select(
        "stratum",
        "n",
        F.posexplode(F.array(*[F.struct(F.col(f"good_{i}").alias("k"), F.col(f"junk_{i}").alias("junk")) for i in range(LEVELS)])).alias("level", "e"),
    )
    passes = binomial_tail(F.col("e.k"), F.col("n"), risk) <= delta / (len(LANGUAGES) + 1)
    worth = F.col("e.junk") - WORTH * F.col("e.k")
    tested = tested.groupBy("stratum").agg(
        F.coalesce(F.min(F.when(~passes, F.col("level"))), F.lit(LEVELS)).alias("stop"),
        F.collect_list(F.struct(worth.alias("worth"), (-F.col("level")).alias("mild"))).alias("levels"),
    )
    best = F.array_max(F.filter("levels", lambda e: (e["worth"] > 0) & (-e["mild"] < F.col("stop"))))
    tested = tested.select("stratum", (-best["mild"]).alias("level"))
    return tested.select(
        "stratum", "level", *[F.get(F.array(*map(F.lit, cuts)), F.col("level")).alias(rule) for rule, cuts in RULES.items()]
    )


def with_verdict(featured: DataFrame, cuts: DataFrame) -> DataFrame:
    """``featured`` (of ``with_features``) with ``__kept``. ``cuts`` has a row for each of the
    fixed strata at most, so it is broadcast; without a cutoff a rule rejects nothing."""
    cuts = cuts.select(F.col("stratum").alias("__stratum"), F.struct(*RULES).alias("__cut"))
    joined = featured.withColumn("__stratum", stratum(F.col("lang"))).join(F.broadcast(cuts), "__stratum", "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(f"__q.{r}") > F.col(f"__cut.{r}"), F.lit(False))
    return joined.withColumn("__kept", ~F.col("__q.base_failed") & ~rejected).drop("__stratum", "__cut")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, the base counts, both verdicts.

    Null text: no words, so it fails the base. Empty tables give no rows; a document with
    a null id is assessed like any other, but no label is its own.
    """
    features = staged(with_features(docs.select("doc_id", "lang", "text")).drop("text"), "quality")
    full = with_verdict(features, cutoffs(features, labels))
    return full.select(
        "doc_id",
        *[F.col(f"__q.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        F.col("__kept").alias("kept"),
        *[F.col(f"__q.{r}") for r in RULES],
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the rules keep, all their columns as they are. The cutoffs need the counts of labelled documents only."""
    ids = staged(labels.select(F.col("doc_id").alias("__id")).where("__id is not null").distinct(), "labelled")
    ids = F.broadcast(ids) if ids.count() <= MOST_SENT else ids
    labelled = docs.select("doc_id", "lang", "text").join(ids, F.col("doc_id") == F.col("__id"), "left_semi")
    features = staged(with_features(labelled).drop("text"), "quality")
    cuts = staged(cutoffs(features, labels), "cutoffs")
    return with_verdict(with_features(docs), cuts).where("__kept").select(*docs.columns)
