"""N-gram Jaccard join by partitioned signatures.

A document is the set of its distinct word shingles. Equal sets are one class; the join runs
on classes. Two sets of the same size band that are similar enough differ in at most H
elements, so when hashing deals the elements into more than H segments, some segment is the
same in both (pigeonhole). Each set is indexed by its segments, in the scheme of its own band
and, where its size allows, in that of the band below.

Cost-based allocation, by band:
  * more segments than H + 1, of which each set leaves out the cheapest to share by chance:
    those with the fewest elements. As equal segments have equal sizes, two similar sets
    still have one kept segment in common;
  * or half as many segments, each with its one-deletion neighbourhood, which tolerates one
    difference a segment. Small sets take this, where whole segments would be too short.

Classes that share a segment are not paired with each other. Each is paired with the least
class of its segments, its centre, and verified on the shingles themselves. Pairs of classes
of one centre that this leaves in different components are verified too: one by one in small
groups, and in blocks against blocks of bounded size in large ones. All links found are
true, and every link joins two documents of one component in the result. ``links`` verifies
the pairs within components too and returns them all.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm.common import freed, settled
from crease.llm.components import components
from crease.session import staged as _staged

#: Words of a shingle, and the similarity of a link in percent.
WORDS, PERCENT = 4, 85
#: Characters hashed at once.
CHUNK = 1_000_000
#: Groups of a centre up to this size are paired; larger ones go by blocks of so many shingles.
SMALL_GROUP, BLOCK_SHINGLES = 24, 60_000
#: What a set counts for in a block at least, where all pairs of two blocks may be links.
LEAST_ROOM = 100
#: Cells into which the elements of a set are counted, for a bound of what two sets share.
CELLS = 256
#: Ids that may be sent to every task (16 MB); beyond that a bit map of so many bits an id is, and what it leaves is shuffled.
MOST_SENT, ID_BITS = 1_000_000, 16
#: Bits of a row of a bit map, as Spark's functions have them.
MAP_BITS = 32_768
#: The cost of an index entry is 1; of a chance match, as many entries; an element is shared by chance so often.
MATCH_COST, SHARED = 200.0, 0.105
#: Bytes of a key in an entry, besides those that its bucket tells, entries of a bucket, about, and buckets at least.
KEY_BYTES, BUCKET_ENTRIES, LEAST_BUCKETS = 6, 8_000_000, 64

_U = np.uint64


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table. What was shuffled for it is not kept beside it."""
    df = _staged(df, name)
    settled(df.sparkSession)
    return df


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose values look random."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_KEPT: dict[int, tuple] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers of the bytes, powers of an odd base and of its inverse, and the signs of white space."""
    if n not in _KEPT:
        _KEPT[n] = _new_tables(n)
    return _KEPT[n]


def _new_tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        of_byte = _mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
        powers, back = (np.cumprod(np.append(_U(1), np.full(n, v, _U)), dtype=_U) for v in (_U(base), _U(inverse)))
    space = np.zeros(256, bool)
    space[[0x20, *range(9, 14)]] = True
    return of_byte, powers, back, space


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of lower-case texts as 64-bit hashes: (text number, hash), in order.

    A text with fewer words has one shingle, the whole sequence; one without words none."""
    buffer = b"\n".join(texts) + b"\n"
    of_byte, powers, back, space = _tables(1 << max(16, (len(buffer) + 1).bit_length()))
    raw = np.frombuffer(buffer, np.uint8)
    blank = space[raw]
    edge = np.flatnonzero(np.diff(np.append(True, blank).astype(np.int8)))  # word begins and ends in turn
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    with np.errstate(over="ignore"):
        sums = np.append(_U(0), np.cumsum(np.where(blank, _U(0), of_byte[raw]) * powers[: len(raw)], dtype=_U))
        word = _mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(_U))
        starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        text = np.searchsorted(starts, begin, "right") - 1
        held = np.bincount(text, minlength=len(texts))
        factors = _mix(np.arange(11, 11 + words, dtype=_U))
        last = len(word) - words + 1
        if last > 0:
            value = sum(word[i : last + i] * factors[i] for i in range(words))
            whole = text[:last] == text[words - 1 :]
            found, owner = _mix(value[whole]), text[:last][whole]
        else:
            found, owner = np.zeros(0, _U), np.zeros(0, np.int64)
        first = np.cumsum(held) - held
        few = np.flatnonzero((held > 0) & (held < words))
        short = np.array(
            [int((word[first[t] : first[t] + held[t]] * factors[: held[t]]).sum(dtype=_U)) ^ int(held[t]) for t in few.tolist()], _U
        )
        found, owner = np.append(found, _mix(short)), np.append(owner, few)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))[: len(found)]
    return owner[new], found[new]


class Scheme:
    """Bands of sizes and the allocation of each."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.least = percent, [1]

    def _upto(self, n: int) -> None:
        while self.least[-1] <= n:
            low = self.least[-1]
            self.least.append(max(low + 1, low * 100 * 100 // (self.percent * self.percent)))

    def bands_of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The band of each size, and whether a set of the band below can be similar."""
        self._upto(int(n.max(initial=1)))
        least = np.array(self.least)
        band = np.searchsorted(least, n, "right") - 1
        return band, (band > 0) & (100 * (least[band] - 1) >= self.percent * n)

    def differences(self, band: int) -> int:
        """Most elements in which two similar sets differ, one of them of this band, the other no smaller."""
        self._upto(self.least[band] if band < len(self.least) else 1 << 40)
        while len(self.least) <= band + 1:
            self._upto(self.least[-1])
        most = self.least[band + 1] - 1
        return (most + most * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)

    def allocation(self, band: int) -> tuple[int, int, bool]:
        """Segments, how many of them are kept, and whether with one-deletion neighbourhoods. No segment: equal sets only."""
        h = self.differences(band)
        if h == 0:
            return 0, 0, False
        n = self.least[band]
        whole = h + 1 + -(-(h + 1) // 5)
        half = -(-(h + 1) // 2)
        cost = lambda entries, size: entries * (1 + MATCH_COST * SHARED**size)
        if cost(half + n, n / half - 1) < cost(h + 1, n / whole):
            return half, half, True
        return whole, h + 1, False


def _sums(flat: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of 64-bit numbers by index, modulo 2 ** 64, from exact sums of their thirds."""
    out = np.zeros(size, _U)
    with np.errstate(over="ignore"):
        for shift, bits in ((0, 22), (22, 21), (43, 21)):
            part = (values >> _U(shift) & _U((1 << bits) - 1)).astype(np.float64)
            out += np.bincount(flat, part, size).astype(_U) << _U(shift)
    return out


def signatures(owner: np.ndarray, token: np.ndarray, sizes: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of sets: (number of the set, key), in order of the sets."""
    band, below = scheme.bands_of(sizes)
    first = np.cumsum(sizes) - sizes
    owners, keys = [], []
    for b in np.unique(np.append(band, band[below] - 1)).tolist():
        segments, kept, deletion = scheme.allocation(b)
        sets = np.flatnonzero(((band == b) | below & (band == b + 1)) & (sizes > 0))
        if not segments or not len(sets):
            continue
        n = sizes[sets]
        place = np.repeat(first[sets] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        with np.errstate(over="ignore"):
            seed = _mix(np.array([b + 1], _U))[0]
            t = _mix(token[place] + seed)
            segment = ((t >> _U(33)) * _U(segments) >> _U(31)).astype(np.int64)
            flat = np.repeat(np.arange(len(sets)), n) * segments + segment
            value = _mix(t ^ seed)
            count = np.bincount(flat, minlength=len(sets) * segments)
            total = _sums(flat, value, len(sets) * segments)
            which = np.tile(np.arange(segments), len(sets)).astype(_U)
            name = lambda s, c, w: _mix(_mix(s + seed) + c.astype(_U) * _U(0x9E3779B97F4A7C15) + w)
            key = name(total, count, which)
            if deletion:
                owners += [np.repeat(sets, segments), np.repeat(sets, n)]
                keys += [key, name(total[flat] - value, count[flat] - 1, segment.astype(_U))]
            else:
                rank = (count.astype(_U) << _U(44) | key >> _U(20)).reshape(-1, segments)
                best = np.argsort(rank, axis=1, kind="stable")[:, segments - kept :]
                owners.append(np.repeat(sets, kept))
                keys.append(np.take_along_axis(key.reshape(-1, segments), best, 1).ravel())
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return owner[order], key[order]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """The ids and lower-case texts of a batch in chunks."""
    ids, texts = batch.column(0), [t.encode().lower() for t in batch.column(1).to_pylist()]
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i + 1 == len(texts):
            yield ids.slice(begin, i + 1 - begin), texts[begin : i + 1]
            begin, size = i + 1, 0


def _class_keys(owner: np.ndarray, token: np.ndarray, n: int) -> list[np.ndarray]:
    """Two sums by set that tell sets apart."""
    return [_sums(owner, _mix(token + _U(seed)), n).view(np.int64) for seed in (1, 2)]


def _class_ids(n: np.ndarray, k1: np.ndarray, k2: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(k1.view(_U) + _mix(k2.view(_U) + _mix(n.astype(_U) + _U(seed)))).view(np.int64)


def _described(texts: list[bytes], words: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Owners and tokens of the sets, their sizes, and k1, k2 and the class id of each."""
    owner, token = shingles(texts, words)
    sizes = np.bincount(owner, minlength=len(texts))
    k1, k2 = _class_keys(owner, token, len(texts))
    return owner, token, sizes, [k1, k2, _class_ids(sizes, k1, k2, seed)]


def _read(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def described(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(doc_id, n, k1, k2, cid): the size of the set, what identifies it, and its class id, null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        for batch in batches:
            for ids, texts in _parts(batch):
                _, _, sizes, (k1, k2, cid) = _described(texts, words, seed)
                columns = [pa.array(sizes.astype(np.int64)), pa.array(k1), pa.array(k2), pa.array(cid, mask=sizes == 0)]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n", "k1", "k2", "cid"])

    return _read(docs).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n long, k1 long, k2 long, cid long")


def entries(docs: DataFrame, words: int, percent: int, seed: int, buckets: int) -> DataFrame:
    """Index entries (bucket, cid, keys): the keys of a class that fall into a bucket, in KEY_BYTES bytes each.

    A task has the entries of a class once, however many copies it reads. Nothing is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        scheme, done = Scheme(percent), set()
        for batch in batches:
            for _, texts in _parts(batch):
                owner, token, sizes, (_, _, cid) = _described(texts, words, seed)
                fresh = np.zeros(len(texts), bool)
                for i, c in enumerate(cid.tolist()):
                    if sizes[i] and c not in done:
                        done.add(c)
                        fresh[i] = True
                chosen = fresh[owner]
                of, key = signatures((np.cumsum(fresh) - 1)[owner[chosen]], token[chosen], sizes[fresh], scheme)
                if not len(key):
                    continue
                bucket = ((key >> _U(40)) * _U(buckets) >> _U(24)).astype(np.int64)
                order = np.argsort(of * buckets + bucket, kind="stable")
                of, bucket, key = of[order], bucket[order], key[order]
                first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (bucket[1:] != bucket[:-1])))
                raw = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
                offsets = (np.append(first, len(key)) * KEY_BYTES).astype(np.int32)
                keys = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                columns = [pa.array(bucket[first].astype(np.int32)), pa.array(cid[fresh][of[first]]), keys]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "cid", "keys"])

    return _read(docs).mapInArrow(run, "bucket int, cid long, keys binary")


def centres(found: DataFrame, buckets: int) -> DataFrame:
    """(centre, cid): for each class that shares a key with others the least class that has it. A task has whole buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        names, cids, keys = [], [], []
        for batch in batches:
            blob = batch.column(2)
            counts = np.diff(np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]) // KEY_BYTES
            raw = np.frombuffer(b"".join(blob.to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :KEY_BYTES] = raw
            keys.append(wide.view("<u8").ravel())
            cids.append(np.repeat(batch.column(1).to_numpy(), counts))
            names.append(np.repeat(batch.column(0).to_numpy(), counts))
        if not keys:
            return
        name, cid, key = np.concatenate(names), np.concatenate(cids), np.concatenate(keys)
        order = np.lexsort((cid, key, name))
        name, cid, key = name[order], cid[order], key[order]
        new = np.append(True, (name[1:] != name[:-1]) | (key[1:] != key[:-1]))
        centre = cid[np.flatnonzero(new)][np.cumsum(new) - 1]  # the first of a group is its least
        other = centre != cid
        pairs = np.unique(np.stack([centre[other], cid[other]], 1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], ["centre", "cid"])

    return found.repartition(buckets, "bucket").mapInArrow(run, "centre long, cid long").distinct()


def cell_counts(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(cid, cells): how many elements of a set are in each cell, without empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        for batch in batches:
            for _, texts in _parts(batch):
                owner, token, sizes, (_, _, cid) = _described(texts, words, seed)
                some = sizes > 0
                flat = owner * CELLS + (token >> _U(40)).astype(np.int64) % CELLS
                counts = np.bincount(flat, minlength=len(texts) * CELLS).reshape(-1, CELLS)[some].astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * CELLS), pa.array(counts.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(cid[some]), cells], ["cid", "cells"])

    return _read(docs).mapInArrow(run, "cid long, cells array<int>")


def shingle_sets(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(cid, tokens): the sets themselves, without empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        for batch in batches:
            for _, texts in _parts(batch):
                _, token, sizes, (_, _, cid) = _described(texts, words, seed)
                some = sizes > 0
                offsets = np.append(0, np.cumsum(sizes[some])).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(token.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(cid[some]), lists], ["cid", "tokens"])

    return _read(docs).mapInArrow(run, "cid long, tokens array<long>")


def _with_flag(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``rows`` with a flag that is true where their doc_id is one of the stored ids, and for one in ID_BITS of the others."""
    (column,) = ids.columns
    bits = max(MAP_BITS, 1 << (ID_BITS * ids.count()).bit_length())
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    row, at = (f"__{part}_{uuid.uuid4().hex}" for part in ("row", "at"))
    maps = ids.select(place(column).alias(at)).groupBy(F.expr(f"{at} div {MAP_BITS}").alias(row))
    maps = maps.agg(F.bitmap_construct_agg(F.expr(f"{at} % {MAP_BITS}")).alias(name))
    found = rows.withColumn(at, place("doc_id")).withColumn(row, F.expr(f"{at} div {MAP_BITS}")).join(F.broadcast(maps), row, "left")
    byte = f"cast(conv(hex(substring({name}, cast({at} % {MAP_BITS} div 8 as int) + 1, 1)), 16, 10) as int)"
    return found.withColumn(name, F.expr(f"coalesce(shiftright({byte}, cast({at} % 8 as int)) & 1 = 1, false)")).drop(row, at)


def _maybe_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is one of the stored ids, null included, and, where these are many, some others. Nothing is shuffled."""
    (column,) = ids.columns
    if ids.count() <= MOST_SENT:
        return rows.join(F.broadcast(ids), rows["doc_id"].eqNullSafe(ids[column]), "left_semi")
    flag = "__flag_" + uuid.uuid4().hex
    return _with_flag(rows, ids, flag).where(flag).drop(flag)


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is one of the stored ids, none of them null. Where these are many, only what a bit map leaves is shuffled."""
    if ids.count() <= MOST_SENT:
        return rows.join(F.broadcast(ids), "doc_id", "left_semi")
    return _maybe_among(rows, ids).join(ids, "doc_id", "left_semi")


def _not_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is none of the stored ids; neither may be null. Where ids are many, only what a bit map leaves is shuffled."""
    if ids.count() <= MOST_SENT:
        return rows.join(F.broadcast(ids), "doc_id", "left_anti").select(*rows.columns)
    flag = "__flag_" + uuid.uuid4().hex
    found = _with_flag(rows, ids, flag)
    surely = found.where(~F.col(flag)).select(*rows.columns)
    return surely.unionByName(found.where(flag).join(ids, "doc_id", "left_anti").select(*rows.columns))


def _tokens(docs: DataFrame, sets: DataFrame, words: int, seed: int) -> Callable[[DataFrame], DataFrame]:
    """What makes the sets (cid, tokens) of chosen classes (cid) from their texts again: they take more room than the texts."""

    def of(chosen: DataFrame) -> DataFrame:
        chosen = staged(sets.join(chosen, "cid").select("cid", "first"), "chosen")
        texts = _maybe_among(docs, staged(chosen.select(F.col("first").alias("__id")).distinct(), "ids"))
        return shingle_sets(texts, words, seed).join(chosen.select("cid"), "cid").dropDuplicates(["cid"])

    return of


def _verified(pairs: DataFrame, sets: DataFrame, tokens: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Pairs (a, b) with the bounds ``lo`` and ``hi`` of 1 minus their Jaccard similarity, and whether they are linked; stored.

    Two sets share no more than the smaller count of each cell adds up to. Pairs that this leaves
    below the limit are not linked; only the others bring their elements together."""
    one, two = (sets.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("cells").alias(f"cells_{c}")) for c in ("a", "b"))
    most = F.aggregate(F.zip_with("cells_a", "cells_b", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y).cast("long")
    bound = pairs.join(one, "a").join(two, "b").select("a", "b", most.alias("most"), (F.col("n_a") + F.col("n_b")).alias("both"))
    might = F.expr(f"100 * most >= {percent} * (both - most)")
    bound = staged(bound.select("a", "b", might.alias("might"), F.expr("1 - most / (both - most)").alias("lo")), "bounds")
    some = staged(tokens(bound.where("might").select(F.explode(F.array("a", "b")).alias("cid")).distinct()), "tokens")
    one = some.select(F.col("cid").alias("a"), F.col("tokens").alias("ta"))
    two = some.select(F.col("cid").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    met = bound.where("might").select("a", "b").join(one, "a").join(two, "b")
    met = met.select("a", "b", both.alias("both"), (F.size("ta") + F.size("tb") - both).alias("all"))
    far = 1 - F.col("both") / F.col("all")
    met = met.select("a", "b", far.alias("lo"), far.alias("hi"), (100 * F.col("both") >= percent * F.col("all")).alias("linked"))
    return staged(met.unionByName(bound.where("not might").select("a", "b", "lo", F.lit(1.0).alias("hi"), F.lit(False).alias("linked"))), "near")


def _block_bounds(percent: int):
    """Members of the two blocks of a group, or of one, whose cells allow a link with one of another component on the other side."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        comp, block, n = (group[c].to_numpy() for c in ("comp", "block", "n"))
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        cells = np.stack(list(group["cells"]))
        others, some = cells[right], np.zeros(len(group), bool)
        for k in left.tolist():
            most = np.minimum(cells[k], others).sum(1)
            might = (100 * most >= percent * (n[k] + n[right] - most)) & (comp[k] != comp[right])
            some[k] |= might.any()
            some[right[might]] = True
        return group.loc[some, ["centre", "i", "j", "block", "cid", "comp"]]

    return run


def _block_links(percent: int):
    """Links between the two blocks of a group, or within one, that join different components."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid")
        cid, comp, block = (group[c].to_numpy() for c in ("cid", "comp", "block"))
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        sizes = np.array([len(t) for t in group["tokens"]])
        token = np.concatenate(list(group["tokens"]))
        _, number, held = np.unique(token, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(group)), sizes)
        owner, number = owner[held[number] > 1], number[held[number] > 1]
        shared = np.zeros((len(left), len(right)), np.float32)
        # Incidence of a span of tokens at a time: the memory is bounded by the block.
        _, number = np.unique(number, return_inverse=True)
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        width = 2048
        for begin in range(0, int(number.max(initial=-1)) + 1, width):
            lo, hi = np.searchsorted(number, [begin, begin + width])
            met = np.zeros((len(group), width), np.float32)
            met[owner[lo:hi], number[lo:hi] - begin] = 1
            shared += met[left] @ met[right].T
        whole = sizes[left][:, None] + sizes[right][None, :] - shared
        i, j = np.nonzero((100 * shared >= percent * whole) & (comp[left][:, None] != comp[right][None, :]))
        out = pd.DataFrame({"a": cid[left][i], "b": cid[right][j], "x": comp[left][i], "y": comp[right][j]})
        return out.drop_duplicates(["x", "y"])[["a", "b"]]  # one link joins two components

    return run


def _met_at_centres(base: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, seed: int) -> tuple[DataFrame, Callable, DataFrame]:
    """The classes that share a key with others (cid, first, n, cells), what makes their sets, and each of them with its centres, verified; stored."""
    # A set of n shingles has fewer than n + 2 entries in a scheme and is in two at most.
    most = 2 * (classes.agg(F.sum(F.col("n") + 2)).head()[0] or 0)
    buckets = max(LEAST_BUCKETS, -(-most // BUCKET_ENTRIES))
    members = staged(centres(entries(docs, words, percent, seed, buckets), buckets), "members")

    needed = members.select("cid").unionByName(members.select(F.col("centre").alias("cid"))).distinct()
    needed = staged(needed.join(classes, "cid").select("cid", "first", "n"), "needed")
    texts = _maybe_among(docs, staged(needed.select(F.col("first").alias("__id")).distinct(), "ids"))
    sets = staged(cell_counts(texts, words, seed).join(needed, "cid").dropDuplicates(["cid"]), "sets")
    tokens = _tokens(docs, sets, words, seed)

    return sets, tokens, _verified(members.select(F.col("centre").alias("a"), F.col("cid").alias("b")), sets, tokens, percent)


def _met_beside_centres(sets: DataFrame, tokens: Callable, near: DataFrame, comps: DataFrame | None, percent: int) -> DataFrame:
    """Links (a, b) between members of one centre: all of them, or, with the components (node, component) that the links
    with centres make, as many as join those."""
    spread = near.select(F.col("a").alias("centre"), F.col("b").alias("cid"), "lo", "hi")
    if comps is None:
        spread = spread.withColumn("comp", F.col("cid"))
    else:
        spread = spread.join(comps.withColumnRenamed("node", "cid").withColumnRenamed("component", "comp"), "cid", "left")
    spread = spread.join(sets.select("cid", "n"), "cid").withColumn("comp", F.coalesce("comp", "cid"))
    spread = staged(spread.select("centre", "cid", "lo", "hi", "n", "comp"), "spread")
    # Groups of a centre whose members are not all in one component.
    groups = spread.groupBy("centre").agg(F.count("*").alias("g"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    groups = groups.where("c0 < c1").select("centre", "g")
    few, many = groups.where(F.col("g") <= SMALL_GROUP), groups.where(F.col("g") > SMALL_GROUP)
    room = 1 - percent / 100 + 1e-9
    x, y = (spread.join(few, "centre").alias(name) for name in ("x", "y"))
    pairs = (
        x.join(y, F.expr("x.centre = y.centre and x.cid < y.cid and x.comp <> y.comp"))
        .where(F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and x.lo - y.hi <= {room} and y.lo - x.hi <= {room}"))
        .select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
        .distinct()
    )
    more = _verified(staged(pairs, "pairs"), sets, tokens, percent).where("linked").select("a", "b")

    line = Window.partitionBy("centre").orderBy("n", "cid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room_of = F.col("n") if comps is not None else F.greatest("n", F.lit(LEAST_ROOM))
    blocked = spread.join(many, "centre").withColumn("block", F.sum(room_of).over(line) - 1)
    blocked = staged(blocked.withColumn("block", F.expr(f"block div {BLOCK_SHINGLES}")).select("centre", "cid", "comp", "n", "block"), "blocks")
    ranges = blocked.groupBy("centre", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    left, right = ranges.alias("l"), ranges.alias("r")
    units = left.join(right, F.expr(f"l.centre = r.centre and l.block <= r.block and 100 * l.hi >= {percent} * r.lo"))
    units = units.select(F.col("l.centre").alias("centre"), F.col("l.block").alias("i"), F.col("r.block").alias("j"))
    sides = units.select("centre", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = sides.join(blocked.select("centre", "block", "cid", "comp", "n"), ["centre", "block"]).join(sets.select("cid", "cells"), "cid")
    # Cells take a tenth of the room of the elements, which only members with a possible link bring together.
    likely = dealt.groupBy("centre", "i", "j").applyInPandas(_block_bounds(percent), "centre long, i long, j long, block long, cid long, comp long")
    likely = staged(likely, "likely")
    dealt = likely.join(tokens(likely.select("cid").distinct()), "cid")
    by_blocks = dealt.groupBy("centre", "i", "j").applyInPandas(_block_links(percent), "a long, b long")
    return more.unionByName(by_blocks)


def class_components(base: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, seed: int) -> DataFrame:
    """(node, component) of the classes that are linked with others. ``base`` and ``classes`` are stored."""
    sets, tokens, near = _met_at_centres(base, classes, docs, words, percent, seed)
    links = near.where("linked").select("a", "b")
    comps = staged(components(links), "components")
    return components(links.unionByName(_met_beside_centres(sets, tokens, near, comps, percent)))


def _classes(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame, int]:
    """``described`` documents, the classes of equal sets (cid, n, first), and the seed that gives no two classes one id; stored."""
    for seed in itertools.count():
        base = staged(described(docs, words, seed), "described")
        same = F.lit(True)
        for c in ("n", "k1", "k2"):
            same = same & (F.min(c) == F.max(c))
        classes = base.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"), same.alias("same"))
        classes = staged(classes, "classes")
        if not classes.where("not same").head(1):
            return base, classes.drop("same"), seed


def links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links: pairs of classes (a, b; each once, a < b), and the membership (doc_id, cid), one row for each document.

    Documents of one class are linked with each other, and with all of the classes that theirs is paired with. Null
    texts and those without words are in no class: their cid is null. The pairs grow with the square of a group of near copies.
    """
    base, classes, seed = _classes(docs, words)
    sets, tokens, near = _met_at_centres(base, classes, docs, words, percent, seed)
    found = near.where("linked").select("a", "b").unionByName(_met_beside_centres(sets, tokens, near, None, percent))
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs, base.select("doc_id", "cid")


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id.

    The component is the smallest doc_id that links lead to. Null or empty texts, and texts
    without words, have no shingle and are linked with nothing: their component is their own
    id. A null doc_id counts as larger than all; repeated rows are copies of each other.
    """
    base, named, _ = _named(docs, words, percent)
    return base.join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _named(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """``described`` documents, and of each class (cid) the least doc_id of its component, nulls last, and the class that has it."""
    base, classes, seed = _classes(docs, words)
    comps = staged(class_components(base, classes, docs, words, percent, seed), "components")
    joined = classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    best = F.min(F.struct(F.col("first").isNull(), "first", "cid"))
    least = joined.groupBy("component").agg(best["first"].alias("component_id"), best["cid"].alias("of"))
    return base, joined.join(least, "component").select("cid", "component_id", "of"), seed


def _with_class(docs: DataFrame, words: int, seed: int, name: str) -> DataFrame:
    """Rows with all their columns and the class of their text, null for empty sets."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode().lower() for t in batch.column(place).to_pylist()]
            if texts:
                _, _, sizes, (_, _, cid) = _described(texts, words, seed)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cid, mask=sizes == 0)], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, and all rows that are linked with nothing, all their columns as they are.

    The row with the least doc_id stays, nulls last. Where rows share an id, or have none, they are
    told apart by their texts, and one stays of those that are equal in both. Null texts and
    those without words are linked with nothing, so all of them stay, repeated ones too.
    """
    base, named, seed = _named(docs, words, percent)
    verdict = base.join(named, "cid").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("cid") == F.col("of")))
    verdict = staged(verdict.select("doc_id", "cid", "stays"), "verdicts")
    several = staged(base.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "several")
    gone = verdict.where("not stays and doc_id is not null").select("doc_id").unionByName(several).distinct()
    alone = _not_among(docs.where("doc_id is not null"), staged(gone, "gone"))

    # Rows without an id of their own: by id and class.
    name = "__class_" + uuid.uuid4().hex
    shared = docs.where("doc_id is null").unionByName(_among(docs, several).select(*docs.columns))
    shared = _with_class(shared, words, seed, name)
    stays = verdict.where("stays").select(F.col("doc_id").alias("__id"), F.col("cid").alias("__cid")).distinct()
    same = shared["doc_id"].eqNullSafe(stays["__id"]) & (shared[name] == stays["__cid"])
    kept = shared.join(stays, same, "left_semi").dropDuplicates(["doc_id", name])
    return alone.unionByName(kept.drop(name)).unionByName(shared.where(F.col(name).isNull()).drop(name))
