"""Short codes of vectors by codebooks of their parts, with members that stay where they are.

Each vector is cut into PARTS parts. A part is a member of the codebook entry nearest to it,
and lies with the owner (position, entry, salt) in a table bucketed by these three; an entry
with many members has several salts. A round goes through the owners: each finds the
nearest entry of the new codebook for the members it has. Those that stay are written where
they were, without a shuffle; only those that change their entry go through one. Sums and
counts are taken by owner, where the members lie, and then over the salts, so the driver
gets one row for each entry.

All of it is whole numbers. The members' table of a round is written in the shared folder
and dropped when the next one is there.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import removed
from crease.session import shared_folder, staged

#: Parts of a vector, entries of a codebook, rounds, and what a component is multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Members of an owner, and of a bucket of the members' table, about.
OWNED, BUCKET = 4096, 500_000
#: Copies of a label's total that meet the vectors of the label.
COPIES = 64
OWNER = ["position", "entry", "salt"]
_BLOCK = 4096


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry of ``book`` (the first among equals) for each part, and the squared distance."""
    entry, error = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    small = 4 * parts.shape[1] * most * most < 1 << 53  # products of doubles are exact then
    squares = (book * book).sum(1).astype(np.float64) if small else None
    for i in range(0, len(parts), _BLOCK):
        block = parts[i : i + _BLOCK]
        if small:
            best = (squares - 2.0 * (block.astype(np.float64) @ book.T.astype(np.float64))).argmin(1)
        else:
            best = np.stack([((block - e) ** 2).sum(1) for e in book], 1).argmin(1)
        entry[i : i + _BLOCK] = best
        error[i : i + _BLOCK] = ((block - book[best]) ** 2).sum(1)
    return entry, error


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def kept_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Scaled vectors (row, vec_id, label, v) without those that do not count, stored, and their length."""
    raw = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = raw.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % PARTS == 0) & ~bad)
    first = whole.select("vec_id", F.size("v").alias("n")).orderBy(F.col("vec_id").asc_nulls_last(), "n").head(1)
    size = first[0]["n"] if first else PARTS
    # With smaller components, distances and the errors of a vector fit into longs.
    limit = math.isqrt((2**63 - 1) // size) // 2
    scaled = F.transform("v", lambda x: F.floor(F.when(F.abs(x * SCALE) < limit, x * SCALE).otherwise(
        F.raise_error(F.lit(f"a component is too large: {SCALE} times it must be below {limit}")).cast("double"))))
    rows = whole.where(F.size("v") == size).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", scaled.alias("v"))
    return staged(rows, "vectors"), size


def first_books(kept: DataFrame, size: int) -> np.ndarray:
    """Codebooks (position, entry, component) of the vectors with the smallest ids."""
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    whole = np.array([r["v"] for r in first], np.int64).reshape(len(first), PARTS, size // PARTS)
    return np.ascontiguousarray(whole.transpose(1, 0, 2))


_MEMBER = "row bigint, vec_id {id}, label {label}, position int, entry int, salt int, part array<bigint>, was int, error bigint"


def _schema(kept: DataFrame) -> str:
    kinds = dict(kept.dtypes)
    return _MEMBER.format(id=kinds["vec_id"], label=kinds["label"])


def _newcomers(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """All parts with their nearest entry; they have no owner yet (``was`` is -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column(3)).reshape(batch.num_rows, PARTS, -1)
            for position in range(PARTS):
                part = np.ascontiguousarray(whole[:, position])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_columns(part, position, books, -1, 0)], _NAMES)

    return kept.mapInArrow(run, _schema(kept))


_NAMES = ["row", "vec_id", "label", "position", "entry", "salt", "part", "was", "error"]


def _columns(part: np.ndarray, position: int, books: np.ndarray, was: int, salt: int) -> list[pa.Array]:
    n = len(part)
    entry, error = nearest(part, books[position])
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * part.shape[1])
    fixed = lambda value: pa.array(np.full(n, value, np.int32))
    lists = pa.ListArray.from_arrays(offsets, pa.array(part.reshape(-1)))
    return [fixed(position), pa.array(entry), fixed(salt), lists, fixed(was), pa.array(error)]


def _visited(members: DataFrame, books: np.ndarray) -> DataFrame:
    """The members of each owner with the entry that is nearest now; ``was`` is the one they lie with."""

    def owner(table: pa.Table) -> pa.Table:
        position, was, salt = (table.column(c)[0].as_py() for c in OWNER)
        columns = _columns(_matrix(table.column("part")), position, books, was, salt)
        return pa.table([*(table.column(c) for c in _NAMES[:3]), *columns], _NAMES)

    return members.groupBy(*OWNER).applyInArrow(owner, _schema(members))


class Members:
    """The members' table of a round."""

    def __init__(self, visited: DataFrame, buckets: int):
        """Write what was found on a round: who stays, stays; who moves is shuffled to the new owner."""
        spark = visited.sparkSession
        visited = visited.persist(StorageLevel.DISK_ONLY)
        sizes = visited.groupBy("position", "entry").count().withColumn("salts", F.ceil(F.col("count") / OWNED).cast("int"))
        sizes = F.broadcast(sizes.drop("count"))  # a row for each entry
        columns = ["row", "vec_id", "label", *OWNER, "part"]
        stay = visited.where("entry = was").select(columns)
        move = visited.where("entry <> was").drop("salt").join(sizes, ["position", "entry"])
        move = move.withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")).select(columns).repartition(buckets, *OWNER)
        self.name, self.buckets = f"members_{uuid.uuid4().hex}", buckets
        self.path = f"{shared_folder(spark)}/{self.name}"
        stay.unionByName(move).write.option("path", self.path).bucketBy(buckets, *OWNER).saveAsTable(self.name)
        visited.unpersist()
        self.table = spark.table(self.name)

    def sums(self, dims: int) -> DataFrame:
        """Count and sums of the components of the members of each entry; no shuffle below the owners."""
        each = [F.sum(F.col("part")[i]).alias(f"s{i}") for i in range(dims)]
        owned = self.table.groupBy(*OWNER).agg(F.count("*").alias("n"), *each)
        return owned.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(dims)])

    def drop(self) -> None:
        spark = self.table.sparkSession
        spark.sql(f"drop table {self.name}")
        removed(spark, self.path)


def updated(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries replaced by the mean of their members, cut down; entries without members stay."""
    books = books.copy()
    for r in sums.collect():  # at most PARTS * ENTRIES rows
        books[r["position"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(books.shape[2])]
    return books


def codes(vectors: DataFrame) -> DataFrame:
    """One row for each vector that counts: vec_id, code, error, label_error, codebooks_sha256.

    Dropped: null and empty vectors, such with null or non-finite components, and such whose
    length is not a multiple of four or not that of the vector with the smallest id. The
    codebooks start with the first 256 rows by id (nulls last), equal ids by their
    components; with fewer rows they have fewer entries. Repeated rows are rows of their own.
    Components of about 185,000 and more (64 of them) would not fit and are an error. An
    empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    kept, size = kept_vectors(vectors)
    books, dims = first_books(kept, size), size // PARTS
    parallel = spark.sparkContext.defaultParallelism
    buckets = max(parallel, math.ceil(kept.count() * PARTS / BUCKET))
    members = Members(_newcomers(kept, books), buckets)
    for done in range(ROUNDS):
        books = updated(books, members.sums(dims))
        if done < ROUNDS - 1:
            before, members = members, Members(_visited(members.table, books), buckets)
            before.drop()
    last = staged(_visited(members.table, books).select("row", "vec_id", "label", "position", "entry", "error"), "codes")
    members.drop()
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("position") == p, F.col("entry"))))), 2, "0") for p in range(PARTS)]
    coded = last.groupBy("row").agg(
        F.any_value("vec_id").alias("vec_id"), F.any_value("label").alias("label"), F.concat(*digits).alias("code"), F.sum("error").alias("error")
    ).withColumn("__label", F.to_json(F.struct("label")))
    # A label may hold a third of the vectors: they meet its total in several places.
    totals = last.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.to_json(F.struct("label")).alias("__label"), "label_error")
    totals = totals.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    dealt = coded.withColumn("__copy", F.pmod(F.xxhash64("row"), F.lit(COPIES)).cast("int"))
    return dealt.join(totals, ["__label", "__copy"]).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
