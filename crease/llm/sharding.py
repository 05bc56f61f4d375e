"""Sharding by a lookup table that the shards fill in turns.

Each shard has a permutation of the slots of a prime-sized table: ``offset + rank * skip``.
The shards take turns; at its turn a shard claims the first free slot of its permutation.
So all shards own the same number of slots, give or take one, and when a shard leaves, few
slots of the others move. A key is placed by one hash and one look into the table.

Filling is one aggregate over a row that holds the whole state, so it stays an expression;
its size is that of the table, a parameter, and never that of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.session import staged

#: Slots of the table, a prime. Also the proven bound of what is broadcast: one short row each.
SLOTS = 65537
#: Shards of the registered query.
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(key: Column, seed: str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), key)), 1, 15), 16, 10).cast("long")


def lookup_table(spark: SparkSession, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """Table (slot, shard) with one row for each slot.

    ``shards`` are distinct names in the order of their turns, at least one and at most
    as many as slots (and 65,535); ``slots`` is a prime. Anything else is a ValueError.
    """
    shards = list(shards)
    if not shards or len(set(shards)) < len(shards) or len(shards) > min(slots, 65535):
        raise ValueError("shards must be distinct names, one at least and no more than slots")
    if not _is_prime(slots):
        raise ValueError("the number of slots must be a prime")
    n = len(shards)
    names = F.array(*[F.lit(s) for s in shards])
    state = spark.range(1).select(
        names.alias("names"),
        F.transform(names, lambda s: _hash(s, "skip:") % F.lit(slots - 1) + 1).alias("skips"),
        F.struct(
            F.unhex(F.repeat(F.lit("0000"), slots)).alias("owners"),
            F.transform(names, lambda s: _hash(s, "offset:") % F.lit(slots)).alias("next"),
            F.lit(0).alias("turn"),
            F.lit(slots).alias("left"),
        ).alias("state"),
    )
    # One probe a step: a free slot is claimed and ends the turn, a taken one does not. About
    # slots * ln(slots) probes fill the table; while that was not enough, the next pass goes on.
    step = """
      if(s.left = 0, s, transform(array(s.next[s.turn]), slot ->
        transform(array(substring(s.owners, cast(2 * slot + 1 as int), 2) = X'0000'), free ->
          named_struct(
            'owners', if(free, overlay(s.owners placing unhex(lpad(hex(s.turn + 1), 4, '0'))
                                       from cast(2 * slot + 1 as int) for 2), s.owners),
            'next', concat(slice(s.next, 1, s.turn), array((slot + skips[s.turn]) % {slots}L),
                           slice(s.next, s.turn + 2, {n})),
            'turn', if(free, (s.turn + 1) % {n}, s.turn),
            'left', if(free, s.left - 1, s.left)))[0])[0])
    """.format(slots=slots, n=n)
    left = slots
    while left:
        state = staged(
            state.withColumn("state", F.expr(f"aggregate(sequence(1, {16 * slots}), state, (s, x) -> {step})")), "slots"
        )
        left = state.select("state.left").head()[0]
    return state.select(
        F.expr(
            f"""inline(transform(sequence(0, {slots - 1}), slot -> named_struct('slot', cast(slot as long),
                'shard', names[cast(conv(hex(substring(state.owners, 2 * slot + 1, 2)), 16, 10) as int) - 1])))"""
        )
    )


def place(df: DataFrame, key: str, lookup: DataFrame, slots: int = SLOTS) -> DataFrame:
    """All rows with their slot and shard, by the hash of ``key``.

    Equal keys meet in one shard; a null key is placed like an empty text. Columns named
    ``slot`` or ``shard`` are replaced; all others, also repeated rows, stay.
    """
    rest = df.drop("slot", "shard")
    slot = F.pmod(F.xxhash64(F.coalesce(rest[key].cast("string"), F.lit(""))), F.lit(slots).cast("long"))
    return rest.withColumn("slot", slot).join(F.broadcast(lookup), "slot").select(*rest.columns, "slot", "shard")


def write_shards(df: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Write placed rows, a folder for each shard. Several tasks write a shard, so that
    none holds all of one."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in ("slot", "shard")]), F.lit(files_per_shard))
    (df.withColumn("__salt", salt).repartition("shard", "__salt").drop("__salt").write.partitionBy("shard").parquet(path))
