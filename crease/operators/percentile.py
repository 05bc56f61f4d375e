"""Percentile scores: share of the pool at or below a value, times 100.

The pool is reduced to one row per distinct value, the counts are summed up along the
values, and the share is joined back by value; all metrics of a call go through one pass,
as one long table. Blocks are the leading bits of a value, so each holds a bounded number
of distinct values, however the values lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crease.operators.running import SALTS

Metrics = dict[str, tuple[Column, Column]]


def ordered_bits(value: Column) -> Column:
    """Whole number that has the order of a double; NaN is the largest, as in a sort."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value).cast("bigint")
    # Larger numbers below zero have smaller bits: turn them round.
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)


def percentile_scores(
    df: DataFrame, ids: Sequence[str], metrics: Metrics, within: Sequence[str] = ()
) -> DataFrame:
    """One row per ``ids`` with a percentile column per metric.

    ``metrics`` maps an output name to (value, is in the pool). Rows outside the
    pool, and rows without a value, get 0.0. ``within`` names the columns that separate
    pools, besides the metric; they must be among ``ids``, and NULL is a pool of its own.
    A pool keeps its ties: equal values get an equal score, and the largest gets 100.
    Repeated rows count, and come out, as often as they are there.
    """
    ids, within = list(ids), list(within)
    columns = {name: f"__v{i}" for i, name in enumerate(metrics)}
    values = [F.when(member, value.cast("double")).alias(columns[name]) for name, (value, member) in metrics.items()]
    own = [*ids, *columns.values()]
    cells = F.array(
        *(F.struct(F.lit(name).alias("__metric"), F.col(column).alias("__value")) for name, column in columns.items())
    )
    # One key for the pool: a NULL in it is a value like any other.
    key = F.to_json(F.struct(*within)) if within else F.lit("")
    entries = df.select(*ids, *values).select(*own, key.alias("__pool"), F.inline(cells))
    # Entries without a value meet no score; their parts keep them from one task.
    part = F.when(F.col("__value").isNull(), F.pmod(F.hash(*own), F.lit(SALTS))).otherwise(F.lit(0))
    scored = entries.withColumn("__part", part).join(
        _scores(entries.filter(F.col("__value").isNotNull())).withColumn("__part", F.lit(0)),
        ["__pool", "__metric", "__value", "__part"],
        "left",
    )
    best = {
        name: F.max(F.when(F.col("__metric") == name, F.coalesce("__score", F.lit(0.0)))).alias(name)
        for name in columns
    }
    # Equal rows are one row here, and come out as often as they went in.
    copies = F.count_if(F.col("__metric") == next(iter(columns)))
    return (
        scored.groupBy(*own)
        .agg(*best.values(), copies.alias("__copies"))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
        .select(*ids, *columns)
    )


def _scores(members: DataFrame) -> DataFrame:
    """Score of each distinct value of a pool and metric.

    Three levels: values of a block, blocks of a region, regions of a pool. Each level adds
    what lies before it at the level above, and the size of the pool comes down with it.
    """
    pool, fine = ["__pool", "__metric"], F.shiftright("__bits", 21)
    counted = (
        members.groupBy(*pool, "__value")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__bits", ordered_bits(F.col("__value")))
        .withColumns({"__region": F.shiftright("__bits", 43), "__block": fine})
        .drop("__bits")
    )
    region, block = [*pool, "__region"], [*pool, "__region", "__block"]
    blocks = counted.groupBy(*block).agg(F.sum("__n").alias("__n"))
    regions = blocks.groupBy(*region).agg(F.sum("__n").alias("__n"))

    def upto(keys: list[str], order: str, last: int) -> Column:
        window = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, last)
        return F.coalesce(F.sum("__n").over(window), F.lit(0))

    above = regions.select(
        *region, upto(pool, "__region", -1).alias("__above"), F.sum("__n").over(W.partitionBy(*pool)).alias("__size")
    )
    before = (
        blocks.withColumn("__before", upto(region, "__block", -1))
        .join(above, region)
        .select(*block, (F.col("__above") + F.col("__before")).alias("__before"), "__size")
    )
    share = F.lit(100.0) * (F.col("__before") + F.col("__upto")) / F.col("__size")
    return (
        counted.withColumn("__upto", upto(block, "__value", W.currentRow))
        .join(before, block)
        .select(*pool, "__value", share.alias("__score"))
    )
