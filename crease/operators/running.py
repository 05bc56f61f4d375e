"""Running totals that never bring a whole group into one task.

A plain ``sum() over (partition by key order by ...)`` sends all rows of a key to
one task. Here the rows of a key are cut into blocks along their order. Each block
is one window partition; the totals of the earlier blocks are added to it. Block
totals come from a map-side combined aggregate, so they are small, and they are
summed up level by level in the same way.

``path`` names the columns that cut the order, coarse to fine. Read as a tuple they
must not decrease along the order. A block is one value of the whole tuple; it must
hold few enough rows for one task. Each level must have few enough values under one
value of the level above. An empty path is for keys known to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BEFORE = "__before_"


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    path: Sequence[str],
    order: Sequence[str | Column],
    measures: dict[str, Column],
) -> DataFrame:
    """Add, per row, the sum of each measure over the rows up to and with it.

    The measures must be whole numbers (their sums are exact in any grouping) and
    the keys and path columns must not be NULL. ``order`` must tell rows of a block
    apart. NULL values of a measure do not count; a total is NULL until the first
    value that is none, whatever the blocks.
    """
    names = list(measures)
    block = [*keys, *path]
    upto = W.partitionBy(*block).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = df.withColumns({n: F.sum(m).over(upto).cast("bigint") for n, m in measures.items()})
    if not path:
        return inside
    totals = df.groupBy(*block).agg(*(F.sum(m).cast("bigint").alias(n) for n, m in measures.items()))
    before = _totals_before(totals, list(keys), list(path), names)
    before = before.filter(_any_value(names)).select(
        *block, *(F.col(n).alias(_BEFORE + n) for n in names)
    )
    return (
        inside.join(before, block, "left")
        .withColumns({n: _plus(F.col(n), F.col(_BEFORE + n)) for n in names})
        .drop(*(_BEFORE + n for n in names))
    )


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    path: Sequence[str],
    order: Sequence[str | Column],
    name: str,
) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return running_totals(df, keys, path, order, {name: F.lit(1)})


def _totals_before(totals: DataFrame, keys: list[str], path: list[str], names: list[str]) -> DataFrame:
    """Per block, the sums over all earlier blocks of the same key."""
    outer, last = path[:-1], path[-1]
    earlier = W.partitionBy(*keys, *outer).orderBy(last).rowsBetween(W.unboundedPreceding, -1)
    here = totals.withColumns({_BEFORE + n: F.sum(n).over(earlier) for n in names})
    here = here.select(*keys, *path, *(F.col(_BEFORE + n).alias(n) for n in names))
    if not outer:
        return here
    coarse = totals.groupBy(*keys, *outer).agg(*(F.sum(n).cast("bigint").alias(n) for n in names))
    above = _totals_before(coarse, keys, outer, names).filter(_any_value(names))
    above = above.select(*keys, *outer, *(F.col(n).alias(_BEFORE + n) for n in names))
    joined = here.join(above, [*keys, *outer], "left")
    return joined.select(
        *keys, *path, *(_plus(F.col(n), F.col(_BEFORE + n)).alias(n) for n in names)
    )


def _plus(one: Column, other: Column) -> Column:
    """The sum; of a value and NULL the value."""
    return F.coalesce(one + other, one, other)


def _any_value(names: Sequence[str]) -> Column:
    return F.coalesce(*names).isNotNull()


# Parts into which the rows of a key are dealt to meet the total of their key.
SALTS = 64


def beside_totals(rows: DataFrame, totals: DataFrame, keys: Sequence[str], part: Column) -> DataFrame:
    """Put the one row that ``totals`` has for a key beside each row of the key.

    A key may hold most of the rows, so they are dealt over parts by a hash of ``part``,
    and each part has its copy of the total. Keys are not NULL.
    """
    copies = totals.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__salt", F.pmod(F.hash(part), F.lit(SALTS)))
    return dealt.join(copies, [*keys, "__salt"]).drop("__salt")
