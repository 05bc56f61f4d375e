"""Best and worst rows, heads of an order, distinct values, the match to show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions.scalars import as_float


def top_row(df: DataFrame, key: str, ties: Sequence[str | Column] = ()) -> DataFrame:
    """Row with the largest value; a value that is no number counts as 0."""
    return df.orderBy(as_float(key).desc(), *ties).limit(1)


def bottom_row(df: DataFrame, key: str, ties: Sequence[str | Column] = ()) -> DataFrame:
    return df.orderBy(as_float(key).asc(), *ties).limit(1)


def head_by(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First rows of an order, without sorting the rest."""
    return df.orderBy(*order).limit(n)


def best_of_role(impact: DataFrame, role: str | None = None) -> DataFrame:
    """Highest impact among eligible players, of the role if there is one of it."""
    wanted = F.lit(False) if role is None else F.col("role_signal") == role
    return (
        impact.filter(F.col("impact_eligible") == 1)
        .orderBy(wanted.desc(), F.desc("player_impact_score"), "player")
        .limit(1)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Values of a column, sorted, without missing ones."""
    return df.select(column).dropna().distinct().orderBy(column)


def rows_of_match(df: DataFrame, match_id) -> DataFrame:
    """Rows of one match; ids are compared as text."""
    return df.filter(F.col("match_id").cast("string") == str(match_id))


def match_swing(scored: DataFrame) -> DataFrame:
    """Range of the win probability in the second innings, matches with two innings."""
    chase = F.when(F.col("innings") == 2, F.col("win_probability"))
    numbers = F.col("innings")
    return (
        scored.groupBy("match_id")
        .agg(
            (F.min(numbers) < F.max(numbers)).alias("two_innings"),
            (F.max(chase) - F.min(chase)).alias("swing"),
        )
        .filter(F.col("two_innings") & F.col("swing").isNotNull())
        .select("match_id", "swing")
    )


def choose_match(scored: DataFrame) -> DataFrame:
    """The match with the widest swing, ties to the largest id; any one if none swings."""
    swings = match_swing(scored).withColumn("found", F.lit(1))
    any_match = scored.select("match_id", F.lit(None).cast("double").alias("swing"), F.lit(0).alias("found"))
    as_number = F.col("match_id").try_cast("bigint")
    return (
        swings.unionByName(any_match)
        .orderBy(F.desc("found"), F.desc("swing"), as_number.desc(), F.desc("match_id"))
        .limit(1)
        .select("match_id")
    )


CURVE_COLUMNS = (
    "match_id",
    "season",
    "innings",
    "batting_team",
    "over_number",
    "current_score",
    "wickets_lost",
    "target",
    "runs_required",
    "batting_team_won",
    "win_probability",
)


def match_curve(scored: DataFrame, match_id: str | None = None) -> DataFrame:
    """Win probability over the overs of one match, the chosen one if none is named."""
    if match_id:
        rows = rows_of_match(scored, match_id)
    else:
        rows = scored.join(choose_match(scored), "match_id", "left_semi")
    return rows.select(*CURVE_COLUMNS).orderBy("innings", "batting_team", "over_number", "current_score")
