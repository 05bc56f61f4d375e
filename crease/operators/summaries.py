"""Summary tables over all balls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import in_order, present, ratio, runs_conceded, total


#: Columns of a ball that reports add up, and those that runs conceded are made of.
MEASURES = (
    "total_runs", "batter_runs", "wicket_count", "bowler_wickets", "is_legal_ball", "byes", "legbyes", "penalty",
)
CONCEDED = ("total_runs", "byes", "legbyes", "penalty")


def ball_totals(deliveries: DataFrame) -> DataFrame:
    """Balls added up at three grains in one pass, map-side combined: ``grain`` is ``batter`` (by
    phase and batter), ``bowler`` (by phase and bowler) or ``innings`` (by match, innings, phase
    and result of the batting side).

    The measures keep their names, so the reports that only add up balls give the same from the
    rows of their grain; so does the season summary, but for the players used, which no grain
    has. Columns of other grains are NULL, and a NULL is a value of its own. Rows of a bowler that
    lack different parts of the runs conceded stay apart, as a sum over them would hide that.
    ``balls`` is the number of balls. An empty table gives no rows.
    """
    lacks = [F.col(c).isNull().cast("int") * F.lit(2**i) for i, c in enumerate(CONCEDED)]
    balls = deliveries.withColumn("__lacks", sum(lacks[1:], lacks[0]))
    grains = {
        "batter": ["phase", "batter"],
        "bowler": ["phase", "bowler", "__lacks"],
        "innings": ["match_id", "innings", "phase", "batting_result"],
    }
    keys = [*dict.fromkeys(c for columns in grains.values() for c in columns)]
    sums = balls.groupingSets([[F.col(c) for c in columns] for columns in grains.values()], *map(F.col, keys)).agg(
        F.grouping("batter").alias("__not_batter"),
        F.grouping("bowler").alias("__not_bowler"),
        F.count(F.lit(1)).alias("balls"),
        *(total(c).alias(c) for c in MEASURES),
    )
    grain = F.when(F.col("__not_batter") == 0, "batter").when(F.col("__not_bowler") == 0, "bowler").otherwise("innings")
    return sums.select(grain.alias("grain"), *(c for c in keys if c != "__lacks"), "balls", *MEASURES)


def batting_summary(deliveries: DataFrame, ordered: bool = True) -> DataFrame:
    """Runs per batter, most first."""
    report = (
        deliveries.filter(present("batter"))
        .groupBy(F.col("batter").alias("player"))
        .agg(total("batter_runs").alias("runs"))
    )
    return in_order(report, ordered, F.desc("runs"), "player")


def bowling_summary(deliveries: DataFrame, ordered: bool = True) -> DataFrame:
    """Wickets, balls, runs conceded and economy per bowler, most wickets first."""
    report = (
        deliveries.filter(present("bowler"))
        .groupBy(F.col("bowler").alias("player"))
        .agg(
            total("bowler_wickets").alias("wickets"),
            total("is_legal_ball").alias("balls"),
            total(runs_conceded()).alias("runs_conceded"),
        )
        .withColumn("economy", ratio("runs_conceded", "balls", 6))
    )
    return in_order(report, ordered, F.desc("wickets"), "player")


def phase_summary(deliveries: DataFrame) -> DataFrame:
    """Runs and innings of winners and losers in each phase.

    All six rows are there, also those without a ball. An innings is counted once by
    adding up its balls first, so no distinct count is needed.
    """
    sums = (
        deliveries.filter(
            F.col("batting_result").isin("Winner", "Loser") & F.col("phase").isin(*K.PHASES)
        )
        .groupBy("batting_result", "phase", "match_id", "innings")
        .agg(total("total_runs").alias("runs"))
        .groupBy("batting_result", "phase")
        .agg(total("runs").alias("runs"), F.count(F.lit(1)).alias("innings"))
    )
    cells = [
        F.struct(F.lit(result).alias("batting_result"), F.lit(phase).alias("phase"))
        for result in ("Winner", "Loser")
        for phase in K.PHASES
    ]
    grid = deliveries.sparkSession.range(1).select(F.inline(F.array(*cells)))
    return (
        grid.join(sums, ["batting_result", "phase"], "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("runs", "innings")})
        .withColumn("avg_runs", ratio("runs", "innings"))
    )


def phase_gap(phases: DataFrame) -> DataFrame:
    """Average of winners minus average of losers per phase, from a phase summary."""
    def average(result):
        return F.coalesce(
            F.max(F.when(F.col("batting_result") == result, F.col("avg_runs"))), F.lit(0.0)
        )

    return (
        phases.groupBy("phase")
        .agg(average("Winner").alias("winner_avg"), average("Loser").alias("loser_avg"))
        .withColumn("gap", F.col("winner_avg") - F.col("loser_avg"))
    )
