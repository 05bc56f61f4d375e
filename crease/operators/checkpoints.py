"""State of an innings at the end of each over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import flag, present, ratio
from crease.operators.running import running_totals


def over_snapshots(
    balls: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    legal: Column,
    measures: dict[str, Column],
    carry: Sequence[str] = (),
    balls_per_over: int = K.BALLS_PER_OVER,
    dedupe: str | None = None,
    path: Sequence[str] = (),
) -> DataFrame:
    """State after every ball at which the count of legal balls is a full number of overs.

    Gives the keys, ``balls_bowled``, ``over_number``, the running total of each
    measure under its name, ``last_<measure>``, the total since the snapshot before,
    and the ``carry`` columns of the ball. An illegal ball right after the end of an
    over is a snapshot of its own; ``dedupe="last"`` keeps the last one of each over.

    The rows between two snapshots are one group of an aggregate: the balls up to the
    legal one that ends an over share its number, and each later illegal ball is alone.
    So the totals since the last snapshot are sums, formed before the shuffle, and no
    ball looks for an earlier snapshot.

    ``path`` are columns that cut the order into blocks small enough for a task, see
    :func:`running_totals`; without them a key must be small. Keys and path are not NULL.
    """
    if dedupe not in (None, "last"):
        raise ValueError("dedupe is None or 'last'")
    keys, names, order = list(keys), list(measures), list(order)
    balls = balls.withColumns({f"__{n}": m for n, m in measures.items()}).withColumn("__legal", legal)
    counted = running_totals(
        balls,
        keys,
        list(path),
        order,
        {"balls_bowled": F.col("__legal"), "__place": F.lit(1), **{n: F.col(f"__{n}") for n in names}},
    )
    bowled = F.col("balls_bowled")
    over = F.greatest(F.expr(f"(balls_bowled + {balls_per_over - 1}) div {balls_per_over}"), F.lit(1))
    extra_end = (F.col("__legal") == 0) & (bowled > 0) & (bowled % balls_per_over == 0)
    alone = F.when(extra_end, F.col("__place")).otherwise(F.lit(0)) if dedupe is None else F.lit(0)
    at_end = {c: F.max_by(F.col(c), F.col("__place")).alias(c) for c in (*names, *carry)}
    return (
        counted.withColumn("over_number", over)
        .withColumn("__alone", alone)
        .groupBy(*keys, "over_number", "__alone")
        .agg(
            F.max("balls_bowled").alias("balls_bowled"),
            *at_end.values(),
            *(F.sum(f"__{n}").cast("bigint").alias(f"last_{n}") for n in names),
        )
        .filter(F.col("balls_bowled") == F.col("over_number") * balls_per_over)
        .drop("__alone")
    )


def over_checkpoints(
    deliveries: DataFrame,
    order: Sequence[str] = ("over", "ball_in_over"),
    balls_per_over: int = K.BALLS_PER_OVER,
    max_overs: int = K.OVERS_PER_INNINGS,
    dedupe: str | None = None,
) -> DataFrame:
    """Score, wickets and rates at the end of each over of decided matches.

    ``order`` puts the balls of an innings in sequence and begins with the number of the
    over, which cuts the innings into blocks; a ball without one comes before all others.
    """
    keys = ["match_id", "season", "innings", "batting_team", "winner"]
    known = F.col("season").isNotNull() & F.col("innings").isNotNull() & F.col("match_id").isNotNull()
    balls = deliveries.filter(present("winner", "batting_team") & known).select(
        *keys, *order, "total_runs", "wicket_count", "is_legal_ball", F.coalesce(order[0], F.lit(-1)).alias("__over")
    )
    ends = over_snapshots(
        balls,
        keys,
        order,
        F.col("is_legal_ball"),
        {"runs": F.col("total_runs"), "wickets": F.col("wicket_count")},
        (),
        balls_per_over,
        dedupe,
        path=["__over"],
    )
    return ends.select(
        "match_id",
        "season",
        "innings",
        "batting_team",
        "over_number",
        F.col("runs").alias("current_score"),
        F.col("wickets").alias("wickets_lost"),
        "balls_bowled",
        F.greatest(F.lit(0), F.lit(max_overs) - F.col("over_number")).alias("overs_remaining"),
        ratio("runs", "balls_bowled", balls_per_over).alias("current_run_rate"),
        F.col("last_runs").alias("last_over_runs"),
        F.col("last_wickets").alias("last_over_wickets"),
        flag(F.col("batting_team") == F.col("winner")).alias("batting_team_won"),
    )


def enrich_checkpoints(
    checkpoints: DataFrame,
    innings: DataFrame,
    balls_per_innings: int = K.BALLS_PER_INNINGS,
    max_overs: int = K.OVERS_PER_INNINGS,
) -> DataFrame:
    """Add final score, target, runs and rate required, and the chase flag.

    The target is one more than the first innings and is set in the second only.
    """
    completed = innings.filter(present("winner"))
    finals = completed.select("match_id", "innings", F.col("runs").alias("final_innings_score"))
    targets = completed.filter(F.col("innings") == 1).select(
        "match_id", (F.col("runs") + 1).alias("__target")
    )
    chase = F.col("innings") == 2
    return (
        checkpoints.filter(F.col("over_number").between(1, max_overs))
        .join(finals, ["match_id", "innings"], "left")
        .join(targets, "match_id", "left")
        .withColumn("target", F.when(chase, F.col("__target")))
        .drop("__target")
        .withColumn("runs_required", F.col("target") - F.col("current_score"))
        .withColumns(
            {
                "required_run_rate": ratio(
                    "runs_required", F.lit(balls_per_innings) - F.col("balls_bowled"), K.BALLS_PER_OVER
                ),
                "score_pct_of_final": ratio("current_score", "final_innings_score"),
                "is_chase": flag(chase),
            }
        )
    )


def checkpoint_frame(deliveries: DataFrame, innings: DataFrame, **options) -> DataFrame:
    """Checkpoints with everything the win model needs."""
    return enrich_checkpoints(over_checkpoints(deliveries, **options), innings)
