"""Feature frames of the score models, and the split into training and test rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import flag, floor_at_zero, is_boundary, is_dot, is_six, ratio, total
from crease.operators.ranks import keys_at
from crease.session import staged

INNINGS_KEY = ("match_id", "season", "innings", "batting_team")


def _early_totals(deliveries: DataFrame, overs: int, measures: dict[str, Column]) -> DataFrame:
    """Sums over the first overs of each innings with a full key."""
    known = F.lit(True)
    for name in INNINGS_KEY:
        known = known & F.col(name).isNotNull()
    return (
        deliveries.filter((F.col("over") < overs) & known)
        .groupBy(*INNINGS_KEY)
        .agg(*(total(m).alias(n) for n, m in measures.items()))
    )


def _with_final_score(features: DataFrame, innings: DataFrame) -> DataFrame:
    finals = innings.filter(F.col("runs").isNotNull()).select(
        "match_id", "innings", F.col("runs").alias("final_score")
    )
    return features.join(finals, ["match_id", "innings"])


def powerplay_features(
    deliveries: DataFrame,
    innings: DataFrame,
    overs: int = 6,
    min_balls: int = K.MIN_POWERPLAY_BALLS,
) -> DataFrame:
    """One row per innings from its first six overs, with the final score."""
    features = _early_totals(
        deliveries,
        overs,
        {
            "powerplay_runs": F.col("total_runs"),
            "powerplay_wickets": F.col("wicket_count"),
            "powerplay_balls": F.col("is_legal_ball"),
            "powerplay_boundaries": is_boundary(),
            "powerplay_dot_balls": is_dot(),
        },
    ).filter(F.col("powerplay_balls") >= min_balls)
    features = features.withColumns(
        {
            "powerplay_run_rate": ratio("powerplay_runs", "powerplay_balls", 6),
            "powerplay_wickets_left": F.lit(K.WICKETS_PER_INNINGS) - F.col("powerplay_wickets"),
            "boundary_pct": ratio("powerplay_boundaries", "powerplay_balls", 100),
            "dot_ball_pct": ratio("powerplay_dot_balls", "powerplay_balls", 100),
            "is_first_innings": flag(F.col("innings") == 1),
        }
    )
    return _with_final_score(features, innings)


def halfway_features(
    deliveries: DataFrame,
    innings: DataFrame,
    matches: DataFrame,
    overs: int = 10,
    min_balls: int = K.MIN_HALFWAY_BALLS,
    balls_per_innings: int = K.BALLS_PER_INNINGS,
) -> DataFrame:
    """One row per innings from its first ten overs, with ground, chase and final score.

    Here the target is the first-innings score itself, not one more.
    """
    features = _early_totals(
        deliveries,
        overs,
        {
            "runs_so_far": F.col("total_runs"),
            "wickets_so_far": F.col("wicket_count"),
            "balls_so_far": F.col("is_legal_ball"),
            "boundaries": is_boundary(),
            "sixes": is_six(),
            "dot_balls": is_dot(),
        },
    ).filter(F.col("balls_so_far") >= min_balls)
    features = with_rates(features, F.col("balls_so_far"), balls_per_innings)
    grounds = matches.select("match_id", "venue", "city")
    firsts = innings.filter(F.col("innings") == 1).select("match_id", F.col("runs").alias("target_score"))
    # The two match-level tables are joined with each other first: the features move once.
    features = features.join(grounds.join(firsts, "match_id", "full"), "match_id", "left")
    features = features.withColumn("target_score", _in_chase(F.col("target_score")))
    return _with_final_score(with_chase(features, F.col("balls_remaining")), innings)


def _in_chase(value: Column) -> Column:
    return F.when(F.col("innings") == 2, value).otherwise(F.lit(0))


def with_rates(df: DataFrame, balls: Column, balls_per_innings: int = K.BALLS_PER_INNINGS) -> DataFrame:
    """Rates and remainders that follow from the totals so far; ``balls`` divides."""
    return df.withColumns(
        {
            "run_rate_so_far": ratio("runs_so_far", balls, 6),
            "wickets_remaining": F.lit(K.WICKETS_PER_INNINGS) - F.col("wickets_so_far"),
            "boundary_pct": ratio("boundaries", balls, 100),
            "dot_ball_pct": ratio("dot_balls", balls, 100),
            "six_pct": ratio("sixes", balls, 100),
            "is_first_innings": flag(F.col("innings") == 1),
            "balls_remaining": F.lit(balls_per_innings) - F.col("balls_so_far"),
        }
    )


def with_chase(df: DataFrame, balls_left: Column) -> DataFrame:
    """Runs needed and rate required; both 0 outside the second innings."""
    needed = floor_at_zero(F.col("target_score") - F.col("runs_so_far"))
    return df.withColumn("runs_needed", _in_chase(needed)).withColumn(
        "required_run_rate", _in_chase(ratio("runs_needed", balls_left, 6))
    )


def situations(inputs: DataFrame, balls_per_innings: int = K.BALLS_PER_INNINGS) -> DataFrame:
    """Features of match situations given as raw numbers, for batch projection.

    Divisors are at least 1 here, while the training frame leaves a NULL.
    """
    rated = with_rates(inputs, F.greatest(F.col("balls_so_far"), F.lit(1)), balls_per_innings)
    return with_chase(rated, F.greatest(F.col("balls_remaining"), F.lit(1)))


def training_split(
    frame: DataFrame,
    unit: Sequence[str],
    strata: Sequence[str] = (),
    train_share: tuple[int, int] = (4, 5),
    seed: int = K.RANDOM_SEED,
    name: str = "is_train",
) -> DataFrame:
    """Add 1 for training rows and 0 for test rows.

    All rows of a unit go to the same side. In each stratum the units are put in the
    order of a hash of their key; the first ``train_share`` of them train. The same
    data always gives the same split, whatever its partitions. The hash of the last unit
    that trains is found by selection; rows are then compared with it where they lie.
    """
    unit, strata = list(unit), list(strata)
    part, whole = train_share
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in unit))
    # A stratum may be NULL; the key of a join may not, so it is taken as text.
    stratum = F.to_json(F.struct(*strata)) if strata else F.lit("")
    keys = list(dict.fromkeys([*strata, *unit]))
    units = frame.select(*keys).distinct().select(stratum.alias("group"), F.md5(text).alias("key"))
    cuts = keys_at(staged(units, "units"), {"cut": f"n * {part} div {whole}"})
    if strata:
        cuts = cuts.select(F.col("group").alias("__group"), F.col("key").alias("__cut"))
        sides = frame.withColumn("__group", stratum).join(cuts, "__group", "left").drop("__group")
    else:
        sides = frame.withColumn("__cut", cuts.agg(F.max("key")).scalar())
    return sides.withColumn(name, flag(F.coalesce(F.md5(text) <= F.col("__cut"), F.lit(False)))).drop("__cut")


def season_decay_weight(frame: DataFrame, decay: float = K.SEASON_DECAY, name: str = "weight") -> DataFrame:
    """Add a weight that falls with the seasons since the latest one of the frame."""
    latest = frame.agg(F.max("season")).scalar()
    return frame.withColumn(name, F.exp(F.lit(-decay) * (latest - F.col("season"))))


def balanced_class_weight(frame: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add rows / (classes * rows of the class) for a label of 0 and 1.

    The three counts are one value put into the plan, so the frame is read once for
    them. A join on the label would move half of all rows to one place.
    """
    is_one, is_zero = F.col(label) == 1, F.col(label) == 0
    counts = frame.agg(
        F.struct(
            F.count(label).alias("rows"),
            F.count(F.when(is_one, 1)).alias("ones"),
            (F.max(flag(is_one)) + F.max(flag(is_zero))).alias("classes"),
        ).alias("counts")
    ).scalar()
    rows, ones, classes = (counts[c] for c in ("rows", "ones", "classes"))
    same = F.when(F.col(label) == 1, ones).when(F.col(label) == 0, rows - ones)
    return frame.withColumn(name, F.try_divide(rows, classes * same))


def rows_per_innings(frame: DataFrame) -> DataFrame:
    """Rows of the frame that belong to the first and to the second innings."""
    return frame.agg(
        F.count(F.when(F.col("innings") == 1, 1)).alias("innings_1_rows"),
        F.count(F.when(F.col("innings") == 2, 1)).alias("innings_2_rows"),
    )
