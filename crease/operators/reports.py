"""Season, toss, chase, venue, team and phase reports.

Every report is a ``DataFrame -> DataFrame`` function. Results are not rounded; see
:data:`crease.plans.reports.REPORTS` for the digits used on export. Missing text is
NULL in all input tables. ``ordered=False`` leaves out the final sort, for reports
that feed another operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import count_if, in_order, present, ratio, runs_conceded, total


def season_summary(
    matches: DataFrame, deliveries: DataFrame, innings: DataFrame, exact: bool = True, ordered: bool = True
) -> DataFrame:
    """Matches, players used, runs, wickets and rates per season.

    ``exact=False`` repeats what a plain join of matches, deliveries and innings on
    the match gives: every ball counts once per innings of its match, and every
    innings score once per ball. The multiples are applied to per-match totals, so
    the joined rows are never built.

    The balls are read once: they are added up per match, role and player, and the few
    rows that leaves are summed and counted per season.
    """
    per_match = innings.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("innings_count"),
        total("runs").alias("score_sum"),
        F.count("runs").alias("score_count"),
    )
    header = matches.select("match_id", "season").join(per_match, "match_id", "left")

    # A ball is a row of its batter, which carries the sums, and one of its bowler.
    def person(role: str, player: str, *values: Column) -> Column:
        names = ("balls", "runs", "wickets", "legal")
        cells = (v.cast("bigint").alias(n) for n, v in zip(names, values))
        return F.struct(F.lit(role).alias("role"), F.col(player).alias("player"), *cells)

    batter = person("batter", "batter", F.lit(1), *map(F.col, ("total_runs", "wicket_count", "is_legal_ball")))
    bowler = person("bowler", "bowler", *[F.lit(None)] * 4)
    people = (
        deliveries.select("match_id", F.inline(F.array(batter, bowler)))
        .groupBy("match_id", "role", "player")
        .agg(*(total(c).alias(c) for c in ("balls", "runs", "wickets", "legal")))
    )

    factor = F.lit(1) if exact else F.greatest(F.coalesce(F.col("innings_count"), F.lit(1)), F.lit(1))
    # Rows that carry the innings scores: one per match, or one per ball of it.
    if exact:
        weight = F.lit(None).cast("bigint")
        match_weight = F.lit(1).cast("bigint")
    else:
        weight = F.when(F.col("role") == "batter", F.col("balls")).when(F.col("role").isNull(), F.lit(1))
        match_weight = F.lit(None).cast("bigint")

    def row(role, player, matches_, weight_, carry):
        return [
            "season",
            role.alias("role"),
            player.alias("player"),
            matches_.cast("bigint").alias("matches"),
            *((F.col(c) * factor if carry else F.lit(None)).cast("bigint").alias(c) for c in ("runs", "wickets", "legal")),
            (F.col("score_sum") * weight_).alias("score_sum"),
            (F.col("score_count") * weight_).alias("score_count"),
        ]

    as_people = header.join(people, "match_id", "left").select(
        row(F.col("role"), F.col("player"), F.lit(None), weight, True)
    )
    as_matches = header.select(row(F.lit("match"), F.lit(None), F.lit(1), match_weight, False))
    summed = ("matches", "runs", "wickets", "legal", "score_sum", "score_count")
    per_player = (
        as_people.unionByName(as_matches)
        .groupBy("season", "role", "player")
        .agg(*(total(c).alias(c) for c in summed))
    )
    known = F.col("player").isNotNull()
    report = (
        per_player.groupBy("season")
        .agg(
            count_if((F.col("role") == "batter") & known).alias("batters_used"),
            count_if((F.col("role") == "bowler") & known).alias("bowlers_used"),
            *(total(c).alias(c) for c in summed),
        )
        .select(
            "season",
            "matches",
            "batters_used",
            "bowlers_used",
            F.col("runs").alias("total_runs"),
            F.col("wickets").alias("total_wickets"),
            ratio("runs", "legal", 6).alias("run_rate"),
            ratio("score_sum", "score_count").alias("avg_innings_score"),
        )
    )
    return in_order(report, ordered, "season")


def toss_impact_by_season(matches: DataFrame, ordered: bool = True) -> DataFrame:
    """How often the side that won the toss won the match, per season."""
    report = (
        matches.filter(present("winner", "toss_winner"))
        .groupBy("season")
        .agg(
            F.count(F.lit(1)).alias("completed_matches"),
            count_if(F.col("toss_winner") == F.col("winner")).alias("toss_winner_wins"),
        )
        .withColumn("toss_winner_win_pct", ratio("toss_winner_wins", "completed_matches", 100))
    )
    return in_order(report, ordered, "season")


def innings_order(innings: DataFrame) -> DataFrame:
    """Side batting first and side batting second, per match."""
    return innings.groupBy("match_id").agg(
        F.max(F.when(F.col("innings") == 1, F.col("batting_team"))).alias("first_batting_team"),
        F.max(F.when(F.col("innings") == 2, F.col("batting_team"))).alias("chasing_team"),
    )


def chasing_vs_defending(matches: DataFrame, innings: DataFrame, ordered: bool = True) -> DataFrame:
    """Wins batting second and batting first per season, decided matches with a chase."""
    order = innings_order(innings.filter(F.col("innings").isin(1, 2)))
    report = (
        matches.filter(present("winner"))
        .join(order.filter(F.col("chasing_team").isNotNull()), "match_id")
        .groupBy("season")
        .agg(
            F.count(F.lit(1)).alias("completed_matches"),
            count_if(F.col("winner") == F.col("chasing_team")).alias("chasing_wins"),
            count_if(F.col("winner") == F.col("first_batting_team")).alias("defending_wins"),
        )
        .withColumn("chasing_win_pct", ratio("chasing_wins", "completed_matches", 100))
    )
    return in_order(report, ordered, "season")


def with_defending_pct(chasing: DataFrame) -> DataFrame:
    """Add the share of matches won by the side batting first."""
    return chasing.withColumn("defending_win_pct", ratio("defending_wins", "completed_matches", 100))


def venue_summary(
    matches: DataFrame,
    innings: DataFrame,
    min_matches: int = K.MIN_VENUE_MATCHES,
    ordered: bool = True,
) -> DataFrame:
    """First-innings average and toss effect per ground, decided matches only."""
    first = innings.filter(F.col("innings") == 1).select("match_id", F.col("runs").alias("first_runs"))
    report = (
        matches.filter(present("winner"))
        .join(first, "match_id")
        .groupBy("venue", "city")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.avg("first_runs").alias("avg_first_innings_score"),
            count_if(F.col("winner") == F.col("toss_winner")).alias("toss_wins"),
        )
        .filter(F.col("matches") >= min_matches)
        .select(
            "venue",
            "city",
            "matches",
            "avg_first_innings_score",
            ratio("toss_wins", "matches", 100).alias("toss_winner_win_pct"),
        )
    )
    return in_order(report, ordered, F.desc("avg_first_innings_score"), F.desc("matches"), "venue", "city")


def team_matches(matches: DataFrame) -> DataFrame:
    """Each match once per side, from one scan."""
    return matches.select(
        "match_id", "season", F.explode(F.array("team_1", "team_2")).alias("team"), "winner"
    )


def team_summary(matches: DataFrame, ordered: bool = True) -> DataFrame:
    """Matches, wins and win share per team; matches with no winner count as not won."""
    report = (
        team_matches(matches)
        .filter(present("team"))
        .groupBy("team")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            count_if(F.col("team") == F.col("winner")).alias("wins"),
        )
        .select(
            "team",
            "matches",
            "wins",
            (F.col("matches") - F.col("wins")).alias("losses_or_no_results"),
            ratio("wins", "matches", 100).alias("win_pct"),
        )
    )
    return in_order(report, ordered, F.desc("win_pct"), F.desc("wins"), "team")


def top_batters_by_phase(deliveries: DataFrame, top: int = 10, ordered: bool = True) -> DataFrame:
    """Highest run scorers of each phase."""
    place = F.row_number().over(W.partitionBy("phase").orderBy(F.desc("runs"), "batter"))
    report = (
        deliveries.filter(present("batter") & F.col("phase").isin(*K.PHASES))
        .groupBy("phase", "batter")
        .agg(total("batter_runs").alias("runs"), total("is_legal_ball").alias("balls"))
        .withColumn("place", place)
        .filter(F.col("place") <= top)
        .select("phase", "batter", "runs", "balls", ratio("runs", "balls", 100).alias("strike_rate"))
    )
    return in_order(report, ordered, "phase", F.desc("runs"), "batter")


def top_death_bowlers(
    deliveries: DataFrame, min_balls: int = K.MIN_DEATH_BALLS, top: int = 25
) -> DataFrame:
    """Most wickets in the death overs, cheapest first among equals."""
    return (
        deliveries.filter((F.col("phase") == "Death") & present("bowler"))
        .groupBy("bowler")
        .agg(
            total("bowler_wickets").alias("wickets"),
            total("is_legal_ball").alias("balls"),
            total(runs_conceded()).alias("runs_conceded"),
        )
        .filter(F.col("balls") >= min_balls)
        .withColumn("economy", ratio("runs_conceded", "balls", 6))
        .orderBy(F.desc("wickets"), F.asc("economy"), "bowler")
        .limit(top)
    )
