"""Composite indexes of players, teams and grounds, built from percentile scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import (
    count_if,
    dismissals_of,
    in_order,
    is_boundary,
    is_dot,
    present,
    runs_conceded,
    safe_rate,
    total,
)
from crease.operators.percentile import percentile_scores

BATTING_TOTALS = ("batting_runs", "batting_balls", "batting_boundaries", "batting_dismissals")
BOWLING_TOTALS = ("bowling_wickets", "bowling_balls", "bowling_runs", "bowling_dots")


def player_totals(deliveries: DataFrame) -> DataFrame:
    """Batting and bowling totals per player; 0 in a discipline never taken part in.

    Two aggregates with a short union of their results, and one more sum by player,
    in place of a full outer join. Each reads its own columns and forms partial sums
    before the shuffle.
    """
    batting = {
        "batting_runs": F.col("batter_runs"),
        "batting_balls": F.col("is_legal_ball"),
        "batting_boundaries": is_boundary(),
        "batting_dismissals": dismissals_of("batter"),
    }
    bowling = {
        "bowling_wickets": F.col("bowler_wickets"),
        "bowling_balls": F.col("is_legal_ball"),
        "bowling_runs": runs_conceded(),
        "bowling_dots": is_dot(),
    }
    names = (*BATTING_TOTALS, *BOWLING_TOTALS)

    def one_role(player: str, measures: dict[str, Column]) -> DataFrame:
        sums = (
            deliveries.filter(present(player))
            .groupBy(F.col(player).alias("player"))
            .agg(*(total(m).alias(n) for n, m in measures.items()))
        )
        none = F.lit(0).cast("bigint")
        return sums.select("player", *(F.col(n) if n in measures else none.alias(n) for n in names))

    return (
        one_role("batter", batting)
        .unionByName(one_role("bowler", bowling))
        .groupBy("player")
        .agg(*(total(n).alias(n) for n in names))
    )


def batting_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "batting_strike_rate": safe_rate("batting_runs", "batting_balls", 100),
            "batting_average": safe_rate("batting_runs", "batting_dismissals"),
            "boundary_pct": safe_rate("batting_boundaries", "batting_balls", 100),
        }
    )


def bowling_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "bowling_economy": safe_rate("bowling_runs", "bowling_balls", 6),
            "wickets_per_over": safe_rate("bowling_wickets", "bowling_balls", 6),
            "dot_ball_pct": safe_rate("bowling_dots", "bowling_balls", 100),
        }
    )


def _bowling_score(wickets: str, economy: str, dots: str) -> Column:
    weight = K.BOWLING_WEIGHTS
    return (
        F.lit(weight["wicket_rate"]) * F.col(wickets)
        + F.lit(weight["economy"]) * F.col(economy)
        + F.lit(weight["dot"]) * F.col(dots)
    )


def player_impact(
    deliveries: DataFrame,
    min_bat_balls: int = K.MIN_IMPACT_BALLS,
    min_bowl_balls: int = K.MIN_IMPACT_BALLS,
    ordered: bool = True,
) -> DataFrame:
    """Impact score and role of every player; only eligible ones enter the pools."""
    players = bowling_rates(batting_rates(player_totals(deliveries)))
    bats = F.col("batting_balls") >= min_bat_balls
    bowls = F.col("bowling_balls") >= min_bowl_balls
    scores = percentile_scores(
        players,
        players.columns,
        {
            "p_strike_rate": (F.col("batting_strike_rate"), bats),
            "p_average": (F.col("batting_average"), bats),
            "p_boundary": (F.col("boundary_pct"), bats),
            "p_wickets": (F.col("wickets_per_over"), bowls),
            "p_economy": (-F.col("bowling_economy"), bowls),
            "p_dots": (F.col("dot_ball_pct"), bowls),
        },
    )
    weight = K.BATTING_WEIGHTS
    batting_score = (
        F.lit(weight["strike_rate"]) * F.col("p_strike_rate")
        + F.lit(weight["average"]) * F.col("p_average")
        + F.lit(weight["boundary"]) * F.col("p_boundary")
    )
    bat, bowl = F.col("batting_score"), F.col("bowling_score")
    role = (
        F.when(bat >= bowl * F.lit(K.ROLE_DOMINANCE), "Batter")
        .when(bowl >= bat * F.lit(K.ROLE_DOMINANCE), "Bowler")
        .otherwise("All-rounder")
    )
    report = (
        scores.withColumns(
            {
                "batting_score": batting_score,
                "bowling_score": _bowling_score("p_wickets", "p_economy", "p_dots"),
            }
        )
        .select(
            "player",
            role.alias("role_signal"),
            F.greatest(bat, bowl, (bat + bowl) / 2).alias("player_impact_score"),
            "batting_score",
            "bowling_score",
            (bats | bowls).cast("int").alias("impact_eligible"),
            "batting_runs",
            "batting_balls",
            "batting_strike_rate",
            "batting_average",
            "boundary_pct",
            "bowling_wickets",
            "bowling_balls",
            F.when(F.col("bowling_balls") > 0, F.col("bowling_economy")).alias("bowling_economy"),
            "wickets_per_over",
            "dot_ball_pct",
        )
    )
    return in_order(report, ordered, F.desc("impact_eligible"), F.desc("player_impact_score"), "player")


def death_batting_totals(deliveries: DataFrame, min_balls: int = K.MIN_DEATH_BALLS) -> DataFrame:
    return (
        deliveries.filter((F.col("phase") == "Death") & present("batter"))
        .groupBy(F.col("batter").alias("player"))
        .agg(
            total("batter_runs").alias("death_runs"),
            total("is_legal_ball").alias("death_balls"),
            total(is_boundary()).alias("boundaries"),
        )
        .filter(F.col("death_balls") >= min_balls)
        .select(
            "player",
            "death_runs",
            "death_balls",
            safe_rate("death_runs", "death_balls", 100).alias("death_strike_rate"),
            safe_rate("boundaries", "death_balls", 100).alias("death_boundary_pct"),
        )
    )


def death_batting_index(deliveries: DataFrame, min_balls: int = K.MIN_DEATH_BALLS) -> DataFrame:
    """Death-over batting index among batters with enough death balls."""
    players = death_batting_totals(deliveries, min_balls)
    scores = percentile_scores(
        players,
        players.columns,
        {
            "p_strike_rate": (F.col("death_strike_rate"), F.lit(True)),
            "p_boundary": (F.col("death_boundary_pct"), F.lit(True)),
        },
    )
    weight = K.DEATH_BATTING_WEIGHTS
    index = F.lit(weight["strike_rate"]) * F.col("p_strike_rate") + F.lit(weight["boundary"]) * F.col("p_boundary")
    return scores.select(
        "player",
        index.alias("death_batting_index"),
        "death_runs",
        "death_balls",
        "death_strike_rate",
        "death_boundary_pct",
    ).orderBy(F.desc("death_batting_index"), "player")


def death_bowling_totals(deliveries: DataFrame, min_balls: int = K.MIN_DEATH_BALLS) -> DataFrame:
    return (
        deliveries.filter((F.col("phase") == "Death") & present("bowler"))
        .groupBy(F.col("bowler").alias("player"))
        .agg(
            total("bowler_wickets").alias("death_wickets"),
            total("is_legal_ball").alias("death_balls"),
            total(runs_conceded()).alias("death_runs_conceded"),
            total(is_dot()).alias("dots"),
        )
        .filter(F.col("death_balls") >= min_balls)
        .select(
            "player",
            "death_wickets",
            "death_balls",
            "death_runs_conceded",
            safe_rate("death_runs_conceded", "death_balls", 6).alias("death_economy"),
            safe_rate("death_wickets", "death_balls", 6).alias("death_wickets_per_over"),
            safe_rate("dots", "death_balls", 100).alias("death_dot_ball_pct"),
        )
    )


def death_bowling_index(deliveries: DataFrame, min_balls: int = K.MIN_DEATH_BALLS) -> DataFrame:
    """Death-over bowling index among bowlers with enough death balls."""
    players = death_bowling_totals(deliveries, min_balls)
    everyone = F.lit(True)
    scores = percentile_scores(
        players,
        players.columns,
        {
            "p_wickets": (F.col("death_wickets_per_over"), everyone),
            "p_economy": (-F.col("death_economy"), everyone),
            "p_dots": (F.col("death_dot_ball_pct"), everyone),
        },
    )
    return scores.select(
        "player",
        _bowling_score("p_wickets", "p_economy", "p_dots").alias("death_bowling_index"),
        "death_wickets",
        "death_balls",
        "death_runs_conceded",
        "death_economy",
        "death_wickets_per_over",
        "death_dot_ball_pct",
    ).orderBy(F.desc("death_bowling_index"), "player")


def team_phase_totals(deliveries: DataFrame, min_innings: int = K.MIN_PHASE_INNINGS) -> DataFrame:
    """Runs, balls, wickets and innings per team and phase.

    The balls of an innings are added up first; counting those rows gives the number
    of innings without a distinct count.
    """
    return (
        deliveries.filter(F.col("phase").isin(*K.PHASES) & present("batting_team"))
        .groupBy(F.col("batting_team").alias("team"), "phase", "match_id", "innings")
        .agg(
            total("total_runs").alias("runs"),
            total("is_legal_ball").alias("balls"),
            total("wicket_count").alias("wickets"),
        )
        .groupBy("team", "phase")
        .agg(
            F.count(F.lit(1)).alias("innings"),
            total("runs").alias("runs"),
            total("balls").alias("balls"),
            total("wickets").alias("wickets"),
        )
        .filter(F.col("innings") >= min_innings)
    )


def team_phase_strength(
    deliveries: DataFrame, min_innings: int = K.MIN_PHASE_INNINGS, ordered: bool = True
) -> DataFrame:
    """Percentile of a team's run rate among the teams of the same phase."""
    teams = team_phase_totals(deliveries, min_innings).select(
        "team",
        "phase",
        "innings",
        "runs",
        safe_rate("runs", "balls", 6).alias("run_rate"),
        safe_rate("wickets", "innings").alias("wickets_lost_per_innings"),
    )
    scores = percentile_scores(
        teams,
        teams.columns,
        {"team_phase_strength_score": (F.col("run_rate"), F.lit(True))},
        within=["phase"],
    )
    return in_order(scores, ordered, "phase", F.desc("team_phase_strength_score"), "team")


def phase_strength_pivot(strength: DataFrame) -> DataFrame:
    """Team by phase table of mean strength scores."""
    return (
        strength.groupBy("team")
        .pivot("phase", list(K.PHASES))
        .agg(F.avg("team_phase_strength_score"))
    )


def venue_matches(matches: DataFrame, innings: DataFrame) -> DataFrame:
    """Per match at a known ground: first-innings runs and the side batting second."""
    per_match = (
        innings.filter(F.col("innings").isin(1, 2))
        .groupBy("match_id")
        .agg(
            F.max(F.when(F.col("innings") == 1, F.col("runs"))).alias("first_runs"),
            F.max(F.when(F.col("innings") == 2, F.col("batting_team"))).alias("second_team"),
        )
    )
    return matches.filter(present("venue")).select("match_id", "venue", "city", "winner").join(per_match, "match_id")


_CHASED = "winner IS NOT NULL AND second_team IS NOT NULL"


def _score_measures(approximate_median: bool) -> list[Column]:
    # The exact median keeps one counter per distinct score of a ground, not per match.
    median = F.percentile_approx("first_runs", 0.5, 10000) if approximate_median else F.median("first_runs")
    return [
        F.count("first_runs").alias("matches"),
        F.avg("first_runs").alias("venue_par_score"),
        median.cast("double").alias("median_first_innings_score"),
        F.max("first_runs").alias("highest_first_innings_score"),
        F.min("first_runs").alias("lowest_first_innings_score"),
    ]


def _chase_measures() -> list[Column]:
    chased = F.expr(_CHASED)
    return [
        count_if(chased).alias("chase_matches"),
        count_if(chased & (F.col("winner") == F.col("second_team"))).alias("chasing_wins"),
    ]


def venue_first_innings(
    matches: DataFrame,
    innings: DataFrame,
    min_matches: int = K.MIN_VENUE_MATCHES,
    approximate_median: bool = False,
) -> DataFrame:
    """First-innings score statistics per ground, undecided matches included."""
    return (
        venue_matches(matches, innings)
        .groupBy("venue", "city")
        .agg(*_score_measures(approximate_median))
        .filter(F.col("matches") >= min_matches)
    )


def venue_chase_record(matches: DataFrame, innings: DataFrame) -> DataFrame:
    """Decided matches with a second innings per ground, and how many the chase won."""
    return (
        venue_matches(matches, innings)
        .filter(_CHASED)
        .groupBy("venue", "city")
        .agg(*_chase_measures())
    )


def venue_par_score(
    matches: DataFrame,
    innings: DataFrame,
    min_matches: int = K.MIN_VENUE_MATCHES,
    approximate_median: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Score statistics and chase record per ground in one aggregate.

    Grouping keeps a missing city as a group of its own, so no null-safe join of two
    aggregates is needed; a ground with no chase gets 0.
    """
    report = (
        venue_matches(matches, innings)
        .groupBy("venue", "city")
        .agg(*_score_measures(approximate_median), *_chase_measures())
        .filter(F.col("matches") >= min_matches)
        .withColumn("chasing_win_pct", safe_rate("chasing_wins", "chase_matches", 100))
        .drop("chase_matches", "chasing_wins")
    )
    return in_order(report, ordered, F.desc("venue_par_score"), "venue", "city")
