"""Headline findings and page figures, as tables of (name, subject, value)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import short_name


def _number(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.cast("double"), F.lit(0.0))


def _first(where: Column | None, value: str, subject: str | Column, rank: Sequence[Column]) -> Column:
    """(subject, value) of the row that comes first by ``rank``, as an aggregate."""
    subject = F.col(subject) if isinstance(subject, str) else subject
    pair = F.struct(subject.cast("string").alias("subject"), F.col(value).cast("double").alias("value"))
    order = F.struct(*rank)
    if where is not None:
        order = F.when(where, order)
    return F.min_by(pair, order)


def highest(value, subject, ties=(), where=None) -> Column:
    return _first(where, value, subject, [-_number(value), *_columns(ties)])


def lowest(value, subject, ties=(), where=None) -> Column:
    return _first(where, value, subject, [_number(value), *_columns(ties)])


def figure(value: Column) -> Column:
    """A plain number without a subject."""
    return F.struct(F.lit(None).cast("string").alias("subject"), value.cast("double").alias("value"))


def _columns(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def fact_rows(report: DataFrame, facts: dict[str, Column], label: str = "fact") -> DataFrame:
    """One row per fact; all facts of a report come from a single aggregate over it."""
    row = report.agg(*(fact.alias(name) for name, fact in facts.items()))
    cells = [
        F.struct(F.lit(name).alias(label), F.col(f"{name}.subject"), F.col(f"{name}.value"))
        for name in facts
    ]
    return row.select(F.inline(F.array(*cells)))


def insight_facts(
    season: DataFrame,
    toss: DataFrame,
    chasing: DataFrame,
    venues: DataFrame,
    teams: DataFrame,
    phase_batters: DataFrame,
    death_bowlers: DataFrame,
    batting: DataFrame,
    bowling: DataFrame,
    phase_gaps: DataFrame,
    min_team_matches: int = K.MIN_BEST_TEAM_MATCHES,
) -> DataFrame:
    """Findings of all reports: fact, subject, value. Ties go to the first report row."""
    by_season = ["season"]
    gap_order = F.array_position(F.array(*(F.lit(p) for p in K.PHASES)), F.col("phase"))
    strongest = {"where": None, "ties": [gap_order]}
    parts = [
        fact_rows(
            season,
            {
                "first_season": figure(F.min("season")),
                "last_season": figure(F.max("season")),
                "total_matches": figure(F.sum("matches")),
                "total_runs": figure(F.sum("total_runs")),
                "total_wickets": figure(F.sum("total_wickets")),
                "highest_run_rate_season": highest("run_rate", "season", by_season),
                "lowest_run_rate_season": lowest("run_rate", "season", by_season),
            },
        ),
        fact_rows(
            phase_gaps,
            {
                "strongest_phase_gap": highest("gap", F.lower("phase"), **strongest),
                "strongest_phase_winner_avg": _first(
                    None, "winner_avg", F.lower("phase"), [-_number("gap"), gap_order]
                ),
                "strongest_phase_loser_avg": _first(
                    None, "loser_avg", F.lower("phase"), [-_number("gap"), gap_order]
                ),
            },
        ),
        fact_rows(
            toss,
            {
                "best_toss_season": highest("toss_winner_win_pct", "season", by_season),
                "worst_toss_season": lowest("toss_winner_win_pct", "season", by_season),
            },
        ),
        fact_rows(
            chasing,
            {
                "best_chasing_season": highest("chasing_win_pct", "season", by_season),
                "worst_chasing_season": lowest("chasing_win_pct", "season", by_season),
            },
        ),
        fact_rows(
            teams,
            {
                "best_team": highest(
                    "win_pct", "team", [-F.col("wins"), "team"], F.col("matches") >= min_team_matches
                )
            },
        ),
        fact_rows(
            venues,
            {
                "highest_scoring_venue": highest(
                    "avg_first_innings_score", "venue", [-F.col("matches"), "venue", "city"]
                ),
                "best_toss_venue": highest(
                    "toss_winner_win_pct",
                    "venue",
                    [-_number("avg_first_innings_score"), -F.col("matches"), "venue", "city"],
                ),
            },
        ),
        fact_rows(batting, {"top_batter": highest("runs", "player", ["player"])}),
        fact_rows(bowling, {"top_bowler": highest("wickets", "player", ["player"])}),
        fact_rows(
            phase_batters,
            {
                "fastest_death_batter": highest(
                    "strike_rate", "batter", [-F.col("runs"), "batter"], F.col("phase") == "Death"
                ),
                "top_powerplay_batter": highest("runs", "batter", ["batter"], F.col("phase") == "Powerplay"),
            },
        ),
        fact_rows(
            death_bowlers,
            {"top_death_bowler": highest("wickets", "bowler", [_number("economy"), "bowler"])},
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def season_figures(season: DataFrame) -> DataFrame:
    return fact_rows(
        season,
        {
            "seasons": figure(F.count_distinct("season")),
            "total_matches": figure(F.sum("matches")),
            "total_runs": figure(F.sum("total_runs")),
            "total_wickets": figure(F.sum("total_wickets")),
        },
        "figure",
    )


def team_figures(teams: DataFrame, toss: DataFrame) -> DataFrame:
    return fact_rows(
        teams,
        {
            "highest_win_pct": highest("win_pct", "team", [-F.col("wins"), "team"]),
            "most_matches": highest("matches", "team", [-_number("win_pct"), -F.col("wins"), "team"]),
        },
        "figure",
    ).unionByName(
        fact_rows(toss, {"average_toss_win_pct": figure(F.avg("toss_winner_win_pct"))}, "figure")
    )


def player_figures(impact: DataFrame) -> DataFrame:
    """Best eligible player, and best of each role; the best one if a role has none."""
    eligible = F.col("impact_eligible") == 1

    def best(value: str, role: str | None) -> Column:
        other = F.lit(False) if role is None else F.col("role_signal") != role
        return _first(eligible, value, "player", [other, -_number("player_impact_score"), F.col("player")])

    return fact_rows(
        impact,
        {
            "top_impact_player": best("player_impact_score", None),
            "top_batter": best("batting_strike_rate", "Batter"),
            "top_bowler": best("bowling_economy", "Bowler"),
        },
        "figure",
    )


def venue_figures(venues: DataFrame, par: DataFrame) -> DataFrame:
    return fact_rows(
        venues,
        {
            "highest_scoring_ground": highest(
                "avg_first_innings_score", short_name("venue"), [-F.col("matches"), "venue", "city"]
            )
        },
        "figure",
    ).unionByName(
        fact_rows(
            par,
            {
                "best_ground_for_chasing": highest(
                    "chasing_win_pct", short_name("venue"), [-_number("venue_par_score"), "venue", "city"]
                ),
                "venues_tracked": figure(F.count(F.lit(1))),
            },
            "figure",
        )
    )
