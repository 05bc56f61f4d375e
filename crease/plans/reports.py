"""Registry of reports and indexes, and their export."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import rounded
from crease.operators import facts, indexes, reports, summaries
from crease.session import staged
from crease.sources.tables import table_paths, write_table


@dataclass(frozen=True)
class Report:
    """How to build a report from the stored tables, and the digits it is shown with."""

    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    digits: dict[str, int] = field(default_factory=dict)


REPORTS: dict[str, Report] = {
    "season_summary": Report(
        lambda t: reports.season_summary(t["matches"], t["deliveries"], t["innings"]),
        {"run_rate": 2, "avg_innings_score": 2},
    ),
    "toss_impact_by_season": Report(
        lambda t: reports.toss_impact_by_season(t["matches"]), {"toss_winner_win_pct": 2}
    ),
    "chasing_vs_defending": Report(
        lambda t: reports.chasing_vs_defending(t["matches"], t["innings"]), {"chasing_win_pct": 2}
    ),
    "venue_summary": Report(
        lambda t: reports.venue_summary(t["matches"], t["innings"]),
        {"avg_first_innings_score": 2, "toss_winner_win_pct": 2},
    ),
    "team_summary": Report(lambda t: reports.team_summary(t["matches"]), {"win_pct": 2}),
    "top_batters_by_phase": Report(
        lambda t: reports.top_batters_by_phase(t["deliveries"]), {"strike_rate": 2}
    ),
    "top_death_bowlers": Report(lambda t: reports.top_death_bowlers(t["deliveries"]), {"economy": 2}),
}

INDEXES: dict[str, Report] = {
    "player_impact_score": Report(
        lambda t: indexes.player_impact(t["deliveries"]),
        {
            "player_impact_score": 2,
            "batting_score": 2,
            "bowling_score": 2,
            "batting_strike_rate": 2,
            "batting_average": 2,
            "boundary_pct": 2,
            "bowling_economy": 2,
            "wickets_per_over": 3,
            "dot_ball_pct": 2,
        },
    ),
    "venue_par_score": Report(
        lambda t: indexes.venue_par_score(t["matches"], t["innings"]),
        {"venue_par_score": 2, "median_first_innings_score": 2, "chasing_win_pct": 2},
    ),
    "team_phase_strength": Report(
        lambda t: indexes.team_phase_strength(t["deliveries"]),
        {"run_rate": 2, "wickets_lost_per_innings": 2, "team_phase_strength_score": 2},
    ),
    "death_over_batting_index": Report(
        lambda t: indexes.death_batting_index(t["deliveries"]),
        {"death_batting_index": 2, "death_strike_rate": 2, "death_boundary_pct": 2},
    ),
    "death_over_bowling_index": Report(
        lambda t: indexes.death_bowling_index(t["deliveries"]),
        {
            "death_bowling_index": 2,
            "death_economy": 2,
            "death_wickets_per_over": 3,
            "death_dot_ball_pct": 2,
        },
    ),
}


def insights(tables: Mapping[str, DataFrame], min_team_matches: int = K.MIN_BEST_TEAM_MATCHES) -> DataFrame:
    """Findings of all reports. The balls are read once: their totals by batter, by bowler and by
    innings are stored, and all reports start from these."""
    matches, innings = staged(tables["matches"], "matches"), staged(tables["innings"], "innings")
    totals = staged(summaries.ball_totals(tables["deliveries"]), "ball-totals")
    by_batter, by_bowler, by_innings = (totals.filter(F.col("grain") == g) for g in ("batter", "bowler", "innings"))
    return facts.insight_facts(
        season=reports.season_summary(matches, by_innings, innings, ordered=False),
        toss=reports.toss_impact_by_season(matches, ordered=False),
        chasing=reports.chasing_vs_defending(matches, innings, ordered=False),
        venues=reports.venue_summary(matches, innings, ordered=False),
        teams=reports.team_summary(matches, ordered=False),
        phase_batters=reports.top_batters_by_phase(by_batter, ordered=False),
        death_bowlers=reports.top_death_bowlers(by_bowler),
        batting=summaries.batting_summary(by_batter, ordered=False),
        bowling=summaries.bowling_summary(by_bowler, ordered=False),
        phase_gaps=summaries.phase_gap(summaries.phase_summary(by_innings)),
        min_team_matches=min_team_matches,
    )


def build(name: str, tables: Mapping[str, DataFrame], display: bool = False) -> DataFrame:
    """A report by name; ``display`` rounds it."""
    report = REPORTS.get(name) or INDEXES[name]
    df = report.build(tables)
    return rounded(df, report.digits) if display else df


def export(
    tables: Mapping[str, DataFrame],
    folder: str,
    names: Mapping[str, Report] = {**REPORTS, **INDEXES},
    kind: str = "csv",
) -> dict[str, int]:
    """Write reports as shown and return the rows of each, counted while writing."""
    paths = table_paths(folder, names, kind)
    return {name: write_table(build(name, tables, display=True), paths[name], kind) for name in names}
