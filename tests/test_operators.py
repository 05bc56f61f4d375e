"""Hand-made cases with results worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F
from conftest import BALL_SCHEMA, INNINGS_SCHEMA, MATCH_SCHEMA, ball, rows  # noqa: F401

from crease.operators import checkpoints, features, indexes, matchups, reports, selections, summaries


# --- checkpoints ----------------------------------------------------------

def over_of(n, over=0, start=1, **values):
    return [ball(over=over, ball_in_over=start + i, **values) for i in range(n)]


def test_illegal_ball_after_the_over_repeats_it(balls_of):
    balls = over_of(6, batter_runs=1) + [
        ball(over=1, ball_in_over=1, is_legal_ball=0, wides=1, total_runs=1),
        *over_of(6, over=1, start=2, batter_runs=2),
        *over_of(3, over=2, batter_runs=1),
    ]
    found = rows(checkpoints.over_checkpoints(balls_of(balls)))
    found.sort(key=lambda r: r["current_score"])
    assert [(r["over_number"], r["current_score"], r["last_over_runs"], r["balls_bowled"]) for r in found] == [
        (1, 6, 6, 6),
        (1, 7, 1, 6),
        (2, 19, 12, 12),
    ]
    assert found[0]["overs_remaining"] == 19 and found[0]["current_run_rate"] == 6.0
    last = rows(checkpoints.over_checkpoints(balls_of(balls), dedupe="last"))
    assert sorted((r["over_number"], r["last_over_runs"]) for r in last) == [(1, 7), (2, 12)]


def test_checkpoints_skip_undecided_matches(balls_of):
    assert checkpoints.over_checkpoints(balls_of(over_of(6, winner=None))).count() == 0


def test_overs_past_512_are_one_sequence(balls_of):
    balls = [ball(over=o, ball_in_over=b, batter_runs=1) for o in range(1100) for b in range(1, 7)]
    found = rows(checkpoints.over_checkpoints(balls_of(balls)))
    assert len(found) == 1100
    assert all(r["current_score"] == 6 * r["over_number"] and r["last_over_runs"] == 6 for r in found)


def test_target_is_one_more_and_only_in_the_chase(spark, balls_of):
    balls = over_of(6, batter_runs=1) + over_of(6, innings=2, batter_runs=2)
    innings = spark.createDataFrame(
        [("m1", 2010, 1, "A", "A", 6, 0, 6), ("m1", 2010, 2, "B", "A", 12, 0, 6)], INNINGS_SCHEMA
    )
    found = {r["innings"]: r for r in rows(checkpoints.checkpoint_frame(balls_of(balls), innings))}
    assert (found[1]["target"], found[1]["runs_required"], found[1]["is_chase"]) == (None, None, 0)
    assert (found[2]["target"], found[2]["runs_required"], found[2]["is_chase"]) == (7, -5, 1)
    assert found[2]["required_run_rate"] == pytest.approx(-5 * 6 / 114)
    assert (found[1]["batting_team_won"], found[2]["batting_team_won"]) == (1, 0)


# --- reports --------------------------------------------------------------

def a_match(match_id, winner="A", toss="A", city="C", venue="V", season=2010):
    return (match_id, season, venue, city, "A", "B", winner, toss)


def two_innings(match_id, first=100, second=90, winner="A"):
    return [
        (match_id, 2010, 1, "A", winner, first, 5, 120),
        (match_id, 2010, 2, "B", winner, second, 5, 120),
    ]


def test_undecided_and_one_innings_matches(spark):
    matches = spark.createDataFrame(
        [a_match("m1"), a_match("m2", winner=None), a_match("m3", winner="B")], MATCH_SCHEMA
    )
    innings = spark.createDataFrame(
        two_innings("m1") + two_innings("m2", winner=None) + two_innings("m3", winner="B")[:1], INNINGS_SCHEMA
    )
    assert rows(reports.toss_impact_by_season(matches))[0]["completed_matches"] == 2
    chasing = rows(reports.chasing_vs_defending(matches, innings))[0]
    assert (chasing["completed_matches"], chasing["chasing_wins"], chasing["defending_wins"]) == (1, 0, 1)
    teams = {r["team"]: r for r in rows(reports.team_summary(matches))}
    assert (teams["A"]["matches"], teams["A"]["wins"], teams["A"]["losses_or_no_results"]) == (3, 1, 2)


def test_season_summary_both_ways(spark, balls_of):
    matches = spark.createDataFrame([a_match("m1"), a_match("m2")], MATCH_SCHEMA)
    innings = spark.createDataFrame(two_innings("m1", 100, 50), INNINGS_SCHEMA)
    balls = balls_of(over_of(6, batter_runs=2) + over_of(3, innings=2, batter_runs=1, batter="b2", bowler=None))
    exact = rows(reports.season_summary(matches, balls, innings))[0]
    assert (exact["matches"], exact["batters_used"], exact["bowlers_used"]) == (2, 2, 1)
    assert (exact["total_runs"], exact["run_rate"], exact["avg_innings_score"]) == (15, 10.0, 75.0)
    joined = rows(reports.season_summary(matches, balls, innings, exact=False))[0]
    assert (joined["total_runs"], joined["run_rate"], joined["avg_innings_score"]) == (30, 10.0, 75.0)


def test_missing_city_is_a_group_of_its_own(spark):
    names = [f"m{i}" for i in range(10)]
    matches = spark.createDataFrame(
        [a_match(n, city=None if i < 5 else "C", winner="B" if i < 2 else "A") for i, n in enumerate(names)],
        MATCH_SCHEMA,
    )
    scores = [10, 30, 20, 40, 50, 1, 2, 3, 4, 6]
    innings = spark.createDataFrame(
        [row for n, s in zip(names, scores) for row in two_innings(n, first=s)], INNINGS_SCHEMA
    )
    par = {r["city"]: r for r in rows(indexes.venue_par_score(matches, innings))}
    assert (par[None]["median_first_innings_score"], par[None]["chasing_win_pct"]) == (30.0, 40.0)
    assert (par["C"]["median_first_innings_score"], par["C"]["chasing_win_pct"]) == (3.0, 0.0)
    assert {r["city"]: r["matches"] for r in rows(reports.venue_summary(matches, innings))} == {None: 5, "C": 5}
    assert indexes.venue_par_score(matches, innings, min_matches=6).count() == 0


def test_even_group_median_is_halfway(spark):
    names = [f"m{i}" for i in range(6)]
    matches = spark.createDataFrame([a_match(n) for n in names], MATCH_SCHEMA)
    innings = spark.createDataFrame(
        [row for n, s in zip(names, [5, 1, 9, 3, 7, 20]) for row in two_innings(n, first=s)], INNINGS_SCHEMA
    )
    assert rows(indexes.venue_par_score(matches, innings))[0]["median_first_innings_score"] == 6.0


def test_ties_at_the_last_place_go_by_name(balls_of):
    balls = [ball(batter=f"p{i:02d}", batter_runs=4) for i in range(12)]
    found = rows(reports.top_batters_by_phase(balls_of(balls)))
    assert [r["batter"] for r in found] == [f"p{i:02d}" for i in range(10)]


def test_phase_grid_is_complete(balls_of):
    found = rows(summaries.phase_summary(balls_of(over_of(6, batter_runs=1))))
    assert len(found) == 6
    cells = {(r["batting_result"], r["phase"]): (r["runs"], r["innings"], r["avg_runs"]) for r in found}
    assert cells["Winner", "Powerplay"] == (6, 1, 6.0)
    assert cells["Winner", "Death"] == (0, 0, None)


def test_an_empty_economy_is_null(balls_of):
    found = rows(summaries.bowling_summary(balls_of([ball(is_legal_ball=0, wides=1, total_runs=1)])))
    assert found == [{"player": "bowl", "wickets": 0, "balls": 0, "runs_conceded": 1, "economy": None}]


# --- indexes --------------------------------------------------------------

def test_only_the_striker_is_charged_with_a_dismissal(balls_of):
    balls = [
        ball(players_out="other", wicket_count=1),
        ball(players_out="bat", wicket_count=1),
        ball(players_out="bat; other", wicket_count=2),
    ]
    totals = {r["player"]: r for r in rows(indexes.player_totals(balls_of(balls)))}
    assert totals["bat"]["batting_dismissals"] == 2
    assert "other" not in totals
    assert (totals["bowl"]["batting_balls"], totals["bowl"]["bowling_balls"], totals["bowl"]["bowling_dots"]) == (0, 3, 3)


@pytest.mark.parametrize("balls_faced, eligible", [(6, 1), (5, 0)])
def test_eligibility_starts_at_the_threshold(balls_of, balls_faced, eligible):
    found = indexes.player_impact(balls_of(over_of(balls_faced, batter_runs=1)), 6, 100)
    impact = {r["player"]: r for r in rows(found)}
    assert impact["bat"]["impact_eligible"] == eligible
    assert impact["bat"]["player_impact_score"] == (100.0 if eligible else 0.0)
    assert impact["bowl"]["role_signal"] == "Batter"  # both scores are 0
    assert impact["bat"]["bowling_economy"] is None


def test_a_bowler_is_told_from_a_batter(balls_of):
    impact = {r["player"]: r for r in rows(indexes.player_impact(balls_of(over_of(6)), 6, 6))}
    assert impact["bowl"]["role_signal"] == "Bowler"


def test_team_phase_counts_innings_once(balls_of):
    balls = [ball(match_id=f"m{i}", ball_in_over=b) for i in range(10) for b in (1, 2)]
    found = rows(indexes.team_phase_strength(balls_of(balls)))
    assert [(r["team"], r["innings"], r["team_phase_strength_score"]) for r in found] == [("A", 10, 100.0)]
    assert indexes.team_phase_strength(balls_of(balls), min_innings=11).count() == 0


# --- features -------------------------------------------------------------

def test_powerplay_frame_needs_thirty_balls(spark, balls_of):
    innings = spark.createDataFrame(two_innings("m1"), INNINGS_SCHEMA)
    enough = [ball(over=o, ball_in_over=b, batter_runs=4) for o in range(5) for b in range(1, 7)]
    found = rows(features.powerplay_features(balls_of(enough), innings))
    assert [(r["powerplay_runs"], r["powerplay_run_rate"], r["final_score"]) for r in found] == [(120, 24.0, 100)]
    assert features.powerplay_features(balls_of(enough[:-1]), innings).count() == 0


def test_halfway_frame_of_a_chase(spark, balls_of):
    innings = spark.createDataFrame(two_innings("m1", 100, 90), INNINGS_SCHEMA)
    matches = spark.createDataFrame([a_match("m1")], MATCH_SCHEMA)
    balls = [ball(innings=i, over=o, ball_in_over=b, batter_runs=1) for i in (1, 2) for o in range(12) for b in range(1, 7)]
    found = {r["innings"]: r for r in rows(features.halfway_features(balls_of(balls), innings, matches))}
    assert (found[1]["target_score"], found[1]["runs_needed"], found[1]["required_run_rate"]) == (0, 0, 0.0)
    assert (found[2]["target_score"], found[2]["runs_needed"], found[2]["required_run_rate"]) == (100, 40, 4.0)
    assert found[2]["balls_so_far"] == 60 and found[2]["venue"] == "V"


# --- match-ups ------------------------------------------------------------

def test_both_views_of_a_match_sum_to_one(spark):
    matches = spark.createDataFrame(
        [a_match("m1"), a_match("m2", winner="B"), a_match("m3", winner=None), a_match("m4", venue=None)], MATCH_SCHEMA
    )
    found = rows(matchups.prematch_frame(matches, {"B": "Z"}))
    assert len(found) == 4 and sum(r["team_A_won"] for r in found) == 2
    assert {r["team_A"] for r in found} == {"A", "Z"}


def test_pairs_are_those_that_met(spark):
    met = [("A", "B"), ("B", "A"), ("A", "B"), ("B", "C"), ("C", None), ("D", "D")]
    homes = spark.createDataFrame([("A", "V"), ("B", "W")], "team string, venue string")
    found = rows(matchups.pairings(spark.createDataFrame(met, "team_1 string, team_2 string"), homes))
    assert sorted((r["home_team"], r["away_team"], r["venue"]) for r in found) == [
        ("A", "B", "V"), ("B", "A", "W"), ("B", "C", "W"),
    ]


def test_names_from_a_table(spark):
    matches = spark.createDataFrame([("A", "B", None), ("B", None, "B")], "team_1 string, team_2 string, winner string")
    names = spark.createDataFrame([("B", "Z"), ("X", "Y")], "old string, new string")
    found = sorted(tuple(r) for r in matchups.rename_by_table(matches, names).collect())
    assert found == [("A", "Z", None), ("Z", None, "Z")]


# --- selections -----------------------------------------------------------

SCORED = "match_id string, innings int, win_probability double"


def test_widest_swing_ties_go_to_the_largest_id(spark):
    data = [("9", 1, 0.0), ("9", 2, 10.0), ("9", 2, 60.0), ("10", 1, 0.0), ("10", 2, 0.0), ("10", 2, 50.0), ("5", 2, 0.0), ("5", 2, 99.0)]
    found = selections.choose_match(spark.createDataFrame(data, SCORED))
    assert [r["match_id"] for r in found.collect()] == ["10"]


def test_some_match_is_chosen_when_none_has_two_innings(spark):
    found = selections.choose_match(spark.createDataFrame([("5", 2, 0.0)], SCORED))
    assert [r["match_id"] for r in found.collect()] == ["5"]


def test_best_of_a_role_falls_back_to_the_best(spark):
    impact = spark.createDataFrame(
        [("a", "Batter", 50.0, 1), ("b", "Bowler", 40.0, 1), ("c", "All-rounder", 90.0, 0)],
        "player string, role_signal string, player_impact_score double, impact_eligible int",
    )
    pick = lambda role: selections.best_of_role(impact, role).first()["player"]
    assert (pick(None), pick("Bowler"), pick("All-rounder")) == ("a", "b", "a")


def test_top_row_counts_no_number_as_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "-1"), ("c", "-2")], "name string, v string")
    assert selections.top_row(df, "v", ["name"]).first()["name"] == "a"
    assert selections.bottom_row(df, "v", ["name"]).first()["name"] == "c"


def test_reports_give_the_same_from_ball_totals(spark, balls_of):
    from crease.operators import summaries as S

    rng = random.Random(3)
    data = []
    for i in range(600):
        over = rng.randrange(22)
        row = ball(over=over, ball_in_over=i, innings=rng.choice([1, 2]), batter_runs=rng.randrange(7))
        row |= {"match_id": str(i % 5), "batter": rng.choice(["a", "b", None]), "bowler": rng.choice(["x", "y", None])}
        row |= {"bowler_wickets": rng.randrange(2), "is_legal_ball": rng.choice([0, 1, 1, None])}
        row |= {rng.choice(["byes", "legbyes", "penalty"]): rng.choice([0, 1, None])}
        data.append(row)
    deliveries = balls_of(data)
    totals = S.ball_totals(deliveries)
    for grain in ("batter", "bowler", "innings"):
        assert totals.filter(F.col("grain") == grain).agg(F.sum("balls")).head()[0] == len(data)
    header = spark.createDataFrame([(str(i), 2000 + i % 2, None, None, "A", "B", None, None) for i in range(6)], MATCH_SCHEMA)
    innings = spark.createDataFrame([(str(i), 2000, 1, "A", None, 9, 1, 6) for i in range(5)], INNINGS_SCHEMA)

    def seasons(d):
        return reports.season_summary(header, d, innings).drop("batters_used", "bowlers_used")

    for grain, report in (
        ("batter", S.batting_summary), ("bowler", S.bowling_summary), ("innings", S.phase_summary), ("innings", seasons),
        ("batter", reports.top_batters_by_phase), ("bowler", lambda d: reports.top_death_bowlers(d, min_balls=1)),
    ):
        assert rows(report(totals.filter(F.col("grain") == grain))) == rows(report(deliveries))
    assert S.ball_totals(deliveries.limit(0)).count() == 0
