"""Registered queries: checkpoints, feature frames, match-ups, evaluation, facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract import adapters as A
from contract.queries import (
    BATTING,
    BOWLING,
    CHASING,
    DEATH_BOWLERS,
    PHASE_GAP,
    PHASES,
    TEAMS,
    TOP_BATTERS,
    VENUE_PAR,
    VENUES,
    _impact,
    register,
)
from crease.functions.scalars import rounded
from crease.operators import (
    checkpoints,
    evaluate,
    facts,
    features,
    indexes,
    matchups,
    reports,
    selections,
)
from crease.plans.reports import insights
from crease.session import staged

# --- checkpoints ------------------------------------------------------------

_ORDER = ", ".join(A.BALL_ORDER)
SNAPSHOTS = f"""
, seq as (
  select *, sum(total_runs) over w as cum_runs, sum(wicket_count) over w as cum_wickets,
    sum(is_legal_ball) over w as cum_balls
  from deliveries where winner is not null
  window w as (partition by match_id, innings order by {_ORDER} rows unbounded preceding)),
marked as (
  select *, coalesce(sum(case when cum_balls > 0 and cum_balls % 6 = 0 then 1 else 0 end) over (
    partition by match_id, innings order by {_ORDER} rows between unbounded preceding and 1 preceding), 0) as segment
  from seq),
summed as (
  select *, sum(total_runs) over s as seg_runs, sum(wicket_count) over s as seg_wickets
  from marked window s as (partition by match_id, innings, segment)),
checkpoints as (
  select match_id, season, innings, batting_team, cast(cum_balls // 6 as bigint) as over_number,
    cast(cum_runs as bigint) as current_score, cast(cum_wickets as bigint) as wickets_lost,
    cast(cum_balls as bigint) as balls_bowled, cast(greatest(0, 20 - cum_balls // 6) as bigint) as overs_remaining,
    6e0 * cast(cum_runs as bigint) / cast(cum_balls as bigint) as current_run_rate,
    cast(seg_runs as bigint) as last_over_runs, cast(seg_wickets as bigint) as last_over_wickets,
    cast(batting_team = winner as int) as batting_team_won
  from summed where cum_balls > 0 and cum_balls % 6 = 0)
"""
ENRICHED = SNAPSHOTS + """
, frame as (
  select c.*, f.runs as final_innings_score,
    case when c.innings = 2 then t.runs + 1 end as target,
    case when c.innings = 2 then t.runs + 1 - current_score end as runs_required,
    6e0 * case when c.innings = 2 then t.runs + 1 - current_score end / nullif(120 - balls_bowled, 0)
      as required_run_rate,
    1e0 * current_score / nullif(f.runs, 0) as score_pct_of_final,
    cast(c.innings = 2 as int) as is_chase
  from checkpoints c
  left join innings_table f on c.match_id = f.match_id and c.innings = f.innings and f.winner is not null
  left join innings_table t on c.match_id = t.match_id and t.innings = 1 and t.winner is not null
  where over_number between 1 and 20)
"""


def _checkpoints(spark, sf, **options):
    return checkpoints.over_checkpoints(A.deliveries(spark, sf), order=A.BALL_ORDER, **options)


def frame(spark, sf):
    return checkpoints.enrich_checkpoints(_checkpoints(spark, sf), A.innings(spark, sf))


register("w06_checkpoints", SNAPSHOTS + "select * from checkpoints")(_checkpoints)


@register(
    "w06_checkpoints_last",
    SNAPSHOTS + f"""
, kept as (
  select * from checkpoints
  qualify row_number() over (
    partition by match_id, innings, over_number order by current_score desc, wickets_lost desc,
    last_over_runs) = 1)
select match_id, season, innings, batting_team, over_number, current_score, wickets_lost, balls_bowled,
  overs_remaining, current_run_rate, batting_team_won,
  current_score - coalesce(lag(current_score) over w, 0) as last_over_runs,
  wickets_lost - coalesce(lag(wickets_lost) over w, 0) as last_over_wickets
from kept window w as (partition by match_id, innings order by over_number)
""",
)
def _(spark, sf):
    return _checkpoints(spark, sf, dedupe="last")


@register(
    "w05_event_segments",
    """
with seq as (
  select *, cast(round(value * 100) as bigint) as cents,
    sum(case when event_type <> 'error' then 1 else 0 end) over w as n
  from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)),
marked as (
  select *, coalesce(sum(case when n > 0 and n % 6 = 0 then 1 else 0 end) over (
    partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as segment,
    sum(cents) over (partition by user_id order by ts, event_id rows unbounded preceding) as cents_upto
  from seq)
select user_id, event_id, cast(n as bigint) as balls_bowled, cast(n // 6 as bigint) as over_number,
  cast(cents_upto as bigint) as cents,
  cast((select sum(m2.cents) from marked m2 where m2.user_id = m.user_id and m2.segment = m.segment) as bigint)
    as last_cents
from marked m where n > 0 and n % 6 = 0
""",
    tables=False,
)
def _(spark, sf):
    events = A.read(spark, sf, "events").select(
        "user_id",
        "event_id",
        "ts",
        (F.col("event_type") != "error").cast("int").alias("legal"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        F.to_date("ts").alias("day"),
        F.hour("ts").alias("hour"),
    )
    return checkpoints.over_snapshots(
        events,
        ["user_id"],
        ["ts", "event_id"],
        F.col("legal"),
        {"cents": F.col("amount")},
        carry=["event_id"],
        path=["day", "hour"],
    )


register("w07_enriched", ENRICHED + "select * from frame")(frame)


# --- win probability curve over a supplied probability ------------------------

_CHANCE = "(current_score * 7 + over_number * 13 + cast(match_id as bigint)) % 101"
SCORED = ENRICHED + f"""
, scored as (select *, cast({_CHANCE} as double) as win_probability from frame),
swings as (
  select match_id, max(case when innings = 2 then win_probability end)
    - min(case when innings = 2 then win_probability end) as swing
  from scored group by match_id having count(distinct innings) >= 2
    and max(case when innings = 2 then win_probability end) is not null),
chosen as (select match_id from swings order by swing desc, cast(match_id as bigint) desc limit 1)
"""


def _scored(spark, sf):
    return frame(spark, sf).withColumn("win_probability", F.expr(f"cast({_CHANCE} as double)"))


def _stored(spark, sf):
    """Scored checkpoints as a table: choosing a match and showing it are two reads."""
    return staged(_scored(spark, sf), "scored")


@register("a21_match_swing", SCORED + "select * from swings")
def _(spark, sf):
    return selections.match_swing(_scored(spark, sf))


@register("l04_choose_match", SCORED + "select * from chosen")
def _(spark, sf):
    return selections.choose_match(_stored(spark, sf))


@register(
    "m17_match_curve",
    SCORED + f"select {', '.join(selections.CURVE_COLUMNS)} from scored where match_id in (select match_id from chosen)",
)
def _(spark, sf):
    return selections.match_curve(_stored(spark, sf))


@register(
    "p17_match_rows",
    SCORED + f"select {', '.join(selections.CURVE_COLUMNS)} from scored where match_id = '7'",
)
def _(spark, sf):
    return selections.match_curve(_scored(spark, sf), match_id="7")


@register(
    "m14_classification_metrics",
    ENRICHED + f"""
, p as (select batting_team_won as y, (({_CHANCE}) % 99 + 1) / 100e0 as p from frame),
counts as (select p, sum(y) as won, sum(1 - y) as lost from p group by p),
upto as (select *, sum(lost) over (order by p) - lost as below from counts)
select (select count(*) from p) as rows,
  round((select avg(cast((p >= 0.5e0) = (y = 1) as int)) from p), 6) as accuracy,
  round((select -avg(ln(case when y = 1 then p else 1 - p end)) from p), 6) as log_loss,
  round(sum(won * (below + lost / 2e0)) / (sum(won) * sum(lost)), 6) as roc_auc
from upto
""",
)
def _(spark, sf):
    chance = F.expr(f"(({_CHANCE}) % 99 + 1) / cast(100 as double)")
    scored = staged(frame(spark, sf).select("batting_team_won", chance.alias("p")), "scored")
    metrics = evaluate.classification_metrics(scored, "batting_team_won", "p")
    return rounded(metrics, {"accuracy": 6, "log_loss": 6, "roc_auc": 6})


# --- feature frames ---------------------------------------------------------

POWERPLAY = """
, early as (
  select match_id, season, innings, batting_team, cast(sum(total_runs) as bigint) as powerplay_runs,
    cast(sum(wicket_count) as bigint) as powerplay_wickets, cast(sum(is_legal_ball) as bigint) as powerplay_balls,
    cast(sum(case when batter_runs in (4, 6) then 1 else 0 end) as bigint) as powerplay_boundaries,
    cast(sum(case when total_runs = 0 then 1 else 0 end) as bigint) as powerplay_dot_balls
  from balls where over < 6 group by all),
powerplay as (
  select e.*, 6e0 * powerplay_runs / powerplay_balls as powerplay_run_rate,
    10 - powerplay_wickets as powerplay_wickets_left,
    100e0 * powerplay_boundaries / powerplay_balls as boundary_pct,
    100e0 * powerplay_dot_balls / powerplay_balls as dot_ball_pct,
    cast(innings = 1 as int) as is_first_innings, i.runs as final_score
  from early e join innings_table i using (match_id, innings) where powerplay_balls >= 30)
"""
HALFWAY = """
, early as (
  select match_id, season, innings, batting_team, cast(sum(total_runs) as bigint) as runs_so_far,
    cast(sum(wicket_count) as bigint) as wickets_so_far, cast(sum(is_legal_ball) as bigint) as balls_so_far,
    cast(sum(case when batter_runs in (4, 6) then 1 else 0 end) as bigint) as boundaries,
    cast(sum(case when batter_runs = 6 then 1 else 0 end) as bigint) as sixes,
    cast(sum(case when total_runs = 0 then 1 else 0 end) as bigint) as dot_balls
  from balls where over < 10 group by all),
chased as (
  select e.*, 6e0 * runs_so_far / balls_so_far as run_rate_so_far, 10 - wickets_so_far as wickets_remaining,
    100e0 * boundaries / balls_so_far as boundary_pct, 100e0 * dot_balls / balls_so_far as dot_ball_pct,
    100e0 * sixes / balls_so_far as six_pct, cast(e.innings = 1 as int) as is_first_innings,
    120 - balls_so_far as balls_remaining, venue, city,
    case when e.innings = 2 then t.runs else 0 end as target_score
  from early e left join matches m on e.match_id = m.match_id
  left join innings_table t on e.match_id = t.match_id and t.innings = 1
  where balls_so_far >= 55),
needed as (
  select *, case when innings <> 2 then 0 when target_score is null then null
    else greatest(target_score - runs_so_far, 0) end as runs_needed from chased),
halfway as (
  select n.*, case when n.innings = 2 then 6e0 * runs_needed / nullif(balls_remaining, 0) else 0 end
    as required_run_rate, i.runs as final_score
  from needed n join innings_table i using (match_id, innings))
"""


def powerplay(spark, sf):
    return features.powerplay_features(A.balls(spark, sf), A.innings(spark, sf))


def halfway(spark, sf):
    return features.halfway_features(A.balls(spark, sf), A.innings(spark, sf), A.matches(spark, sf))


register("m01_features_6", POWERPLAY + "select * from powerplay")(powerplay)
register("m02_features_10", HALFWAY + "select * from halfway")(halfway)


@register(
    "m03_split",
    POWERPLAY + """
select match_id, innings, cast(5 * row_number() over (partition by innings
    order by md5('42|' || match_id || '|' || innings)) <= 4 * count(*) over (partition by innings) as int) as is_train
from powerplay
""",
)
def _(spark, sf):
    split = features.training_split(powerplay(spark, sf), ["match_id", "innings"], ["innings"])
    return split.select("match_id", "innings", "is_train")


@register(
    "m03_split_by_match",
    ENRICHED + """
, units as (select distinct match_id from frame),
sides as (
  select match_id, cast(5 * row_number() over (order by md5('42|' || match_id)) <= 4 * count(*) over () as int)
    as is_train from units)
select match_id, innings, over_number, current_score, balls_bowled, last_over_runs, is_train
from frame join sides using (match_id)
""",
)
def _(spark, sf):
    split = features.training_split(staged(frame(spark, sf), "frame"), ["match_id"])
    return split.select(
        "match_id", "innings", "over_number", "current_score", "balls_bowled", "last_over_runs", "is_train"
    )


@register(
    "m10_decay_weight",
    POWERPLAY + """
select match_id, innings, cast(round(1e9 * exp(-0.15e0 * ((select max(season) from powerplay) - season))) as bigint)
  as weight_e9
from powerplay
""",
)
def _(spark, sf):
    weighted = features.season_decay_weight(powerplay(spark, sf))
    return weighted.select("match_id", "innings", F.round(F.col("weight") * 1e9).cast("bigint").alias("weight_e9"))


@register(
    "m11_class_weight",
    ENRICHED + """
select batting_team_won, count(*) as rows,
  (select count(*) from frame) / (2e0 * count(*)) as weight
from frame group by batting_team_won
""",
)
def _(spark, sf):
    weighted = features.balanced_class_weight(staged(frame(spark, sf), "frame"), "batting_team_won")
    return weighted.groupBy("batting_team_won").agg(
        F.count(F.lit(1)).alias("rows"), F.max("weight").alias("weight")
    )


@register(
    "m12_regression_metrics",
    HALFWAY + """
, guess as (select innings, final_score as y, 2 * runs_so_far as p from halfway),
parts as (
  select innings, count(*) as rows, avg(abs(p - y)) as mae, sqrt(avg((p - y) * (p - y))) as rmse,
    1 - avg((p - y) * (p - y)) / var_pop(y) as r2 from guess group by innings)
select innings, rows, round(mae, 6) as mae, round(rmse, 6) as rmse, round(r2, 6) as r2 from parts
""",
)
def _(spark, sf):
    guess = halfway(spark, sf).withColumn("prediction", F.col("runs_so_far") * 2)
    metrics = evaluate.regression_metrics(guess, "final_score", by=["innings"])
    return rounded(metrics, {"mae": 6, "rmse": 6, "r2": 6})


@register(
    "m15_closest_predictions",
    HALFWAY + """
select match_id, innings, final_score, cast(2 * runs_so_far as int) as predicted_final_score,
  abs(2 * runs_so_far - final_score) as absolute_error
from halfway order by absolute_error, match_id, innings limit 30
""",
)
def _(spark, sf):
    guess = halfway(spark, sf).withColumn("prediction", (F.col("runs_so_far") * 2).cast("double"))
    return evaluate.closest_predictions(guess, "final_score", ["match_id", "innings"])


@register(
    "m18_situations",
    HALFWAY + """
select match_id, innings, 6e0 * runs_so_far / greatest(balls_so_far, 1) as run_rate_so_far,
  100e0 * boundaries / greatest(balls_so_far, 1) as boundary_pct,
  case when innings = 2 then greatest(target_score - runs_so_far, 0) else 0 end as runs_needed,
  case when innings = 2 then 6e0 * greatest(target_score - runs_so_far, 0) / greatest(120 - balls_so_far, 1)
    else 0 end as required_run_rate
from chased
""",
)
def _(spark, sf):
    raw = halfway(spark, sf).select(
        "match_id",
        "innings",
        "runs_so_far",
        "wickets_so_far",
        "balls_so_far",
        "boundaries",
        "sixes",
        "dot_balls",
        "target_score",
    )
    return features.situations(raw).select(
        "match_id", "innings", "run_rate_so_far", "boundary_pct", "runs_needed", "required_run_rate"
    )


@register(
    "a25_rows_per_innings",
    POWERPLAY + """
select count(*) filter (where innings = 1) as innings_1_rows,
  count(*) filter (where innings = 2) as innings_2_rows from powerplay
""",
)
def _(spark, sf):
    return features.rows_per_innings(powerplay(spark, sf))


# --- match-ups ----------------------------------------------------------------

_RENAMES = {"T0": "T9", "T4": "T5"}
RENAMED = """
, now as (
  select match_id, venue, case team_1 when 'T0' then 'T9' when 'T4' then 'T5' else team_1 end as team_1,
    case team_2 when 'T0' then 'T9' when 'T4' then 'T5' else team_2 end as team_2,
    case winner when 'T0' then 'T9' when 'T4' then 'T5' else winner end as winner
  from matches)
"""


@register("p16_rename", RENAMED + "select match_id, team_1, team_2, winner from now")
def _(spark, sf):
    return matchups.rename_teams(A.matches(spark, sf), _RENAMES).select("match_id", "team_1", "team_2", "winner")


@register(
    "p16_rename_by_table",
    """
select match_id, case when team_1 in ('T0', 'T2', 'T4', 'T6', 'T8') then 'New ' || team_1 else team_1 end as team_1,
  case when team_2 in ('T0', 'T2', 'T4', 'T6', 'T8') then 'New ' || team_2 else team_2 end as team_2,
  case when winner in ('T0', 'T2', 'T4', 'T6', 'T8') then 'New ' || winner else winner end as winner
from matches
""",
)
def _(spark, sf):
    matches = A.matches(spark, sf)
    old = matches.select(F.col("team_1").alias("old")).distinct().filter("cast(substr(old, 2) as int) % 2 = 0")
    names = old.withColumn("new", F.concat(F.lit("New "), "old"))
    return matchups.rename_by_table(matches, names).select("match_id", "team_1", "team_2", "winner")


@register(
    "u02_symmetrize",
    RENAMED + """
, both_sides as (
  select team_1 as team_A, team_2 as team_B, venue, cast(winner = team_1 as int) as team_A_won from now
  where winner is not null
  union all
  select team_2, team_1, venue, cast(winner = team_2 as int) from now where winner is not null)
select * from both_sides
""",
)
def _(spark, sf):
    return matchups.prematch_frame(A.matches(spark, sf), _RENAMES)


def teams_at_home(spark, sf):
    """Teams with the ground they play most at, first by name among equals."""
    return (
        A.matches(spark, sf)
        .groupBy(F.col("team_1").alias("team"), "venue")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("team")
        .agg(F.min_by("venue", F.struct(-F.col("n"), "venue")).alias("venue"))
    )


@register(
    "j13_pairs",
    """
, homes as (
  select team_1 as team, venue, count(*) as n from matches group by team_1, venue
  qualify row_number() over (partition by team_1 order by count(*) desc, venue) = 1)
select distinct h.team as home_team, case when m.team_1 = h.team then m.team_2 else m.team_1 end as away_team, h.venue
from homes h join matches m on h.team = m.team_1 or h.team = m.team_2
""",
)
def _(spark, sf):
    return matchups.pairings(A.matches(spark, sf, results=False), teams_at_home(spark, sf))


@register("p20_distinct_venues", "select distinct venue from matches where venue is not null")
def _(spark, sf):
    return selections.distinct_values(A.matches(spark, sf), "venue")


# --- facts --------------------------------------------------------------------

SEASONS = """
, seasons as (
  select m.season, count(distinct m.match_id) as matches, cast(sum(d.total_runs) as bigint) as total_runs,
    cast(sum(d.wicket_count) as bigint) as total_wickets,
    6e0 * cast(sum(d.total_runs) as bigint) / nullif(sum(d.is_legal_ball), 0) as run_rate
  from matches m left join deliveries d using (match_id) group by m.season),
toss as (
  select season, 100e0 * sum(case when toss_winner = winner then 1 else 0 end) / count(*) as toss_winner_win_pct
  from matches where winner is not null group by season)
"""


def _pick(name: str, subject: str, value: str, source: str, order: str, label: str = "fact") -> str:
    return (
        f"(select '{name}' as {label}, cast({subject} as varchar) as subject, cast({value} as double) as value "
        f"from {source} order by {order} limit 1)"
    )


def _season_report(spark, sf):
    return reports.season_summary(
        A.matches(spark, sf, results=False), A.balls(spark, sf), A.innings(spark, sf), ordered=False
    )


@register(
    "c06_facts",
    SEASONS + CHASING + VENUES + TEAMS + TOP_BATTERS + DEATH_BOWLERS + BATTING + BOWLING + PHASES + PHASE_GAP
    + " union all ".join(
        [
            _pick("first_season", "null", "min(season)", "seasons", "1"),
            _pick("last_season", "null", "max(season)", "seasons", "1"),
            _pick("total_matches", "null", "sum(matches)", "seasons", "1"),
            _pick("total_runs", "null", "sum(total_runs)", "seasons", "1"),
            _pick("total_wickets", "null", "sum(total_wickets)", "seasons", "1"),
            _pick("highest_run_rate_season", "season", "run_rate", "seasons", "run_rate desc, season"),
            _pick("lowest_run_rate_season", "season", "run_rate", "seasons", "run_rate, season"),
            _pick("strongest_phase_gap", "lower(phase)", "gap", "phase_gap", "gap desc"),
            _pick("strongest_phase_winner_avg", "lower(phase)", "winner_avg", "phase_gap", "gap desc"),
            _pick("strongest_phase_loser_avg", "lower(phase)", "loser_avg", "phase_gap", "gap desc"),
            _pick("best_toss_season", "season", "toss_winner_win_pct", "toss", "toss_winner_win_pct desc, season"),
            _pick("worst_toss_season", "season", "toss_winner_win_pct", "toss", "toss_winner_win_pct, season"),
            _pick("best_chasing_season", "season", "chasing_win_pct", "chasing", "chasing_win_pct desc, season"),
            _pick("worst_chasing_season", "season", "chasing_win_pct", "chasing", "chasing_win_pct, season"),
            _pick("best_team", "team", "win_pct", "team_summary where matches >= 40", "win_pct desc, wins desc, team"),
            _pick(
                "highest_scoring_venue",
                "venue",
                "avg_first_innings_score",
                "venue_summary",
                "avg_first_innings_score desc, matches desc, venue, city",
            ),
            _pick(
                "best_toss_venue",
                "venue",
                "toss_winner_win_pct",
                "venue_summary",
                "toss_winner_win_pct desc, avg_first_innings_score desc, matches desc, venue, city",
            ),
            _pick("top_batter", "player", "runs", "batting_summary", "runs desc, player"),
            _pick("top_bowler", "player", "wickets", "bowling_summary", "wickets desc, player"),
            _pick(
                "fastest_death_batter",
                "batter",
                "strike_rate",
                "top_batters where phase = 'Death'",
                "strike_rate desc, runs desc, batter",
            ),
            _pick(
                "top_powerplay_batter", "batter", "runs", "top_batters where phase = 'Powerplay'", "runs desc, batter"
            ),
            _pick("top_death_bowler", "bowler", "wickets", "death_bowlers", "wickets desc, economy, bowler"),
        ]
    ),
)
def _(spark, sf):
    tables = {"matches": A.matches(spark, sf), "innings": A.innings(spark, sf), "deliveries": A.deliveries(spark, sf)}
    return insights(tables, min_team_matches=40)


@register(
    "c07_season_figures",
    SEASONS + """
select * from (select 'seasons' as figure, null::varchar as subject, cast(count(distinct season) as double) as value from seasons
union all select 'total_matches', null, sum(matches) from seasons
union all select 'total_runs', null, sum(total_runs) from seasons
union all select 'total_wickets', null, sum(total_wickets) from seasons)
""",
)
def _(spark, sf):
    return facts.season_figures(_season_report(spark, sf))


@register(
    "c07_team_figures",
    SEASONS + TEAMS
    + _pick("highest_win_pct", "team", "win_pct", "team_summary", "win_pct desc, wins desc, team", "figure")
    + " union all "
    + _pick("most_matches", "team", "matches", "team_summary", "matches desc, win_pct desc, wins desc, team", "figure")
    + " union all select 'average_toss_win_pct', null, round(avg(toss_winner_win_pct), 6) from toss",
)
def _(spark, sf):
    matches = A.matches(spark, sf)
    figures = facts.team_figures(
        reports.team_summary(matches, ordered=False), reports.toss_impact_by_season(matches, ordered=False)
    )
    average = F.col("figure") == "average_toss_win_pct"
    return figures.withColumn("value", F.when(average, F.round("value", 6)).otherwise(F.col("value")))


_BEST = "player_impact_score desc, player"


@register(
    "c07_player_figures",
    _impact(600, 600)
    + " union all ".join(
        [
            _pick("top_impact_player", "player", "player_impact_score", "impact where impact_eligible = 1", _BEST, "figure"),
            _pick(
                "top_batter",
                "player",
                "batting_strike_rate",
                "impact where impact_eligible = 1",
                f"role_signal <> 'Batter', {_BEST}",
                "figure",
            ),
            _pick(
                "top_bowler",
                "player",
                "bowling_economy",
                "impact where impact_eligible = 1",
                f"role_signal <> 'Bowler', {_BEST}",
                "figure",
            ),
        ]
    ),
)
def _(spark, sf):
    return facts.player_figures(indexes.player_impact(A.balls(spark, sf), ordered=False))


@register(
    "c07_venue_figures",
    VENUES + VENUE_PAR
    + _pick(
        "highest_scoring_ground",
        "split_part(venue, ',', 1)",
        "avg_first_innings_score",
        "venue_summary",
        "avg_first_innings_score desc, matches desc, venue, city",
        "figure",
    )
    + " union all "
    + _pick(
        "best_ground_for_chasing",
        "split_part(venue, ',', 1)",
        "chasing_win_pct",
        "venue_par",
        "chasing_win_pct desc, venue_par_score desc, venue, city",
        "figure",
    )
    + " union all select 'venues_tracked', null, count(*) from venue_par",
)
def _(spark, sf):
    matches, innings = A.matches(spark, sf), A.innings(spark, sf)
    return facts.venue_figures(
        reports.venue_summary(matches, innings, ordered=False),
        indexes.venue_par_score(matches, innings, ordered=False),
    )


@register(
    "l06_top_impact",
    _impact(600, 600) + "select player, role_signal, player_impact_score from impact where impact_eligible = 1 "
    "order by player_impact_score desc, player limit 20",
)
def _(spark, sf):
    impact = indexes.player_impact(A.balls(spark, sf), ordered=False).filter(F.col("impact_eligible") == 1)
    return selections.head_by(impact, 20, F.desc("player_impact_score"), "player").select(
        "player", "role_signal", "player_impact_score"
    )


@register(
    "l07_best_all_rounder",
    _impact(600, 600) + "select player, role_signal from impact where impact_eligible = 1 "
    f"order by role_signal <> 'All-rounder', {_BEST} limit 1",
)
def _(spark, sf):
    return selections.best_of_role(indexes.player_impact(A.balls(spark, sf), ordered=False), "All-rounder").select(
        "player", "role_signal"
    )


@register(
    "l03_extreme_venues",
    VENUES
    + "(select 'top' as place, venue, city from venue_summary order by avg_first_innings_score desc, venue, city limit 1)"
    + " union all (select 'bottom', venue, city from venue_summary order by avg_first_innings_score, venue, city limit 1)",
)
def _(spark, sf):
    venues = reports.venue_summary(A.matches(spark, sf), A.innings(spark, sf), ordered=False)
    ends = {"top": selections.top_row, "bottom": selections.bottom_row}
    top, bottom = (
        pick(venues, "avg_first_innings_score", ["venue", "city"]).select(F.lit(name).alias("place"), "venue", "city")
        for name, pick in ends.items()
    )
    return top.unionByName(bottom)
