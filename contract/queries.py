"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contract import adapters as A
from contract.adapters import CTES
from crease.operators import indexes, reports, summaries

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, tables: bool = True):
    """Register a query; ``tables`` puts the match tables in front of its SQL."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = f"{CTES}\n{sql.strip()}" if tables else sql.strip()
        return query

    return add


# --- reports ----------------------------------------------------------------

@register(
    "a01_season_summary_exact",
    """
, per_season as (
  select m.season, cast(count(*) as bigint) as matches from matches m group by m.season),
ball_part as (
  select m.season, count(distinct d.batter) as batters_used, count(distinct d.bowler) as bowlers_used,
    cast(sum(d.total_runs) as bigint) as total_runs, cast(sum(d.wicket_count) as bigint) as total_wickets,
    6e0 * cast(sum(d.total_runs) as bigint) / nullif(sum(d.is_legal_ball), 0) as run_rate
  from matches m left join deliveries d using (match_id) group by m.season),
score_part as (
  select m.season, avg(i.runs) as avg_innings_score
  from matches m left join innings_table i using (match_id) group by m.season)
select * from per_season join ball_part using (season) join score_part using (season)
""",
)
def _(spark, sf):
    return reports.season_summary(
        A.matches(spark, sf, results=False), A.balls(spark, sf), A.innings(spark, sf)
    )


@register(
    "a01_season_summary_compat",
    """
select m.season, count(distinct m.match_id) as matches, count(distinct d.batter) as batters_used,
  count(distinct d.bowler) as bowlers_used, cast(sum(d.total_runs) as bigint) as total_runs,
  cast(sum(d.wicket_count) as bigint) as total_wickets,
  6e0 * cast(sum(d.total_runs) as bigint) / nullif(sum(d.is_legal_ball), 0) as run_rate,
  avg(i.runs) as avg_innings_score
from matches m left join deliveries d on m.match_id = d.match_id
left join innings_table i on m.match_id = i.match_id
group by m.season
""",
)
def _(spark, sf):
    return reports.season_summary(
        A.matches(spark, sf, results=False), A.balls(spark, sf), A.innings(spark, sf), exact=False
    )


@register(
    "a02_toss_impact",
    """
, known as (
  select season, toss_winner = winner as kept_luck from matches where (toss_winner = winner) is not null)
select season, count(*) as completed_matches, count(*) filter (kept_luck) as toss_winner_wins,
  100e0 * count(*) filter (kept_luck) / count(*) as toss_winner_win_pct
from known group by season
""",
)
def _(spark, sf):
    return reports.toss_impact_by_season(A.matches(spark, sf))


@register(
    "a03_innings_order",
    """
select coalesce(a.match_id, b.match_id) as match_id, a.batting_team as first_batting_team, b.batting_team as chasing_team
from (from innings_table where innings = 1) a full join (from innings_table where innings = 2) b on a.match_id = b.match_id
""",
)
def _(spark, sf):
    return reports.innings_order(A.innings(spark, sf))


CHASING = """
, replies as (
  select m.season, m.winner is not distinct from b.batting_team as chased, a.batting_team = m.winner as defended
  from (from innings_table where innings = 2) b
  join (from matches where winner is not null) m on m.match_id = b.match_id
  left join (from innings_table where innings = 1) a on a.match_id = b.match_id),
chasing as (
  select season, count(*) as completed_matches, count(*) filter (chased) as chasing_wins,
    count(*) filter (defended) as defending_wins, 100e0 * count(*) filter (chased) / count(*) as chasing_win_pct
  from replies group by season)
"""


@register("a04_chasing", CHASING + "select * from chasing")
def _(spark, sf):
    return reports.chasing_vs_defending(A.matches(spark, sf), A.innings(spark, sf))


@register(
    "a24_defending_pct",
    CHASING + "select *, 100e0 * defending_wins / completed_matches as defending_win_pct from chasing",
)
def _(spark, sf):
    return reports.with_defending_pct(
        reports.chasing_vs_defending(A.matches(spark, sf), A.innings(spark, sf))
    )


VENUES = """
, venue_summary as (
  select venue, city, count(*) as matches, avg(i.runs) as avg_first_innings_score,
    100e0 * sum(case when m.winner = toss_winner then 1 else 0 end) / count(*) as toss_winner_win_pct
  from matches m join innings_table i on m.match_id = i.match_id and i.innings = 1
  where m.winner is not null group by venue, city having count(*) >= 5)
"""


@register("a05_venue_summary", VENUES + "select * from venue_summary")
def _(spark, sf):
    return reports.venue_summary(A.matches(spark, sf), A.innings(spark, sf))


TEAMS = """
, team_summary as (
  select team, count(*) as matches, cast(sum(case when team = winner then 1 else 0 end) as bigint) as wins,
    cast(count(*) - sum(case when team = winner then 1 else 0 end) as bigint) as losses_or_no_results,
    100e0 * sum(case when team = winner then 1 else 0 end) / count(*) as win_pct
  from (select team_1 as team, winner from matches union all select team_2, winner from matches)
  where team is not null group by team)
"""


@register("a06_team_summary", TEAMS + "select * from team_summary")
def _(spark, sf):
    return reports.team_summary(A.matches(spark, sf))


TOP_BATTERS = """
, top_batters as (
  select phase, batter, cast(sum(batter_runs) as bigint) as runs, cast(sum(is_legal_ball) as bigint) as balls,
    100e0 * sum(batter_runs) / nullif(sum(is_legal_ball), 0) as strike_rate
  from balls where batter is not null and phase in ('Powerplay', 'Middle', 'Death')
  group by phase, batter
  qualify row_number() over (partition by phase order by sum(batter_runs) desc, batter) <= 10)
"""


@register("a07_top_batters_phase", TOP_BATTERS + "select * from top_batters")
def _(spark, sf):
    return reports.top_batters_by_phase(A.balls(spark, sf))


DEATH_BOWLERS = """
, death_bowlers as (
  select bowler, cast(sum(bowler_wickets) as bigint) as wickets, cast(sum(is_legal_ball) as bigint) as balls,
    cast(sum(total_runs - byes - legbyes - penalty) as bigint) as runs_conceded,
    6e0 * sum(total_runs - byes - legbyes - penalty) / nullif(sum(is_legal_ball), 0) as economy
  from balls where phase = 'Death' and bowler is not null group by bowler
  having sum(is_legal_ball) >= 120
  order by wickets desc, economy, bowler limit 25)
"""


@register("a08_top_death_bowlers", DEATH_BOWLERS + "select * from death_bowlers")
def _(spark, sf):
    return reports.top_death_bowlers(A.balls(spark, sf))


# --- summaries --------------------------------------------------------------

BATTING = """
, batting_summary as (
  select batter as player, cast(sum(batter_runs) as bigint) as runs from balls
  where batter is not null group by batter)
"""
BOWLING = """
, bowling_summary as (
  select bowler as player, cast(sum(bowler_wickets) as bigint) as wickets,
    cast(sum(is_legal_ball) as bigint) as balls,
    cast(sum(total_runs - byes - legbyes - penalty) as bigint) as runs_conceded,
    6e0 * sum(total_runs - byes - legbyes - penalty) / nullif(sum(is_legal_ball), 0) as economy
  from balls where bowler is not null group by bowler)
"""
PHASES = """
, phase_summary as (
  select batting_result, phase, coalesce(runs, 0) as runs, coalesce(innings, 0) as innings,
    1e0 * runs / innings as avg_runs
  from (values ('Winner'), ('Loser')) r(batting_result)
  cross join (values ('Powerplay'), ('Middle'), ('Death')) p(phase)
  left join (
    select batting_result, phase, cast(sum(total_runs) as bigint) as runs,
      count(distinct (match_id, innings)) as innings
    from deliveries where batting_result <> 'No result' group by batting_result, phase)
  using (batting_result, phase))
"""
PHASE_GAP = """
, phase_gap as (
  select phase, w.avg_runs as winner_avg, l.avg_runs as loser_avg, w.avg_runs - l.avg_runs as gap
  from phase_summary w join phase_summary l using (phase)
  where w.batting_result = 'Winner' and l.batting_result = 'Loser')
"""


@register("a09_batting_summary", BATTING + "select * from batting_summary")
def _(spark, sf):
    return summaries.batting_summary(A.balls(spark, sf))


@register("a10_bowling_summary", BOWLING + "select * from bowling_summary")
def _(spark, sf):
    return summaries.bowling_summary(A.balls(spark, sf))


@register("a11_phase_summary", PHASES + "select * from phase_summary")
def _(spark, sf):
    return summaries.phase_summary(A.deliveries(spark, sf))


@register("j12_phase_gap", PHASES + PHASE_GAP + "select * from phase_gap")
def _(spark, sf):
    return summaries.phase_gap(summaries.phase_summary(A.deliveries(spark, sf)))


# --- indexes ----------------------------------------------------------------

PLAYERS = """
, bat as (
  select batter as player, sum(batter_runs) as runs, sum(is_legal_ball) as balls,
    sum(case when batter_runs in (4, 6) then 1 else 0 end) as boundaries,
    sum(len(list_filter(string_split(coalesce(players_out, ''), '; '), lambda x : x = batter))) as dismissals
  from balls where batter is not null group by batter),
bowl as (
  select bowler as player, sum(bowler_wickets) as wickets, sum(is_legal_ball) as balls,
    sum(total_runs - byes - legbyes - penalty) as runs,
    sum(case when total_runs = 0 then 1 else 0 end) as dots
  from balls where bowler is not null group by bowler),
players as (
  select player, cast(coalesce(bat.runs, 0) as bigint) as batting_runs,
    cast(coalesce(bat.balls, 0) as bigint) as batting_balls,
    cast(coalesce(boundaries, 0) as bigint) as batting_boundaries,
    cast(coalesce(dismissals, 0) as bigint) as batting_dismissals,
    cast(coalesce(wickets, 0) as bigint) as bowling_wickets,
    cast(coalesce(bowl.balls, 0) as bigint) as bowling_balls,
    cast(coalesce(bowl.runs, 0) as bigint) as bowling_runs,
    cast(coalesce(dots, 0) as bigint) as bowling_dots
  from bat full outer join bowl using (player))
"""


@register("j10_player_outer", PLAYERS + "select * from players")
def _(spark, sf):
    return indexes.player_totals(A.balls(spark, sf))


def _share(value: str, member: str = "true", within: str = "") -> str:
    """Percentile of a value in its pool, by ranking the pool."""
    pool = f"({member})" + (f", {within}" if within else "")
    return (
        f"case when {member} then 100e0 * count(*) over (partition by {pool} order by {value} "
        f"range between unbounded preceding and current row) / count(*) over (partition by {pool}) else 0e0 end"
    )


RATES = PLAYERS + """
, rates as (
  select *, coalesce(100e0 * batting_runs / nullif(batting_balls, 0), 0) as batting_strike_rate,
    coalesce(1e0 * batting_runs / nullif(batting_dismissals, 0), 0) as batting_average,
    coalesce(100e0 * batting_boundaries / nullif(batting_balls, 0), 0) as boundary_pct,
    coalesce(6e0 * bowling_runs / nullif(bowling_balls, 0), 0) as bowling_economy,
    coalesce(6e0 * bowling_wickets / nullif(bowling_balls, 0), 0) as wickets_per_over,
    coalesce(100e0 * bowling_dots / nullif(bowling_balls, 0), 0) as dot_ball_pct
  from players)
"""


def _impact(bat_balls: int, bowl_balls: int) -> str:
    bats, bowls = f"batting_balls >= {bat_balls}", f"bowling_balls >= {bowl_balls}"
    return RATES + f"""
, shares as (
  select *, {_share('batting_strike_rate', bats)} as p_sr, {_share('batting_average', bats)} as p_avg,
    {_share('boundary_pct', bats)} as p_boundary, {_share('wickets_per_over', bowls)} as p_wickets,
    {_share('-bowling_economy', bowls)} as p_economy, {_share('dot_ball_pct', bowls)} as p_dots
  from rates),
scored as (
  select *, 0.45e0 * p_sr + 0.35e0 * p_avg + 0.20e0 * p_boundary as batting_score,
    0.45e0 * p_wickets + 0.35e0 * p_economy + 0.20e0 * p_dots as bowling_score
  from shares),
impact as (
select player, case when batting_score >= bowling_score * 1.4e0 then 'Batter'
    when bowling_score >= batting_score * 1.4e0 then 'Bowler' else 'All-rounder' end as role_signal,
  greatest(batting_score, bowling_score, (batting_score + bowling_score) / 2) as player_impact_score,
  batting_score, bowling_score, cast({bats} or {bowls} as int) as impact_eligible,
  batting_runs, batting_balls, batting_strike_rate, batting_average, boundary_pct,
  bowling_wickets, bowling_balls,
  case when bowling_balls > 0 then bowling_economy end as bowling_economy, wickets_per_over, dot_ball_pct
from scored)
"""


@register("c01_player_impact", _impact(600, 600) + "select * from impact")
def _(spark, sf):
    return indexes.player_impact(A.balls(spark, sf))


@register(
    "w02_percentile",
    f"""
, customers as (
  select c_custkey, c_nationkey, c_acctbal, {_share('c_acctbal', 'c_acctbal >= 0', 'c_nationkey')} as balance_share,
  from customer)
select * from customers
""",
)
def _(spark, sf):
    from pyspark.sql import functions as F

    from crease.operators.percentile import percentile_scores

    customers = A.read(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    balance = F.col("c_acctbal")
    return percentile_scores(
        customers, customers.columns, {"balance_share": (balance, balance >= 0)}, within=["c_nationkey"]
    )


@register(
    "c02_death_batting",
    f"""
, death as (
  select batter as player, cast(sum(batter_runs) as bigint) as death_runs,
    cast(sum(is_legal_ball) as bigint) as death_balls,
    100e0 * sum(batter_runs) / sum(is_legal_ball) as death_strike_rate,
    100e0 * sum(case when batter_runs in (4, 6) then 1 else 0 end) / sum(is_legal_ball) as death_boundary_pct
  from balls where phase = 'Death' and batter is not null group by batter having sum(is_legal_ball) >= 120)
select *, 0.70e0 * {_share('death_strike_rate')} + 0.30e0 * {_share('death_boundary_pct')} as death_batting_index
from death
""",
)
def _(spark, sf):
    return indexes.death_batting_index(A.balls(spark, sf))


@register(
    "c03_death_bowling",
    f"""
, death as (
  select bowler as player, cast(sum(bowler_wickets) as bigint) as death_wickets,
    cast(sum(is_legal_ball) as bigint) as death_balls,
    cast(sum(total_runs - byes - legbyes - penalty) as bigint) as death_runs_conceded,
    6e0 * sum(total_runs - byes - legbyes - penalty) / sum(is_legal_ball) as death_economy,
    6e0 * sum(bowler_wickets) / sum(is_legal_ball) as death_wickets_per_over,
    100e0 * sum(case when total_runs = 0 then 1 else 0 end) / sum(is_legal_ball) as death_dot_ball_pct
  from balls where phase = 'Death' and bowler is not null group by bowler having sum(is_legal_ball) >= 120)
select *, 0.45e0 * {_share('death_wickets_per_over')} + 0.35e0 * {_share('-death_economy')}
    + 0.20e0 * {_share('death_dot_ball_pct')} as death_bowling_index
from death
""",
)
def _(spark, sf):
    return indexes.death_bowling_index(A.balls(spark, sf))


TEAM_PHASE = """
, team_phase as (
  select batting_team as team, phase, count(distinct (match_id, innings)) as innings,
    cast(sum(total_runs) as bigint) as runs, cast(sum(is_legal_ball) as bigint) as balls,
    cast(sum(wicket_count) as bigint) as wickets
  from balls where phase <> 'Other' group by batting_team, phase
  having count(distinct (match_id, innings)) >= 10)
"""
STRENGTH = TEAM_PHASE + f"""
, team_rates as (
  select team, phase, innings, runs, 6e0 * runs / balls as run_rate,
    1e0 * wickets / innings as wickets_lost_per_innings
  from team_phase),
strength as (select *, {_share('run_rate', 'true', 'phase')} as team_phase_strength_score from team_rates)
"""


@register("a16_team_phase", TEAM_PHASE + "select * from team_phase")
def _(spark, sf):
    return indexes.team_phase_totals(A.balls(spark, sf))


@register("c04_team_phase_strength", STRENGTH + "select * from strength")
def _(spark, sf):
    return indexes.team_phase_strength(A.balls(spark, sf))


@register(
    "a23_phase_pivot",
    STRENGTH + """
select team, avg(case when phase = 'Powerplay' then team_phase_strength_score end) as "Powerplay",
  avg(case when phase = 'Middle' then team_phase_strength_score end) as "Middle",
  avg(case when phase = 'Death' then team_phase_strength_score end) as "Death"
from strength group by team
""",
)
def _(spark, sf):
    return indexes.phase_strength_pivot(indexes.team_phase_strength(A.balls(spark, sf), ordered=False))


VENUE_PAR = """
, firsts as (
  select venue, city, count(*) as matches, avg(runs) as venue_par_score,
    median(runs) as median_first_innings_score, max(runs) as highest_first_innings_score,
    min(runs) as lowest_first_innings_score
  from matches m join innings_table i on m.match_id = i.match_id and i.innings = 1
  group by venue, city having count(*) >= 5),
chases as (
  select venue, city, count(*) as chase_matches,
    cast(sum(case when m.winner = i.batting_team then 1 else 0 end) as bigint) as chasing_wins
  from matches m join innings_table i on m.match_id = i.match_id and i.innings = 2
  where m.winner is not null group by venue, city),
venue_par as (
  select f.*, coalesce(100e0 * chasing_wins / chase_matches, 0) as chasing_win_pct
  from firsts f left join chases c
  on f.venue is not distinct from c.venue and f.city is not distinct from c.city)
"""


@register("a14_venue_par", VENUE_PAR + "select * from firsts")
def _(spark, sf):
    return indexes.venue_first_innings(A.matches(spark, sf), A.innings(spark, sf))


@register("a15_venue_chase", VENUE_PAR + "select * from chases")
def _(spark, sf):
    return indexes.venue_chase_record(A.matches(spark, sf), A.innings(spark, sf))


@register("c05_venue_par_full", VENUE_PAR + "select * from venue_par")
def _(spark, sf):
    return indexes.venue_par_score(A.matches(spark, sf), A.innings(spark, sf))
