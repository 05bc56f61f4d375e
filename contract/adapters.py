"""The match tables, derived from the given tables.

A ball is a row of ``lineitem``; 32 orders are an innings and 64 a match. The SQL in
:data:`CTES` defines the same tables for the oracle. Only whole-number arithmetic is
used, so both engines agree. The ball table is a plain projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.functions.scalars import batting_result, overs_notation, phase_for_over, total

# Columns that put the balls of an innings in order; together they are unique.
BALL_ORDER = (
    "over",
    "ball_in_over",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _side(match: str, first: bool) -> str:
    one = f"concat('T', cast({match} % 10 as string))"
    two = f"concat('T', cast(({match} % 10 + 1 + ({match} div 10) % 9) % 10 as string))"
    return one if first else two


def _player(expression: str) -> str:
    """One of 60 players; one key in 61 has no name."""
    return f"case when {expression} % 61 = 60 then null else concat('P', cast({expression} % 61 as string)) end"


def balls(spark: SparkSession, folder: str) -> DataFrame:
    """Ball table without the columns that need the result of the match."""
    number = "(l_orderkey div 64)"
    innings = "(1 + (l_orderkey div 32) % 2)"
    out = "cast(round(l_discount * 100) as int) = 10"
    base = read(spark, folder, "lineitem").selectExpr(
        "*",
        f"{number} as match_number",
        f"cast({innings} as int) as innings",
        "cast(round(l_tax * 100) as int) as t",
        f"{out} as is_out",
        "cast(l_quantity as int) % 7 as batter_runs",
        f"{_player('l_partkey')} as batter",
        f"{_player('(l_partkey + 7)')} as non_striker",
        f"{_player('l_suppkey')} as bowler",
    )
    first_bats = "(match_number % 2 = 0) = (innings = 1)"
    extras = {
        "wides": "cast(t = 0 as int)",
        "noballs": "cast(t = 8 as int)",
        "byes": "cast(t = 1 as int)",
        "legbyes": "cast(t = 2 as int)",
        "penalty": "cast(t = 3 and l_linenumber = 7 as int)",
    }
    base = base.selectExpr("*", *(f"{e} as {n}" for n, e in extras.items()))
    return base.selectExpr(
        "match_number",
        "cast(match_number as string) as match_id",
        "cast(2008 + match_number % 18 as int) as season",
        "innings",
        f"case when {first_bats} then {_side('match_number', True)} else {_side('match_number', False)} end as batting_team",
        "cast((l_orderkey % 32) * 22 div 32 as int) as over",
        "cast((l_orderkey % 32) * 8 + l_linenumber as int) as ball_in_over",
        "batter",
        "non_striker",
        "bowler",
        "batter_runs",
        "wides + noballs + byes + legbyes + penalty as extras",
        "batter_runs + wides + noballs + byes + legbyes + penalty as total_runs",
        "cast(t not in (0, 8) as int) as is_legal_ball",
        *extras,
        "case when is_out and l_linenumber = 1 then 2 when is_out then 1 else 0 end as wicket_count",
        "cast(is_out and l_returnflag <> 'R' as int) as bowler_wickets",
        "case when is_out and l_linenumber = 1 then concat_ws('; ', batter, non_striker)"
        " when is_out and l_returnflag = 'R' and l_linestatus = 'O' then non_striker"
        " when is_out then batter end as players_out",
        *BALL_ORDER[2:],
    ).withColumn("phase", phase_for_over("over"))


def _match_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Runs, wickets, legal balls and balls of both innings, one row per match."""
    measures = {
        "runs": F.col("total_runs"),
        "wickets": F.col("wicket_count"),
        "legal_balls": F.col("is_legal_ball"),
        "balls": F.lit(1),
    }
    return (
        balls(spark, folder)
        .groupBy("match_number")
        .agg(
            *(
                F.coalesce(total(F.when(F.col("innings") == n, m)), F.lit(0)).alias(f"{name}_{n}")
                for n in (1, 2)
                for name, m in measures.items()
            )
        )
    )


def _team(match: str, number: int) -> str:
    """Side that bats in the first or second innings of a match."""
    even, odd = (_side(match, True), _side(match, False))[:: 1 if number == 1 else -1]
    return f"case when {match} % 2 = 0 then {even} else {odd} end"


# Side with more runs; NULL for a tie and for every 25th match.
_WINNER = (
    "case when match_number % 25 = 0 then null"
    f" when runs_1 > runs_2 then {_team('match_number', 1)}"
    f" when runs_2 > runs_1 then {_team('match_number', 2)} end as winner"
)


def winners(spark: SparkSession, folder: str) -> DataFrame:
    return _match_totals(spark, folder).selectExpr("match_number", _WINNER)


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Ball table with the winner and the result of the batting side."""
    return (
        balls(spark, folder)
        .join(winners(spark, folder), "match_number", "left")
        .withColumn("batting_result", batting_result("batting_team", "winner"))
    )


def innings(spark: SparkSession, folder: str) -> DataFrame:
    """Both innings of a match from one row of totals; one without a ball is left out."""
    def one(n: int) -> str:
        fields = ", ".join(f"{c}_{n} as {c}" for c in ("runs", "wickets", "legal_balls", "balls"))
        return f"struct({n} as innings, {_team('match_number', n)} as batting_team, {fields})"

    return (
        _match_totals(spark, folder)
        .selectExpr(
            "cast(match_number as string) as match_id",
            "cast(2008 + match_number % 18 as int) as season",
            _WINNER,
            f"inline(array({one(1)}, {one(2)}))",
        )
        .filter("balls > 0")
        .drop("balls")
        .withColumn("batting_result", batting_result("batting_team", "winner"))
        .withColumn("overs", overs_notation("legal_balls"))
    )


def matches(spark: SparkSession, folder: str, results: bool = True) -> DataFrame:
    """One row per 64 orders, with or without a ball; the winner if ``results``."""
    numbers = read(spark, folder, "orders").select(F.expr("o_orderkey div 64").alias("match_number")).distinct()
    if results:
        numbers = numbers.join(winners(spark, folder), "match_number", "left")
    toss_first = "(match_number div 3) % 2 = 0"
    return numbers.selectExpr(
        "cast(match_number as string) as match_id",
        "cast(2008 + match_number % 18 as int) as season",
        "case when match_number % 12 = 11 then null else concat('C', cast(match_number % 12 as string)) end as city",
        "concat('V', cast(match_number % 12 as string), ', C', cast(match_number % 12 as string)) as venue",
        f"{_side('match_number', True)} as team_1",
        f"{_side('match_number', False)} as team_2",
        *(["winner"] if results else []),
        f"case when {toss_first} then {_side('match_number', True)} else {_side('match_number', False)} end as toss_winner",
    )


# --- the same tables for the oracle ----------------------------------------

def _sql(expression: str) -> str:
    return expression.replace(" div ", " // ").replace("as string", "as varchar")


_BALLS = f"""
raw_balls as (
  select *, l_orderkey // 64 as match_number,
    cast(1 + (l_orderkey // 32) % 2 as int) as innings,
    cast(round(l_tax * 100) as int) as t,
    cast(round(l_discount * 100) as int) = 10 as is_out,
    cast(l_quantity as int) % 7 as batter_runs,
    {_sql(_player('l_partkey'))} as batter,
    {_sql(_player('(l_partkey + 7)'))} as non_striker,
    {_sql(_player('l_suppkey'))} as bowler
  from lineitem),
ball_extras as (
  select *, cast(t = 0 as int) as wides, cast(t = 8 as int) as noballs, cast(t = 1 as int) as byes,
    cast(t = 2 as int) as legbyes, cast(t = 3 and l_linenumber = 7 as int) as penalty
  from raw_balls),
balls as (
  select match_number, cast(match_number as varchar) as match_id,
    cast(2008 + match_number % 18 as int) as season, innings,
    case when (match_number % 2 = 0) = (innings = 1)
      then {_sql(_side('match_number', True))} else {_sql(_side('match_number', False))} end as batting_team,
    cast((l_orderkey % 32) * 22 // 32 as int) as over,
    cast((l_orderkey % 32) * 8 + l_linenumber as int) as ball_in_over,
    batter, non_striker, bowler, batter_runs,
    wides + noballs + byes + legbyes + penalty as extras,
    batter_runs + wides + noballs + byes + legbyes + penalty as total_runs,
    cast(t not in (0, 8) as int) as is_legal_ball,
    wides, noballs, byes, legbyes, penalty,
    case when is_out and l_linenumber = 1 then 2 when is_out then 1 else 0 end as wicket_count,
    cast(is_out and l_returnflag <> 'R' as int) as bowler_wickets,
    case when is_out and l_linenumber = 1 then concat_ws('; ', batter, non_striker)
      when is_out and l_returnflag = 'R' and l_linestatus = 'O' then non_striker
      when is_out then batter end as players_out,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
    case when (l_orderkey % 32) * 22 // 32 between 0 and 5 then 'Powerplay'
      when (l_orderkey % 32) * 22 // 32 between 6 and 15 then 'Middle'
      when (l_orderkey % 32) * 22 // 32 between 16 and 19 then 'Death' else 'Other' end as phase
  from ball_extras)"""

_INNINGS = f"""
innings_totals as (
  select match_number, match_id, season, innings, batting_team, cast(sum(total_runs) as bigint) as runs,
    cast(sum(wicket_count) as bigint) as wickets, cast(sum(is_legal_ball) as bigint) as legal_balls
  from balls group by all),
scores as (
  select match_number,
    coalesce(max(case when innings = 1 then runs end), 0) as r1,
    coalesce(max(case when innings = 2 then runs end), 0) as r2,
    max(case when innings = 1 then batting_team end) as b1,
    max(case when innings = 2 then batting_team end) as b2
  from innings_totals group by match_number),
winners as (
  select match_number, case when match_number % 25 = 0 then null when r1 > r2 then b1 when r2 > r1 then b2 end as winner
  from scores),
innings_table as (
  select match_id, season, innings, batting_team, winner,
    case when winner is null then 'No result' when winner = batting_team then 'Winner' else 'Loser' end as batting_result,
    runs, wickets, legal_balls, (legal_balls // 6) || '.' || (legal_balls % 6) as overs
  from innings_totals left join winners using (match_number)),
deliveries as (
  select b.*, winner,
    case when winner is null then 'No result' when winner = batting_team then 'Winner' else 'Loser' end as batting_result
  from balls b left join winners using (match_number))"""

_MATCHES = f"""
matches as (
  select cast(match_number as varchar) as match_id, cast(2008 + match_number % 18 as int) as season,
    case when match_number % 12 = 11 then null else 'C' || (match_number % 12) end as city,
    'V' || (match_number % 12) || ', C' || (match_number % 12) as venue,
    {_sql(_side('match_number', True))} as team_1,
    {_sql(_side('match_number', False))} as team_2,
    winner,
    case when (match_number // 3) % 2 = 0 then {_sql(_side('match_number', True))}
      else {_sql(_side('match_number', False))} end as toss_winner
  from (select distinct o_orderkey // 64 as match_number from orders) left join winners using (match_number))"""

CTES = f"with {_BALLS.strip()},{_INNINGS},{_MATCHES}"
