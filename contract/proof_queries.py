"""Registered queries of what else the library does: round trips of sources and sinks,
display orders, texts, and the parts of models that SQL can express.

A position column tells the place a row has in the result as an operator returns it.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contract import adapters as A
from contract.more_queries import _CHANCE, ENRICHED, HALFWAY, POWERPLAY, frame, halfway, powerplay
from contract.queries import BATTING, BOWLING, TEAMS, VENUE_PAR, VENUES, _impact, register
from crease.functions.scalars import as_float, as_int, number_text, percent_text
from crease.operators import features, indexes, models, normalize, reports, selections, summaries
from crease.plans import ingest
from crease.plans import reports as report_plan
from crease.session import shared_folder
from crease.sources import match_json, tables


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks --------------------------------------------------------

def _written(spark, sf, table: str, kind: str) -> str:
    path = _folder(spark, table)
    tables.write_table(A.read(spark, sf, table), path, kind)
    return path


@register("s05_csv_round_trip", "select * from orders", tables=False)
def _(spark, sf):
    schema = A.read(spark, sf, "orders").schema
    return tables.read_csv(spark, _written(spark, sf, "orders", "csv"), schema)


@register(
    "s04_csv_as_text",
    """
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as bigint) as nation, c_acctbal as balance,
  cast(trunc(c_acctbal) as bigint) as whole_balance, cast(0 as bigint) as no_number
from customer
""",
    tables=False,
)
def _(spark, sf):
    schema = A.read(spark, sf, "customer").schema
    read = tables.read_csv(spark, _written(spark, sf, "customer", "csv"), schema, text_only=True)
    return read.select(
        "c_custkey",
        "c_name",
        as_int("c_nationkey").alias("nation"),
        as_float("c_acctbal").alias("balance"),
        as_int("c_acctbal").alias("whole_balance"),
        as_int("c_name").alias("no_number"),
    )


@register("s07_full_refresh", "select * from customer", tables=False)
def _(spark, sf):
    path, rows = _folder(spark, "refresh"), A.read(spark, sf, "customer")
    tables.refresh_table(rows.unionByName(rows), path)
    tables.refresh_table(tables.read_table(spark, path).distinct(), path)
    return tables.read_table(spark, path, rows.schema)


@register("s08_partitioned_sink", "select * from events", tables=False)
def _(spark, sf):
    path, rows = _folder(spark, "events"), A.read(spark, sf, "events")
    tables.write_table(rows, path, partition_by=["event_type"])
    return spark.read.parquet(path).select(*rows.columns)


@register("s13_rows_written", "select (select count(*) from orders) as orders, (select count(*) from customer) as customers", tables=False)
def _(spark, sf):
    counts = [
        tables.write_table(A.read(spark, sf, name), _folder(spark, name), "csv") for name in ("orders", "customer")
    ]
    return spark.range(1).select(F.lit(counts[0]).cast("bigint").alias("orders"), F.lit(counts[1]).cast("bigint").alias("customers"))


@register(
    "s06_registered_tables",
    "select c_mktsegment, count(*) as orders from orders join customer on o_custkey = c_custkey group by c_mktsegment",
    tables=False,
)
def _(spark, sf):
    folder = _folder(spark, "registry")
    names = {"orders": "kept_orders", "customer": "kept_customers"}
    for table, name in names.items():
        tables.write_table(A.read(spark, sf, table), f"{folder}/{name}")
    tables.register_tables(spark, folder, names={name: A.read(spark, sf, table).schema for table, name in names.items()})
    return spark.sql(
        "select c_mktsegment, count(*) as orders from kept_orders join kept_customers on o_custkey = c_custkey"
        " group by c_mktsegment"
    )


@register(
    "s10_exported_report",
    TEAMS + "select team, matches, wins, losses_or_no_results, round(win_pct, 2) as win_pct from team_summary",
)
def _(spark, sf):
    folder = _folder(spark, "export")
    name = "team_summary"
    report_plan.export({"matches": A.matches(spark, sf)}, folder, {name: report_plan.REPORTS[name]})
    schema = "team string, matches bigint, wins bigint, losses_or_no_results bigint, win_pct double"
    return tables.read_csv(spark, f"{folder}/{name}.csv", spark.createDataFrame([], schema).schema)


@register(
    "s11_metrics_json",
    "select count(*) as rows, min(season) as first_season, max(season) as last_season from matches",
)
def _(spark, sf):
    path = _folder(spark, "metrics")
    found = ingest.audit(A.matches(spark, sf)).withColumnRenamed("matches", "rows")
    tables.save_metrics(found, path)
    return tables.load_metrics(spark, path, found.schema)


def _write_files(documents: DataFrame, path: str) -> None:
    """A file for each row (name, text). Tasks write them by Arrow's file system, each put in place by one rename.

    Spark's writer commits every file on its own: the driver moves them one after another when all tasks are done.
    """
    folder = path if ":" in path else f"file://{path}"

    def write(rows) -> None:
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        for row in rows:
            draft = f"{root}/_{uuid.uuid4().hex}.draft"
            with place.open_output_stream(draft) as out:
                out.write(row["text"].encode())
            place.move(draft, f"{root}/{row['name']}.json")

    place, root = fs.FileSystem.from_uri(folder)
    place.create_dir(root, recursive=True)  # also there when no row is
    documents.select("name", "text").foreachPartition(write)


def _match_files(spark, sf) -> str:
    """A folder with a JSON document for each match; every tenth is no match document."""
    path = _folder(spark, "matches")
    ball = F.struct(
        "batter",
        "bowler",
        F.struct(F.col("batter_runs").alias("batter"), "extras", F.col("total_runs").alias("total")).alias("runs"),
    )
    # The balls of a match meet once; the three groupings stay where they are.
    overs = (
        A.balls(spark, sf)
        .filter(F.col("match_number").isNotNull())
        .repartition("match_number")
        .groupBy("match_number", "season", "innings", "batting_team", "over")
        .agg(F.collect_list(ball).alias("deliveries"))
    )
    innings = overs.groupBy("match_number", "season", "innings", "batting_team").agg(
        F.collect_list(F.struct("over", "deliveries")).alias("overs")
    )
    documents = innings.groupBy("match_number", "season").agg(
        F.collect_list(F.struct(F.col("batting_team").alias("team"), "overs")).alias("innings")
    )
    number = F.col("match_number").cast("string")
    good = F.to_json(F.struct(F.struct(F.col("season").alias("season"), number.alias("venue")).alias("info"), "innings"))
    bad = F.to_json(F.struct(F.concat(F.lit("bad "), number).alias("info")))
    _write_files(documents.select(number.alias("name"), F.when(F.col("match_number") % 10 == 0, bad).otherwise(good).alias("text")), path)
    return path


@register(
    "s01_match_files",
    """
select match_id as venue, cast(season as int) as season, count(*) as balls, cast(sum(total_runs) as bigint) as runs
from balls where cast(match_id as bigint) % 10 <> 0 group by match_id, season
""",
)
def _(spark, sf):
    scanned = match_json.scan_documents(spark, _match_files(spark, sf))
    documents = match_json.require_matches(match_json.good_documents(scanned))
    matches = normalize.matches_table(documents).select("match_id", "venue", "season")
    balls = normalize.deliveries_table(documents).groupBy("match_id").agg(
        F.count(F.lit(1)).alias("balls"), F.sum("total_runs").alias("runs")
    )
    return matches.join(balls, "match_id").drop("match_id")


@register(
    "s02_skipped_files",
    "select distinct match_id from balls where cast(match_id as bigint) % 10 = 0",
)
def _(spark, sf):
    skipped = match_json.skipped_files(match_json.scan_documents(spark, _match_files(spark, sf)))
    return skipped.select(F.regexp_extract("error", r"bad (\d+)", 1).alias("match_id"))


# --- orders -------------------------------------------------------------------

def placed(ordered: DataFrame) -> DataFrame:
    """A small result with the position of each row in it."""
    rows = ordered.withColumn("__row", F.monotonically_increasing_id())
    return rows.withColumn("position", F.row_number().over(W.orderBy("__row")).cast("bigint")).drop("__row")


def _place(order: str) -> str:
    return f"select *, row_number() over (order by {order}) as position "


@register("l01_team_order", TEAMS + _place("win_pct desc, wins desc, team") + "from team_summary")
def _(spark, sf):
    return placed(reports.team_summary(A.matches(spark, sf)))


@register(
    "l01_venue_order",
    VENUES + _place("avg_first_innings_score desc, matches desc, venue, city nulls first") + "from venue_summary",
)
def _(spark, sf):
    return placed(reports.venue_summary(A.matches(spark, sf), A.innings(spark, sf)))


@register("l01b_venue_names", "select venue, row_number() over (order by venue) as position from (select distinct venue from matches where venue is not null)")
def _(spark, sf):
    return placed(selections.distinct_values(A.matches(spark, sf), "venue"))


@register("l05_batting_order", BATTING + _place("runs desc, player") + "from batting_summary")
def _(spark, sf):
    return placed(summaries.batting_summary(A.balls(spark, sf)))


@register("l05_bowling_order", BOWLING + _place("wickets desc, player") + "from bowling_summary")
def _(spark, sf):
    return placed(summaries.bowling_summary(A.balls(spark, sf)))


@register(
    "l09_impact_order", _impact(600, 600) + _place("impact_eligible desc, player_impact_score desc, player") + "from impact"
)
def _(spark, sf):
    return placed(indexes.player_impact(A.balls(spark, sf)))


@register("l10_venue_par_order", VENUE_PAR + _place("venue_par_score desc, venue, city nulls first") + "from venue_par")
def _(spark, sf):
    return placed(indexes.venue_par_score(A.matches(spark, sf), A.innings(spark, sf)))


# --- texts --------------------------------------------------------------------

@register(
    "x11_display_texts",
    r"""
select o_orderkey, regexp_replace(format('{:,.2f}', o_totalprice), '\.?0+$', '') as price,
  format('{:.1f}%', o_custkey % 1000 / 10e0) as share,
  regexp_replace(format('{:,.2f}', o_orderkey * 50 / 100e0), '\.?0+$', '') as halves
from orders
""",
    tables=False,
)
def _(spark, sf):
    return A.read(spark, sf, "orders").select(
        "o_orderkey",
        number_text("o_totalprice").alias("price"),
        percent_text(F.col("o_custkey") % 1000 / 10).alias("share"),
        number_text(F.col("o_orderkey") * 50 / 100).alias("halves"),
    )


_TEXT = "case o_orderkey % 5 when 0 then '' when 1 then 'n/a' when 2 then o_custkey || '.75' when 3 then '-' || o_custkey end"


@register(
    "p12_tolerant_numbers",
    f"""
select o_orderkey, coalesce(cast(trunc(try_cast({_TEXT} as double)) as bigint), 0) as whole,
  coalesce(try_cast({_TEXT} as double), 0) as number
from orders
""",
    tables=False,
)
def _(spark, sf):
    text = F.expr(_TEXT)
    return A.read(spark, sf, "orders").select(
        "o_orderkey", as_int(text).alias("whole"), as_float(text).alias("number")
    )


# --- models -------------------------------------------------------------------

_MISSING = "case when (cast(match_id as bigint) + innings) % 7 = 0 then null else {0} end as {0}"


def _gaps(rows: DataFrame, columns) -> DataFrame:
    """Rows without a value in some of the columns, for the imputers."""
    return rows.selectExpr(*(_MISSING.format(c) if c in columns else c for c in rows.columns))


_HALF_GAPS = ("runs_so_far", "boundary_pct", "batting_team")
_HALF = HALFWAY + f", gaps as (select * replace ({', '.join(_MISSING.format(c) for c in _HALF_GAPS)}) from halfway)\n"


@register(
    "m04_fill_values",
    _HALF
    + "select "
    + ", ".join(f"round(median(cast({n} as double)), 9) as {n}" for n in models.HALFWAY_NUMBERS)
    + ", "
    + ", ".join(
        f"(select {c} from gaps where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as {c}"
        for c in models.HALFWAY_CATEGORIES
    )
    + " from gaps",
)
def _(spark, sf):
    rows = _gaps(halfway(spark, sf), _HALF_GAPS)
    fill = models.fill_values(rows, models.HALFWAY_NUMBERS, models.HALFWAY_CATEGORIES)
    return fill.withColumns({n: F.round(n, 9) for n in models.HALFWAY_NUMBERS})


_POWER_GAPS = ("powerplay_runs", "boundary_pct", "batting_team")


@register(
    "m06_feature_vectors",
    POWERPLAY
    + f", gaps as (select * replace ({', '.join(_MISSING.format(c) for c in _POWER_GAPS)}) from powerplay)"
    + """
, mode as (select batting_team as team from gaps where batting_team is not null
  group by batting_team order by count(*) desc, batting_team limit 1),
names as (select batting_team as name, row_number() over (order by batting_team) as slot
  from gaps where batting_team is not null group by batting_team)
select match_id, innings,
  round(coalesce(powerplay_runs, (select median(cast(powerplay_runs as double)) from gaps)), 9) as runs,
  round(coalesce(boundary_pct, (select median(boundary_pct) from gaps)), 9) as boundaries,
  n.slot as team_slot, (select count(*) from names) + """
    + f"{len(models.POWERPLAY_NUMBERS)} as width, 1e0 as ones "
    + "from gaps g join names n on n.name = coalesce(g.batting_team, (select team from mode))",
)
def _(spark, sf):
    rows = _gaps(powerplay(spark, sf), _POWER_GAPS)
    numbers = list(models.POWERPLAY_NUMBERS)
    stages = models.encoding_stages(rows, numbers, ["batting_team"])
    encoded = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("v", vector_to_array("features"))
    team = F.slice("v", len(numbers) + 1, F.size("v") - len(numbers))
    return encoded.select(
        "match_id",
        "innings",
        F.round(F.col("v")[numbers.index("powerplay_runs")], 9).alias("runs"),
        F.round(F.col("v")[numbers.index("boundary_pct")], 9).alias("boundaries"),
        F.array_position(team, 1.0).alias("team_slot"),
        F.size("v").cast("bigint").alias("width"),
        F.aggregate(team, F.lit(0.0), lambda a, b: a + b).alias("ones"),
    )


@register(
    "m16_chance_in_percent",
    ENRICHED + f"select match_id, innings, over_number, current_score, round(({_CHANCE}) / 128e0 * 100, 1) as win_probability from frame",
)
def _(spark, sf):
    chance = F.expr(f"({_CHANCE}) / cast(128 as double)")
    return frame(spark, sf).select(
        "match_id", "innings", "over_number", "current_score", models.in_percent(chance).alias("win_probability")
    )


@register(
    "m18_interval",
    HALFWAY + """
, guess as (select match_id, innings, cast(trunc(2.3e0 * runs_so_far) as int) as predicted_score from halfway)
select *, predicted_score - 17 as lower_bound, predicted_score + 17 as upper_bound from guess
""",
)
def _(spark, sf):
    guess = halfway(spark, sf).select("match_id", "innings", (F.lit(2.3) * F.col("runs_so_far")).alias("prediction"))
    return models.with_interval(guess, 17.9)
