"""Documents to tables, with small documents written here."""

import json

import pytest
from conftest import rows

from crease import schemas
from crease.operators import normalize
from crease.plans import ingest as plan
from crease.plans import reports as report_plan
from crease.sources import match_json, tables
from crease.streaming.ingest import arriving_deliveries, arriving_documents, store_tables


def delivery(batter="a1", bowler="b1", runs=0, total=None, **more):
    return {
        "batter": batter,
        "non_striker": "a2",
        "bowler": bowler,
        "runs": {"batter": runs, "extras": 0, "total": runs if total is None else total},
        **more,
    }


def document(season=2011, winner="A", dates=("2011-05-21",), innings=None, **info):
    head = {
        "dates": list(dates),
        "city": "Town",
        "venue": "Ground",
        "event": {"name": "Cup", "match_number": 3},
        "teams": ["A", "B"],
        "toss": {"winner": "B", "decision": "field"},
        "outcome": {"winner": winner, "by": {"runs": 7}} if winner else {"result": "no result"},
        "players": {"A": ["a1", "a2"], "B": ["b1"]},
        "registry": {"people": {"a1": "x"}},
        **info,
    }
    if season is not None:
        head["season"] = season
    return {"meta": {"revision": 1}, "info": head, "innings": innings if innings is not None else []}


FULL = [
    {
        "team": "A",
        "overs": [
            {
                "over": 0,
                "deliveries": [
                    delivery(runs=4),
                    delivery(total=1, extras={"wides": 1}),
                    delivery(total=0, extras={"wides": 0}),
                    delivery(total=2, extras={"legbyes": 2}),
                    delivery(wickets=[{"kind": "run out", "player_out": "a2"}, {"kind": "caught", "player_out": "a1"}]),
                    delivery(wickets=[{"kind": "retired hurt", "player_out": "a1"}]),
                ],
            },
            {"over": 19, "deliveries": [delivery(runs=6)]},
            {"over": 20, "deliveries": [delivery(batter="")]},
        ],
        "powerplays": [],
    },
    {"team": "B", "target": {"runs": 9}},
    {"team": "A", "overs": []},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("docs")
    docs = {
        "100": document(innings=FULL),
        "200": document(season="2007/08", winner=None, city="", player_of_match=["a1", "b1"]),
        "300": document(season=None, dates=("2015-04-01", "2015-04-02")),
        "400": document(season=None, dates=(), event={"name": "Cup", "match_number": "Final"}),
        "with a space+1": document(),
    }
    for name, doc in docs.items():
        (place / f"{name}.json").write_text(json.dumps(doc, indent=1))
    (place / "cut.json").write_text('{"info": {"season": 2011, ')
    (place / "notes.txt").write_text("not a match")
    return str(place)


@pytest.fixture(scope="module")
def documents(spark, folder):
    return match_json.good_documents(match_json.scan_documents(spark, folder))


def by_match(df):
    return {r["match_id"]: r for r in rows(df)}


def test_matches(documents):
    found = by_match(normalize.matches_table(documents))
    assert set(found) == {"100", "200", "300", "400", "with a space+1"}
    assert {m: r["season"] for m, r in found.items()} == {
        "100": 2011, "200": 2007, "300": 2015, "400": None, "with a space+1": 2011,
    }
    one, two = found["100"], found["200"]
    assert (one["winner"], one["win_by_runs"], one["win_by_wickets"]) == ("A", 7, None)
    assert (two["winner"], two["city"], two["player_of_match"]) == (None, None, "a1; b1")
    assert found["400"]["match_number"] is None
    assert (one["match_number"], one["balls_per_over"], str(one["date"])) == (3, 6, "2011-05-21")


def test_schema_of_every_table(documents):
    for name, table in normalize.normalized_tables(documents).items():
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in schemas.TABLES[name]
        ]


def test_deliveries(documents):
    balls = [r for r in rows(normalize.deliveries_table(documents)) if r["match_id"] == "100"]
    balls.sort(key=lambda r: (r["over"], r["ball_in_over"]))
    assert [(r["over"], r["ball_in_over"], r["phase"]) for r in balls] == [
        *((0, n, "Powerplay") for n in range(1, 7)), (19, 1, "Death"), (20, 1, "Other"),
    ]
    assert [r["is_legal_ball"] for r in balls] == [1, 0, 0, 1, 1, 1, 1, 1]
    assert [r["legbyes"] for r in balls][3] == 2
    double, retired = balls[4], balls[5]
    assert (double["wicket_count"], double["bowler_wickets"]) == (2, 1)
    assert (double["wicket_kinds"], double["players_out"]) == ("run out; caught", "a2; a1")
    assert (retired["wicket_count"], retired["bowler_wickets"]) == (1, 0)
    assert balls[7]["batter"] is None and balls[0]["players_out"] is None
    assert {r["batting_result"] for r in balls} == {"Winner"}


def test_innings_without_a_ball_are_rows(documents):
    found = sorted(
        (r for r in rows(normalize.innings_table(documents)) if r["match_id"] == "100"), key=lambda r: r["innings"]
    )
    assert [(r["innings"], r["batting_team"], r["batting_result"]) for r in found] == [
        (1, "A", "Winner"), (2, "B", "Loser"), (3, "A", "Winner"),
    ]
    assert [(r["runs"], r["wickets"], r["legal_balls"], r["overs"]) for r in found] == [
        (13, 3, 6, "1.0"), (0, 0, 0, "0.0"), (0, 0, 0, "0.0"),
    ]


def test_match_players(documents):
    players = [r for r in rows(normalize.match_players_table(documents)) if r["match_id"] == "100"]
    assert sorted((r["team"], r["player"]) for r in players) == [("A", "a1"), ("A", "a2"), ("B", "b1")]


def test_bad_files_are_set_aside(spark, folder):
    skipped = rows(match_json.skipped_files(match_json.scan_documents(spark, folder)))
    assert len(skipped) == 1 and skipped[0]["file"].endswith("/cut.json") and skipped[0]["error"]


def test_a_folder_without_a_match_is_an_error(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{")
    scanned = match_json.scan_documents(spark, str(tmp_path))
    with pytest.raises(match_json.NoMatches):
        match_json.require_matches(match_json.good_documents(scanned))


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_ingest_register_and_export(spark, folder, tmp_path, kind):
    target = str(tmp_path / "tables")
    counts = plan.ingest(spark, folder, target, kind)
    assert (counts["matches"], counts["innings"], counts["deliveries"], counts["skipped_files"]) == (5, 3, 8, 1)
    again = plan.ingest(spark, folder, target, kind)
    assert again == counts
    found = tables.register_tables(spark, target, kind)
    assert spark.sql("select count(*) from deliveries where batter is null").first()[0] == 1
    assert {r["city"] for r in rows(found["matches"])} == {"Town", None}
    shown = report_plan.export(found, str(tmp_path / "reports"))
    assert shown["season_summary"] == 4 and shown["team_summary"] == 2
    header = next((tmp_path / "reports" / "team_summary.csv").glob("part-*")).read_text().splitlines()[0]
    assert header == "team,matches,wins,losses_or_no_results,win_pct"
    assert plan.audit(found["matches"]).first().asDict() == {
        "matches": 5, "first_season": 2007, "last_season": 2015,
    }


def test_a_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(tables.MissingTable):
        tables.register_tables(spark, str(tmp_path))


def test_csv_as_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('player,runs\n"a, ""b""",7.0\n  ,x\n')
    found = rows(tables.read_csv(spark, str(path), schemas.BATTING_SUMMARY, text_only=True))
    assert found == [{"player": 'a, "b"', "runs": "7.0"}, {"player": None, "runs": "x"}]


def test_rebalanced_partitions_keep_all_rows(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "case when id < 900 then 1 else id % 7 end as season")
    path = str(tmp_path / "p")
    assert tables.write_table(df, path, partition_by=["season"]) == 1000
    assert tables.read_table(spark, path).count() == 1000


def test_stream_gives_the_batch_tables(spark, folder, documents, tmp_path):
    target = str(tmp_path / "stream")
    query = store_tables(arriving_documents(spark, folder, files_per_batch=2), target)
    query.awaitTermination()
    assert query.exception() is None
    for name, table in normalize.normalized_tables(documents).items():
        streamed = spark.read.parquet(f"{target}/{name}").drop("batch").select(table.columns)
        assert sorted(map(str, streamed.collect())) == sorted(map(str, table.collect()))
    assert spark.read.parquet(f"{target}/skipped_files").count() == 1
    assert spark.read.parquet(f"{target}/checkpoints").count() == 1


def test_running_batting_totals_of_a_stream(spark, folder, documents):
    balls = arriving_deliveries(arriving_documents(spark, folder, files_per_batch=2))
    query = (
        balls.groupBy("batter").sum("batter_runs").writeStream.format("memory").queryName("batting")
        .outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = normalize.deliveries_table(documents).groupBy("batter").sum("batter_runs")
    assert sorted(map(str, spark.table("batting").collect())) == sorted(map(str, want.collect()))


def values(df):
    return sorted(r["n"] for r in df.collect())


def failing(spark):
    from pyspark.sql import functions as F

    return spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("midway"))).alias("n"))


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.refresh_table(spark.range(5).toDF("n"), path) == 5
    with pytest.raises(Exception, match="midway"):
        tables.refresh_table(failing(spark), path)
    assert values(tables.read_table(spark, path)) == [0, 1, 2, 3, 4]
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 1
    plain = str(tmp_path / "plain")
    tables.write_table(spark.range(3).toDF("n"), plain)
    with pytest.raises(Exception, match="midway"):
        tables.write_table(failing(spark), plain)
    assert values(spark.read.parquet(plain)) == [0, 1, 2] and {p.name for p in tmp_path.iterdir()} == {"table", "plain"}


def test_a_table_is_refreshed_from_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.refresh_table(spark.range(4).toDF("n"), path)
    before = tables.read_table(spark, path)
    for _ in range(3):
        tables.refresh_table(tables.read_table(spark, path).selectExpr("n + 1 as n"), path)
    assert values(tables.read_table(spark, path)) == [3, 4, 5, 6]
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 2
    tables.refresh_table(spark.range(2).toDF("n"), str(tmp_path / "kept"), keep=9)
    first = tables.read_table(spark, str(tmp_path / "kept"))
    tables.refresh_table(spark.range(9).toDF("n"), str(tmp_path / "kept"), keep=9)
    assert values(first) == [0, 1] and before.columns == ["n"]
    for kind in ("csv", "json"):
        place = str(tmp_path / kind)
        tables.refresh_table(spark.range(2).toDF("n"), place, kind)
        tables.refresh_table(spark.range(3).toDF("n"), place, kind)
        assert values(tables.read_table(spark, place, before.schema, kind)) == [0, 1, 2]


def test_only_new_and_changed_files_are_read(spark, tmp_path, monkeypatch):
    docs, target = tmp_path / "docs", str(tmp_path / "out")
    docs.mkdir()
    for name in ("1", "2", "3"):
        (docs / f"{name}.json").write_text(json.dumps(document(innings=FULL)))
    (docs / "bad.json").write_text("{")
    assert plan.ingest_new(spark, str(docs), target)["matches"] == 3
    scans = []
    scan = plan.scan_documents
    monkeypatch.setattr(plan, "scan_documents", lambda s, files: scans.append(sorted(f.rsplit("/", 1)[1] for f in files)) or scan(s, files))
    assert plan.ingest_new(spark, str(docs), target) == {} and scans == []
    (docs / "4.json").write_text(json.dumps(document(innings=FULL)))
    (docs / "2.json").write_text(json.dumps(document(season=2019, innings=[])))
    (docs / "bad.json").write_text(json.dumps(document(season=2018)))
    counts = plan.ingest_new(spark, str(docs), target)
    assert scans == [["2.json", "4.json", "bad.json"]]
    assert counts["matches"] == 5 and counts["skipped_files"] == 0
    stored = {name: rows(tables.read_table(spark, f"{target}/{name}", schema)) for name, schema in schemas.TABLES.items()}
    monkeypatch.setattr(plan, "scan_documents", scan)
    plan.ingest(spark, str(docs), str(tmp_path / "whole"))
    for name, schema in schemas.TABLES.items():
        whole = rows(tables.read_table(spark, str(tmp_path / "whole" / name), schema))
        assert sorted(map(repr, whole)) == sorted(map(repr, stored[name])), name
    assert plan.ingest_new(spark, str(docs), target) == {}


def test_only_folders_that_all_executors_see_are_shared():
    from crease.session import is_shared

    assert is_shared("local[8]", "file:/tmp/w") and is_shared("local", "/tmp/w")
    assert is_shared("spark://host:7077", "hdfs://host/w")
    assert not is_shared("local-cluster[3,1,1024]", "file:/tmp/w") and not is_shared("yarn", "/tmp/w")
