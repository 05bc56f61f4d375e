"""What the physical plans must and must not hold."""

import glob
import os
import re

import pytest

import __spark_entry__  # registers the queries of the match tables
from contract.queries import QUERIES

TRAINED = ("m08", "m09", "m10_halfway", "m11_win", "m16", "m18_score", "m20", "s12")
LAZY = sorted(n for n in QUERIES if not n.startswith(TRAINED))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairing_of_all_rows(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan, banned


def test_scan_reads_only_what_is_needed(spark, sf):
    plan = plan_of(QUERIES["a09_batting_summary"](spark, sf))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_quantity"}


def test_filter_reaches_a_stored_table(spark, tmp_path):
    from crease.operators.reports import top_death_bowlers
    from conftest import BALL_SCHEMA, ball

    path = str(tmp_path / "balls")
    spark.createDataFrame([tuple(ball().values())], BALL_SCHEMA).write.parquet(path)
    plan = plan_of(top_death_bowlers(spark.read.parquet(path)))
    assert "EqualTo(phase,Death)" in plan and "TakeOrderedAndProject" in plan
    assert "non_striker" not in plan


def test_top_n_is_cut_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan_of(QUERIES["a07_top_batters_phase"](spark, sf))


def test_sums_are_combined_before_the_shuffle(spark, sf):
    assert "partial_sum" in plan_of(QUERIES["j10_player_outer"](spark, sf))


@pytest.mark.parametrize(
    "name, scans",
    [("a01_season_summary_exact", 3), ("a01_season_summary_compat", 3), ("j10_player_outer", 2), ("a16_team_phase", 1), ("a07_top_batters_phase", 1), ("a11_phase_summary", 2)],
)
def test_balls_are_not_scanned_again(spark, sf, name, scans):
    df = QUERIES[name](spark, sf)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == scans


@pytest.mark.parametrize(
    "name, scans",
    [("c01_player_impact", 2), ("c02_death_batting", 1), ("c03_death_bowling", 1), ("w02_percentile", 2)],
)
def test_scores_read_their_tables_once(spark, sf, name, scans):
    df = QUERIES[name](spark, sf)
    df.collect()
    assert plan_of(df).split("== Initial Plan ==")[0].count("FileScan parquet") == scans


def test_facts_start_from_stored_totals(spark, sf):
    plan = plan_of(QUERIES["c06_facts"](spark, sf))
    assert "lineitem" not in plan and plan.count("ball-totals") >= 1


def test_sources_define_no_python_udf_and_no_local_checkpoint():
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    for path in glob.glob(f"{root}/crease/**/*.py", recursive=True):
        text = open(path).read()
        banned = ["localCheckpoint", "crossJoin", ".rdd"]
        if "/crease/llm/" not in path:  # its operators choose their style one by one
            banned += ["pandas_udf", "F.udf", "applyInPandas", ".collect()"]
        for word in banned:
            assert word not in text, (path, word)
