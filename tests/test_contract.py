"""Every registered query against its oracle SQL, and shape checks of the others."""

import os

import pytest

import __spark_entry__ as entry
from contract import document_queries, model_queries, proof_queries
from contract.check import compare, oracle
from crease import schemas
from crease.operators import normalize

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return oracle(sf)


@pytest.fixture
def small_models(monkeypatch):
    """Fewer trees: what SQL tells of a model does not depend on their number."""
    monkeypatch.setattr(model_queries, "FOREST", {"num_trees": 12, "max_depth": 6})
    monkeypatch.setattr(model_queries, "BOOSTED", {"max_iter": 12})


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_oracle(spark, sf, duck, small_models, name):
    sizes = []
    assert compare(QUERIES[name](spark, sf), duck, ORACLE[name], sizes) is None
    assert sizes[0] > 0


@pytest.mark.parametrize("name", ["a01_season_summary_compat", "w06_checkpoints", "c04_team_phase_strength"])
def test_equal_to_oracle_on_the_smallest_tables(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), oracle(folder), ORACLE[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["phase", "batter", "runs", "balls", "strike_rate"]
    assert result.count() > 0


def test_documents_are_made_without_casts_and_innings_are_reduced_before_they_are_exploded(spark, sf):
    documents = document_queries.documents(spark, sf)
    for part in ("info", "innings"):
        wanted = schemas.MATCH_DOCUMENT[part].dataType
        assert documents.schema[part].dataType.simpleString() == wanted.simpleString()
    plan = normalize.innings_table(documents)._jdf.queryExecution().executedPlan().toString()
    assert "cast(named_struct(season" not in plan and "cast(array(named_struct(team" not in plan
    assert "Generate inline(transform(" in plan and "Exchange" not in plan


def test_match_files_are_named_by_match_and_written_by_the_tasks(spark, tmp_path):
    rows = [(64 * m + o, 1 + o % 2, 10 * m + o, o, 5.0, 0.1, 0.03, "N", "O", 100.0, "1995-01-01")
            for m in (10, 11, 12) for o in (1, 2, 40)]
    spark.createDataFrame(
        rows + [(None, *rows[0][1:])],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_extendedprice double, l_shipdate string",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    folder = proof_queries._match_files(spark, str(tmp_path)).removeprefix("file:")
    assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == ["10.json", "11.json", "12.json"]
    found = {(r["venue"], r["balls"]) for r in QUERIES["s01_match_files"](spark, str(tmp_path)).collect()}
    assert found == {("11", 3), ("12", 3)}
    assert [r["match_id"] for r in QUERIES["s02_skipped_files"](spark, str(tmp_path)).collect()] == ["10"]
