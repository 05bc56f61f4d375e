"""Running totals, snapshots, percentiles and splits against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from crease.operators.checkpoints import over_snapshots
from crease.operators.evaluate import roc_auc
from crease.operators.features import training_split
from crease.operators.percentile import ordered_bits, percentile_scores
from crease.operators.running import row_numbers, running_totals


def make_balls(seed, keys=7, most=4000):
    """Balls of several keys, one of which holds far more than the others."""
    chance = random.Random(seed)
    data = []
    for key in range(keys):
        count = most if key == 0 else chance.randrange(1, 60)
        for n in range(count):
            data.append((key, n, chance.randrange(0, 7), int(chance.random() > 0.2), int(chance.random() < 0.1)))
    chance.shuffle(data)
    return data


COLUMNS = "key int, n int, runs int, legal int, wickets int"


@pytest.mark.parametrize("path", [["p3"], ["p2", "p3"], ["p1", "p2", "p3"]])
def test_running_totals_do_not_depend_on_the_blocks(spark, path):
    data = make_balls(1)
    df = spark.createDataFrame(data, COLUMNS)
    df = df.selectExpr("*", "n div 900 as p1", "n div 300 as p2", "n div 10 as p3")
    found = running_totals(df, ["key"], path, ["n"], {"total": F.col("runs"), "balls": F.col("legal")})
    got = {(r["key"], r["n"]): (r["total"], r["balls"]) for r in found.collect()}
    sums, want = {}, {}
    for key, n, runs, legal, _ in sorted(data):
        a, b = sums.get(key, (0, 0))
        sums[key] = want[key, n] = (a + runs, b + legal)
    assert got == want


def test_row_numbers_without_a_key(spark):
    df = spark.range(5000).selectExpr("id", "id div 64 as block")
    found = row_numbers(df, [], ["block"], ["id"], "place")
    assert found.filter("place <> id + 1").count() == 0 and found.count() == 5000


def fold(data, dedupe):
    """Snapshots by a plain loop over the balls of each key in order."""
    out = {}
    for key in {d[0] for d in data}:
        runs = wickets = balls = 0
        rows = []
        for _, n, r, legal, w in sorted(d for d in data if d[0] == key):
            runs, wickets, balls = runs + r, wickets + w, balls + legal
            if balls > 0 and balls % 6 == 0:
                rows.append((n, balls // 6, balls, runs, wickets))
        if dedupe:
            rows = [r for i, r in enumerate(rows) if i + 1 == len(rows) or rows[i + 1][1] != r[1]]
        before = (0, 0)
        for n, over, balls_, runs_, wickets_ in rows:
            out[key, n] = (over, balls_, runs_, wickets_, runs_ - before[0], wickets_ - before[1])
            before = (runs_, wickets_)
    return out


def snapshots(df, dedupe, width):
    found = over_snapshots(
        df.withColumn("block", F.floor(F.col("n") / (width or 1))),
        ["key"],
        ["n"],
        F.col("legal"),
        {"r": F.col("runs"), "w": F.col("wickets")},
        carry=["n"],
        dedupe=dedupe,
        path=["block"] if width else [],
    )
    return {
        (x["key"], x["n"]): (x["over_number"], x["balls_bowled"], x["r"], x["w"], x["last_r"], x["last_w"])
        for x in found.collect()
    }


# Balls of one key in blocks of one, of some, of all, and not cut.
@pytest.mark.parametrize("width", [1, 37, 100_000, None])
@pytest.mark.parametrize("dedupe", [None, "last"])
@pytest.mark.parametrize("seed", [2, 3])
def test_snapshots_equal_a_sequential_fold(spark, seed, dedupe, width):
    data = make_balls(seed)
    assert snapshots(spark.createDataFrame(data, COLUMNS), dedupe, width) == fold(data, dedupe)


def test_bits_have_the_order_of_the_numbers(spark):
    values = [float("-inf"), -1e300, -2.5, -1.0000000001, -1.0, -5e-324, 0.0, 5e-324, 0.1, 1.0, 7.25, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(n, x) for n, x in enumerate(values)], "n int, x double")
    found = [r["b"] for r in df.orderBy("n").select(ordered_bits(F.col("x")).alias("b")).collect()]
    assert found == sorted(set(found)) and len(found) == len(values)


def test_percentiles_keep_ties_and_pools(spark):
    data = [(i, i % 3, float(chance)) for i, chance in enumerate(random.Random(5).choices(range(-40, 40), k=900))]
    data += [(1000 + i, 0, 7.25) for i in range(400)]
    df = spark.createDataFrame(data, "id int, pool int, x double")
    member = F.col("x") > -30
    metrics = {"up": (F.col("x"), member), "down": (-F.col("x"), member)}
    found = percentile_scores(df, ["id", "pool"], metrics, ["pool"])
    got = {r["id"]: (r["up"], r["down"]) for r in found.collect()}
    for i, pool, x in data:
        values = [v for _, p, v in data if p == pool and v > -30]
        up = 100.0 * sum(v <= x for v in values) / len(values) if x > -30 else 0.0
        down = 100.0 * sum(v >= x for v in values) / len(values) if x > -30 else 0.0
        assert got[i] == (up, down)


def test_percentile_of_an_empty_pool_is_zero(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, x double")
    found = percentile_scores(df, ["id"], {"p": (F.col("x"), F.lit(False))})
    assert sorted((r["id"], r["p"]) for r in found.collect()) == [(1, 0.0), (2, 0.0)]


def test_equal_values_all_get_the_largest_share(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 9.0), (4, 1.0)], "id int, x double")
    found = percentile_scores(df, ["id"], {"p": (F.col("x"), F.lit(True))})
    assert {r["id"]: r["p"] for r in found.collect()} == {1: 75.0, 2: 75.0, 3: 100.0, 4: 25.0}


def test_percentiles_of_null_pools_nan_and_repeated_rows(spark):
    data = [(1, None, 2.0), (2, None, 3.0), (3, "a", 3.0), (4, "a", float("nan")), (5, "b", 1.0), (5, "b", 1.0)]
    df = spark.createDataFrame(data, "id int, pool string, x double")
    found = percentile_scores(df, ["id", "pool"], {"p": (F.col("x"), F.lit(True))}, ["pool"])
    assert sorted((r["id"], r["p"]) for r in found.collect()) == [
        (1, 50.0), (2, 100.0), (3, 50.0), (4, 100.0), (5, 100.0), (5, 100.0),
    ]


@pytest.mark.parametrize("path", [[], ["a"], ["a", "b"]])
def test_totals_of_a_measure_with_nulls(spark, path):
    values = [None, None, 5, None, 0, 4, None, -9, None, None, 2, None]
    data = [("k", n // 6, n // 2, n, v) for n, v in enumerate(values)] + [("z", 0, 0, 0, None), ("z", 1, 3, 1, None)]
    df = spark.createDataFrame(data, "key string, a int, b int, n int, x int")
    found = running_totals(df, ["key"], path, ["n"], {"t": F.col("x")})
    got = [r["t"] for r in found.filter("key = 'k'").orderBy("n").collect()]
    assert got == [None, None, 5, 5, 5, 9, 9, 0, 0, 0, 2, 2]
    assert [r["t"] for r in found.filter("key = 'z'").collect()] == [None, None]


def test_split_is_exact_stable_and_by_unit(spark):
    data = [(u, s, n) for u in range(500) for s in [None if u % 5 == 0 else f"s{u % 2}"] for n in range(3)]
    df = spark.createDataFrame(data, "unit int, stratum string, n int")
    split = training_split(df, ["unit"], ["stratum"])
    again = training_split(df.repartition(13), ["unit"], ["stratum"])
    sides = {(r["unit"], r["is_train"]) for r in split.collect()}
    assert len(sides) == 500
    assert sides == {(r["unit"], r["is_train"]) for r in again.collect()}
    assert split.count() == len(data)
    for stratum in (None, "s0", "s1"):
        units = {u for u, s, _ in data if s == stratum}
        assert sum(t for u, t in sides if u in units) == len(units) * 4 // 5


def test_roc_auc_counts_pairs(spark):
    chance = random.Random(9)
    data = [(chance.randrange(0, 20) / 20, int(chance.random() < 0.4)) for _ in range(300)]
    won = [p for p, y in data if y]
    lost = [p for p, y in data if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in won for b in lost)
    df = spark.createDataFrame(data, "p double, y int")
    assert roc_auc(df, "y", "p").first()[0] == pytest.approx(pairs / (len(won) * len(lost)), abs=1e-12)
