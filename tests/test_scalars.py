import pytest
from pyspark.sql import functions as F

from crease.functions import scalars as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "season, date, label",
    [
        ("2011", None, 2011),
        ("2007/08", "2008-04-18", 2007),
        ("200", None, 200),
        (None, "2015-05-01", 2015),
        ("x", "2015-05-01", 2015),
        (None, None, None),
        ("", "", None),
    ],
)
def test_season_label(spark, season, date, label):
    text = lambda t: F.lit(t).cast("string")
    assert value(spark, S.season_label(text(season), text(date))) == label


@pytest.mark.parametrize(
    "over, phase",
    [(0, "Powerplay"), (5, "Powerplay"), (6, "Middle"), (15, "Middle"), (16, "Death"), (19, "Death"), (20, "Other")],
)
def test_phase(spark, over, phase):
    assert value(spark, S.phase_for_over(F.lit(over))) == phase


def test_rates(spark):
    assert value(spark, S.safe_rate(F.lit(3), F.lit(2), 6)) == 9.0
    assert value(spark, S.safe_rate(F.lit(3), F.lit(0))) == 0.0
    assert value(spark, S.ratio(F.lit(3), F.lit(0))) is None


@pytest.mark.parametrize(
    "text, whole, real", [("7.9", 7, 7.9), ("-7.9", -7, -7.9), ("x", 0, 0.0), (None, 0, 0.0), ("", 0, 0.0), (" 5 ", 5, 5.0)]
)
def test_tolerant_numbers(spark, text, whole, real):
    text = F.lit(text).cast("string")
    assert value(spark, S.as_int(text)) == whole
    assert value(spark, S.as_float(text)) == real


def test_not_a_number_is_zero(spark):
    assert value(spark, S.as_int(F.lit("NaN"))) == 0


@pytest.mark.parametrize("number, text", [(1234.5, "1,234.5"), (100.0, "100"), (0.25, "0.25"), (20.1, "20.1")])
def test_number_text(spark, number, text):
    assert value(spark, S.number_text(F.lit(number))) == text


def test_percent_text(spark):
    assert value(spark, S.percent_text(F.lit(62.07))) == "62.1%"


def test_dismissals(spark):
    one = lambda names: value(spark, S.dismissals_of(F.lit("a"), F.lit(names).cast("string")))
    assert (one("a"), one("b; a"), one("ab"), one("b"), one(None)) == (1, 1, 0, 0, 0)


def test_floor_at_zero_keeps_null(spark):
    assert value(spark, S.floor_at_zero(F.lit(-3))) == 0
    assert value(spark, S.floor_at_zero(F.lit(None).cast("int"))) is None


def test_overs_notation(spark):
    assert value(spark, S.overs_notation(F.lit(118))) == "19.4"
    assert value(spark, S.overs_notation(F.lit(0))) == "0.0"


def test_batting_result(spark):
    text = lambda t: F.lit(t).cast("string")
    results = [value(spark, S.batting_result(text(t), text(w))) for t, w in (("A", "A"), ("B", "A"), ("A", None), (None, "A"))]
    assert results == ["Winner", "Loser", "No result", "Loser"]


def test_short_name(spark):
    assert value(spark, S.short_name(F.lit("Eden Gardens, Kolkata"))) == "Eden Gardens"
