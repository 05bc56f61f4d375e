"""Column expressions shared by the operators. All of them are native Spark
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crease import constants as K


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- missing values -------------------------------------------------------

def blank_to_null(value: Column | str) -> Column:
    """NULL for a missing, empty or all-space text; the text itself otherwise."""
    value = _col(value)
    return F.when(F.trim(value) != "", value)


def present(*values: Column | str) -> Column:
    """True when every value is there and not blank."""
    condition = F.lit(True)
    for value in values:
        value = _col(value)
        condition = condition & value.isNotNull() & (F.trim(value) != "")
    return condition


# --- numbers --------------------------------------------------------------

def safe_rate(numerator, denominator, multiplier: float = 1.0) -> Column:
    """``multiplier * numerator / denominator``; 0.0 when the denominator is 0 or missing."""
    return F.coalesce(ratio(numerator, denominator, multiplier), F.lit(0.0))


def ratio(numerator, denominator, multiplier: float = 1.0) -> Column:
    """``multiplier * numerator / denominator``; NULL when the denominator is 0 or missing."""
    return F.try_divide(F.lit(float(multiplier)) * _col(numerator), _col(denominator))


def as_float(value: Column | str) -> Column:
    """Number in a text; 0.0 when it is not one."""
    return F.coalesce(_col(value).try_cast("double"), F.lit(0.0))


def as_int(value: Column | str) -> Column:
    """Number in a text, cut to a whole number; 0 when it is not one."""
    return F.coalesce(_col(value).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def floor_at_zero(value: Column | str) -> Column:
    """Negative numbers become 0; NULL stays NULL."""
    value = _col(value)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0)))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def total(value: Column | str) -> Column:
    """Sum as a whole number."""
    return F.sum(_col(value)).cast("bigint")


def count_if(condition: Column) -> Column:
    """Number of rows that meet the condition (0, not NULL, when none does)."""
    return F.count(F.when(condition, F.lit(1)))


# --- balls ----------------------------------------------------------------

def phase_for_over(over: Column | str) -> Column:
    over = _col(over)
    name = None
    for label, first, last in K.PHASE_BOUNDS:
        inside = over.between(first, last)
        name = F.when(inside, label) if name is None else name.when(inside, label)
    return name.otherwise(K.OTHER_PHASE)


def is_boundary(batter_runs: Column | str = "batter_runs") -> Column:
    return flag(_col(batter_runs).isin(4, 6))


def is_six(batter_runs: Column | str = "batter_runs") -> Column:
    return flag(_col(batter_runs) == 6)


def is_dot(total_runs: Column | str = "total_runs") -> Column:
    return flag(_col(total_runs) == 0)


def runs_conceded() -> Column:
    """Runs charged to the bowler: byes, leg byes and penalties are not."""
    return F.col("total_runs") - F.col("byes") - F.col("legbyes") - F.col("penalty")


def dismissals_of(player: Column | str, players_out: Column | str = "players_out") -> Column:
    """How often the player is named in the joined list of players out.

    The names that remain without the player are counted, not filtered by a lambda,
    which keeps the expression in generated code.
    """
    player, players_out = _col(player), _col(players_out)
    names = F.split(players_out, K.LIST_SEPARATOR)
    named = F.size(names) - F.size(F.array_remove(names, player))
    return F.when(players_out.isNotNull() & player.isNotNull(), named).otherwise(F.lit(0))


def batting_result(team: Column | str, winner: Column | str) -> Column:
    team, winner = _col(team), _col(winner)
    return (
        F.when(winner.isNull(), "No result")
        .when(team.eqNullSafe(winner), "Winner")
        .otherwise("Loser")
    )


def overs_notation(balls: Column | str) -> Column:
    """Balls as overs and balls, 118 -> ``19.4``."""
    balls = _col(balls)
    whole = F.floor(balls / F.lit(K.BALLS_PER_OVER)).cast("bigint")
    return F.concat_ws(".", whole, balls % F.lit(K.BALLS_PER_OVER))


# --- seasons, names -------------------------------------------------------

def leading_year(text: Column | str) -> Column:
    """First four characters as a number when all of them are digits."""
    return F.regexp_extract(_col(text), r"^(\d{4}|\d{1,3}$)", 1).try_cast("int")


def season_label(season: Column | str, first_date: Column | str) -> Column:
    """Year the season began: ``2007/08`` -> 2007; else the year of the date."""
    return F.coalesce(leading_year(season), leading_year(first_date))


def short_name(name: Column | str) -> Column:
    """Part before the first comma."""
    return F.split(_col(name), ",").getItem(0)


# --- text for display -----------------------------------------------------

def percent_text(value: Column | str) -> Column:
    """``52.0%``"""
    return F.concat(F.format_number(as_float(value), 1), F.lit("%"))


def number_text(value: Column | str) -> Column:
    """At most two decimals, thousands separated, no trailing zeros."""
    text = F.format_number(as_float(value), 2)
    return F.regexp_replace(text, r"\.?0+$", "")


def in_order(df, ordered: bool, *columns):
    """Rows in display order, or as they are when another operator reads them next."""
    return df.orderBy(*columns) if ordered else df


def rounded(df, digits: dict[str, int]):
    """Round the named columns for display; operators themselves never round."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items() if name in df.columns})
