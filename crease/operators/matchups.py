"""Frames about who plays whom: team names, both views of a match, fixture lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import flag, present


def renamed(name: Column | str, names: dict[str, str] | None = None) -> Column:
    """Current name of a historic one; any other name as it is."""
    name = F.col(name) if isinstance(name, str) else name
    names = K.TEAM_RENAMES if names is None else names
    if not names:
        return name
    pairs = [F.lit(text) for pair in names.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[name], name)


def rename_teams(
    matches: DataFrame,
    names: dict[str, str] | None = None,
    columns: Sequence[str] = ("team_1", "team_2", "winner"),
) -> DataFrame:
    return matches.withColumns({c: renamed(c, names) for c in columns})


def rename_by_table(
    matches: DataFrame, names: DataFrame, columns: Sequence[str] = ("team_1", "team_2", "winner")
) -> DataFrame:
    """As :func:`rename_teams`, with the names in a table: old, new (one row per old name)."""
    for column in columns:
        table = names.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
        joined = matches.join(table, F.col(column) == F.col("__old"), "left")
        matches = joined.withColumn(column, F.coalesce("__new", column)).drop("__old", "__new")
    return matches


def prematch_frame(matches: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Each decided match seen from both sides, with a flag for the side that won."""
    teams = rename_teams(matches, names).filter(present("winner", "team_1", "team_2", "venue"))

    def view(side: str, other: str) -> Column:
        return F.struct(
            F.col(side).alias("team_A"),
            F.col(other).alias("team_B"),
            F.col("venue").alias("venue"),
            flag(F.col("winner") == F.col(side)).alias("team_A_won"),
        )

    return teams.select(F.inline(F.array(view("team_1", "team_2"), view("team_2", "team_1"))))


def pairings(matches: DataFrame, homes: DataFrame) -> DataFrame:
    """Each pair of teams that met, once with either at home, at its venue.

    ``homes`` has one row per team: team, venue. A team without one is at home nowhere.
    """
    met = matches.filter(present("team_1", "team_2")).select(
        F.inline(
            F.array(
                F.struct(F.col("team_1").alias("team"), F.col("team_2").alias("away_team")),
                F.struct(F.col("team_2").alias("team"), F.col("team_1").alias("away_team")),
            )
        )
    )
    return (
        met.filter("team <> away_team")
        .distinct()
        .join(homes.select("team", "venue"), "team")
        .withColumnRenamed("team", "home_team")
    )


def current_teams(spark, homes: dict[str, str] | None = None) -> DataFrame:
    """Table of teams and home venues from a mapping."""
    homes = K.HOME_VENUES if homes is None else homes
    return spark.createDataFrame(list(homes.items()), "team string, venue string")
