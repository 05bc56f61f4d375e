import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from crease.session import get_spark  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def ball(match_id="m1", innings=1, over=0, ball_in_over=1, **values):
    """A ball with plain defaults; give the columns that matter."""
    row = {
        "match_id": match_id,
        "season": 2010,
        "innings": innings,
        "batting_team": "A" if innings == 1 else "B",
        "winner": "A",
        "batting_result": "Winner" if innings == 1 else "Loser",
        "over": over,
        "ball_in_over": ball_in_over,
        "phase": "Powerplay" if over < 6 else "Middle" if over < 16 else "Death" if over < 20 else "Other",
        "batter": "bat",
        "non_striker": "other",
        "bowler": "bowl",
        "batter_runs": 0,
        "extras": 0,
        "total_runs": values.get("batter_runs", 0),
        "is_legal_ball": 1,
        "wides": 0,
        "noballs": 0,
        "byes": 0,
        "legbyes": 0,
        "penalty": 0,
        "wicket_count": 0,
        "bowler_wickets": 0,
        "wicket_kinds": None,
        "players_out": None,
    }
    row.update(values)
    return row


BALL_SCHEMA = (
    "match_id string, season int, innings int, batting_team string, winner string, batting_result string, "
    "over int, ball_in_over int, phase string, batter string, non_striker string, bowler string, "
    "batter_runs int, extras int, total_runs int, is_legal_ball int, wides int, noballs int, byes int, "
    "legbyes int, penalty int, wicket_count int, bowler_wickets int, wicket_kinds string, players_out string"
)
MATCH_SCHEMA = (
    "match_id string, season int, venue string, city string, team_1 string, team_2 string, "
    "winner string, toss_winner string"
)
INNINGS_SCHEMA = (
    "match_id string, season int, innings int, batting_team string, winner string, runs bigint, "
    "wickets bigint, legal_balls bigint"
)


@pytest.fixture(scope="session")
def balls_of(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r.values()) for r in rows], BALL_SCHEMA)

    return make


def rows(df):
    return [r.asDict() for r in df.collect()]
