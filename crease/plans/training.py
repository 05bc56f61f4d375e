"""Train a model from the stored tables and keep all it produced under one version."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease import constants as K
from crease.functions.scalars import rounded
from crease.operators import models
from crease.operators.checkpoints import checkpoint_frame
from crease.operators.features import halfway_features, powerplay_features
from crease.operators.matchups import prematch_frame
from crease.operators.selections import match_curve
from crease.session import staged
from crease.sources.tables import save_metrics, write_table

METRIC_DIGITS = {
    "mae": 2, "rmse": 2, "r2": 3,
    "mae_innings_1": 2, "r2_innings_1": 3, "mae_innings_2": 2, "r2_innings_2": 3,
    "accuracy": 3, "roc_auc": 3, "log_loss": 3,
}

VERSIONS = ("score_v1", "score_v2", "score_v3", "win_probability")


def training_frame(version: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    balls, innings = tables["deliveries"], tables["innings"]
    if version == "score_v1":
        return powerplay_features(balls, innings)
    if version in ("score_v2", "score_v3"):
        return halfway_features(balls, innings, tables["matches"])
    if version == "win_probability":
        return checkpoint_frame(balls, innings)
    raise ValueError(f"{version} is none of {VERSIONS}")


def train(
    version: str, tables: Mapping[str, DataFrame], folder: str, estimator: Estimator | None = None
) -> models.Trained:
    """Fit, then store model, metrics, training frame and sample below ``folder/version``."""
    frame = staged(training_frame(version, tables), version)
    if version == "score_v1":
        trained = models.train_powerplay_score(frame, estimator)
    elif version == "score_v2":
        trained = models.train_halfway_score(frame, estimator)
    elif version == "score_v3":
        trained = models.train_halfway_score(frame, estimator, decay=K.SEASON_DECAY)
    else:
        trained = models.train_win_probability(frame, estimator)
    sample = models.win_sample(trained) if version == "win_probability" else models.score_sample(trained)
    place = f"{folder.rstrip('/')}/{version}"
    features = F.array(*(F.lit(f) for f in trained.features)).alias("features")
    models.save_model(trained.model, f"{place}/model")
    save_metrics(rounded(trained.metrics, METRIC_DIGITS).select("*", features), f"{place}/metrics")
    write_table(frame, f"{place}/training_data")
    write_table(sample, f"{place}/sample_predictions")
    return trained


def train_prematch(tables: Mapping[str, DataFrame], folder: str, estimator: Estimator | None = None):
    model = models.train_prematch(prematch_frame(tables["matches"]), estimator)
    models.save_model(model, f"{folder.rstrip('/')}/prematch/model")
    return model


def store_curve(frame: DataFrame, model, path: str, match_id: str | None = None) -> int:
    """Score all checkpoints, pick a match if none is named, and store its curve."""
    scored = staged(models.score_win_probability(model, frame), "curve")
    return write_table(match_curve(scored, match_id), path, "csv")
