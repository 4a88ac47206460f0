"""Train on the earlier sources, evaluate on the later ones, export and persist."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tidewell.functions.cells import ref
from tidewell.functions.labels import BENIGN, binary_label
from tidewell.operators.balance import with_class_weights
from tidewell.operators.evaluation import binary_metrics, class_metrics, confusion_matrix, roc_points
from tidewell.operators.models import (
    model_importance,
    save_model,
    score_binary,
    scored_export,
    train_binary,
    train_multiclass,
)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame
    confusion: DataFrame
    roc: DataFrame | None
    importance: DataFrame | None


def run_binary(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    target: str,
    benign: str = BENIGN,
    use_class_weights: bool = True,
    **params,
) -> Trained:
    """Boosted trees for benign against the rest, with weights from class frequencies."""
    labelled = train.withColumn("__y", binary_label(ref(target), benign))
    weight = None
    if use_class_weights:
        labelled, weight = with_class_weights(labelled, "__y", "__weight"), "__weight"
    model = train_binary(labelled, features, "__y", weight, **params)
    scored = score_binary(model, test.withColumn("label", binary_label(ref(target), benign)))
    narrow = scored.select("label", "score", scored["prediction"].cast("int").alias("prediction"))
    return Trained(model, binary_metrics(narrow), confusion_matrix(narrow), roc_points(narrow), model_importance(model))


def run_multiclass(
    train: DataFrame, test: DataFrame, features: Sequence[str], target: str, method: str = "forest", **params
) -> Trained:
    """All classes; classes the training split never saw cannot be predicted and count as errors."""
    model = train_multiclass(train, features, target, method, **params)
    scored = model.transform(test).selectExpr("cast(label_id as int) as label", "cast(prediction as int) as prediction")
    importance = model_importance(model) if method == "forest" else None
    return Trained(model, class_metrics(scored), confusion_matrix(scored), None, importance)


def write_training(trained: Trained, test: DataFrame, target: str, folder: str, mode: str = "errorifexists") -> None:
    """Model, metrics, confusion counts, curve, importances and scored rows below ``folder``."""
    save_model(trained.model, f"{folder}/model")
    trained.metrics.write.mode(mode).json(f"{folder}/metrics")
    trained.confusion.write.mode(mode).json(f"{folder}/confusion")
    if trained.roc is not None:
        trained.roc.write.mode(mode).json(f"{folder}/roc")
    if trained.importance is not None:
        trained.importance.write.mode(mode).json(f"{folder}/importance")
        scored_export(trained.model, test, target).write.mode(mode).parquet(f"{folder}/scored")
