"""Scoring a stream with a fitted model and alerting on attacks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.models import score_binary


def score_stream(model: PipelineModel, stream: DataFrame) -> DataFrame:
    """``prediction`` and ``score`` next to every row; stateless, so it works on streams as on tables."""
    return score_binary(model, stream)


def alerts(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Scored rows called an attack at ``threshold``."""
    return scored.filter(F.col("score") >= threshold)
