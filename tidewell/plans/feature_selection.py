"""Feature selection: filters by correlation, variance and name, then a forest ranking."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import numeric_columns, ref
from tidewell.functions.labels import BENIGN, binary_label
from tidewell.functions.names import IDENTITY_COLUMNS, TARGET, identity_split
from tidewell.operators.correlation import correlated_columns
from tidewell.operators.infinity import replace_infinite
from tidewell.operators.missing import drop_missing, fill_missing
from tidewell.operators.models import FOREST, model_importance, train_forest
from tidewell.operators.profile import profile
from tidewell.operators.sampling import DEFAULT_ROWS, sample_exact
from tidewell.operators.statistics import low_variance
from tidewell.session import durable

# Thresholds of the filters and the number of features kept.
CORRELATION = 0.95
VARIANCE = 0.01
MAX_FEATURES = 30


def clean_split(df: DataFrame, infinity: str = "max", missing: str = "drop", fit_on: DataFrame | None = None) -> DataFrame:
    """Clean a whole split with its own statistics, or with those of ``fit_on``.

    ``infinity`` is ``max`` (a column without a finite value becomes missing) or ``null``.
    """
    fitted = profile(fit_on) if fit_on is not None and infinity == "max" else None
    finite = replace_infinite(df, (), infinity, fallback=None, fitted=fitted)
    if missing == "drop":
        return drop_missing(finite)
    source = replace_infinite(fit_on, (), infinity, fallback=None) if fit_on is not None else None
    return fill_missing(finite, (), missing, fit_on=source)


def feature_importance(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    rows: int | None = DEFAULT_ROWS,
    key: Sequence[str] | None = None,
    **params,
) -> DataFrame:
    """``feature, importance, rank``: normalised Gini importances of a forest, descending.

    The forest is fitted on a seeded sample of ``rows`` rows, or on all of them with ``None``.
    """
    sample = df if rows is None else sample_exact(df, rows, key, params.get("seed", FOREST["seed"]))
    narrow = sample.select(*[ref(c).cast("double").alias(c) for c in features], ref(label))
    if rows is not None:  # the fit reads its input several times; the sample is small enough to keep
        narrow = durable(narrow, "sample")
    model = train_forest(narrow, features, label, **params)
    return model_importance(model, None).select("feature", "importance", "rank")


def top_features(importance: DataFrame, n: int = MAX_FEATURES) -> list[str]:
    ranked = importance.orderBy(F.desc("importance"), "feature").limit(n)
    return [r["feature"] for r in ranked.collect()]


def select_features(
    train: DataFrame,
    target: str = TARGET,
    benign: str = BENIGN,
    drops: Sequence[str] = IDENTITY_COLUMNS,
    correlation: float = CORRELATION,
    variance: float = VARIANCE,
    max_features: int = MAX_FEATURES,
    match: str = "substring",
    rows: int | None = DEFAULT_ROWS,
    key: Sequence[str] | None = None,
    **params,
) -> DataFrame:
    """``feature, position, importance, rank, selected, drop_reason`` for every column but the target.

    ``train`` is a cleaned split.  The first reason that applies is shown: not numeric, configured,
    identity, correlated, low variance; columns without one are ranked.
    """
    names = [c for c in train.columns if c != target]
    numbers = numeric_columns(train, exclude=[target])
    correlated = {r["column"] for r in correlated_columns(train, correlation, numbers).collect()}
    flat = {r["column"] for r in low_variance(train, variance, numbers).collect()}
    identity = set(identity_split(names, target, match)[1])
    reasons = [
        ("not_numeric", set(names) - set(numbers)),
        ("configured", set(drops)),
        ("identity", identity),
        ("correlated", correlated),
        ("low_variance", flat),
    ]
    why = {c: next((r for r, s in reasons if c in s), None) for c in names}
    clean = [c for c in names if why[c] is None]
    labelled = train.withColumn("__y", binary_label(ref(target), benign))
    ranked = feature_importance(labelled, clean, "__y", rows, key, **params)
    spark = train.sparkSession
    listing = spark.createDataFrame(
        [(c, i, why[c]) for i, c in enumerate(names)], "feature string, position int, drop_reason string"
    )
    joined = listing.join(ranked, "feature", "left")
    return joined.withColumn("selected", F.coalesce(F.col("rank") <= max_features, F.lit(False))).select(
        "feature", "position", "importance", "rank", "selected", "drop_reason"
    )


def write_reports(selection: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Ranking as CSV, the selected names with their count as JSON, the top 20 as text."""
    ranked = selection.filter(F.col("rank").isNotNull()).select("feature", "importance", "rank").orderBy("rank")
    ranked.select("feature", "importance").coalesce(1).write.mode(mode).option("header", "true").csv(f"{folder}/feature_importance")
    rows = selection.filter("selected").orderBy("rank").select("feature", "importance").collect()
    names = [r["feature"] for r in rows]
    spark = selection.sparkSession
    body = json.dumps({"selected_features": names, "count": len(names)})
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode(mode).text(f"{folder}/selected_features")
    table = ["rank\tfeature\timportance"] + [f"{i}\t{r['feature']}\t{r['importance']:.6f}" for i, r in enumerate(rows[:20], 1)]
    spark.createDataFrame([("\n".join(table),)], "value string").coalesce(1).write.mode(mode).text(f"{folder}/report")
