"""Evaluation of scored rows: confusion matrix, metrics, ROC and precision-recall points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.cells import ref
from tidewell.operators.running import running_totals
from tidewell.session import settle

DEFAULT_BINS = 1000


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n`` for the pairs that occur."""
    return df.groupBy(ref(label).alias("label"), ref(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_wide(df: DataFrame, classes: list, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per label, one count column per predicted class."""
    counts = confusion_matrix(df, label, prediction)
    return counts.groupBy("label").pivot("prediction", classes).agg(F.sum("n")).na.fill(0)


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``class, support, precision, recall, f1`` per class, from the confusion counts."""
    pairs = settle(confusion_matrix(df, label, prediction))
    hit = F.when(F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = pairs.select(F.col("label").alias("class"), F.col("n").alias("a"), zero.alias("p"), hit.alias("h")).unionAll(
        pairs.select(F.col("prediction").cast(pairs.schema["label"].dataType), zero, "n", zero)
    )
    summed = sides.groupBy("class").agg(F.sum("a").alias("support"), F.sum("p").alias("p"), F.sum("h").alias("h"))
    precision, recall = F.try_divide("h", "p"), F.try_divide("h", "support")
    return summed.select(
        "class",
        "support",
        F.coalesce(precision, F.lit(0.0)).alias("precision"),
        F.coalesce(recall, F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("h"), F.col("p") + F.col("support")), F.lit(0.0)).alias("f1"),
    )


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; ties collapse map-side."""
    return df.groupBy(ref(score).cast("double").alias("score")).agg(
        F.sum(ref(label).cast("long")).alias("pos"), F.sum(1 - ref(label).cast("long")).alias("neg")
    )


def score_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``score, pos, neg, tp, fp``: counts at or above each distinct score, exact at any size."""
    curve = running_totals(_by_score(df, label, score), ["pos", "neg"], [F.desc("score")])
    return curve.select(
        "score", "pos", "neg", (F.col("pos") + F.col("pos_before")).alias("tp"), (F.col("neg") + F.col("neg_before")).alias("fp")
    )


def binary_metrics(
    df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5, best: bool = False
) -> DataFrame:
    """One row: ``n, auc, logloss, accuracy, precision, recall, f1``.

    ``label`` is 0/1 and ``score`` the probability of 1.  Accuracy and the like are taken at
    ``threshold``, or with ``best`` each at the distinct score that maximises it.
    """
    y, p = ref(label).cast("long"), ref(score).cast("double")
    bounded = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(y * F.ln(bounded) + (1 - y) * F.ln(1 - bounded))
    called = (p >= threshold).cast("long")
    base = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(loss).alias("logloss"),
        F.sum(y).alias("p"),
        F.sum(y * called).alias("tp"),
        F.sum((1 - y) * called).alias("fp"),
    ).first()
    n, positives = base["n"], base["p"] or 0
    negatives = n - positives
    tp, fp = F.col("tp"), F.col("fp")
    area = F.col("neg") * (tp - F.col("pos") / 2)
    measures = {
        "accuracy": (tp + (F.lit(negatives) - fp)) / F.lit(max(n, 1)),
        "precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, F.lit(positives)), F.lit(0.0)),
        "f1": F.coalesce(F.try_divide(2 * tp, tp + fp + F.lit(positives)), F.lit(0.0)),
    }
    curve = score_curve(df, label, score)
    peaks = [F.max(m).alias(f"best_{name}") for name, m in measures.items()] if best else []
    swept = curve.agg(F.sum(area).alias("area"), *peaks)
    auc = F.try_divide(F.col("area"), F.lit(float(positives) * negatives)).alias("auc")
    shown = swept.select(
        F.lit(n).cast("long").alias("n"),
        auc,
        F.lit(base["logloss"]).cast("double").alias("logloss"),
        F.lit(base["tp"] or 0).alias("tp"),
        F.lit(base["fp"] or 0).alias("fp"),
        *[F.col(f"best_{name}") for name in measures if best],
    )
    chosen = [(F.col(f"best_{m}") if best else e).cast("double").alias(m) for m, e in measures.items()]
    return shown.select("n", "auc", "logloss", *chosen)


def roc_points(
    df: DataFrame, label: str = "label", score: str = "score", bins: int = DEFAULT_BINS, low: float = 0.0, high: float = 1.0
) -> DataFrame:
    """``threshold, tp, fp, tpr, fpr, precision`` at the lower edge of each occupied score bin.

    Recall equals ``tpr``.  ``[low, high]`` is where scores are expected and sets the width of a bin; a score outside gets
    a bin of the same width further out, and ``high`` itself belongs to the last bin inside.
    """
    if bins < 1 or not low < high:
        raise ValueError("bins must be positive and low below high")
    place = F.floor((ref(score) - low) / (high - low) * bins)
    counts = (
        df.groupBy(F.when(ref(score) == high, F.lit(bins - 1)).otherwise(place).alias("bin"))
        .agg(F.sum(ref(label).cast("long")).alias("pos"), F.sum(1 - ref(label).cast("long")).alias("neg"))
    )
    down = W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
    whole = W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    curve = counts.select(
        (F.lit(low) + F.col("bin") * (high - low) / bins).alias("threshold"),
        F.sum("pos").over(down).alias("tp"),
        F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(whole).alias("p"),
        F.sum("neg").over(whole).alias("q"),
    )
    return curve.select(
        "threshold",
        "tp",
        "fp",
        F.try_divide("tp", "p").alias("tpr"),
        F.try_divide("fp", "q").alias("fpr"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )
