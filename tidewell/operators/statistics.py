"""Descriptive statistics; wide tables go through the exploded ``(group, column)`` aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import numeric_columns, ref
from tidewell.operators.grouping import attach
from tidewell.operators.profile import explode_cells, name_of
from tidewell.operators.quantiles import quantiles


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``label, n, percent`` in descending order; the share window runs over one row per class."""
    counts = df.groupBy(ref(label)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy().agg(F.sum("n").alias("__total"))
    shared = attach(counts, total, [])
    return shared.select(ref(label), "n", (F.col("n") * 100.0 / F.col("__total")).alias("percent")).orderBy(
        F.desc("n"), ref(label)
    )


def _moments(df: DataFrame, columns: Sequence[str], by: Sequence[str], *aggregates) -> DataFrame:
    cells = explode_cells(df, by, columns)
    v = F.when(~F.isnan("v"), F.col("v"))
    grouped = cells.withColumn("v", v).groupBy(*[ref(k) for k in by], "pos").agg(*aggregates)
    keep = [c for c in grouped.columns if c not in by and c != "pos"]
    return grouped.select(*[ref(k) for k in by], name_of(columns, F.col("pos")).alias("column"), *keep)


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """``column, count, mean, std, min, q25, q50, q75, max`` with interpolated quartiles."""
    names = list(columns or numeric_columns(df))
    base = _moments(
        df,
        names,
        (),
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    points = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quart = quantiles(df, names, list(points), exact=exact)
    wide = quart.groupBy("column").agg(
        *[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for p, n in points.items()]
    )
    return base.join(wide, "column", "left")


def variances(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, variance``: population variance, missing cells ignored."""
    names = list(columns or numeric_columns(df))
    return _moments(df, names, (), F.var_pop("v").alias("variance"))


def low_variance(df: DataFrame, threshold: float = 0.01, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, variance`` of the columns at or below ``threshold``."""
    return variances(df, columns).filter(F.col("variance") <= threshold)


def group_statistics(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75, 0.95),
    exact: bool = True,
) -> DataFrame:
    """``by..., column, n, mean, std, p25...``: moments and percentiles per group and column."""
    base = _moments(
        df,
        columns,
        by,
        F.count("v").alias("n"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
    )
    quart = quantiles(df, columns, probabilities, by, exact=exact)
    keys = [*by, "column"]
    wide = quart.groupBy(*[ref(k) for k in keys]).agg(
        *[
            F.max(F.when(F.col("probability") == float(p), F.col("value"))).alias(f"p{p * 100:g}".replace(".", "_"))
            for p in probabilities
        ]
    )
    return attach(base, wide, keys)
