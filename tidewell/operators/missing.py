"""Missing cells: counting, dropping, and filling with group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import cell_array, count_gaps, missing, numeric_columns, ref
from tidewell.operators.grouping import attach
from tidewell.operators.profile import CellProfile, profile
from tidewell.operators.quantiles import quantile_values
from tidewell.session import settle


def count_missing(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., n_missing``: NULL or NaN over all columns of each group."""
    cells = cell_array(df, [c for c in df.columns if c not in by])
    packed = df.select(*[ref(k) for k in by], cells.alias("cells"))
    packed = packed.withColumn("n", count_gaps(F.col("cells")))
    return packed.groupBy(*[ref(k) for k in by]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_missing"))


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop every row with a missing cell; a narrow filter."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def fill_missing(
    df: DataFrame,
    by: Sequence[str] = (),
    how: str = "median",
    exact: bool = True,
    prof: CellProfile | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Fill numeric gaps with the column's median or mean in the row's group.

    Statistics come from ``df`` itself or from ``fit_on``.  Infinite cells are expected
    to be gone.  Only columns that hold a gap are rewritten (all numeric ones with
    ``fit_on``); integer columns that held NULL become double, like their fill value.
    """
    if how not in ("median", "mean"):
        raise ValueError(f"unknown fill {how!r}")
    source = fit_on if fit_on is not None else df
    numeric = numeric_columns(df, exclude=by)
    if fit_on is None or how == "mean":
        prof = prof or profile(source, by, numeric)
    if fit_on is None:
        gaps = set(prof.columns_with("n_missing"))
        targets = [c for c in numeric if c in gaps]
    else:
        targets = numeric
    if not targets:
        return df
    if how == "mean":
        present = F.col("rows") - F.col("n_missing") - F.col("n_inf")
        fills = settle(prof.values(F.try_divide(F.col("finite_sum"), present), targets, "__fill"))
    else:
        fills = quantile_values(source, targets, [0.5], by, name="__fill", exact=exact)
    wide = attach(df, fills, by)
    return wide.withColumns(
        {
            name: F.when(missing(df, name), F.col("__fill")[i]).otherwise(ref(name).cast("double"))
            for i, name in enumerate(targets)
        }
    ).drop("__fill")


def sparse_columns(df: DataFrame, threshold: float = 0.5, prof: CellProfile | None = None) -> list[str]:
    """Names of columns whose missing share over the whole frame is above ``threshold``."""
    prof = prof or profile(df)
    shares = prof.per_column().groupBy("column").agg(
        (F.sum("n_missing") / F.greatest(F.sum("rows"), F.lit(1))).alias("share")
    )
    hit = {r["column"] for r in shares.filter(F.col("share") > threshold).collect()}
    return [c for c in prof.columns if c in hit]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5, prof: CellProfile | None = None) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold, prof))
