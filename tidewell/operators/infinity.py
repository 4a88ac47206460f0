"""Infinite cells: counting and replacement, with statistics scoped per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import (
    cell_array,
    count_infinities,
    floating_columns,
    has_gap,
    has_infinity,
    infinite,
    is_floating,
    ref,
)
from tidewell.operators.grouping import attach
from tidewell.operators.profile import CellProfile, profile
from tidewell.session import settle

LARGE_VALUE = 1_000_000_000
STRATEGIES = ("max", "large_int", "drop", "null")


def count_infinite(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., n_inf``: ±Infinity over all numeric cells of each group, one narrow aggregate."""
    cells = cell_array(df, floating_columns(df, exclude=by))
    packed = df.select(*[ref(k) for k in by], cells.alias("cells"))
    packed = packed.withColumn("n", count_infinities(F.col("cells")))
    return packed.groupBy(*[ref(k) for k in by]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_inf"))


def replace_infinite(
    df: DataFrame,
    by: Sequence[str] = (),
    strategy: str = "max",
    large_value: float = LARGE_VALUE,
    fallback: float | None = LARGE_VALUE,
    signed: bool = False,
    prof: CellProfile | None = None,
    fitted: CellProfile | None = None,
) -> DataFrame:
    """Handle ±Infinity.

    ``max``       both signs become the largest finite value of the column in the row's group;
                  a group without a finite value takes ``fallback`` (``None``: missing).
                  ``signed=True`` sends −Infinity to the smallest finite value instead.
    ``large_int`` both signs become ``large_value``.
    ``null``      both signs become missing; rows stay.
    ``drop``      in a group that holds any infinite cell, every row with an infinite or
                  missing cell in any column goes; other groups are left alone.

    ``prof`` reuses a profile of this very frame.  ``fitted`` applies the statistics of
    another frame (fit on train, apply to test).  Columns without an infinite cell are
    not rewritten, so a clean table keeps its plan.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown infinity strategy {strategy!r}; one of {STRATEGIES}")
    if strategy == "drop":
        return _drop_dirty_groups(df, by, prof)
    if fitted is not None:
        targets = [c for c in floating_columns(df, exclude=by) if c in fitted.columns]
    elif strategy == "max":
        prof = prof or profile(df, by)
        targets = [c for c in prof.columns_with("n_inf") if is_floating(df, c)]
    else:
        targets = floating_columns(df, exclude=by)
    if not targets:
        return df
    if strategy != "max":
        value = F.lit(large_value if strategy == "large_int" else None)
        return df.withColumns(
            {c: F.when(infinite(ref(c)), value.cast(df.schema[c].dataType)).otherwise(ref(c)) for c in targets}
        )
    source = fitted or prof
    low = F.col("finite_min") if signed else F.col("finite_max")
    bounds = settle(
        source.values(F.array(F.col("finite_max"), low), targets, "__bounds")
    )
    wide = attach(df, bounds, by)
    default = F.lit(fallback).cast("double")
    rewritten = {}
    for i, name in enumerate(targets):
        pair = F.col("__bounds")[i]
        finite = F.when(ref(name) > 0, pair[0]).otherwise(pair[1])
        rewritten[name] = F.when(
            infinite(ref(name)), F.coalesce(finite, default).cast(df.schema[name].dataType)
        ).otherwise(ref(name))
    return wide.withColumns(rewritten).drop("__bounds")


def _drop_dirty_groups(df: DataFrame, by: Sequence[str], prof: CellProfile | None) -> DataFrame:
    df = df.withColumn("__cells", cell_array(df, [c for c in df.columns if c not in by]))
    clean = ~(has_gap(F.col("__cells")) | has_infinity(F.col("__cells")))
    if by:
        prof = prof or profile(df.drop("__cells"), by)
        flags = settle(
            prof.totals().select(*[ref(k) for k in by], (F.col("infinity_values") > 0).alias("__hit"))
        )
        wide = attach(df, flags, by)
        return wide.filter(~F.coalesce(F.col("__hit"), F.lit(False)) | clean).drop("__hit", "__cells")
    if not (prof or profile(df.drop("__cells"))).columns_with("n_inf"):
        return df.drop("__cells")
    return df.filter(clean).drop("__cells")


__all__ = ["LARGE_VALUE", "count_infinite", "replace_infinite"]
