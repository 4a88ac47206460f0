"""Pairwise-complete Pearson correlation of many columns in two passes.

Pass one takes column means.  Pass two folds each partition into one masked Gramian of the
centred values (count, sums, squares and cross products per pair, O(d²) state whatever the
partition holds) and the partials are summed per pair.  A wide matrix of built-in ``corr``
aggregates would need thousands of expressions in one plan, and each raises on a constant
column; here zero variance gives NULL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import is_dirty, numeric_columns, ref
from tidewell.operators.profile import explode_cells, name_of

_PARTIAL = "i int, j int, n double, si double, sj double, sii double, sjj double, sij double"


def _gramians(centers: np.ndarray):
    width = len(centers)
    upper_i, upper_j = np.triu_indices(width)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            x -= centers  # here and not in the plan, whose wide projection would not compile
            seen = ~np.isnan(x)
            with np.errstate(invalid="ignore", over="ignore"):
                if seen.all():
                    ones = np.ones((width, width))
                    counts, sums, squares = ones * len(x), x.sum(0)[:, None] * ones, (x * x).sum(0)[:, None] * ones
                else:
                    x = np.where(seen, x, 0.0)
                    mask = seen.astype(float)
                    counts, sums, squares = mask.T @ mask, x.T @ mask, (x * x).T @ mask
                part = np.stack([counts, sums, sums.T, squares, squares.T, x.T @ x])
            state = part if state is None else state + part
        if state is not None:
            flat = [state[k][upper_i, upper_j] for k in range(6)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper_i.astype(np.int32)), pa.array(upper_j.astype(np.int32)), *map(pa.array, flat)],
                names=["i", "j", "n", "si", "sj", "sii", "sjj", "sij"],
            )

    return fold


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``i, j, column_i, column_j, r`` for ``i <= j``; ``r`` is NULL where it is undefined."""
    names = list(columns or numeric_columns(df))
    values = df.select(*[ref(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    cells = explode_cells(values, (), values.columns)
    finite = F.when(~is_dirty(F.col("v")), F.col("v"))
    means = {r["pos"]: r["m"] for r in cells.groupBy("pos").agg(F.avg(finite).alias("m")).collect()}
    centers = np.array([means.get(i) or 0.0 for i in range(len(names))])
    summed = (
        values.mapInArrow(_gramians(centers), _PARTIAL)
        .groupBy("i", "j")
        .agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])
    )
    n = F.col("n")
    vi = n * F.col("sii") - F.col("si") * F.col("si")
    vj = n * F.col("sjj") - F.col("sj") * F.col("sj")
    # rounding noise of a constant column must not read as variance
    noise = 1e-14
    varies = (vi > n * F.col("sii") * noise) & (vj > n * F.col("sjj") * noise)
    r = F.try_divide(n * F.col("sij") - F.col("si") * F.col("sj"), F.sqrt(vi) * F.sqrt(vj))
    bounded = F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))
    return summed.select(
        "i",
        "j",
        name_of(names, F.col("i")).alias("column_i"),
        name_of(names, F.col("j")).alias("column_j"),
        F.when(varies & ~F.isnan(r), bounded).alias("r"),
    )


def correlated_columns(
    df: DataFrame, threshold: float = 0.95, columns: Sequence[str] | None = None, matrix: DataFrame | None = None
) -> DataFrame:
    """``column``: every column with |r| above ``threshold`` to some earlier one.

    The earlier column counts even if it is itself on the list; undefined r never counts.
    """
    pairs = matrix if matrix is not None else correlation_matrix(df, columns)
    hit = pairs.filter((F.col("i") < F.col("j")) & (F.abs("r") > threshold))
    return hit.groupBy(F.col("column_j").alias("column")).agg(F.min("j").alias("position"))
