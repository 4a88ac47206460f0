"""Scalers fitted on one frame and applied to any: statistics become constants in the plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import ref
from tidewell.operators.profile import explode_cells
from tidewell.operators.quantiles import quantiles

METHODS = ("standard", "minmax", "robust")


@dataclass(frozen=True)
class Scaler:
    """``(x - center) / width`` per column."""

    method: str
    center: dict[str, float]
    width: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (ref(c) - F.lit(self.center[c])) / F.lit(self.width[c]) for c in self.center}
        )


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard", exact: bool = True) -> Scaler:
    """Fit on ``df``; a constant column gets width 1, unknown methods fall back to standard.

    ``standard`` uses the population deviation, ``minmax`` does not clip later values,
    ``robust`` uses the median and the interpolated interquartile range.
    """
    names = list(columns)
    if method == "robust":
        stats: dict[str, dict[float, float]] = {}
        for row in quantiles(df, names, [0.25, 0.5, 0.75], exact=exact).collect():
            stats.setdefault(row["column"], {})[row["probability"]] = row["value"]
        center = {c: stats[c][0.5] for c in names}
        width = {c: stats[c][0.75] - stats[c][0.25] for c in names}
    else:
        v = F.when(~F.isnan("v"), F.col("v"))
        cells = explode_cells(df, (), names).withColumn("v", v)
        pair = (
            (F.min("v"), F.max("v") - F.min("v"))
            if method == "minmax"
            else (F.avg("v"), F.stddev_pop("v"))
        )
        rows = cells.groupBy("pos").agg(pair[0].alias("c"), pair[1].alias("w")).collect()
        found = {names[r["pos"]]: (r["c"], r["w"]) for r in rows}
        center = {c: found[c][0] for c in names}
        width = {c: found[c][1] for c in names}
    center = {c: 0.0 if v is None else float(v) for c, v in center.items()}
    width = {c: float(v) if v else 1.0 for c, v in width.items()}
    return Scaler(method if method in METHODS else "standard", center, width)
