"""The profile pass: every cell statistic cleaning and reporting needs, in one scan.

Each task folds its Arrow batches into one small table (a row per group and column), vectorised over all columns at
once, and Spark adds the tables up; at most ``groups x columns`` rows per task are shuffled, so a file that
holds most of the rows costs nothing extra.  Exploding cells to rows would make ``rows x columns`` rows instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import as_cell, cell_array, ref
from tidewell.session import settle

ROW_MISSING = "*missing"  # pseudo column: missing where any cell of the row is missing
ROW_DIRTY = "*dirty"  # pseudo column: missing where any cell of the row is missing or infinite


def explode_cells(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``(by..., pos, v)`` with one row per cell."""
    return df.select(*[ref(k) for k in by], F.posexplode(cell_array(df, names)).alias("pos", "v"))


def name_of(names: Sequence[str], pos: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), pos + 1)


@dataclass(frozen=True)
class CellProfile:
    """Settled cell statistics, one row per group and column."""

    cells: DataFrame
    by: tuple[str, ...]
    columns: tuple[str, ...]
    numeric: tuple[str, ...]

    def per_column(self) -> DataFrame:
        """Real columns only."""
        return self.cells.filter(~F.col("column").isin(ROW_MISSING, ROW_DIRTY))

    def columns_with(self, counter: str) -> list[str]:
        """Names of the columns for which ``counter`` is above zero in any group."""
        hit = self.per_column().filter(F.col(counter) > 0).select("column").distinct().collect()
        found = {r["column"] for r in hit}
        return [c for c in self.columns if c in found]

    def totals(self) -> DataFrame:
        """One row per group: rows, infinite cells, missing cells, rows with a missing cell."""
        real = ~F.col("column").isin(ROW_MISSING, ROW_DIRTY)
        return self.cells.groupBy(*[ref(k) for k in self.by]).agg(
            F.max("rows").alias("rows"),
            F.sum(F.when(real, F.col("n_inf")).otherwise(0)).alias("infinity_values"),
            F.sum(F.when(real, F.col("n_missing")).otherwise(0)).alias("missing_values"),
            F.max(F.when(F.col("column") == ROW_MISSING, F.col("n_missing"))).alias("rows_missing"),
            F.max(F.when(F.col("column") == ROW_DIRTY, F.col("n_missing"))).alias("rows_dirty"),
        )

    def with_infinity_replaced(self, value: Column) -> CellProfile:
        """The profile as it is after every infinite cell became ``value``; saves a second scan."""
        sums = F.coalesce("finite_sum", F.lit(0.0)) + F.when(F.col("n_inf") > 0, F.col("n_inf") * value).otherwise(0.0)
        cells = self.cells.withColumn("finite_sum", sums).withColumn("n_inf", F.lit(0).cast("long"))
        return CellProfile(cells, self.by, self.columns, self.numeric)

    def values(self, value: Column, columns: Sequence[str], name: str) -> DataFrame:
        """``(by..., name: array<double>)`` holding ``value`` for ``columns``, in that order."""
        place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
        picked = self.cells.filter(F.col("column").isin(*columns)).select(
            *[ref(k) for k in self.by], F.struct(place.alias("p"), value.alias("x")).alias("s")
        )
        grouped = picked.groupBy(*[ref(k) for k in self.by]).agg(
            F.sort_array(F.collect_list("s")).alias("s")
        )
        return grouped.select(
            *[ref(k) for k in self.by], F.transform("s", lambda s: s["x"]).alias(name)
        )


KEYS_HELD = 50_000  # group and column pairs a task holds before it passes them on


def _folded(width: int, n_keys: int):
    """Arrow batches of ``keys..., cells...`` -> ``keys..., pos`` and the statistics of each cell column."""

    def rows_of(state: dict, schema: pa.Schema) -> pa.RecordBatch:
        keys = list(state)
        each = [np.stack([state[k][j] for k in keys]).reshape(-1) for j in range(6)]
        empty = ~np.isfinite(each[3])
        columns = [
            pa.array([k[i] for k in keys for _ in range(width + 2)], schema.field(i).type) for i in range(n_keys)
        ]
        columns += [pa.array(np.tile(np.arange(width + 2, dtype=np.int32), len(keys)))]
        columns += [pa.array(x.astype(np.int64)) for x in each[:3]]
        columns += [pa.array(x, mask=empty) for x in each[3:]]
        names = [f"k{i}" for i in range(n_keys)] + ["pos", "rows", "n_inf", "n_missing", "low", "high", "total"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple, list[np.ndarray]] = {}
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[n_keys:]])
            gap, inf = np.isnan(x), np.isinf(x)
            gap_row = gap.any(1)
            marks = np.where(np.column_stack([gap_row, gap_row | inf.any(1)]), np.nan, 0.0)
            x, gap, inf = np.hstack([x, marks]), np.hstack([gap, marks != marks]), np.hstack([inf, np.zeros_like(marks, bool)])
            code = np.zeros(len(x), np.int64)
            for column in batch.columns[:n_keys]:
                found = column.dictionary_encode("encode")
                code = code * (len(found.dictionary) + 1) + found.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) != 0]))
            if len(starts) > 1:
                x, gap, inf = x[order], gap[order], inf[order]
            fine = ~(gap | inf)
            parts = (
                np.diff(np.concatenate([starts, [len(x)]]))[:, None] * np.ones(width + 2),
                np.add.reduceat(inf, starts, dtype=float),
                np.add.reduceat(gap, starts, dtype=float),
                np.minimum.reduceat(np.where(fine, x, np.inf), starts),
                np.maximum.reduceat(np.where(fine, x, -np.inf), starts),
                np.add.reduceat(np.where(fine, x, 0.0), starts),
            )
            firsts = [batch.column(i).take(pa.array(order[starts])).to_pylist() for i in range(n_keys)]
            for g, key in enumerate(zip(*firsts) if n_keys else [()]):
                new = [p[g] for p in parts]
                old = state.get(key)
                if old is not None:
                    new = [old[0] + new[0], old[1] + new[1], old[2] + new[2], np.minimum(old[3], new[3]), np.maximum(old[4], new[4]), old[5] + new[5]]
                state[key] = new
            if len(state) * width > KEYS_HELD:
                yield rows_of(state, schema)
                state = {}
        if state:
            yield rows_of(state, schema)

    return fold


def profile_cells(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Lazy profile: ``by..., column, rows, n_inf, n_missing, finite_min/max/sum``."""
    names = [c for c in (columns or df.columns) if c not in by]
    keys = [f"k{i}" for i in range(len(by))]
    cells = df.select(
        *[ref(k).alias(alias) for k, alias in zip(by, keys)], *[as_cell(df, c).alias(f"c{i}") for i, c in enumerate(names)]
    )
    types = "".join(f"{alias} {df.schema[k].dataType.simpleString()}, " for k, alias in zip(by, keys))
    schema = types + "pos int, rows long, n_inf long, n_missing long, low double, high double, total double"
    parts = cells.mapInArrow(_folded(len(names), len(by)), schema)
    stats = parts.groupBy(*keys, "pos").agg(
        F.sum("rows").alias("rows"),
        F.sum("n_inf").alias("n_inf"),
        F.sum("n_missing").alias("n_missing"),
        F.min("low").alias("finite_min"),
        F.max("high").alias("finite_max"),
        F.sum("total").alias("finite_sum"),
    )
    return stats.select(
        *[F.col(alias).alias(k) for k, alias in zip(by, keys)],
        name_of([*names, ROW_MISSING, ROW_DIRTY], F.col("pos")).alias("column"),
        *[c for c in stats.columns if c not in keys and c != "pos"],
    )


def profile(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None
) -> CellProfile:
    """Run the profile pass."""
    names = [c for c in (columns or df.columns) if c not in by]
    numeric = [c for c in names if isinstance(df.schema[c].dataType, T.NumericType)]
    return CellProfile(settle(profile_cells(df, by, names)), tuple(by), tuple(names), tuple(numeric))
