"""Forward fill in one shuffle: fill inside sorted partitions, then a carry between them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import missing, ref
from tidewell.operators.profile import profile
from tidewell.session import durable, settle

PART, ROW = "__part", "__row"


def _present(column: pa.Array) -> np.ndarray:
    here = pc.is_valid(column)
    if pa.types.is_floating(column.type):
        here = pc.and_(here, pc.invert(pc.fill_null(pc.is_nan(column), True)))
    return here.to_numpy(zero_copy_only=False)


def _filled(keys: list[int], targets: list[int]):
    """Fill gaps from above within runs of equal keys; rows arrive in order.  Adds the partition and row number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last_key = TaskContext.get().partitionId(), 0, None
        above: dict[int, pa.Array] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for k in keys:
                codes = batch.column(k).dictionary_encode("encode").indices.to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            first = tuple(str(batch.column(k)[0].as_py()) for k in keys)
            goes_on = first == last_key
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
            columns = list(batch.columns)
            for t in targets:
                # index 0 is the last present value of the batch before, if its run goes on
                before = above.get(t) if goes_on else None
                known = before is not None
                column = batch.column(t)
                joined = pa.concat_arrays([before if known else pa.nulls(1, column.type), column])
                at = np.maximum.accumulate(np.concatenate([[0], np.where(_present(column), np.arange(1, n + 1), 0)]))[1:]
                ok = (at >= start) | ((start == 1) & ((at > 0) | known))
                columns[t] = joined.take(pa.array(np.where(ok, at, 0), mask=~ok))
                above[t] = columns[t].slice(n - 1, 1) if columns[t][n - 1].is_valid else None
            last_key = tuple(str(batch.column(k)[n - 1].as_py()) for k in keys)
            numbers = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n))]
            row += n
            yield pa.RecordBatch.from_arrays([*columns, *numbers], names=[*batch.schema.names, PART, ROW])

    return run


def forward_fill(
    df: DataFrame, by: Sequence[str], order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace each missing cell by the last present one above it in its group.

    ``order_by`` must order the rows of a group uniquely.  Leading gaps stay missing (NULL).
    Rows are sorted by range once, so a large group spreads over many partitions; gaps are filled as the sorted rows
    stream by, and the result is written once.  What a partition inherits is one row per group and partition.
    """
    if columns is None:
        columns = profile(df, by).columns_with("n_missing")
    targets = [c for c in columns if c not in by]
    if not targets:
        return df
    names = df.columns
    ordered = df.orderBy(*[ref(k) for k in by], *[ref(k) for k in order_by])
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema]
        + [T.StructField(PART, T.IntegerType()), T.StructField(ROW, T.LongType())]
    )
    run = _filled([names.index(k) for k in by], [names.index(c) for c in targets])
    filled = durable(ordered.mapInArrow(run, schema), "filled")
    group = F.struct(F.lit(0).alias("all"), *[ref(k) for k in by])  # never NULL, so joins are plain equality
    tails = filled.groupBy(group.alias("__group"), PART).agg(
        *[F.max_by(ref(c), F.when(~missing(df, c), F.col(ROW))).alias(f"__last{i}") for i, c in enumerate(targets)]
    )
    earlier = W.partitionBy("__group").orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carries = settle(
        tails.select(
            F.col("__group").alias("__g"),
            F.col(PART).alias("__p"),
            *[F.last(f"__last{i}", ignorenulls=True).over(earlier).alias(f"__carry{i}") for i in range(len(targets))],
        )
    )
    joined = filled.join(carries, (group == F.col("__g")) & (F.col(PART) == F.col("__p")), "left")
    carry = {c: F.col(f"__carry{i}") for i, c in enumerate(targets)}
    return joined.select(*[F.coalesce(ref(c), carry[c]).alias(c) if c in carry else ref(c) for c in names])
