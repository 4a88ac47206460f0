"""A global row order that later passes can share.

``number_rows`` range-partitions and sorts by the full order (so no key value, however
frequent, ends up in one task), numbers rows within partitions, and writes the result:
boundaries come from sampling, so only the written table gives every later pass, and every
retry, the same numbers.  ``BUCKET`` cuts the order into runs of bounded length, the unit in
which running computations are done before a carry from the earlier runs is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import durable

ROW = "__row"
BUCKET = "__bucket"
BUCKET_ROWS = 1_000_000


def number_rows(
    df: DataFrame, order_by: Sequence[Column | str], bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``ROW`` (increasing in ``order_by``) and ``BUCKET`` (at most ``bucket_rows`` rows each)."""
    ordered = df.orderBy(*order_by).withColumn(ROW, F.monotonically_increasing_id())
    bucketed = ordered.withColumn(BUCKET, F.expr(f"{ROW} div {int(bucket_rows)}"))
    return durable(bucketed, "ordered")
