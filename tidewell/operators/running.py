"""Running totals over data of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.cells import ref
from tidewell.operators.ordering import BUCKET, BUCKET_ROWS, ROW, number_rows
from tidewell.session import durable

SMALL_ROWS = 200_000


def running_totals(
    df: DataFrame,
    values: Sequence[str],
    order_by: Sequence[Column | str],
    by: Sequence[str] = (),
    small: int = SMALL_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``<value>_before``: the sum of ``value`` over the group's earlier rows.

    The rows are written once; none comes to the driver.  Up to ``small`` rows one window does it.  Beyond that rows are range-ordered once, summed
    inside buckets of bounded length, and each bucket gets the totals of the buckets before it;
    the per-group window then runs over one row per bucket.
    """
    settled = durable(df, "running")
    group = F.struct(F.lit(0).alias("all"), *[ref(k) for k in by])
    if settled.count() <= small:  # counted from the footers
        over = W.partitionBy(group).orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
        return settled.withColumns({f"{v}_before": F.coalesce(F.sum(ref(v)).over(over), F.lit(0)) for v in values})
    numbered = number_rows(settled, [*[ref(k) for k in by], *order_by], bucket_rows).withColumn("__group", group)
    totals = numbered.groupBy("__group", BUCKET).agg(*[F.sum(ref(v)).alias(f"__t_{v}") for v in values])
    earlier = W.partitionBy("__group").orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "__group", BUCKET, *[F.coalesce(F.sum(f"__t_{v}").over(earlier), F.lit(0)).alias(f"__o_{v}") for v in values]
    )
    within = W.partitionBy("__group", BUCKET).orderBy(ROW).rowsBetween(W.unboundedPreceding, -1)
    local = numbered.withColumns({f"__l_{v}": F.coalesce(F.sum(ref(v)).over(within), F.lit(0)) for v in values})
    joined = local.join(offsets, ["__group", BUCKET])
    return joined.select(
        *[ref(c) for c in df.columns],
        *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).alias(f"{v}_before") for v in values],
    )
