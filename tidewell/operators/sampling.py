"""Row samples of an exact size, reproducible and without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import ref
from tidewell.operators.running import running_totals

DEFAULT_ROWS = 100_000  # fixed value: rows used for the preliminary ranking
_SPAN = 1 << 62


def sample_exact(df: DataFrame, n: int = DEFAULT_ROWS, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement (all rows if there are fewer): those with the smallest hash.

    The sample is a filter ``hash <= threshold``, so it keeps the partitioning of ``df`` and moves no
    rows.  The n-th smallest hash is found among the few hashes close to its expected place; should
    it lie outside, the range is widened, so the size is exact.  ``key`` should identify rows (by
    default all columns are hashed); only of rows that share the threshold hash are some left out.
    """
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if total <= n:
        return df
    columns = [ref(c) for c in (key or df.columns)]
    # xxhash64 is uniform over 64 bits; 62 of them leave room for the arithmetic
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 2)
    margin = 6 * (n**0.5) + 20
    while True:
        low = max(0, int((n - margin) / total * _SPAN))
        high = min(_SPAN, int((n + margin) / total * _SPAN))
        place = F.when(draw < low, F.lit(-1)).otherwise(draw)
        near = df.filter(draw < high).groupBy(place.alias("at")).agg(F.count(F.lit(1)).alias("c"))
        ranked = running_totals(near, ["c"], ["at"])
        upto = F.col("c_before") + F.col("c")
        hit = ranked.filter((F.col("c_before") < n) & (upto >= n)).select("at", "c_before", "c").first()
        if hit is not None and hit["at"] >= 0:
            break
        margin *= 4
    edge, wanted = hit["at"], n - hit["c_before"]
    if wanted == hit["c"]:
        return df.filter(draw <= edge)
    tied = df.filter(draw == edge).withColumn("__one", F.lit(1).cast("long"))
    some = running_totals(tied, ["__one"], columns).filter(F.col("__one_before") < wanted)
    return df.filter(draw < edge).unionAll(some.drop("__one", "__one_before"))
