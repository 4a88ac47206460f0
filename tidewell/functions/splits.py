"""Time-ordered train/test splits; never random."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import ref


def split_by_source(
    df: DataFrame, train: Sequence[str], test: Sequence[str], source: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by source name: a pushed-down filter, or partition pruning if laid out so."""
    both = set(train) & set(test)
    if both:
        raise ValueError(f"sources on both sides of the split: {sorted(both)}")
    return df.filter(ref(source).isin(list(train))), df.filter(ref(source).isin(list(test)))


def split_by_time(df: DataFrame, at: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """``(before cutoff, from cutoff on)``; rows without a time are in neither."""
    edge = F.lit(cutoff).cast(df.schema[at].dataType)
    return df.filter(ref(at) < edge), df.filter(ref(at) >= edge)
