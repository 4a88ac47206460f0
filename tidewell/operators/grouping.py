"""Joining per-group statistics back to rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import ref


def _constant(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        items = [_constant(v, dtype.elementType) for v in value or []]
        return F.array(*items) if value is not None else F.lit(None).cast(dtype)
    return F.lit(value).cast(dtype)


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join ``stats`` on the group columns (NULL groups match).

    There is no broadcast hint: ``stats`` comes from ``settle``, so Catalyst sees its
    real size and broadcasts it only below ``autoBroadcastJoinThreshold``; above it
    the join is shuffled and AQE splits a hot group.  Without group columns ``stats``
    is one row and enters the plan as constants.
    """
    if not by:
        row = stats.first()
        return df.withColumns(
            {f.name: _constant(row[f.name] if row else None, f.dataType) for f in stats.schema}
        )
    keys = {name: f"__group{i}" for i, name in enumerate(by)}
    renamed = stats.select(
        *[ref(name).alias(alias) for name, alias in keys.items()],
        *[ref(c) for c in stats.columns if c not in keys],
    )
    condition = reduce(
        lambda a, b: a & b, [ref(name).eqNullSafe(F.col(alias)) for name, alias in keys.items()]
    )
    return df.join(renamed, condition, "left").drop(*keys.values())
