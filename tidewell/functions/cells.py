"""Cell-level predicates: a cell is missing when it is NULL or NaN, infinite when it is ±Infinity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INFINITY = float("inf")


def ref(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def floating_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and f.name not in skip
    ]


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def missing(df: DataFrame, name: str) -> Column:
    cell = ref(name)
    return (cell.isNull() | F.isnan(cell)) if is_floating(df, name) else cell.isNull()


def infinite(cell: Column) -> Column:
    """True for ±Infinity, false otherwise, never NULL."""
    return F.coalesce(F.abs(cell) == F.lit(INFINITY), F.lit(False))


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    targets = list(columns) if columns is not None else floating_columns(df)
    return df.withColumns({c: F.when(~F.isnan(ref(c)), ref(c)) for c in targets if is_floating(df, c)})


def as_cell(df: DataFrame, name: str) -> Column:
    """The column as a double: numbers as they are, of other types only whether they are missing."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return ref(name).cast("double")
    return F.when(ref(name).isNotNull(), F.lit(0.0))


def cell_array(df: DataFrame, names: Iterable[str]) -> Column:
    """A row's cells as one array.

    Row-wide tests run as a loop over this array.  Spelled out per column they would make a
    generated method too long for the JVM to compile, and wide tables would run interpreted.
    """
    return F.array(*[as_cell(df, c) for c in names]).cast("array<double>")


def is_gap(cell: Column) -> Column:
    return cell.isNull() | F.isnan(cell)


def is_infinite(cell: Column) -> Column:
    return F.abs(cell) == F.lit(INFINITY)


def is_dirty(cell: Column) -> Column:
    return is_gap(cell) | is_infinite(cell)


def has_gap(cells: Column) -> Column:
    """Whether a cell array holds NULL or NaN.  ``array_contains`` compiles to a plain loop, and is
    NULL when the value is not found among cells that include NULL."""
    return F.coalesce(F.array_contains(cells, F.lit(float("nan"))), F.lit(True))


def has_infinity(cells: Column) -> Column:
    found = [F.coalesce(F.array_contains(cells, F.lit(v)), F.lit(False)) for v in (INFINITY, -INFINITY)]
    return found[0] | found[1]


def count_gaps(cells: Column) -> Column:
    """Missing cells of a row; clean rows stop at the compiled test."""
    return F.when(has_gap(cells), F.size(F.filter(cells, is_gap))).otherwise(0).cast("long")


def count_infinities(cells: Column) -> Column:
    return F.when(has_infinity(cells), F.size(F.filter(cells, is_infinite))).otherwise(0).cast("long")
