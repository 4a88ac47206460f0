"""Data-quality checks per source.

``checked_rows`` shuffles two 64-bit hashes per row next to its counts.  Only rows whose hashes occur more than once
are then read again and compared in full, so duplicate counts are exact and a table without duplicates never moves a row.
Copies collapse map-side, so one row that makes up much of the table is not a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import cell_array, count_gaps, count_infinities, is_floating, ref
from tidewell.operators.grouping import attach
from tidewell.session import durable, settle


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row that equal rows share; NULLs count by their position, -0.0 is 0.0.

    Cells are hashed as arrays, one per type, so the generated code stays a few loops however wide the row is.
    """
    holes = F.array(*[ref(c).isNull() for c in df.columns])
    kinds: dict[str, list[Column]] = {}
    for f in df.schema:
        cell = ref(f.name) + F.lit(0.0).cast(f.dataType) if is_floating(df, f.name) else ref(f.name)
        kinds.setdefault(f.dataType.simpleString(), []).append(cell)
    arrays = [F.array(*cells) for _, cells in sorted(kinds.items())]
    return F.xxhash64(holes, *arrays), F.xxhash64(F.lit("second"), *reversed(arrays), holes)


def _hashed(df: DataFrame) -> DataFrame:
    one, two = row_hashes(df)
    return df.withColumns({"__h1": one, "__h2": two})


def checked_rows(df: DataFrame, by: Sequence[str], count_cells: bool = True) -> DataFrame:
    """``by..., total_rows, infinity_values, missing_values, duplicate_rows``.

    NaN equals NaN and 0.0 equals -0.0 when rows are compared.  The first scan is written folded: a row per group for
    what occurs once and a row per pair of hashes that repeats.  Without repeats there is no second scan.
    ``count_cells=False`` is for tables known to have no infinite or missing cell.
    """
    names = [c for c in df.columns if c not in by]
    keys = [ref(k) for k in by]
    found = {"i": F.lit(0), "g": F.lit(0)}
    hashed = _hashed(df)
    if count_cells:
        hashed = hashed.withColumn("__cells", cell_array(df, names))
        found = {"i": count_infinities(F.col("__cells")), "g": count_gaps(F.col("__cells"))}
    packed = hashed.select(*keys, "__h1", "__h2", *[c.cast("long").alias(n) for n, c in found.items()])
    sums = [F.sum(c).alias(c) for c in found]
    copies = packed.groupBy(*keys, "__h1", "__h2").agg(F.count(F.lit(1)).alias("n"), *sums)
    again = F.when(F.col("n") > 1, F.struct("__h1", "__h2")).alias("again")
    folded = durable(copies.groupBy(*keys, again).agg(F.sum("n").alias("n"), *sums), "copies")

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0))

    counted = settle(
        folded.groupBy(*keys).agg(
            total("n").alias("total_rows"),
            total("i").alias("infinity_values"),
            total("g").alias("missing_values"),
            F.count("again").alias("suspected"),
        )
    )
    plain = counted.select(*keys, "total_rows", "infinity_values", "missing_values", F.lit(0).cast("long").alias("duplicate_rows"))
    if not counted.agg(F.max("suspected")).first()[0]:
        return plain  # equal rows have equal hashes
    repeated = folded.filter("again is not null").select("again.*").distinct()
    suspects = _hashed(df).join(repeated, ["__h1", "__h2"], "left_semi").drop("__h1", "__h2")
    exact = suspects.groupBy(*[ref(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    exact = exact.groupBy(*keys).agg(F.sum(F.col("__n") - 1).alias("__duplicates"))
    if not by:  # one row, entered as a constant
        return attach(plain.drop("duplicate_rows"), exact.select(total("__duplicates").alias("duplicate_rows")), [])
    found = attach(plain.drop("duplicate_rows"), settle(exact), by)
    return found.withColumn("duplicate_rows", F.coalesce("__duplicates", F.lit(0))).drop("__duplicates")


def duplicate_counts(df: DataFrame, by: Sequence[str] = (), method: str = "rows") -> DataFrame:
    """``by..., duplicate_rows`` = rows − distinct rows; nothing is removed.

    ``rows`` compares whole rows.  ``fingerprint`` trusts the two hashes and saves the second pass, where an
    accidental 128-bit match (below 1e-14 for 10^12 rows) is acceptable.
    """
    if method == "rows":
        return checked_rows(df, by, count_cells=False).select(*[ref(k) for k in by], "duplicate_rows")
    if method != "fingerprint":
        raise ValueError(f"unknown method {method!r}")
    counted = _hashed(df).groupBy(*[ref(k) for k in by], "__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"))
    return counted.groupBy(*[ref(k) for k in by]).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows")
    )


@dataclass(frozen=True)
class SchemaDiff:
    """Difference of two column-name sets; order and types do not matter."""

    missing: tuple[str, ...]
    extra: tuple[str, ...]

    @property
    def valid(self) -> bool:
        return not self.missing and not self.extra


def schema_diff(columns: Sequence[str], expected: Sequence[str] | None) -> SchemaDiff:
    if expected is None:
        return SchemaDiff((), ())
    return SchemaDiff(
        tuple(sorted(set(expected) - set(columns))), tuple(sorted(set(columns) - set(expected)))
    )


def type_mismatches(df: DataFrame, expected: T.StructType | None) -> list[str]:
    """Expected columns that are present with another type."""
    if expected is None:
        return []
    actual = {f.name: f.dataType for f in df.schema}
    return [f.name for f in expected if f.name in actual and actual[f.name] != f.dataType]


def type_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``column, expected_type, actual_type, matches, n_bad``: present cells that do not cast.

    One scan; each expected column contributes one 0/1 flag per row to a narrow aggregate.
    """
    actual = {f.name: f.dataType for f in df.schema}
    fields = [f for f in expected if f.name in actual]
    flags = F.array(
        *[(ref(f.name).isNotNull() & ref(f.name).try_cast(f.dataType).isNull()).cast("long") for f in fields]
    )
    bad = df.select(F.posexplode(flags).alias("pos", "bad")).groupBy("pos").agg(F.sum("bad").alias("n_bad"))
    described = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(actual[f.name].simpleString()).alias("actual_type"),
                F.lit(actual[f.name] == f.dataType).alias("matches"),
            )
            for f in fields
        ]
    )
    return bad.select(F.element_at(described, F.col("pos") + 1).alias("d"), "n_bad").select("d.*", "n_bad")


def quality_report(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per source: counts, flags, columns, PASS/FAIL and the number of failed checks."""
    names = [c for c in df.columns if c not in by]
    flags = {
        "has_infinity": F.col("infinity_values") > 0,
        "has_missing": F.col("missing_values") > 0,
        "has_duplicates": F.col("duplicate_rows") > 0,
    }
    report = checked_rows(df, by).withColumns(flags)
    issues = sum(F.col(c).cast("int") for c in flags)
    return report.withColumns(
        {
            "total_columns": F.lit(len(names)),
            "columns": F.array(*[F.lit(c) for c in names]),
            "issues_count": issues,
            "quality_score": F.when(issues == 0, F.lit("PASS")).otherwise(F.lit("FAIL")),
        }
    )


def validate_all(
    df: DataFrame,
    by: Sequence[str],
    expected_columns: Sequence[str] | None = None,
    expected_types: T.StructType | None = None,
    count_cells: bool = True,
) -> DataFrame:
    """One row per source with the four checks and their verdict.

    Duplicates are reported but do not change the verdict; a failed verdict drops nothing.  ``count_cells=False``
    is for tables known to have no infinite or missing cell.
    """
    names = [c for c in df.columns if c not in by]
    counted = checked_rows(df, by, count_cells)
    checked = counted.select(
        *[ref(k) for k in by],
        (F.col("infinity_values") == 0).alias("no_infinity"),
        (F.col("missing_values") == 0).alias("no_missing"),
        F.lit(schema_diff(names, expected_columns).valid).alias("schema_valid"),
        F.lit(not type_mismatches(df, expected_types)).alias("data_types_valid"),
        F.col("duplicate_rows").alias("duplicate_count"),
        "total_rows",
        F.lit(len(names)).alias("total_columns"),
    )
    verdict = F.col("no_infinity") & F.col("no_missing") & F.col("schema_valid") & F.col("data_types_valid")
    return checked.withColumn("validation_passed", verdict)


def row_totals(rows_in: DataFrame, rows_out: DataFrame, by: str) -> DataFrame:
    """``by, rows_in, rows_out, rows_dropped`` per source and, with ``by`` NULL, overall.

    Both inputs are tagged and unioned, so one ``rollup`` aggregate does it; each reads only
    the group column.
    """
    tagged = rows_in.select(ref(by).alias(by), F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(
        rows_out.select(ref(by).alias(by), F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    return tagged.rollup(ref(by)).agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("rows_out"),
        F.coalesce(F.sum(F.col("i") - F.col("o")), F.lit(0)).alias("rows_dropped"),
    )
