"""The cleaning job: names, infinity, missing values, checks, report.

Two passes over the files: the profile pass, from which all cleaning statistics and the counts of bad cells and records
come, and the narrow pass that rewrites and writes.  The second one observes what it writes, so the checks read
the written table once, for duplicate rows only.  Strategies that read the rows more often (median, forward fill) land
them as Parquet first.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import cell_array, count_gaps, count_infinities, ref
from tidewell.functions.names import normalized, renamed_count
from tidewell.operators.fill import forward_fill
from tidewell.operators.infinity import LARGE_VALUE, replace_infinite
from tidewell.operators.missing import drop_missing, drop_sparse_columns, fill_missing
from tidewell.operators.profile import CellProfile, profile
from tidewell.operators.quality import validate_all
from tidewell.session import durable, settle
from tidewell.sources.files import (
    MALFORMED_RECORDS,
    SOURCE,
    UNPARSED_CELLS,
    csv_headers,
    fingerprints,
    header_consistency,
    path_within,
    read_csv_folder,
)
from tidewell.sources.sinks import write_table

MISSING = ("drop", "median", "mean", "forward_fill")


@dataclass(frozen=True)
class Cleaned:
    """A cleaned frame and its statistics, one row per source."""

    frame: DataFrame
    stats: DataFrame


def cleaning_stats(prof: CellProfile, infinity: str, missing: str, columns_renamed: int = 0) -> DataFrame:
    """What cleaning does to each source, derived from the profile alone."""
    totals = prof.totals()
    inf, gaps = F.col("infinity_values"), F.col("missing_values")
    swept = (inf > 0) if infinity == "drop" else F.lit(False)
    dropped_inf = F.when(swept, F.col("rows_dirty")).otherwise(0)
    if infinity == "null":
        found, rows_with_gap = gaps + inf, F.col("rows_dirty")
    else:
        found, rows_with_gap = F.when(swept, F.lit(0)).otherwise(gaps), F.col("rows_missing")
    dropped_gap = F.when(~swept, rows_with_gap).otherwise(0) if missing == "drop" else F.lit(0)
    return totals.select(
        *[ref(k) for k in prof.by],
        F.col("rows").alias("original_rows"),
        F.lit(columns_renamed).alias("columns_renamed"),
        inf.alias("infinity_values"),
        dropped_inf.cast("long").alias("rows_dropped_inf"),
        found.cast("long").alias("missing_values"),
        dropped_gap.cast("long").alias("rows_dropped_nan"),
        (F.col("rows") - dropped_inf - dropped_gap).cast("long").alias("final_rows"),
        (dropped_inf + dropped_gap).cast("long").alias("total_rows_dropped"),
    )


def clean_table(
    df: DataFrame,
    by: Sequence[str],
    infinity: str = "max",
    missing: str = "drop",
    large_value: float = LARGE_VALUE,
    signed: bool = False,
    row_order: Sequence[str] | None = None,
    exact: bool = True,
    sparse_threshold: float | None = None,
    columns_renamed: int = 0,
    prof: CellProfile | None = None,
) -> Cleaned:
    """Infinity first, then missing values, with statistics per ``by`` group.

    ``prof`` reuses a profile of this very frame.  ``row_order`` is required for ``forward_fill``.  ``sparse_threshold`` first drops columns
    with a larger missing share.
    """
    if missing not in MISSING:
        raise ValueError(f"unknown missing strategy {missing!r}; one of {MISSING}")
    prof = prof or profile(df, by)
    if sparse_threshold is not None:
        kept = drop_sparse_columns(df, sparse_threshold, prof)
        if kept.columns != df.columns:
            df, prof = kept, profile(kept, by)
    finite = replace_infinite(df, by, infinity, large_value, large_value, signed, prof)
    if missing == "drop":
        frame = drop_missing(finite, [c for c in finite.columns if c not in by])
    elif missing == "forward_fill":
        if not row_order:
            raise ValueError("forward_fill needs row_order")
        frame = forward_fill(finite, by, row_order, None if infinity == "null" else prof.columns_with("n_missing"))
    else:
        adjusted = None
        if missing == "mean" and not signed and infinity in ("max", "large_int"):
            top = F.coalesce("finite_max", F.lit(float(large_value)))
            adjusted = prof.with_infinity_replaced(top if infinity == "max" else F.lit(float(large_value)))
        frame = fill_missing(finite, by, missing, exact, adjusted)
    return Cleaned(frame, settle(cleaning_stats(prof, infinity, missing, columns_renamed)))


def bad_input(prof: CellProfile, marks: Sequence[str]) -> DataFrame:
    """``by..., marks...``: sums of 0-and-up counter columns of a profiled frame."""
    sums = [F.sum(F.when(F.col("column") == m, F.col("finite_sum"))).cast("long").alias(m) for m in marks]
    return prof.cells.groupBy(*[ref(k) for k in prof.by]).agg(*sums)


def observed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df``, and rows, infinite and missing cells of whatever pass reads it."""
    cells = cell_array(df, [c for c in df.columns if c not in by])
    watch = Observation()
    return df.observe(
        watch,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(count_infinities(cells)), F.lit(0)).alias("infinite"),
        F.coalesce(F.sum(count_gaps(cells)), F.lit(0)).alias("missing"),
    ), watch


def run_report(stats: DataFrame, checks: DataFrame, by: str) -> DataFrame:
    """Per source: cleaning statistics next to the checks; plus an overall row with NULL source."""
    cleaned = stats.join(checks.withColumnRenamed(by, "__key"), F.col("__key").eqNullSafe(ref(by)), "left").drop("__key")
    flags = ["no_infinity", "no_missing", "schema_valid", "data_types_valid", "validation_passed"]
    sums = [
        "original_rows", "final_rows", "total_rows_dropped", "infinity_values", "missing_values",
        "rows_dropped_inf", "rows_dropped_nan", "duplicate_count",
    ]
    return cleaned.rollup(ref(by)).agg(
        F.count(F.lit(1)).alias("files"),
        *[F.sum(c).alias(c) for c in sums],
        F.max("columns_renamed").alias("columns_renamed"),
        F.max("total_columns").alias("total_columns"),
        *[F.every(F.coalesce(c, F.lit(True))).alias(c) for c in flags],
    )


def run_etl(
    spark: SparkSession,
    csv_folder: str,
    output: str,
    schema: T.StructType | None = None,
    report_path: str | None = None,
    infinity: str = "max",
    missing: str = "drop",
    fmt: str = "parquet",
    compression: str | None = None,
    mode: str = "errorifexists",
    pattern: str = "*.csv",
    **clean_options,
) -> DataFrame:
    """Clean a folder of CSV files into ``output`` and return the run report.

    ``schema`` holds the normalised names.  A file that cannot be read to its end shows status ``failed`` and none of its
    rows is written; one without rows shows ``empty``; a failed check is reported and the file is still
    written.  The overall row is ``failed`` if any file is, else ``success``.
    """
    headers = _headers(spark, csv_folder, pattern)
    report, _ = _clean_files(spark, csv_folder, headers, output, schema, infinity, missing, fmt, compression, mode, pattern, **clean_options)
    if report_path:
        report.write.mode(mode).json(report_path)
    return report


def _headers(spark: SparkSession, csv_folder: str, pattern: str) -> DataFrame:
    return settle(csv_headers(spark, csv_folder, pattern).withColumn(SOURCE, path_within(F.col("path"), csv_folder)))


def _clean_files(
    spark: SparkSession,
    csv_folder: str,
    headers: DataFrame,
    output: str,
    schema: T.StructType | None,
    infinity: str,
    missing: str,
    fmt: str,
    compression: str | None,
    mode: str,
    pattern: str,
    whole_folder: bool = True,
    **clean_options,
) -> tuple[DataFrame, CellProfile]:
    """Clean the files of ``headers`` into their partitions of ``output``: the report and the profile of what was read."""
    raw = read_csv_folder(
        spark, csv_folder, schema, pattern, normalize=True, headers=headers, skip_bad_files=True, audit=True, whole_folder=whole_folder
    )
    if missing in ("median", "forward_fill"):
        raw = durable(raw, "landed")
    marks = [UNPARSED_CELLS, MALFORMED_RECORDS]
    seen = profile(raw, [SOURCE])
    audit = bad_input(seen, marks)
    prof = CellProfile(
        seen.cells.filter(~F.col("column").isin(marks)),
        seen.by,
        tuple(c for c in seen.columns if c not in marks),
        tuple(c for c in seen.numeric if c not in marks),
    )
    first = headers.filter("error is null").orderBy("path").first()["header"]
    cleaned = clean_table(
        raw.drop(*marks), [SOURCE], infinity, missing, columns_renamed=renamed_count(first), prof=prof, **clean_options
    )
    watched, written_cells = observed(cleaned.frame, [SOURCE])
    how = {} if whole_folder else {"partitionOverwriteMode": "dynamic"}
    write_table(watched, output, fmt, compression, [SOURCE], mode, **how)
    if fmt == "parquet":
        written = spark.read.schema(cleaned.frame.schema).parquet(output)
    else:
        written = read_written_csv(spark, output, cleaned.frame.schema)
    if not whole_folder:  # partitions of other files stay unread
        written = written.join(headers.select(SOURCE), SOURCE, "left_semi").select(*cleaned.frame.columns)
    found = written_cells.get
    dirty = bool(found["infinite"] or found["missing"])
    checks = validate_all(written, [SOURCE], normalized(first), schema, count_cells=dirty)
    layout = header_consistency(spark, csv_folder, headers=headers).select(F.col("file"), F.col("consistent"))
    checks = (
        checks.join(layout, F.col("file") == ref(SOURCE), "left")
        .withColumn("schema_valid", F.coalesce("consistent", F.lit(True)))
        .withColumn("validation_passed", F.col("validation_passed") & F.col("schema_valid"))
        .drop("file", "consistent")
    )
    listed = headers.select(F.col(SOURCE).alias("__listed"), "error")
    stats = listed.join(cleaned.stats, F.col("__listed") == ref(SOURCE), "left")
    status = (
        F.when(F.col("error").isNotNull(), F.lit("failed"))
        .when(ref(SOURCE).isNull(), F.lit("empty"))
        .otherwise(F.lit("success"))
    )
    stats = stats.withColumn("status", status).withColumn(SOURCE, F.col("__listed")).drop("__listed")
    found = stats.join(audit.withColumnRenamed(SOURCE, "__a"), F.col("__a") == ref(SOURCE), "left")
    found = found.rollup(ref(SOURCE)).agg(
        F.when(F.count_if(F.col("status") == "failed") > 0, F.lit("failed")).otherwise(
            F.when(F.grouping(ref(SOURCE)) == 1, F.lit("success")).otherwise(F.max("status"))
        ).alias("status"),
        F.max("error").alias("error"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in marks],
    )
    report = run_report(stats.drop("error").na.fill(0), checks, SOURCE).join(
        found.withColumnRenamed(SOURCE, "__s"), F.col("__s").eqNullSafe(ref(SOURCE)), "left"
    ).drop("__s")
    return settle(report), prof


@dataclass(frozen=True)
class Increment:
    """What one incremental run did: its report (None without new files), the files it read, and what is known of all files."""

    report: DataFrame | None
    read: DataFrame
    known: DataFrame


STATE = (
    f"{SOURCE} string, length long, modified long, run long, column string, rows long, n_inf long, n_missing long, "
    "finite_min double, finite_max double, finite_sum double"
)


def known_files(spark: SparkSession, state: str) -> DataFrame:
    """The latest state of every file cleaned so far: its fingerprint and, per column, counts, extremes and sums.

    The rows add up: grouped by ``column`` they describe all files together, without reading any.
    """
    try:
        rows = spark.read.schema(STATE).parquet(state)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], STATE)
    latest = rows.groupBy(SOURCE).agg(F.max("run").alias("run"))
    return rows.join(latest, [SOURCE, "run"], "left_semi")


def run_incremental(
    spark: SparkSession,
    csv_folder: str,
    output: str,
    state: str,
    schema: T.StructType,
    infinity: str = "max",
    missing: str = "drop",
    compression: str | None = None,
    pattern: str = "*.csv",
    **clean_options,
) -> Increment:
    """Clean the files of a folder that are new or changed since the last run; the others are not opened.

    Cleaning statistics are scoped by file, so the table is the one a full run would write.  A file is known by length and
    time of change.  Its partition of ``output`` is replaced first and its state appended last: a run that breaks
    off is repeated by the next one.  Files that failed have no state and are tried again; partitions of files
    that are gone stay.
    """
    now = fingerprints(spark, csv_folder, pattern)
    before = known_files(spark, state).select(SOURCE, "length", "modified").distinct()
    pending = settle(now.join(before, [SOURCE, "length", "modified"], "left_anti"))
    if pending.isEmpty():
        return Increment(None, pending.select(SOURCE), known_files(spark, state))
    headers = settle(
        csv_headers(spark, csv_folder, pattern, pending.select(SOURCE)).withColumn(SOURCE, path_within(F.col("path"), csv_folder))
    )
    report = None
    if not headers.filter("error is null").isEmpty():
        report, prof = _clean_files(
            spark, csv_folder, headers, output, schema, infinity, missing, "parquet", compression, "overwrite", pattern,
            whole_folder=False, **clean_options,
        )
        good = headers.filter("error is null").select(SOURCE)
        rows = pending.join(good, SOURCE, "left_semi").join(prof.per_column(), SOURCE, "left")
        names = [f.split()[0] for f in STATE.split(", ")]
        rows.withColumn("run", F.lit(time.time_ns())).select(*names).write.mode("append").parquet(state)
    return Increment(report, headers.select(SOURCE), known_files(spark, state))


def read_written_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_table`` wrote as CSV partitioned by source."""
    reader = spark.read.schema(schema).option("header", "true").option("nanValue", "NaN")
    return reader.option("quote", '"').option("escape", '"').csv(path)
