"""Writing tables, partitioned layouts, and CSV to Parquet conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import ref
from tidewell.sources.files import SOURCE, file_sizes, path_within, read_csv_folder

FORMATS = ("csv", "parquet")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    compression: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    **options,
) -> None:
    """CSV with header, or Parquet (snappy unless told otherwise); no shuffle."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {FORMATS}")
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true").option("nanValue", "NaN").option("quote", '"').option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        (writer.option("compression", compression) if compression else writer).csv(path)
    else:
        writer.option("compression", compression or "snappy").parquet(path)


def with_date_hour(df: DataFrame, at: str) -> DataFrame:
    """Add ``date`` and ``hour`` of a timestamp column."""
    return df.withColumns({"date": F.to_date(ref(at)), "hour": F.hour(ref(at))})


def write_by_date_hour(df: DataFrame, path: str, at: str, compression: str = "snappy", mode: str = "errorifexists") -> None:
    """Parquet partitioned by date and hour.

    ``rebalance`` lets AQE gather each hour's rows into few files and split a hot hour into
    several, where a plain repartition by hour would put it in one task.
    """
    laid_out = with_date_hour(df, at).hint("rebalance", "date", "hour")
    write_table(laid_out, path, "parquet", compression, ["date", "hour"], mode)


def csv_to_parquet(
    spark: SparkSession,
    csv_folder: str,
    parquet_folder: str,
    schema: T.StructType | None = None,
    compression: str = "snappy",
    row_group_bytes: int = 128 << 20,
    mode: str = "errorifexists",
) -> DataFrame:
    """Convert a folder of CSV files and return the conversion report.

    Every task writes the rows of the split it read, one output folder per source file.
    """
    frame = read_csv_folder(spark, csv_folder, schema)
    write_table(
        frame,
        parquet_folder,
        "parquet",
        compression,
        [SOURCE],
        mode,
        **{"parquet.block.size": str(row_group_bytes), "parquet.enable.dictionary": "true"},
    )
    return conversion_report(spark, csv_folder, parquet_folder)


def conversion_report(spark: SparkSession, csv_folder: str, parquet_folder: str) -> DataFrame:
    """``source_file, rows, columns, csv_bytes, parquet_bytes, reduction_percent``; NULL file = total."""
    before = file_sizes(spark, csv_folder, "*.csv").select(
        path_within(F.col("path"), csv_folder).alias(SOURCE), "bytes"
    )
    after = file_sizes(spark, parquet_folder, "*.parquet").select(
        F.regexp_extract("path", SOURCE + "=([^/]+)/", 1).alias(SOURCE), "bytes"
    )
    table = spark.read.parquet(parquet_folder)
    counts = table.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    parts = (
        before.select(SOURCE, F.col("bytes").alias("c"), zero.alias("p"), zero.alias("n"))
        .unionAll(after.select(SOURCE, zero, "bytes", zero))
        .unionAll(counts.select(SOURCE, zero, zero, "n"))
    )
    summed = parts.rollup(SOURCE).agg(
        F.sum("n").alias("rows"), F.sum("c").alias("csv_bytes"), F.sum("p").alias("parquet_bytes")
    )
    return summed.select(
        SOURCE,
        "rows",
        F.lit(len(table.columns) - 1).alias("columns"),
        "csv_bytes",
        "parquet_bytes",
        ((1 - F.try_divide("parquet_bytes", "csv_bytes")) * 100).alias("reduction_percent"),
    )
