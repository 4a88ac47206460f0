"""Record streams: ingest to Parquet, replay of files, updates and their merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions.cells import ref
from tidewell.functions.records import CORRUPT, FLOW_SCHEMA, keyed_records, parse_records

TRIGGER = "10 seconds"  # fixed value: default trigger interval
BATCH = "batch_id"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 1, **options
) -> DataFrame:
    """Files of a folder (or glob) as a stream, ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def replay(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 1, **key_options
) -> DataFrame:
    """Processed files as a stream of keyed JSON records, file by file."""
    return keyed_records(file_stream(spark, path, schema, fmt, max_files), **key_options)


def parse_stream(
    records: DataFrame, schema: T.StructType = FLOW_SCHEMA, aliases: Mapping[str, str] | None = None, dead_letters: bool = False
) -> DataFrame:
    """Parsed records of a key/value stream; malformed ones stay as rows of NULL fields.

    ``dead_letters`` keeps their text in a column.
    """
    parsed = parse_records(records, schema, "value", aliases)
    return parsed if dead_letters else parsed.drop(CORRUPT)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", compression: str = "snappy",
    trigger: str = TRIGGER, available_now: bool = False, partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to files.  The sink's log and the query's own checkpoint make it exactly once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def write_updates(
    df: DataFrame, path: str, checkpoint: str, trigger: str = TRIGGER, available_now: bool = False
) -> StreamingQuery:
    """Write each micro-batch of an aggregate's changed rows to ``path/batch_id=N``.

    A repeated batch overwrites its own folder, so nothing is counted twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current value of every key: its row from the latest batch that changed it."""
    table = spark.read.parquet(path)
    values = [c for c in table.columns if c not in keys and c != BATCH]
    newest = table.groupBy(*[ref(k) for k in keys]).agg(
        F.max_by(F.struct(*[ref(v) for v in values]), F.col(BATCH)).alias("__v")
    )
    return newest.select(*[ref(k) for k in keys], *[F.col("__v").getField(v).alias(v) for v in values])
