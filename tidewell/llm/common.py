"""Small helpers shared by the corpus operators.

A document row is identified by ``(doc_id, xxhash64(text))``: rows that repeat a ``doc_id`` with
another text are different documents, rows equal in both are one document listed more than once and
get the same decision.  A null text is an empty one.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRC_MODULUS = 4
HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """True for the documents no model may learn from."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string")) % CRC_MODULUS == HELD_OUT_REMAINDER, F.lit(False)
    )


def text_key(text="text"):
    """64-bit hash of a text, 0 bits of which are null."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so extra columns cannot clash."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, row``: whole rows as a struct, so their column names cannot clash with a join's."""
    return docs.select("doc_id", text_key().alias("text_key"), F.struct("*").alias("row"))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now; it does so once their plans are collected.

    Listeners hold a plan for a moment after its job, so there are two rounds.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str
) -> DataFrame:
    """Apply ``make()`` (called once per task) to every Arrow batch; narrow, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def sampled(df: DataFrame, key, bound: int, total: int) -> DataFrame:
    """About ``bound`` of ``total`` rows, chosen by a hash of ``key``: the same rows on every run."""
    if total <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * bound / total))
