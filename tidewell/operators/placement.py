"""Rows dealt to partitions by key, with the rows of heavy keys salted so that no task gets far more than its share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import ref
from tidewell.functions.records import KEY_PARTITIONS, key_slot
from tidewell.operators.grouping import attach
from tidewell.session import settle

KEY = "key"
MARK = "\x1f"  # stands between a key and its salt
PIECES = 8  # a key is heavy above one part in this many of a partition's mean
LEAST_TRACKED, MOST_TRACKED = 10_000, 1_000_000


def heavy_keys(keys: DataFrame, partitions: int = KEY_PARTITIONS) -> DataFrame:
    """``key, n, pieces`` of the keys holding more than ``1 / (8 * partitions)`` of the rows; ``keys`` has a column ``key``.

    One frequent-items sketch of bounded size is built per task and merged, so neither the keys nor a busy key's rows are
    gathered.  ``n`` is the sketch's estimate: a key not reported holds at most about one row in ``tracked / 4`` more than
    the threshold.  ``pieces`` is the number of partitions the key's rows are spread over.  At most ``8 * partitions`` rows.
    """
    most = PIECES * partitions
    tracked = min(max(LEAST_TRACKED, 16 * most), MOST_TRACKED)
    text = keys.select(ref(KEY).cast("string").alias(KEY)).filter(F.col(KEY).isNotNull())
    found = text.agg(F.expr(f"approx_top_k({KEY}, {min(most, tracked)}, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows"))
    share = F.col("n") / F.col("rows")
    return settle(
        found.select(F.explode("top").alias("t"), "rows")
        .select(F.col("t.item").alias(KEY), F.col("t.count").alias("n"), "rows")
        .filter(share * most > 1)
        .select(KEY, "n", F.least(F.lit(partitions), F.ceil(share * partitions * PIECES / 2)).cast("int").alias("pieces"))
    )


def salted_key(key: Column, salt: Column) -> Column:
    """The key with its salt; a key without one stays as it is unless it looks like a salted one."""
    return (
        F.when(salt.isNotNull(), F.concat(key, F.lit(MARK), salt.cast("string")))
        .when(key.rlike(f"{MARK}[0-9]+$"), F.concat(key, F.lit(f"{MARK}0")))
        .otherwise(key)
    )


def unsalted_key(key: Column) -> Column:
    """The key as it was before ``salted_key``."""
    return F.regexp_replace(key, f"{MARK}[0-9]+$", "")


def deal_by_key(df: DataFrame, key: Column, partitions: int = KEY_PARTITIONS, heavy: DataFrame | None = None) -> DataFrame:
    """``df`` with a column ``key``, its rows dealt to ``partitions``: a key that is not heavy sits in one of them.

    A heavy key's rows go round the partitions that follow its own, as many as ``pieces`` says; their ``key`` carries the
    salt, which ``unsalted_key`` takes off on reading.  A NULL key is a key like others, kept as NULL and not salted: give it
    a value first (``partition_key`` does) where many rows lack one.  Salts follow a row's place in its input split, so
    ``df`` should be a scan or a written table for a retried task to deal its rows alike.
    """
    keyed = df.withColumn(KEY, key.cast("string"))
    heavy = heavy_keys(keyed.select(KEY), partitions) if heavy is None else heavy
    placed = attach(keyed.withColumn("__row", F.monotonically_increasing_id()), heavy.select(KEY, "pieces"), [KEY])
    salt = F.pmod(F.col("__row"), F.col("pieces").cast("long"))
    slot = F.coalesce(key_slot(F.col(KEY), partitions), F.lit(0)) + F.coalesce(salt, F.lit(0))
    columns = [ref(c) if c != KEY else salted_key(F.col(KEY), salt).alias(KEY) for c in keyed.columns]
    dealt = placed.select(*columns, F.pmod(slot, F.lit(partitions)).cast("int").alias("__slot"))
    return dealt.repartitionById(partitions, F.col("__slot")).drop("__slot")
