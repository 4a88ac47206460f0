"""Heavy keys dealt over several partitions, and distinct counts from mergeable sketches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewell.operators.placement import MARK, deal_by_key, heavy_keys, salted_key, unsalted_key
from tidewell.streaming.windows import LOG_SIZE, destination_sketches, united_destinations

PARTS = 16


@pytest.fixture(scope="module")
def rows(spark):
    """Identical rows of one key make up a third, another key holds a tenth, the rest are light."""
    at = F.col("id")
    key = F.when(at % 3 == 0, "hot").when(at % 10 == 1, "warm").otherwise(F.concat(F.lit("k"), (at % 997).cast("string")))
    return spark.range(0, 60_000, numPartitions=4).select(F.when(key == "hot", 0).otherwise(at).alias("x"), key.alias("host"))


def test_heavy_keys_are_found_and_spread(spark, rows):
    heavy = {r["key"]: r for r in heavy_keys(rows.select(F.col("host").alias("key")), PARTS).collect()}
    counts = {r["host"]: r["n"] for r in rows.groupBy("host").agg(F.count("*").alias("n")).collect()}
    assert set(heavy) == {k for k, n in counts.items() if n * 8 * PARTS > 60_000} == {"hot", "warm"}
    assert heavy["hot"]["n"] == counts["hot"] and heavy["hot"]["pieces"] == PARTS
    dealt = deal_by_key(rows, F.col("host"), PARTS)
    part = dealt.withColumn("part", F.spark_partition_id())
    sizes = [r["n"] for r in part.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == PARTS and max(sizes) <= 2 * 60_000 / PARTS
    light = part.filter(~F.col("host").isin("hot", "warm")).groupBy("host").agg(F.count_distinct("part").alias("parts"))
    assert light.filter("parts > 1").count() == 0
    plain = rows.repartition(PARTS, "host").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert plain > 2 * 60_000 / PARTS  # what a plain repartition by key does


def test_keys_come_back_whole(spark, rows):
    dealt = deal_by_key(rows, F.col("host"), PARTS)
    back = dealt.select("x", unsalted_key(F.col("key")).alias("host"))
    assert back.exceptAll(rows.select("x", "host")).count() == 0 and back.count() == 60_000
    assert dealt.filter("host = 'hot'").select("key").distinct().count() == PARTS


@pytest.mark.parametrize("key", ["a", "", f"a{MARK}", f"a{MARK}5", f"{MARK}0{MARK}12", "line\nbreak", f"a\n{MARK}7"])
def test_salts_are_reversible(spark, key):
    one = spark.createDataFrame([(key,)], "k string")
    for salt in (F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(31).cast("long")):
        assert one.select(unsalted_key(salted_key(F.col("k"), salt))).first()[0] == key


def test_null_keys_and_empty_tables(spark):
    some = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "x int, host string")
    assert sorted(deal_by_key(some, F.col("host"), 4).select("x", unsalted_key(F.col("key"))).collect(), key=str) == [
        (1, None), (2, "a"), (3, None),
    ]
    assert deal_by_key(some.filter("x > 9"), F.col("host"), 4).count() == 0
    assert heavy_keys(some.filter("x > 9").select(F.col("host").alias("key")), 4).count() == 0
    own = spark.createDataFrame([("b", 1)], "key string, x int")
    assert deal_by_key(own, F.col("key"), 2).select("x", unsalted_key(F.col("key"))).collect() == [(1, "b")]


def test_united_sketches_count_shared_destinations_once(spark):
    hours = spark.range(0, 24, numPartitions=4).withColumnRenamed("id", "hour")
    seen = hours.join(spark.range(0, 5000).withColumnRenamed("id", "d"))  # each hour shares half with the next
    rows = seen.select(
        F.lit("s").alias("src"),
        (F.col("hour") * 2500 + F.col("d")).alias("dst"),
        F.timestamp_seconds(F.col("hour") * 3600 + F.col("d") % 3600).alias("at"),
    ).unionByName(spark.sql("SELECT 'few' src, cast(null AS bigint) dst, timestamp_seconds(5) at UNION ALL SELECT 'few', 7, timestamp_seconds(9)"))
    hourly = destination_sketches(rows, "src", "dst", "at", "1 hour")
    assert hourly.agg(F.max(F.octet_length("sketch"))).first()[0] <= (1 << LOG_SIZE) + 64
    daily = {r["src"]: r["destinations"] for r in united_destinations(hourly, "src", "1 day").collect()}
    exact = 23 * 2500 + 5000
    assert daily["few"] == 1 and abs(daily["s"] - exact) <= 4 * 1.04 / 2 ** (LOG_SIZE / 2) * exact
    assert united_destinations(hourly.filter("src = 'nobody'"), "src", "1 day").count() == 0
