import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.labels import binary_label, encode_labels, fit_label_encoder, label_filter
from tidewell.functions.names import (
    feature_columns,
    feature_target,
    identity_split,
    normalize_name,
    normalize_names,
    normalized,
    renamed_count,
)
from tidewell.functions.records import (
    CORRUPT,
    FLOW_ALIASES,
    FLOW_SCHEMA,
    key_report,
    key_slot,
    keyed_records,
    parse_records,
    partition_key,
    record_value,
    split_malformed,
)
from tidewell.functions.splits import split_by_source, split_by_time
from tidewell.sources.broker import publish_stats


def test_normalize_name_order():
    assert normalize_name(" Flow Bytes/s") == "Flow_Bytes/s"
    assert normalize_name("Flow  Bytes/s ") == "Flow__Bytes/s"
    assert normalize_name(" A b/C ", lowercase=True, remove_special_chars=True) == "a_bc"
    assert normalize_name(" A ", strip=False) == "_A_"
    assert normalize_name("a b", replace_spaces=None) == "a b"
    assert renamed_count([" a", "b", "c d"]) == 2


def test_collisions_are_errors(spark):
    with pytest.raises(ValueError, match="a_b"):
        normalized(["a b", " a b"])
    df = spark.range(1).select(F.lit(1).alias(" x y"), F.lit(2).alias("z.w"))
    assert normalize_names(df).columns == ["x_y", "z.w"]


def test_feature_columns(spark):
    df = spark.range(1).selectExpr("1 as Source_IP", "2 as a", "3 as `b/s`", "'x' as Label")
    assert feature_columns(df) == ["a", "b/s"]
    assert feature_target(df).columns == ["a", "b/s", "Label"]
    assert feature_target(df, features=["a"]).columns == ["a", "Label"]


def test_identity_split():
    names = ["Destination_Port", "Idle_Max", "Flow_Duration", "Source_IP", "Timestamp", "Width", "Label"]
    assert identity_split(names) == (["Flow_Duration"], ["Destination_Port", "Idle_Max", "Source_IP", "Timestamp", "Width"])
    behaviour, identity = identity_split(names, match="token")
    assert behaviour == ["Idle_Max", "Flow_Duration", "Width"]
    assert identity == ["Destination_Port", "Source_IP", "Timestamp"]
    assert identity_split(["userId", "PacketCount"], match="token")[1] == ["userId"]


def test_labels(spark):
    df = spark.createDataFrame([("BENIGN",), ("DoS Hulk",), (None,), ("PortScan",)], "Label string")
    assert [r[0] for r in df.select(binary_label(F.col("Label"))).collect()] == [0, 1, 1, 1]
    assert label_filter(df, "Label", "DoS|DDoS").count() == 1
    assert [r["label_id"] for r in encode_labels(df.filter("Label is not null"), "Label").collect()] == [0, 1, 2]
    model = fit_label_encoder(df.filter("Label <> 'PortScan'"), "Label")
    assert [r["label_id"] for r in model.transform(df).collect()] == [0.0, 1.0, 2.0, 2.0]


@pytest.mark.parametrize(
    "cells,want",
    [
        (("1.2.3.4", "b", "c"), "1.2.3.4"),
        (("", "b", "c"), "b"),
        ((None, "", "c"), "c"),
        ((None, None, None), "unknown"),
    ],
)
def test_partition_key(spark, cells, want):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("Source_IP", "Source IP", "other")])
    df = spark.createDataFrame([cells], schema)
    assert df.select(partition_key(df, fallbacks=("Source IP", "other"))).first()[0] == want


def test_partition_key_of_numbers_and_absent_columns(spark):
    df = spark.createDataFrame([(0, 5), (7, 5)], "Source_IP long, source_id long")
    assert [r[0] for r in df.select(partition_key(df, fallbacks=("source_id", "nope"))).collect()] == ["5", "7"]
    assert df.select(partition_key(df, "gone", ())).first()[0] == "unknown"


def test_key_slots_keep_keys_together(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"))
    placed = df.groupBy("k").agg(F.count_distinct(key_slot(F.col("k"))).alias("n"), F.max(key_slot(F.col("k"))).alias("s"))
    assert placed.agg(F.max("n")).first()[0] == 1
    assert placed.agg(F.count_distinct("s")).first()[0] == 8
    one = key_report(df.withColumn("k", F.lit("unknown")), F.col("k")).first()
    assert one["n_keys"] == 1 and one["top_share"] == 1.0


def test_record_value_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y double")
    assert json.loads(df.select(record_value(df)).first()[0]) == {"x": "a", "y": None}
    row = keyed_records(df, "x", ()).first()
    assert row["key"] == "a" and json.loads(row["value"])["y"] is None
    stats = publish_stats(keyed_records(df, "x", ())).first()
    assert (stats["messages"], stats["keys"], stats["bytes"]) == (1, 1, len(row["value"]))


def test_parse_records(spark):
    texts = [
        '{"Source_IP":"192.168.1.100","Destination_IP":"10.0.0.1","Flow_Duration":1000,"Label":"BENIGN"}',
        '{"Source_IP":"a","extra":1,"Flow_Bytes/s":2.5}',
        '{"Source_IP":"b","Flow_Duration":NaN}',
        "not json",
        None,
    ]
    parsed = parse_records(spark.createDataFrame([(t,) for t in texts], "value string"), aliases=FLOW_ALIASES)
    assert parsed.columns == [f.name for f in FLOW_SCHEMA] + [CORRUPT]
    rows = parsed.collect()
    assert rows[0]["Flow_Duration"] == 1000.0 and rows[0]["Source_Port"] is None
    assert rows[1]["Flow_Bytes_per_s"] == 2.5
    assert math.isnan(rows[2]["Flow_Duration"])
    assert all(v is None for v in rows[3][:-1]) and rows[3][CORRUPT] == "not json"
    good, dead = split_malformed(parsed)
    assert good.count() == 4 and dead.collect()[0][0] == "not json"


def test_splits(spark):
    df = spark.createDataFrame([("mon", "2024-01-01"), ("fri", "2024-01-05"), ("sat", "2024-01-06")], "source_file string, d string")
    train, test = split_by_source(df, ["mon"], ["fri"])
    assert train.first()["source_file"] == "mon" and test.count() == 1
    with pytest.raises(ValueError):
        split_by_source(df, ["mon"], ["mon"])
    before, after = split_by_time(df.withColumn("at", F.col("d").cast("timestamp")), "at", "2024-01-05 00:00:00")
    assert before.count() == 1 and after.count() == 2
