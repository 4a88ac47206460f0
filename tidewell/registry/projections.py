"""Queries over names, labels, keys, JSON records and splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.fixtures import DIRTY_SQL, ROW_ORDER, dirty_lineitem, table
from tidewell.functions.labels import binary_label, encode_labels, label_filter
from tidewell.functions.names import feature_target, identity_split, normalize_names
from tidewell.functions.records import (
    CORRUPT,
    KEY_PARTITIONS,
    key_report,
    keyed_records,
    parse_records,
    partition_key,
    record_value,
    split_malformed,
)
from tidewell.functions.splits import split_by_source, split_by_time
from tidewell.operators.grouping import attach
from tidewell.operators.placement import deal_by_key, heavy_keys, unsalted_key
from tidewell.operators.profile import profile
from tidewell.registry.base import query
from tidewell.session import scratch_path, settle
from tidewell.sources.broker import publish_stats

KEYS = ["source_file", *ROW_ORDER]
KEY_SQL = ", ".join(KEYS)


UNTIDY = [
    " Order Key", "Part  Key", "Supp Key ", "Line Number ", "Quantity", " Price/s", "Max  Discount", " Tax", "Return Flag",
    "Line Status", " Ship Date ",
]


@query(
    "normalize_names",
    """SELECT l_orderkey AS "Order_Key", l_partkey AS "Part__Key", l_suppkey AS "Supp_Key", l_linenumber AS "Line_Number",
      l_quantity AS "Quantity", l_extendedprice AS "Price/s", l_discount AS "Max__Discount", l_tax AS "Tax",
      l_returnflag AS "Return_Flag", l_linestatus AS "Line_Status", l_shipdate AS "Ship_Date" FROM lineitem""",
)
def names(spark, sf_dir):
    return normalize_names(table(spark, sf_dir, "lineitem").toDF(*UNTIDY))


@query(
    "numeric_columns",
    f"WITH {DIRTY_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows,
        count(*) FILTER (WHERE isinf({c}::DOUBLE)) AS n_inf,
        count(*) FILTER (WHERE {c} IS NULL OR isnan({c}::DOUBLE)) AS n_missing FROM dirty"""
        for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "rate", "burst", "flat", "twin",
        )
    ),
)
def numerics(spark, sf_dir):
    prof = profile(dirty_lineitem(spark, sf_dir))
    return prof.per_column().filter(F.col("column").isin(list(prof.numeric))).select(
        "column", F.col("rows").alias("n_rows"), "n_inf", "n_missing"
    )


@query(
    "feature_target",
    f"""WITH {DIRTY_SQL}
    SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, flat, twin, note, "Label" FROM dirty""",
)
def features(spark, sf_dir):
    drops = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "source_file", "rate", "burst",
    ]
    return feature_target(dirty_lineitem(spark, sf_dir), "Label", drops=drops)


@query("identity_split", "SELECT ts, event_type, value, props FROM events")
def behaviour(spark, sf_dir):
    """``event_id`` and ``user_id`` are identity columns; the rest is behaviour."""
    events = table(spark, sf_dir, "events")
    kept, _ = identity_split(events.columns, target="Label")
    return events.select(*kept)


@query(
    "binary_label",
    f"""WITH {DIRTY_SQL} SELECT {KEY_SQL}, CASE WHEN "Label" = 'BENIGN' THEN 0 ELSE 1 END AS y FROM dirty""",
)
def binary(spark, sf_dir):
    return dirty_lineitem(spark, sf_dir).select(*KEYS, binary_label(F.col("Label")).alias("y"))


@query(
    "label_encode",
    """SELECT event_id, event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS label_id FROM events""",
)
def encode(spark, sf_dir):
    return encode_labels(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type")


@query(
    "label_filter",
    f"""WITH {DIRTY_SQL} SELECT {KEY_SQL}, "Label" FROM dirty WHERE regexp_matches("Label", 'DoS|DDoS')""",
)
def by_label(spark, sf_dir):
    return label_filter(dirty_lineitem(spark, sf_dir), "Label", "DoS|DDoS").select(*KEYS, "Label")


@query(
    "partition_key",
    """SELECT event_id, CASE WHEN user_id % 5 NOT IN (0, 1) THEN user_id::VARCHAR
      WHEN user_id % 7 <> 0 THEN event_type ELSE 'unknown' END AS key FROM events""",
)
def record_key(spark, sf_dir):
    """Key empty for some users, absent for others; then the fallback column, then the default."""
    user = F.col("user_id")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(user % 5 == 0, F.lit("")).when(user % 5 != 1, user.cast("string")).alias("Source_IP"),
        F.when(user % 7 != 0, F.col("event_type")).alias("source_ip_"),
    )
    return events.select("event_id", partition_key(events, fallbacks=["source_ip_"]).alias("key"))


@query(
    "key_partitions",
    """SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, 0::BIGINT AS split_keys, TRUE AS in_range,
      round(max(n) * 1.0 / count(*), 6) AS top_share
    FROM events JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) USING (user_id)""",
)
def placement(spark, sf_dir):
    """Rows dealt out by key to eight partitions: no key is found in two of them."""
    dealt = table(spark, sf_dir, "events").repartition(8, F.col("user_id").cast("string"))
    seen = dealt.select("user_id", F.spark_partition_id().alias("part")).groupBy("user_id", "part").agg(
        F.count(F.lit(1)).alias("n")
    )
    per_key = seen.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max("part").alias("last")
    )
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("parts") > 1).alias("split_keys"),
        F.every(F.col("last") < 8).alias("in_range"),
        F.round(F.max("n") / F.sum("n"), 6).alias("top_share"),
    )


HOT_KEY_SQL = "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END"


@query(
    "heavy_key_placement",
    f"""SELECT {HOT_KEY_SQL} AS key, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, TRUE AS even, TRUE AS light_in_one
    FROM events GROUP BY 1""",
)
def heavy_placement(spark, sf_dir):
    """A key that holds a third of the rows, dealt to eight partitions and written: no file has twice the mean, a key that
    is not heavy sits in one file, and every key is whole again once its salts are taken off."""
    key = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
    events = table(spark, sf_dir, "events")
    heavy = heavy_keys(events.select(key.alias("key")))
    path = scratch_path(spark, "dealt")
    deal_by_key(events, key, heavy=heavy).write.parquet(path)
    read = spark.read.parquet(path).select("event_id", unsalted_key(F.col("key")).alias("key"), F.input_file_name().alias("file"))
    files = settle(read.groupBy("file").agg(F.count(F.lit(1)).alias("n")))
    even = settle(files.agg((F.max("n") <= 2 * F.sum("n") / KEY_PARTITIONS).alias("even")))
    per_file = read.groupBy("key", "file").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    per_key = per_file.groupBy("key").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.count(F.lit(1)).alias("files"))
    known = attach(per_key, heavy.select("key", "pieces"), ["key"])
    return attach(known, even, []).select(
        "key", "n", "ids", "even", (F.col("files") <= F.coalesce("pieces", F.lit(1))).alias("light_in_one")
    )


@query(
    "key_report",
    """SELECT count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows, round(max(n) / sum(n), 6) AS top_share
    FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""",
)
def key_spread(spark, sf_dir):
    report = key_report(table(spark, sf_dir, "events"), F.col("event_type"))
    return report.withColumn("top_share", F.round("top_share", 6))


@query("json_parse", "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def parse(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return parse_records(table(spark, sf_dir, "events"), schema, "props", keep=["event_id"]).drop(CORRUPT)


@query(
    "json_malformed",
    """SELECT count(*) FILTER (WHERE event_id % 7 <> 0) AS records, count(*) FILTER (WHERE event_id % 7 = 0) AS dead,
      CAST(sum(CASE WHEN event_id % 7 <> 0 THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END) AS BIGINT) AS sum_k
    FROM events""",
)
def malformed(spark, sf_dir):
    """One in seven texts is cut short; it is counted as a dead letter, the rest is parsed."""
    schema = T.StructType([T.StructField("k", T.LongType())])
    text = F.when(F.col("event_id") % 7 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    parsed = parse_records(table(spark, sf_dir, "events").select(text.alias("value")), schema)
    good, dead = split_malformed(parsed)
    tagged = good.select("k", F.lit(1).alias("g")).unionAll(dead.select(F.lit(None).cast("long"), F.lit(0)))
    return tagged.agg(
        F.count_if(F.col("g") == 1).alias("records"), F.count_if(F.col("g") == 0).alias("dead"), F.sum("k").alias("sum_k")
    )


@query("json_roundtrip", "SELECT * FROM lineitem")
def roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return parse_records(rows.select(record_value(rows).alias("value")), rows.schema).drop(CORRUPT)


KEYED_SQL = "SELECT CASE WHEN user_id = 0 THEN 'unknown' ELSE user_id::VARCHAR END AS key, * FROM events"


@query("keyed_records", KEYED_SQL)
def records(spark, sf_dir):
    """Whole events as keyed JSON records, shown by reading the records back."""
    events = table(spark, sf_dir, "events")
    return parse_records(keyed_records(events, "user_id", ()), events.schema, keep=["key"]).drop(CORRUPT)


@query(
    "publish_stats",
    """SELECT count(*) AS messages, count(DISTINCT user_id) AS keys, CAST(sum(strlen('{"user_id":' || user_id
      || ',"event_id":' || event_id || ',"event_type":"' || event_type || '"}')) AS BIGINT) AS bytes FROM events""",
)
def sent(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return publish_stats(keyed_records(events, "user_id", ()))


@query(
    "temporal_split",
    f"""WITH {DIRTY_SQL} SELECT {KEY_SQL}, CASE WHEN source_file = 'R' THEN 'test' ELSE 'train' END AS part FROM dirty""",
)
def by_source(spark, sf_dir):
    train, test = split_by_source(dirty_lineitem(spark, sf_dir).select(*KEYS), ["A", "N"], ["R"])
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


@query(
    "date_split",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS part, o_orderstatus,
      count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY ALL""",
)
def by_date(spark, sf_dir):
    train, test = split_by_time(table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01 00:00:00")
    both = train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
    )
