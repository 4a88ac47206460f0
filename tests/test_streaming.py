import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.records import CORRUPT
from tidewell.streaming.ingest import file_stream, latest_updates, parse_stream, replay, write_stream, write_updates
from tidewell.streaming.windows import connections, request_rate, unique_destinations

SCHEMA = T.StructType(
    [T.StructField("at", T.TimestampType()), T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())]
)
ROWS = [
    ("2024-01-01 00:00:01", "a", "x"),
    ("2024-01-01 00:00:09", "a", "x"),
    ("2024-01-01 00:00:10", "a", "y"),
    ("2024-01-01 00:00:05", "b", "x"),
    ("2024-01-01 00:00:06", "b", "z"),
    ("2024-01-01 00:00:07", "b", None),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "at string, src string, dst string").withColumn("at", F.col("at").cast("timestamp"))


@pytest.fixture
def events(spark):
    return frame(spark, ROWS)


def keyed(df, value):
    return {(r["src"], str(r["window_start"])[-2:]): r[value] for r in df.collect()}


def test_batch_windows(events):
    counts = keyed(connections(events, "src", "at"), "connections")
    assert counts == {("a", "00"): 2, ("a", "10"): 1, ("b", "00"): 3}
    assert keyed(request_rate(events, "src", "at"), "rate")["a", "00"] == pytest.approx(0.2)
    for exact in (True, False):
        assert keyed(unique_destinations(events, "src", "dst", "at", exact=exact), "destinations")["b", "00"] == 2


def test_stream_needs_a_watermark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = file_stream(spark, str(tmp_path / "in"), SCHEMA)
    with pytest.raises(ValueError):
        connections(stream, "src", "at")


def feed(spark, path, batches):
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_updates_over_batches_equal_batch(spark, events, tmp_path):
    source, out, mark = (str(tmp_path / p) for p in ("in", "out", "mark"))
    feed(spark, source, [ROWS[:3], ROWS[3:]])
    stream = connections(file_stream(spark, source, SCHEMA), "src", "at", watermark="1 minute")
    write_updates(stream, out, mark, available_now=True).awaitTermination()
    got = latest_updates(spark, out, ["src", "window_start", "window_end"])
    assert keyed(got, "connections") == keyed(connections(events, "src", "at"), "connections")


def test_late_events_are_left_out_and_reruns_add_nothing(spark, tmp_path):
    source, out, mark = (str(tmp_path / p) for p in ("in", "out", "mark"))
    later = [("2024-01-01 01:00:00", "s", "s")]
    late = [("2024-01-01 00:00:02", "a", "w")]
    for rows in (ROWS, later, late, [("2024-01-01 02:00:00", "s", "s")]):
        feed(spark, source, [rows])
        stream = unique_destinations(file_stream(spark, source, SCHEMA), "src", "dst", "at", watermark="10 seconds")
        write_stream(stream, out, mark, available_now=True).awaitTermination()
    closed = keyed(spark.read.parquet(out), "destinations")
    assert {k: v for k, v in closed.items() if k[0] in "ab"} == {("a", "00"): 1, ("a", "10"): 1, ("b", "00"): 2}
    before = spark.read.parquet(out).count()
    write_stream(stream, out, mark, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == before


def test_replay_parse_ingest(spark, events, tmp_path):
    source, wire, out = (str(tmp_path / p) for p in ("in", "wire", "out"))
    events.coalesce(1).write.parquet(source)
    records = replay(spark, source, SCHEMA, field="src", fallbacks=())
    write_stream(records, wire, str(tmp_path / "m1"), available_now=True).awaitTermination()
    assert {r["key"] for r in spark.read.parquet(wire).collect()} == {"a", "b"}
    broken = spark.createDataFrame([("a", "{broken")], "key string, value string")
    spark.read.parquet(wire).unionByName(broken).write.parquet(str(tmp_path / "wire2"))
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    parsed = parse_stream(file_stream(spark, str(tmp_path / "wire2"), schema, max_files=10), SCHEMA, dead_letters=True)
    write_stream(parsed, out, str(tmp_path / "m2"), available_now=True).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 7
    assert stored.filter(F.col(CORRUPT).isNotNull()).first()[CORRUPT] == "{broken"
    assert stored.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).exceptAll(events).count() == 0


def test_partitioned_sink(spark, events, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.coalesce(1).write.parquet(source)
    stream = file_stream(spark, source, SCHEMA)
    write_stream(stream, out, str(tmp_path / "m"), available_now=True, partition_by=["src"]).awaitTermination()
    assert spark.read.parquet(out).filter("src = 'b'").count() == 3
