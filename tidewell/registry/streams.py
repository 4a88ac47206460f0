"""Queries over window features and streams.  Streams run over the given files to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.fixtures import table
from tidewell.functions.records import CORRUPT, parse_records
from tidewell.operators.models import score_binary, train_forest
from tidewell.registry.base import query
from tidewell.registry.models import FEATURES, flows
from tidewell.registry.projections import KEYED_SQL
from tidewell.session import scratch_path
from tidewell.streaming.ingest import (
    file_stream,
    latest_updates,
    parse_stream,
    replay,
    write_stream,
    write_updates,
)
from tidewell.streaming.scoring import alerts, score_stream
from tidewell.streaming.windows import (
    LOG_SIZE,
    bursts,
    connections,
    destination_sketches,
    request_rate,
    united_destinations,
    unique_destinations,
)

DAY_SQL = "date_trunc('day', ts)::TIMESTAMP"


def naive(df):
    """Window edges as zone-less timestamps."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def event_pattern(sf_dir):
    """As a glob, so it matches a single file as well as a folder of that name."""
    return f"{sf_dir}/event[s].parquet"


def targets(df):
    """``user_id`` as source, ``props.k`` as destination."""
    return df.withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("bigint"))


COUNT_SQL = f"""SELECT user_id, {DAY_SQL} AS window_start, {DAY_SQL} + INTERVAL 1 DAY AS window_end,
  count(*) AS connections FROM events GROUP BY ALL"""


@query("connections_per_window", COUNT_SQL)
def windows(spark, sf_dir):
    return naive(connections(table(spark, sf_dir, "events"), "user_id", "ts", "1 day"))


@query(
    "connections_10s",
    """SELECT user_id, time_bucket(INTERVAL '10 seconds', ts) AS window_start,
      time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end, count(*) AS connections
    FROM events GROUP BY ALL""",
)
def short_windows(spark, sf_dir):
    return naive(connections(table(spark, sf_dir, "events"), "user_id", "ts"))


@query(
    "request_rate",
    f"SELECT user_id, window_start, window_end, connections, round(connections / 86400.0, 9) AS rate FROM ({COUNT_SQL})",
)
def rate(spark, sf_dir):
    found = request_rate(table(spark, sf_dir, "events"), "user_id", "ts", "1 day")
    return naive(found).withColumn("rate", F.round("rate", 9))


DISTINCT_SQL = f"""SELECT user_id, {DAY_SQL} AS window_start, {DAY_SQL} + INTERVAL 1 DAY AS window_end,
  count(DISTINCT regexp_extract(props, '[0-9]+')) AS destinations FROM events GROUP BY ALL"""


@query("unique_destinations", DISTINCT_SQL)
def destinations(spark, sf_dir):
    return naive(unique_destinations(targets(table(spark, sf_dir, "events")), "user_id", "k", "ts", "1 day"))


@query("stream_connections", COUNT_SQL)
def stream_windows(spark, sf_dir):
    """Per-batch updates of a streaming window count, merged to the current state."""
    schema = table(spark, sf_dir, "events").schema
    stream = connections(file_stream(spark, event_pattern(sf_dir), schema), "user_id", "ts", "1 day", "1 hour")
    path, mark = scratch_path(spark, "updates"), scratch_path(spark, "mark")
    write_updates(stream, path, mark, available_now=True).awaitTermination()
    return naive(latest_updates(spark, path, ["user_id", "window_start", "window_end"]))


@query("stream_unique_destinations", DISTINCT_SQL)
def stream_destinations(spark, sf_dir):
    """Chained streaming aggregates in append mode; a late closing record lets the watermark pass every window."""
    events, path = _closed(spark, sf_dir)
    stream = unique_destinations(
        targets(file_stream(spark, path, events.schema, max_files=1000)), "user_id", "k", "ts", "1 day", "1 hour"
    )
    out = scratch_path(spark, "closed")
    write_stream(stream, out, scratch_path(spark, "mark"), available_now=True).awaitTermination()
    return naive(spark.read.schema(stream.schema).parquet(out))


@query("sketched_destinations", DISTINCT_SQL.replace(" FROM events", ", TRUE AS within_error FROM events"))
def sketched_destinations(spark, sf_dir):
    """Hourly sketches written by a stream, united to days without reading an event again, next to the exact counts."""
    events, path = _closed(spark, sf_dir)
    stream = destination_sketches(
        targets(file_stream(spark, path, events.schema, max_files=1000)), "user_id", "k", "ts", "1 hour", "1 hour"
    )
    out = scratch_path(spark, "sketches")
    write_stream(stream, out, scratch_path(spark, "mark"), available_now=True).awaitTermination()
    daily = united_destinations(spark.read.schema(stream.schema).parquet(out), "user_id", "1 day")
    exact = unique_destinations(targets(events), "user_id", "k", "ts", "1 day")
    both = exact.join(
        daily.withColumnRenamed("destinations", "estimate"), ["user_id", "window_start", "window_end"], "left"
    )
    slack = F.col("destinations") * 4 * 1.04 / 2 ** (LOG_SIZE / 2) + 0.5
    near = F.coalesce(F.abs(F.col("estimate") - F.col("destinations")) <= slack, F.lit(False))
    return naive(both.withColumn("within_error", near).drop("estimate"))


def _closed(spark, sf_dir):
    """The events with a closing record of user -1, 40 days after the latest, as files to stream."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events")
    latest = events.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 40 DAYS")).alias("ts"))
    given = {"ts": F.col("ts"), "props": F.lit('{"k": 0}'), "user_id": F.lit(-1)}  # its own window stays open
    closing = latest.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema])
    events.unionByName(closing).write.parquet(path)
    return events, path


@query(
    "stream_alerts",
    """SELECT user_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS events FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS burst FROM (
        SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
        FROM events))
    GROUP BY user_id, burst HAVING count(*) >= 2""",
)
def stream_alerts(spark, sf_dir):
    """One alert per user and burst of at least two events, a burst ending after six quiet hours."""
    events, path = _closed(spark, sf_dir)
    stream = bursts(file_stream(spark, path, events.schema, max_files=1000), "user_id", "ts", "6 hours", 2, "1 hour")
    out = scratch_path(spark, "bursts")
    write_stream(stream, out, scratch_path(spark, "mark"), available_now=True).awaitTermination()
    found = spark.read.schema(stream.schema).parquet(out)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_at", "last_at")})


@query("file_replay", KEYED_SQL)
def replayed(spark, sf_dir):
    """Files replayed as keyed JSON records of all columns into a sink, shown by reading the records back."""
    schema = table(spark, sf_dir, "events").schema
    stream = replay(spark, event_pattern(sf_dir), schema, field="user_id", fallbacks=())
    path = scratch_path(spark, "replay")
    write_stream(stream, path, scratch_path(spark, "mark"), available_now=True).awaitTermination()
    return parse_records(spark.read.schema(stream.schema).parquet(path), schema, keep=["key"]).drop(CORRUPT)


@query("stream_ingest", "SELECT * FROM events")
def ingested(spark, sf_dir):
    """JSON records from a stream, parsed and appended to Parquet."""
    schema = table(spark, sf_dir, "events").schema
    records = replay(spark, event_pattern(sf_dir), schema, field="user_id", fallbacks=())
    parsed = parse_stream(records, schema)
    path = scratch_path(spark, "ingest")
    write_stream(parsed, path, scratch_path(spark, "mark"), available_now=True).awaitTermination()
    return spark.read.schema(parsed.schema).parquet(path)


@query(
    "stream_scoring",
    """SELECT count(*) AS scored, CAST(sum(event_id) AS BIGINT) AS ids, TRUE AS same_as_batch, TRUE AS probabilities FROM events""",
)
def scoring(spark, sf_dir):
    """A forest fitted on the table scores the same events as a stream, like it scores them as a table."""
    known = flows(spark, sf_dir)
    model = train_forest(known, FEATURES, "y", numTrees=5, maxDepth=4)
    path = scratch_path(spark, "flows")
    known.write.parquet(path)
    found = alerts(score_stream(model, file_stream(spark, path, known.schema, max_files=100)), threshold=0.0)
    out = scratch_path(spark, "alerts")
    write_stream(found, out, scratch_path(spark, "mark"), available_now=True).awaitTermination()
    streamed = spark.read.schema(found.schema).parquet(out).select("event_id", "score")
    batch = score_binary(model, known).select("event_id", F.col("score").alias("again"))
    return streamed.join(batch, "event_id").agg(
        F.count(F.lit(1)).alias("scored"),
        F.sum("event_id").alias("ids"),
        F.every(F.abs(F.col("score") - F.col("again")) < 1e-9).alias("same_as_batch"),
        F.every(F.col("score").between(0, 1)).alias("probabilities"),
    )
