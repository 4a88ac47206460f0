"""Keyed tumbling-window features; each function takes a static or a streaming frame.

A streaming frame needs ``watermark``, which bounds the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import ref

WINDOW = "10 seconds"  # fixed value: default window length
LOG_SIZE = 12  # sketches of at most 4 KB


def with_event_time(df: DataFrame, at: str, watermark: str | None = None) -> DataFrame:
    """``at`` as a timestamp, with the watermark a stream needs."""
    timed = df.withColumn(at, ref(at).cast("timestamp"))
    if df.isStreaming:
        if watermark is None:
            raise ValueError("a streaming window feature needs a watermark")
        timed = timed.withWatermark(at, watermark)
    return timed


def _spread(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(
        *[ref(c) for c in keep if c not in ("window",)],
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def connections(
    df: DataFrame, source: str, at: str, window: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """``source, connections, window_start, window_end``: rows per source and window.

    Partial counts are taken before the shuffle, so a source with most of the traffic sends one
    row per task and window.
    """
    counted = with_event_time(df, at, watermark).groupBy(ref(source), F.window(at, window)).agg(
        F.count(F.lit(1)).alias("connections")
    )
    return _spread(counted, [source, "connections"])


def request_rate(
    df: DataFrame, source: str, at: str, window: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """``connections`` plus ``rate``: rows per second of the window."""
    counted = connections(df, source, at, window, watermark)
    seconds = F.unix_micros("window_end") - F.unix_micros("window_start")
    return counted.withColumn("rate", F.col("connections") * 1e6 / seconds)


def unique_destinations(
    df: DataFrame, source: str, destination: str, at: str, window: str = WINDOW, watermark: str | None = None,
    exact: bool = True,
) -> DataFrame:
    """``source, destinations, window_start, window_end``: distinct destinations per source and window.

    Exact counting groups by destination first and counts the groups, in a stream as two chained
    aggregates (append mode): state and work are spread by destination, so no task holds the set of
    a busy source.  ``exact=False`` keeps a sketch of bounded size per source and window instead.
    """
    timed = with_event_time(df, at, watermark)
    if not exact:
        counted = timed.groupBy(ref(source), F.window(at, window)).agg(
            F.approx_count_distinct(ref(destination)).alias("destinations")
        )
        return _spread(counted, [source, "destinations"])
    pairs = timed.filter(ref(destination).isNotNull()).groupBy(ref(source), F.window(at, window), ref(destination)).count()
    if df.isStreaming:
        again = F.window(F.window_time("window"), window).alias("window")
        counted = pairs.groupBy(ref(source), again)
    else:
        counted = pairs.groupBy(ref(source), "window")
    return _spread(counted.agg(F.count(F.lit(1)).alias("destinations")), [source, "destinations"])


def destination_sketches(
    df: DataFrame, source: str, destination: str, at: str, window: str, watermark: str | None = None, log_size: int = LOG_SIZE
) -> DataFrame:
    """``source, window_start, window_end, sketch``: the distinct destinations of a small window as a mergeable sketch.

    A sketch takes at most ``2 ** log_size`` bytes whatever it has seen; in a stream that is the state per source and open
    window.  Its relative standard error is about ``1.04 / sqrt(2 ** log_size)``.  NULL destinations are not counted.
    """
    timed = with_event_time(df, at, watermark).filter(ref(destination).isNotNull() & ref(at).isNotNull())
    sketched = timed.groupBy(ref(source), F.window(at, window)).agg(
        F.hll_sketch_agg(ref(destination).cast("string"), log_size).alias("sketch")
    )
    return _spread(sketched, [source, "sketch"])


def united_destinations(sketches: DataFrame, source: str, window: str) -> DataFrame:
    """``source, destinations, window_start, window_end``: distinct destinations of longer windows from stored sketches.

    The union counts a destination seen in several small windows once; no event is read again.  ``window`` should be a
    multiple of the small ones, which belong to the window they start in.
    """
    merged = sketches.groupBy(ref(source), F.window("window_start", window)).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("destinations")
    )
    return _spread(merged, [source, "destinations"])


def bursts(
    df: DataFrame, source: str, at: str, quiet: str, least: int = 1, watermark: str | None = None
) -> DataFrame:
    """``source, first_at, last_at, events``: one alert per source and burst of rows.

    A burst ends when the source is quiet for ``quiet``; bursts of fewer than ``least`` rows raise none.  In a stream a
    burst is state until the watermark passes its end, then it is emitted once and forgotten (append mode), so the
    state is bounded by the sources active within ``quiet`` plus the watermark.
    """
    timed = with_event_time(df, at, watermark).filter(ref(at).isNotNull())
    merged = timed.groupBy(ref(source), F.session_window(at, quiet)).agg(
        F.min(ref(at)).alias("first_at"), F.max(ref(at)).alias("last_at"), F.count(F.lit(1)).alias("events")
    )
    return merged.filter(F.col("events") >= least).select(ref(source), "first_at", "last_at", "events")
