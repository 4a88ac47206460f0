"""Queries over the infinity and missing-value operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.fixtures import DIRTY_SQL, ROW_ORDER, dirty_lineitem
from tidewell.functions.cells import missing, nan_to_null
from tidewell.operators.fill import forward_fill
from tidewell.operators.infinity import count_infinite, replace_infinite
from tidewell.operators.missing import count_missing, drop_missing, drop_sparse_columns, fill_missing
from tidewell.registry.base import query

KEYS = ["source_file", *ROW_ORDER]
KEY_SQL = ", ".join(KEYS)
BY = ["source_file"]

MAX_SQL = f"""WITH {DIRTY_SQL},
tops AS (SELECT source_file,
    max(rate) FILTER (WHERE isfinite(rate)) AS rate_max,
    max(burst) FILTER (WHERE isfinite(burst)) AS burst_max
  FROM dirty GROUP BY source_file),
fixed AS (SELECT d.* REPLACE (
    CASE WHEN isinf(d.rate) THEN coalesce(t.rate_max, 1e9) ELSE d.rate END AS rate,
    CASE WHEN isinf(d.burst) THEN coalesce(t.burst_max, 1e9) ELSE d.burst END AS burst)
  FROM dirty d JOIN tops t USING (source_file))"""


@query(
    "inf_count",
    f"""WITH {DIRTY_SQL}
    SELECT source_file, CAST(sum(CASE WHEN isinf(rate) THEN 1 ELSE 0 END
      + CASE WHEN isinf(burst) THEN 1 ELSE 0 END) AS BIGINT) AS n_inf
    FROM dirty GROUP BY source_file""",
)
def inf_count(spark, sf_dir):
    return count_infinite(dirty_lineitem(spark, sf_dir), BY)


@query(
    "inf_drop",
    f"""WITH {DIRTY_SQL}
    SELECT {KEY_SQL}, rate, burst, note FROM dirty
    WHERE isfinite(rate) AND isfinite(burst) AND note IS NOT NULL""",
)
def inf_drop(spark, sf_dir):
    return replace_infinite(dirty_lineitem(spark, sf_dir), BY, "drop").select(*KEYS, "rate", "burst", "note")


@query(
    "inf_max_per_file",
    MAX_SQL + f" SELECT {KEY_SQL}, CASE WHEN isnan(rate) THEN NULL ELSE rate END AS rate, burst FROM fixed",
)
def inf_max_per_file(spark, sf_dir):
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), BY, "max")
    return nan_to_null(cleaned, ["rate"]).select(*KEYS, "rate", "burst")


@query(
    "inf_large_int",
    f"""WITH {DIRTY_SQL}
    SELECT {KEY_SQL}, CASE WHEN isinf(rate) THEN 1e9 WHEN isnan(rate) THEN NULL ELSE rate END AS rate,
      CASE WHEN isinf(burst) THEN 1e9 ELSE burst END AS burst FROM dirty""",
)
def inf_large_int(spark, sf_dir):
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), BY, "large_int")
    return nan_to_null(cleaned, ["rate"]).select(*KEYS, "rate", "burst")


@query(
    "inf_max_split",
    f"""WITH {DIRTY_SQL},
    tops AS (SELECT max(rate) FILTER (WHERE isfinite(rate)) AS rate_max,
        max(burst) FILTER (WHERE isfinite(burst)) AS burst_max FROM dirty)
    SELECT {KEY_SQL}, CASE WHEN isinf(rate) THEN rate_max WHEN isnan(rate) THEN NULL ELSE rate END AS rate,
      CASE WHEN isinf(burst) THEN burst_max ELSE burst END AS burst FROM dirty, tops""",
)
def inf_max_split(spark, sf_dir):
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), (), "max", fallback=None)
    return nan_to_null(cleaned, ["rate"]).select(*KEYS, "rate", "burst")


@query(
    "inf_to_null",
    f"""WITH {DIRTY_SQL}
    SELECT {KEY_SQL}, CASE WHEN isfinite(rate) THEN rate END AS rate,
      CASE WHEN isfinite(burst) THEN burst END AS burst FROM dirty""",
)
def inf_to_null(spark, sf_dir):
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), (), "null")
    return nan_to_null(cleaned, ["rate"]).select(*KEYS, "rate", "burst")


@query(
    "missing_count",
    f"""WITH {DIRTY_SQL}
    SELECT source_file, CAST(sum(CASE WHEN rate IS NULL OR isnan(rate) THEN 1 ELSE 0 END
      + CASE WHEN note IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing
    FROM dirty GROUP BY source_file""",
)
def missing_count(spark, sf_dir):
    return count_missing(dirty_lineitem(spark, sf_dir), BY)


@query(
    "missing_drop",
    MAX_SQL
    + f""" SELECT {KEY_SQL}, rate, burst, note FROM fixed
    WHERE rate IS NOT NULL AND NOT isnan(rate) AND note IS NOT NULL""",
)
def missing_drop(spark, sf_dir):
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), BY, "max")
    return drop_missing(cleaned).select(*KEYS, "rate", "burst", "note")


def _filled_sql(stat: str) -> str:
    return (
        MAX_SQL
        + f""", fills AS (SELECT source_file, {stat} AS fill FROM fixed
      WHERE rate IS NOT NULL AND NOT isnan(rate) GROUP BY source_file)
    SELECT {KEY_SQL}, CASE WHEN rate IS NULL OR isnan(rate) THEN round(fill, 4) ELSE rate END AS rate, note
    FROM fixed JOIN fills USING (source_file)"""
    )


def _filled(spark, sf_dir, how):
    """Filled cells are rounded (summation order differs between engines), present ones are not."""
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), BY, "max")
    filled = fill_missing(cleaned.withColumn("gap", missing(cleaned, "rate")), BY, how)
    rate = F.when(F.col("gap"), F.round("rate", 4)).otherwise(F.col("rate"))
    return filled.select(*KEYS, rate.alias("rate"), "note")


@query("missing_median", _filled_sql("quantile_cont(rate, 0.5)"))
def missing_median(spark, sf_dir):
    return _filled(spark, sf_dir, "median")


@query("missing_mean", _filled_sql("avg(rate)"))
def missing_mean(spark, sf_dir):
    return _filled(spark, sf_dir, "mean")


@query(
    "forward_fill",
    MAX_SQL
    + f""", gaps AS (SELECT {KEY_SQL}, CASE WHEN isnan(rate) THEN NULL ELSE rate END AS rate, note FROM fixed)
    SELECT {KEY_SQL}, last_value(rate IGNORE NULLS) OVER w AS rate, last_value(note IGNORE NULLS) OVER w AS note
    FROM gaps WINDOW w AS (PARTITION BY source_file ORDER BY {", ".join(ROW_ORDER)}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward_fill_query(spark, sf_dir):
    cleaned = replace_infinite(dirty_lineitem(spark, sf_dir), BY, "max").select(*KEYS, "rate", "note")
    return forward_fill(cleaned, BY, ROW_ORDER)


@query(
    "drop_sparse_columns",
    f"""WITH {DIRTY_SQL}
    SELECT {KEY_SQL}, twin, note FROM dirty""",
)
def drop_sparse(spark, sf_dir):
    """``sparse`` is missing in 22 of 23 rows and goes; ``note`` (1 in 23) stays."""
    dirty = dirty_lineitem(spark, sf_dir).select(
        *KEYS, "twin", "note", F.when(F.col("note").isNull(), F.lit(1)).alias("sparse")
    )
    return drop_sparse_columns(dirty, 0.5)
