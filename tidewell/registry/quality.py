"""Queries over the quality checks and row totals."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.fixtures import COPIES_SQL, DIRTY_SQL, ROW_ORDER, dirty_lineitem, table
from tidewell.operators.infinity import replace_infinite
from tidewell.operators.missing import drop_missing
from tidewell.operators.quality import (
    duplicate_counts,
    quality_report,
    row_totals,
    schema_diff,
    type_check,
    validate_all,
)
from tidewell.registry.base import query

BY = ["source_file"]

COUNTS_SQL = f"""WITH {COPIES_SQL},
counted AS (SELECT source_file, count(*) AS total_rows,
    CAST(sum(CASE WHEN isinf(rate) THEN 1 ELSE 0 END + CASE WHEN isinf(burst) THEN 1 ELSE 0 END) AS BIGINT) AS infinity_values,
    CAST(sum(CASE WHEN rate IS NULL OR isnan(rate) THEN 1 ELSE 0 END + CASE WHEN note IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values
  FROM copies GROUP BY source_file),
singles AS (SELECT source_file, count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM copies) GROUP BY source_file),
checked AS (SELECT source_file, total_rows, infinity_values, missing_values, total_rows - distinct_rows AS duplicate_rows
  FROM counted JOIN singles USING (source_file))"""


@query(
    "quality_report",
    COUNTS_SQL
    + """ SELECT *, infinity_values > 0 AS has_infinity, missing_values > 0 AS has_missing,
      duplicate_rows > 0 AS has_duplicates, 17 AS total_columns,
      (infinity_values > 0)::INT + (missing_values > 0)::INT + (duplicate_rows > 0)::INT AS issues_count,
      CASE WHEN infinity_values = 0 AND missing_values = 0 AND duplicate_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS quality_score
    FROM checked""",
)
def quality(spark, sf_dir):
    return quality_report(dirty_lineitem(spark, sf_dir, copies=True), BY).drop("columns")


@query("duplicate_count", COUNTS_SQL + " SELECT source_file, duplicate_rows FROM checked")
def duplicates(spark, sf_dir):
    return duplicate_counts(dirty_lineitem(spark, sf_dir, copies=True), BY)


@query("duplicate_fingerprint", COUNTS_SQL + " SELECT source_file, duplicate_rows FROM checked")
def duplicates_by_fingerprint(spark, sf_dir):
    return duplicate_counts(dirty_lineitem(spark, sf_dir, copies=True), BY, "fingerprint")


@query(
    "validate_all",
    COUNTS_SQL
    + """ SELECT source_file, infinity_values = 0 AS no_infinity, missing_values = 0 AS no_missing,
      TRUE AS schema_valid, TRUE AS data_types_valid, duplicate_rows AS duplicate_count, total_rows,
      17 AS total_columns, infinity_values = 0 AND missing_values = 0 AS validation_passed FROM checked""",
)
def validate(spark, sf_dir):
    dirty = dirty_lineitem(spark, sf_dir, copies=True)
    expected = [c for c in dirty.columns if c not in BY]
    return validate_all(dirty, BY, expected, dirty.drop(*BY).schema)


@query(
    "schema_diff",
    """SELECT 'lineitem' AS table_name, count(*) AS n_rows, 'shipped_at' AS missing_columns,
      'l_linestatus,l_shipdate' AS extra_columns, FALSE AS schema_valid FROM lineitem
    UNION ALL SELECT 'orders', count(*), '', '', TRUE FROM orders""",
)
def schema_difference(spark, sf_dir):
    """Two tables against expectations, next to their row counts."""
    frames = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders")}
    expected = {
        "lineitem": [c for c in frames["lineitem"].columns if c not in ("l_linestatus", "l_shipdate")] + ["shipped_at"],
        "orders": list(reversed(frames["orders"].columns)),
    }
    reports = []
    for name, frame in frames.items():
        diff = schema_diff(frame.columns, expected[name])
        reports.append(
            frame.groupBy()
            .count()
            .select(
                F.lit(name).alias("table_name"),
                F.col("count").alias("n_rows"),
                F.lit(",".join(diff.missing)).alias("missing_columns"),
                F.lit(",".join(diff.extra)).alias("extra_columns"),
                F.lit(diff.valid).alias("schema_valid"),
            )
        )
    return reports[0].unionAll(reports[1])


@query(
    "type_check",
    """SELECT 'l_quantity' AS "column", 'double' AS expected_type, 'string' AS actual_type, FALSE AS matches,
      count(*) FILTER (WHERE try_cast(l_quantity::VARCHAR AS DOUBLE) IS NULL) AS n_bad FROM lineitem
    UNION ALL SELECT 'l_returnflag', 'string', 'string', TRUE, 0 FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'l_linestatus', 'bigint', 'string', FALSE,
      count(*) FILTER (WHERE try_cast(l_linestatus AS BIGINT) IS NULL) FROM lineitem
    UNION ALL SELECT 'l_linenumber', 'int', 'string', FALSE,
      count(*) FILTER (WHERE try_cast(l_linenumber::VARCHAR AS INT) IS NULL) FROM lineitem""",
)
def types(spark, sf_dir):
    """``lineitem`` read as text against typed expectations."""
    names = ["l_quantity", "l_returnflag", "l_linestatus", "l_linenumber"]
    text = table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("string").alias(c) for c in names])
    expected = T.StructType(
        [
            T.StructField("l_quantity", T.DoubleType()),
            T.StructField("l_returnflag", T.StringType()),
            T.StructField("l_linestatus", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
        ]
    )
    return type_check(text, expected)


@query(
    "row_totals_rollup",
    f"""WITH {DIRTY_SQL}
    SELECT source_file, count(*) AS rows_in,
      count(*) FILTER (WHERE rate IS NOT NULL AND NOT isnan(rate) AND note IS NOT NULL) AS rows_out,
      count(*) FILTER (WHERE rate IS NULL OR isnan(rate) OR note IS NULL) AS rows_dropped
    FROM dirty GROUP BY ROLLUP (source_file)""",
)
def totals(spark, sf_dir):
    dirty = dirty_lineitem(spark, sf_dir).select(*BY, *ROW_ORDER, "rate", "burst", "note")
    return row_totals(dirty, drop_missing(replace_infinite(dirty, BY, "max")), "source_file")
