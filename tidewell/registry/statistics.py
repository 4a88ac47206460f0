"""Queries over statistics, correlation and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.fixtures import DIRTY_SQL, ROW_ORDER, dirty_lineitem, table
from tidewell.operators.correlation import correlated_columns, correlation_matrix
from tidewell.operators.scaling import fit_scaler
from tidewell.operators.statistics import class_distribution, describe, group_statistics, low_variance, variances
from tidewell.registry.base import query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flat", "twin"]
NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ROUNDED = 6


def _each(columns, template, glue=" UNION ALL "):
    return glue.join(template.format(c=c) for c in columns)


@query(
    "class_distribution",
    f"""WITH {DIRTY_SQL} SELECT "Label", count(*) AS n,
      round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM dirty GROUP BY "Label" """,
)
def classes(spark, sf_dir):
    return class_distribution(dirty_lineitem(spark, sf_dir), "Label").withColumn("percent", F.round("percent", 6))


@query(
    "describe",
    _each(
        NUMBERS,
        """SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean,
      round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS "min", round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
      round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
      max({c})::DOUBLE AS "max" FROM lineitem""",
    ),
)
def summary(spark, sf_dir):
    rounded = ["mean", "std", "q25", "q50", "q75"]
    return describe(table(spark, sf_dir, "lineitem"), NUMBERS).withColumns({c: F.round(c, 4) for c in rounded})


CORR_SQL = f"WITH {DIRTY_SQL}, pairs AS (" + " UNION ALL ".join(
    f"""SELECT {i} AS i, {j} AS j, '{a}' AS column_i, '{b}' AS column_j,
    {"NULL::DOUBLE" if "flat" in (a, b) else f"corr({a}, {b})"} AS r FROM dirty"""
    + (" HAVING count(*) > 0" if "flat" in (a, b) else "")
    for i, a in enumerate(MEASURES)
    for j, b in enumerate(MEASURES)
    if i <= j
) + ")"


@query("correlation_matrix", CORR_SQL + " SELECT i, j, column_i, column_j, round(r, 6) AS r FROM pairs")
def correlations(spark, sf_dir):
    matrix = correlation_matrix(dirty_lineitem(spark, sf_dir), MEASURES)
    return matrix.withColumn("r", F.round(F.col("r"), 6) + 0.0)


@query(
    "correlated_drop",
    CORR_SQL
    + """ SELECT column_j AS "column", min(j) AS position FROM pairs WHERE i < j AND abs(r) > 0.95 GROUP BY column_j""",
)
def correlated(spark, sf_dir):
    return correlated_columns(dirty_lineitem(spark, sf_dir), 0.95, MEASURES)


VAR_SQL = f"WITH {DIRTY_SQL}, v AS (" + _each(
    MEASURES, "SELECT '{c}' AS \"column\", var_pop({c}) AS variance FROM dirty"
) + ")"


@query("variance", VAR_SQL + ' SELECT "column", round(variance, 4) AS variance FROM v')
def variance(spark, sf_dir):
    return variances(dirty_lineitem(spark, sf_dir), MEASURES).withColumn("variance", F.round("variance", 4))


@query("low_variance", VAR_SQL + ' SELECT "column", round(variance, 6) AS variance FROM v WHERE variance <= 0.01')
def quasi_constant(spark, sf_dir):
    return low_variance(dirty_lineitem(spark, sf_dir), 0.01, MEASURES).withColumn("variance", F.round("variance", 6))


@query(
    "group_percentiles",
    """SELECT event_type, 'value' AS "column", count(value) AS n, round(avg(value), 6) AS mean,
      round(stddev_samp(value), 6) AS std, round(quantile_cont(value, 0.25), 6) AS p25,
      round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
      round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type""",
)
def percentiles(spark, sf_dir):
    stats = group_statistics(table(spark, sf_dir, "events"), ["event_type"], ["value"])
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75", "p95")})


SCALED = ["l_quantity", "l_extendedprice", "l_discount", "flat"]
KEY_SQL = ", ".join(f"{c} AS k_{c}" for c in ROW_ORDER)


def _scaled(spark, sf_dir, method):
    dirty = dirty_lineitem(spark, sf_dir)
    keyed = dirty.select(*[F.col(c).alias(f"k_{c}") for c in ROW_ORDER], *SCALED)
    scaled = fit_scaler(dirty, SCALED, method).transform(keyed)
    return scaled.withColumns({c: F.round(c, ROUNDED) for c in SCALED})


def _scaled_sql(center, width):
    stats = ", ".join(f"{center.format(c=c)} AS m_{c}, {width.format(c=c)} AS w_{c}" for c in SCALED)
    cells = ", ".join(f"round(({c} - m_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END, 6) AS {c}" for c in SCALED)
    return f"WITH {DIRTY_SQL}, s AS (SELECT {stats} FROM dirty) SELECT {KEY_SQL}, {cells} FROM dirty, s"


@query("scale_standard", _scaled_sql("avg({c})", "stddev_pop({c})"))
def standard(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query("scale_minmax", _scaled_sql("min({c})", "max({c}) - min({c})"))
def minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query("scale_robust", _scaled_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def robust(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")
