"""The dirty table the queries and tests clean: ``lineitem`` with infinities, gaps and copies
derived by fixed rules, once for Spark and once as SQL for the comparison engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_lineitem(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """``lineitem`` plus rate, burst, flat, twin, note, Label, source_file."""
    inf = float("inf")
    key = F.col("l_orderkey")
    dirty = table(spark, sf_dir, "lineitem").withColumns(
        {
            "source_file": F.col("l_returnflag"),
            "rate": F.when(key % 11 == 0, F.lit(inf))
            .when(key % 13 == 0, F.lit(-inf))
            .when(key % 17 == 0, F.lit(float("nan")))
            .when(key % 19 == 0, F.lit(None).cast("double"))
            .otherwise(F.col("l_extendedprice") / F.col("l_quantity")),
            "burst": F.when(F.col("l_returnflag") == "R", F.lit(inf)).otherwise(F.col("l_extendedprice")),
            "flat": F.lit(1.0),
            "twin": F.col("l_extendedprice") * 2,
            "note": F.when(key % 23 != 0, F.col("l_linestatus")),
            "Label": F.when(F.col("l_returnflag") == "N", F.lit("BENIGN"))
            .when(F.col("l_linestatus") == "F", F.lit("DoS"))
            .otherwise(F.lit("PortScan")),
        }
    )
    if copies:
        dirty = dirty.unionByName(dirty.filter(key % 29 == 0))
    return dirty


DIRTY_SQL = """
dirty AS (
  SELECT *, l_returnflag AS source_file,
    CASE WHEN l_orderkey % 11 = 0 THEN 'Infinity'::DOUBLE
         WHEN l_orderkey % 13 = 0 THEN '-Infinity'::DOUBLE
         WHEN l_orderkey % 17 = 0 THEN 'NaN'::DOUBLE
         WHEN l_orderkey % 19 = 0 THEN NULL
         ELSE l_extendedprice / l_quantity END AS rate,
    CASE WHEN l_returnflag = 'R' THEN 'Infinity'::DOUBLE ELSE l_extendedprice END AS burst,
    1.0::DOUBLE AS flat,
    l_extendedprice * 2 AS twin,
    CASE WHEN l_orderkey % 23 <> 0 THEN l_linestatus END AS note,
    CASE WHEN l_returnflag = 'N' THEN 'BENIGN' WHEN l_linestatus = 'F' THEN 'DoS' ELSE 'PortScan' END AS "Label"
  FROM lineitem)"""

COPIES_SQL = DIRTY_SQL + """,
copies AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE l_orderkey % 29 = 0)"""


def wide_lineitem(spark: SparkSession, sf_dir: str, width: int = 78, sources: int = 8) -> DataFrame:
    """``lineitem`` widened to ``width`` numeric features plus Label and source_file, with a few
    infinite and missing cells in two columns; the shape of a day-per-file flow table."""
    rows = table(spark, sf_dir, "lineitem")
    draw = [F.pmod(F.xxhash64(*ROW_ORDER, F.lit(i)), F.lit(10_000)) for i in range(width)]
    base = [F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    cells = [F.round(draw[i] * (i % 7 + 1) / 10 + base[i % 4] * (i % 3), 3) for i in range(width)]
    cells[0] = F.when(draw[0] < 16, F.lit(float("inf"))).otherwise(cells[0])
    cells[1] = F.when(draw[1] < 5, F.lit(float("nan"))).otherwise(cells[1])
    label = F.when(F.col("l_returnflag") == "N", F.lit("BENIGN")).otherwise(F.lit("DoS"))
    return rows.select(
        *[c.alias(f"Feature {i}") for i, c in enumerate(cells)],
        label.alias("Label"),
        (F.col("l_orderkey") % sources).cast("string").alias("source_file"),
    )
