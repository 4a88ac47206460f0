"""Queries over file formats, layouts and the cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.fixtures import DIRTY_SQL, dirty_lineitem, table
from tidewell.operators.grouping import attach
from tidewell.operators.quality import validate_all
from tidewell.plans.etl import clean_table, run_etl, run_incremental, run_report
from tidewell.registry.base import query
from tidewell.registry.cleaning import KEY_SQL, KEYS, MAX_SQL
from tidewell.session import scratch_path, settle
from tidewell.sources.files import (
    header_consistency,
    list_files,
    locate,
    read_csv,
    read_parquet_files,
    union_files,
    validate_parquet,
)
from tidewell.sources.sinks import csv_to_parquet, write_by_date_hour, write_table

BY = ["source_file"]
CELLS = [*KEYS, "rate", "burst", "note"]


KIND_SQL = """CASE WHEN {0} IS NULL THEN 'null' WHEN isnan({0}) THEN 'nan' WHEN {0} = 'Infinity' THEN '+inf'
           WHEN {0} = '-Infinity' THEN '-inf' ELSE 'finite' END"""


def kind_of(cell):
    return (
        F.when(cell.isNull(), F.lit("null"))
        .when(F.isnan(cell), F.lit("nan"))
        .when(cell == float("inf"), F.lit("+inf"))
        .when(cell == float("-inf"), F.lit("-inf"))
        .otherwise(F.lit("finite"))
    )


def finite(cell):
    return F.when(kind_of(cell) == "finite", cell)


@query(
    "csv_roundtrip",
    f"""WITH {DIRTY_SQL} SELECT * EXCLUDE (rate, burst, l_shipdate), CAST(l_shipdate AS VARCHAR) AS shipped,
      CASE WHEN isfinite(rate) THEN rate END AS rate, {KIND_SQL.format("rate")} AS rate_kind,
      CASE WHEN isfinite(burst) THEN burst END AS burst, {KIND_SQL.format("burst")} AS burst_kind FROM dirty""",
)
def csv_roundtrip(spark, sf_dir):
    """All columns of the dirty table survive the way through CSV: infinities, NaN, NULL and times too."""
    dirty = dirty_lineitem(spark, sf_dir)
    path = scratch_path(spark, "csv")
    write_table(dirty, path, "csv")
    back = read_csv(spark, path, dirty.schema)
    return back.select(
        *[c for c in back.columns if c not in ("rate", "burst", "l_shipdate")],
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
        finite(F.col("rate")).alias("rate"),
        kind_of(F.col("rate")).alias("rate_kind"),
        finite(F.col("burst")).alias("burst"),
        kind_of(F.col("burst")).alias("burst_kind"),
    )


SPELLED = {
    "+inf": ["inf", "Inf", "+INF", "Infinity", "INFINITY"],
    "-inf": ["-inf", "-Infinity", "-INF"],
    "nan": ["nan", "NaN", "-nan"],
    "null": ["", "NA", "N/A", "null", "NULL", "None", "#N/A", "<NA>"],
    "1500": ["1.5e3", "1500", "+1500.0"],
}
SPELLINGS = [(text, kind) for kind, texts in SPELLED.items() for text in texts]
ROW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
SPELLING_SQL = "[" + ", ".join(f"'{k}'" for _, k in SPELLINGS) + "]"


@query(
    "csv_spellings",
    f"""WITH s AS (SELECT {", ".join(ROW_KEYS)}, {SPELLING_SQL}[1 + (l_orderkey * 7 + l_linenumber) % {len(SPELLINGS)}] AS k FROM lineitem)
      SELECT * EXCLUDE k, CASE WHEN k = '1500' THEN 'finite' ELSE k END AS kind,
        CASE WHEN k = '1500' THEN 1500.0::DOUBLE END AS cell FROM s""",
)
def csv_spellings(spark, sf_dir):
    """Every spelling of infinity and of missing cells, one per row of lineitem."""
    rows = table(spark, sf_dir, "lineitem")
    at = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % len(SPELLINGS) + 1
    texts = F.array(*[F.lit(t) for t, _ in SPELLINGS])
    path = scratch_path(spark, "spellings")
    write_table(rows.select(*ROW_KEYS, F.element_at(texts, at.cast("int")).alias("cell")), path, "csv")
    schema = rows.select(*ROW_KEYS, F.lit(0.0).alias("cell")).schema
    back = read_csv(spark, path, schema)
    return back.select(*ROW_KEYS, kind_of(F.col("cell")).alias("kind"), finite(F.col("cell")).alias("cell"))


@query(
    "csv_quoting",
    """SELECT 'documents' AS origin, doc_id AS id, lang AS other, md5(text) AS digest FROM documents
    UNION ALL SELECT 'pages', page_id, url, md5(html) FROM pages""",
)
def csv_quoting(spark, sf_dir):
    """Whole texts and pages through CSV: quotes, commas and line breaks inside cells."""
    parts = []
    for name, key, other, text in (("documents", "doc_id", "lang", "text"), ("pages", "page_id", "url", "html")):
        rows = table(spark, sf_dir, name)
        path = scratch_path(spark, "quoted")
        write_table(rows, path, "csv")
        back = read_csv(spark, path, rows.schema, missing_text=False, multi_line=True)
        parts.append(
            back.select(F.lit(name).alias("origin"), F.col(key).alias("id"), F.col(other).alias("other"), F.md5(text).alias("digest"))
        )
    return parts[0].unionAll(parts[1])


@query("parquet_projection", "SELECT l_orderkey, l_quantity, l_returnflag, 'lineitem.parquet' AS source_file FROM lineitem")
def projection(spark, sf_dir):
    """Two features and the target; the scan reads three columns."""
    return read_parquet_files(spark, [f"{sf_dir}/lineitem.parquet"], ["l_orderkey", "l_quantity", "l_returnflag"])


@query(
    "union_files",
    """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment, NULL::BIGINT AS suppkey FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, s_suppkey FROM supplier""",
)
def outer_union(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nationkey", "c_acctbal AS acctbal", "c_mktsegment AS mktsegment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS acctbal", "s_name AS name", "s_nationkey AS nationkey", "s_suppkey AS suppkey"
    )
    return union_files([customers, suppliers])


@query(
    "convert_stats",
    """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity, CAST(max(l_shipdate) AS VARCHAR) AS latest,
      (SELECT count(*) FROM lineitem) AS reported, TRUE AS files_match, TRUE AS smaller
    FROM lineitem GROUP BY l_returnflag""",
)
def convert(spark, sf_dir):
    """CSV files to Parquet: converted content next to the report, whose rows per file are counted again."""
    rows = table(spark, sf_dir, "lineitem")
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "converted")
    write_table(rows.repartition(4, "l_orderkey"), source, "csv")
    report = csv_to_parquet(spark, source, target, rows.schema)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    lines = spark.read.option("pathGlobFilter", "*.csv").text(source).groupBy(name.alias("name")).count()
    compared = report.join(lines, F.col("name") == F.col("source_file"), "left").agg(
        F.max(F.when(F.col("source_file").isNull(), F.col("rows"))).alias("reported"),
        F.every(F.col("source_file").isNull() | (F.col("rows") == F.col("count") - 1)).alias("files_match"),
        F.every(F.col("parquet_bytes") < F.col("csv_bytes")).alias("smaller"),
    )
    content = spark.read.parquet(target).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("quantity"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("latest"),
    )
    return attach(content, settle(compared), [])


@query(
    "header_consistency",
    """SELECT 11 AS n_columns, '' AS missing_columns, '' AS extra_columns, TRUE AS consistent FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 11, 'l_tax', 'tax', FALSE FROM lineitem HAVING count(*) > 0""",
)
def headers(spark, sf_dir):
    """Two layouts of the same table side by side; one row per distinct finding."""
    rows = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "layouts")
    write_table(rows, f"{path}/batch=1", "csv")
    write_table(rows.withColumnRenamed("l_tax", "tax"), f"{path}/batch=2", "csv")
    found = header_consistency(spark, path)
    return found.select(
        "n_columns",
        F.array_join("missing_columns", ",").alias("missing_columns"),
        F.array_join("extra_columns", ",").alias("extra_columns"),
        "consistent",
    ).distinct()


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@query(
    "file_validation",
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file, count(*) AS \"rows\", count(*) > 0 AS valid FROM {t}" for t in TABLES
    ),
)
def validation(spark, sf_dir):
    return validate_parquet(spark, sf_dir).select("file", "rows", "valid")


@query(
    "partition_validation",
    """SELECT l_returnflag || '/' || l_linestatus AS place, count(*) AS "rows", TRUE AS valid
    FROM lineitem GROUP BY ALL""",
)
def partition_validation(spark, sf_dir):
    """Partition folders that hold files of the same names, each file counted on its own."""
    path = scratch_path(spark, "partitioned")
    rows = table(spark, sf_dir, "lineitem").repartition(3, "l_orderkey")
    write_table(rows, path, "parquet", partition_by=["l_returnflag", "l_linestatus"])
    place = F.regexp_replace("file", "l_returnflag=([^/]+)/l_linestatus=([^/]+)/.*", "$1/$2")
    found = validate_parquet(spark, path).groupBy(place.alias("place"))
    return found.agg(F.sum("rows").alias("rows"), F.every("valid").alias("valid"))


@query(
    "partitioned_layout",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(hour(ts) AS INT) AS hour, count(*) AS n,
      round(sum(value), 4) AS total FROM events WHERE hour(ts) >= 12 GROUP BY ALL""",
)
def layout(spark, sf_dir):
    """Events laid out by date and hour; the filter prunes partitions."""
    path = scratch_path(spark, "by-hour")
    write_by_date_hour(table(spark, sf_dir, "events"), path, "ts")
    stored = spark.read.parquet(path).filter(F.col("hour") >= 12)
    return stored.groupBy(F.col("date").cast("string").alias("day"), "hour").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "clean_table",
    MAX_SQL
    + f""" SELECT {KEY_SQL}, rate, burst, note FROM fixed
    WHERE rate IS NOT NULL AND NOT isnan(rate) AND note IS NOT NULL""",
)
def cleaned(spark, sf_dir):
    """Infinity to the file's maximum, then rows with a gap dropped, off one profile pass."""
    return clean_table(dirty_lineitem(spark, sf_dir), BY).frame.select(*CELLS)


STATS_SQL = f"""WITH {DIRTY_SQL},
stats AS (SELECT source_file, count(*) AS original_rows,
    count(*) FILTER (WHERE NOT (rate IS NULL OR isnan(rate) OR note IS NULL)) AS final_rows,
    count(*) FILTER (WHERE rate IS NULL OR isnan(rate) OR note IS NULL) AS rows_dropped_nan,
    count(*) FILTER (WHERE isinf(rate)) + count(*) FILTER (WHERE isinf(burst)) AS infinity_values,
    count(*) FILTER (WHERE rate IS NULL OR isnan(rate)) + count(*) FILTER (WHERE note IS NULL) AS missing_values
  FROM dirty GROUP BY ROLLUP (source_file))"""


@query(
    "clean_table_report",
    STATS_SQL
    + """ SELECT source_file, CASE WHEN source_file IS NULL THEN 3 ELSE 1 END AS files, original_rows, final_rows,
      original_rows - final_rows AS total_rows_dropped, infinity_values, missing_values, 0::BIGINT AS rows_dropped_inf,
      rows_dropped_nan, 0::BIGINT AS duplicate_count, 0 AS columns_renamed, 17 AS total_columns, TRUE AS no_infinity,
      TRUE AS no_missing, TRUE AS schema_valid, TRUE AS data_types_valid, TRUE AS validation_passed FROM stats""",
)
def report(spark, sf_dir):
    """Cleaning statistics and checks per source file and overall."""
    dirty = dirty_lineitem(spark, sf_dir)
    result = clean_table(dirty, BY)
    expected = [c for c in dirty.columns if c not in BY]
    return run_report(result.stats, validate_all(result.frame, BY, expected), "source_file")


@query(
    "etl_run",
    STATS_SQL
    + """ SELECT original_rows, final_rows, infinity_values, missing_values, rows_dropped_nan, 17 AS columns_renamed,
      0::BIGINT AS unparsed_cells, 0::BIGINT AS malformed_records, TRUE AS validation_passed, 'success' AS status
      FROM stats WHERE source_file IS NULL""",
)
def etl_run(spark, sf_dir):
    """The whole job, all columns, from CSV files with untidy headers to cleaned Parquet and a stored report."""
    dirty = dirty_lineitem(spark, sf_dir).drop("source_file")
    source = scratch_path(spark, "raw")
    write_table(dirty.toDF(*[f" {c.replace('_', ' ')}" for c in dirty.columns]), source, "csv")
    result = run_etl(
        spark, source, scratch_path(spark, "clean"), dirty.schema, report_path=scratch_path(spark, "report"), infinity="max"
    )
    return result.filter(F.col("source_file").isNull()).select(
        "original_rows", "final_rows", "infinity_values", "missing_values", "rows_dropped_nan", "columns_renamed",
        "unparsed_cells", "malformed_records", "validation_passed", "status",
    )


@query(
    "etl_incremental",
    STATS_SQL
    + """ SELECT source_file, original_rows, final_rows, infinity_values, missing_values, source_file = 'R' AS read_last
      FROM stats WHERE source_file IS NOT NULL""",
)
def etl_incremental(spark, sf_dir):
    """Files of one flag are added to cleaned files of the others: what the table then holds, and which files the last run read."""
    dirty = dirty_lineitem(spark, sf_dir)
    source, target, state = (scratch_path(spark, tag) for tag in ("raw", "clean", "state"))
    schema = dirty.drop("source_file").schema
    late = F.col("source_file") == "R"
    one = dirty.repartitionByRange(1, "source_file")
    write_table(one.filter(~late), source, "csv", partition_by=["source_file"])
    run_incremental(spark, source, target, state, schema)
    write_table(one.filter(late), source, "csv", partition_by=["source_file"], mode="append")
    last = run_incremental(spark, source, target, state, schema)
    flag = F.regexp_extract("source_file", "source_file=(.)", 1).alias("source_file")
    known = last.known.groupBy(flag, F.col("source_file").alias("file")).agg(
        F.max("rows").alias("original_rows"), F.sum("n_inf").alias("infinity_values"), F.sum("n_missing").alias("missing_values")
    )
    written = spark.read.parquet(target).groupBy(flag).agg(F.count("*").alias("final_rows"))
    read = last.read.select(flag).distinct().withColumn("read_last", F.lit(True))
    rows = known.drop("file").join(written, "source_file").join(read, "source_file", "left")
    return rows.withColumn("read_last", F.coalesce("read_last", F.lit(False)))


FILE_ROWS = 500_000  # rows of a compressed file


@query(
    "etl_failed_file",
    """SELECT count(*) AS rows_written, sum(l_quantity) AS quantity, 'failed' AS overall, 'failed' AS cut_status,
      0::BIGINT AS cut_rows, 0 AS cut_written FROM lineitem""",
)
def etl_failed_file(spark, sf_dir):
    """A compressed file cut at half its bytes is reported as failed and none of its rows is written.

    A compressed file is one task's work, so a larger table makes more of them, three at least.
    """
    rows = table(spark, sf_dir, "lineitem")
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    files = max(3, -(-rows.count() // FILE_ROWS))
    fast = {"zlib.compress.level": "BEST_SPEED"}
    write_table(rows.repartition(files, "l_orderkey"), source, "csv", compression="gzip", **fast)
    store, place = locate(list_files(spark, source, "*.csv.gz")[0])
    folder = place.rpartition("/")[0]
    with store.open_input_file(place) as whole, store.open_output_stream(f"{folder}/zz-cut.csv.gz", compression=None) as cut:
        cut.write(whole.read(whole.size() // 2))
    report = run_etl(spark, source, target, rows.schema, infinity="max", pattern="*.csv.gz")
    cut = F.col("source_file") == "zz-cut.csv.gz"
    told = report.agg(
        F.max(F.when(F.col("source_file").isNull(), F.col("status"))).alias("overall"),
        F.max(F.when(cut, F.col("status"))).alias("cut_status"),
        F.max(F.when(cut, F.col("original_rows"))).alias("cut_rows"),
    )
    written = spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.sum("l_quantity").alias("quantity"),
        F.count_if(cut).cast("int").alias("cut_written"),
    )
    return attach(written, settle(told), [])
