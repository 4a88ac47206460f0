import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidewell.sources.files as files
from tidewell.plans.etl import run_etl
from tidewell.sources.broker import publish, read_topic
from tidewell.sources.files import (
    all_valid,
    csv_headers,
    file_sizes,
    header_consistency,
    list_files,
    read_csv,
    read_csv_folder,
    read_parquet_files,
    union_files,
    validate_parquet,
)
from tidewell.sources.sinks import csv_to_parquet, write_by_date_hour, write_table

FILES = {
    "mon.csv": " Flow Bytes/s, Label\nInfinity,BENIGN\n2.5,BENIGN\nNaN,DoS\n4.0,BENIGN\n4.0,BENIGN\n",
    "tue.csv": " Flow Bytes/s, Label\n-Infinity,DoS\n,DoS\n",
    "wed.csv": " Flow Bytes/s, Label\n1.0,\n3.0,x\n",
}
SCHEMA = T.StructType([T.StructField("Flow_Bytes/s", T.DoubleType()), T.StructField("Label", T.StringType())])


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text)
    (folder / "notes.txt").write_text("skip me\n")
    return str(folder)


def test_read_csv(spark, raw):
    df = read_csv(spark, f"{raw}/mon.csv")
    assert dict(df.dtypes)["Flow Bytes/s" if "Flow Bytes/s" in df.columns else " Flow Bytes/s"] == "double"
    assert df.count() == 5
    with pytest.raises(FileNotFoundError):
        read_csv(spark, f"{raw}/none.csv")


def test_list_and_headers(spark, raw):
    assert [os.path.basename(p) for p in list_files(spark, raw, "*.csv")] == ["mon.csv", "tue.csv", "wed.csv"]
    assert csv_headers(spark, raw).first()["header"] == [" Flow Bytes/s", " Label"]
    with pytest.raises(FileNotFoundError):
        list_files(spark, raw + "/none", "*.csv")


def test_headers_without_arrow_storage(spark, raw, monkeypatch):
    want = {tuple(r["header"]) for r in csv_headers(spark, raw).collect()}

    def refuse(path):
        raise ValueError(path)

    monkeypatch.setattr(files, "locate", refuse)
    got = csv_headers(spark, raw).collect()
    assert {tuple(r["header"]) for r in got} == want and len(got) == 3


def test_header_consistency(spark, raw):
    with open(f"{raw}/thu.csv", "w") as f:
        f.write(' Label,"odd, name"\nx,1\n')
    got = {r["file"]: r for r in header_consistency(spark, raw).collect()}
    assert got["mon.csv"]["consistent"] and got["wed.csv"]["consistent"]
    thu = got["thu.csv"]
    assert (thu["missing_columns"], thu["extra_columns"]) == ([" Flow Bytes/s"], ["odd, name"])


def test_read_folder_matches_columns_by_name(spark, raw):
    with open(f"{raw}/thu.csv", "w") as f:
        f.write("Label,Flow Bytes/s,more\nq,9.5,1\n")
    df = read_csv_folder(spark, raw, SCHEMA, normalize=True)
    assert set(df.columns) == {"Flow_Bytes/s", "Label", "more", "source_file"}
    row = df.filter("source_file = 'thu.csv'").first()
    assert row["Flow_Bytes/s"] == 9.5 and row["Label"] == "q" and row["more"] == "1"
    assert df.groupBy("source_file").count().count() == 4
    assert df.filter("more is null").count() == 9


def test_read_folder_infers(spark, raw):
    df = read_csv_folder(spark, raw, normalize=True)
    assert dict(df.dtypes)["Flow_Bytes/s"] == "double"


def test_etl_end_to_end(spark, raw, tmp_path):
    report = run_etl(spark, raw, str(tmp_path / "out"), SCHEMA, str(tmp_path / "report"))
    rows = {r["source_file"]: r for r in report.collect()}
    mon, tue, wed, total = rows["mon.csv"], rows["tue.csv"], rows["wed.csv"], rows[None]
    assert (mon["original_rows"], mon["final_rows"], mon["infinity_values"], mon["missing_values"]) == (5, 4, 1, 1)
    assert mon["duplicate_count"] == 2 and mon["validation_passed"]  # 4.0 three times: Infinity became 4.0
    assert (tue["final_rows"], tue["rows_dropped_nan"]) == (1, 1)
    assert wed["rows_dropped_nan"] == 1 and wed["columns_renamed"] == 2
    assert (total["original_rows"], total["final_rows"], total["files"]) == (9, 6, 3)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.filter("source_file = 'tue.csv'").first()["Flow_Bytes/s"] == 1e9
    stored = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert {r.get("source_file") for r in stored} == {"mon.csv", "tue.csv", "wed.csv", None}


def test_etl_to_csv_with_header_only_file(spark, raw, tmp_path):
    with open(f"{raw}/thu.csv", "w") as f:
        f.write(" Flow Bytes/s, Label\n")
    report = run_etl(spark, raw, str(tmp_path / "out"), SCHEMA, missing="mean", fmt="csv")
    rows = {r["source_file"]: r for r in report.collect()}
    assert rows["thu.csv"]["status"] == "empty" and rows["mon.csv"]["status"] == "success"
    assert rows["mon.csv"]["final_rows"] == 5
    assert not rows["wed.csv"]["no_missing"]  # a missing label has no mean


def test_csv_to_parquet_and_validation(spark, raw, tmp_path):
    report = csv_to_parquet(spark, raw, str(tmp_path / "pq"))
    rows = {r["source_file"]: r for r in report.collect()}
    assert rows["mon.csv"]["rows"] == 5 and rows[None]["rows"] == 9 and rows[None]["columns"] == 2
    assert rows["mon.csv"]["csv_bytes"] == len(FILES["mon.csv"])
    size = rows["mon.csv"]["parquet_bytes"]
    assert rows["mon.csv"]["reduction_percent"] == pytest.approx((1 - size / len(FILES["mon.csv"])) * 100)
    assert all_valid(validate_parquet(spark, str(tmp_path / "pq")))
    assert file_sizes(spark, raw, "*.csv").count() == 3


def test_invalid_parquet_is_reported(spark, tmp_path):
    folder = str(tmp_path / "pq")
    spark.range(3).coalesce(1).write.parquet(folder)
    spark.range(0).coalesce(1).write.mode("append").parquet(folder)
    (tmp_path / "pq" / "broken.parquet").write_bytes(b"not parquet")
    got = validate_parquet(spark, folder).collect()
    assert sorted(r["valid"] for r in got) == [False, False, True]
    assert not all_valid(validate_parquet(spark, folder))


def test_parquet_files(spark, sf_dir):
    df = read_parquet_files(spark, [f"{sf_dir}/region.parquet"], ["r_name"])
    assert df.columns == ["r_name", "source_file"] and df.first()["source_file"] == "region.parquet"
    with pytest.raises(FileNotFoundError):
        read_parquet_files(spark, [f"{sf_dir}/none.parquet"])


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert [tuple(r) for r in union_files([a, b]).collect()] == [(1, "x", None), (None, "y", 2.0)]


def test_write_table(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "a")], "x double, f string")
    write_table(df, str(tmp_path / "c"), "csv", partition_by=["f"])
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).columns == ["x", "f"]
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "d"), "orc")


def test_date_hour_layout_prunes(spark, tmp_path):
    df = spark.range(48).select((F.lit("2024-01-01 00:30:00").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"))
    write_by_date_hour(df, str(tmp_path / "h"), "at")
    stored = spark.read.parquet(str(tmp_path / "h"))
    assert stored.filter("date = '2024-01-02' and hour = 3").count() == 1
    plan = stored.filter("hour = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan


def test_broker_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "localhost:9092", "flows", "group", max_offsets_per_trigger=10)
    with pytest.raises(Exception, match="(?i)kafka"):
        publish(spark.range(1), "localhost:9092", "flows")


def test_spellings_quotes_and_line_breaks(spark, tmp_path):
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "a.csv").write_text('x,t\n1.0,"say ""hi"", ok"\ninf,NA\n-INF,"two\nlines"\n n/a ,plain\nword,z\n')
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("t", T.StringType())])
    got = [tuple(r) for r in read_csv(spark, str(folder), schema, multi_line=True).collect()]
    assert got == [(1.0, 'say "hi", ok'), (float("inf"), None), (float("-inf"), "two\nlines"), (None, "plain"), (None, "z")]
    rows = read_csv_folder(spark, str(folder), schema, multi_line=True, audit=True, missing_text=False)
    assert [r.unparsed_cells for r in rows.collect()] == [0, 0, 0, 0, 1]
    assert [r.t for r in rows.collect()][1] == "NA"


def test_infinite_spellings_survive_the_job(spark, tmp_path):
    folder = tmp_path / "inf"
    folder.mkdir()
    (folder / "a.csv").write_text("x,Label\n1.0,a\ninf,a\n-inf,a\n2.0,b\n3.0\n")
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("Label", T.StringType())])
    report = run_etl(spark, str(folder), str(tmp_path / "out"), schema).filter("source_file is null").first()
    assert (report.original_rows, report.infinity_values, report.malformed_records, report.status) == (5, 2, 1, "success")
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1.0, 2.0, 3.0, 3.0]


def test_cut_file_is_an_error_or_left_out_whole(spark, tmp_path):
    import gzip

    folder = tmp_path / "cut"
    folder.mkdir()
    lines = "x\n" + "".join(f"{i}.5\n" for i in range(20000))
    (folder / "good.csv.gz").write_bytes(gzip.compress(b"x\n1.0\n2.0\n"))
    (folder / "half.csv.gz").write_bytes(gzip.compress(lines.encode())[: len(lines) // 8])
    schema = T.StructType([T.StructField("x", T.DoubleType())])
    with pytest.raises(OSError, match="half"):
        read_csv_folder(spark, str(folder), schema, "*.csv.gz")
    left = read_csv_folder(spark, str(folder), schema, "*.csv.gz", skip_bad_files=True)
    assert sorted(r.x for r in left.collect()) == [1.0, 2.0]


def test_validation_decodes_pages_and_keeps_paths_apart(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet as pq

    for part, n in (("a", 1000), ("b", 500)):
        (tmp_path / "t" / f"k={part}").mkdir(parents=True)
        pq.write_table(pa.table({"x": list(range(n)), "y": [str(i) for i in range(n)]}), tmp_path / "t" / f"k={part}" / "same.parquet")
    got = {r.file: (r.rows, r.valid) for r in validate_parquet(spark, str(tmp_path / "t")).collect()}
    assert got == {"k=a/same.parquet": (1000, True), "k=b/same.parquet": (500, True)}
    broken = tmp_path / "t" / "k=a" / "same.parquet"
    data = bytearray(broken.read_bytes())
    tail = int.from_bytes(data[-8:-4], "little") + 8
    data[4 : len(data) - tail] = bytes(len(data) - tail - 4)
    broken.write_bytes(bytes(data))
    got = {r.file: r.valid for r in validate_parquet(spark, str(tmp_path / "t")).collect()}
    assert got == {"k=a/same.parquet": False, "k=b/same.parquet": True}
    quick = {r.file: r.rows for r in files.parquet_row_counts(spark, str(tmp_path / "t")).collect()}
    assert quick == {"k=a/same.parquet": 1000, "k=b/same.parquet": 500}
