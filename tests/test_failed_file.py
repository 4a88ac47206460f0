from pyspark.sql import functions as F

import tidewell.registry.formats as formats
from tidewell.session import scratch_path
from tidewell.sources.files import _path_within_like, list_files, path_within


def test_a_larger_table_makes_more_compressed_files(spark, sf_dir, monkeypatch):
    paths = {}

    def noted(spark, tag):
        return paths.setdefault(tag, scratch_path(spark, tag))

    monkeypatch.setattr(formats, "scratch_path", noted)
    monkeypatch.setattr(formats, "FILE_ROWS", 1000)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n, quantity = rows.agg(F.count("*"), F.sum("l_quantity")).first()
    got = formats.etl_failed_file(spark, sf_dir).first()
    assert (got.rows_written, got.quantity, got.overall, got.cut_status, got.cut_rows, got.cut_written) == (n, quantity, "failed", "failed", 0, 0)
    assert len(list_files(spark, paths["raw"], "part-*.csv.gz")) == -(-n // 1000)


def test_paths_below_a_folder(spark):
    paths = ["file:///a/b c/x.csv", "file:/a/b c/x.csv", "file:///a/b c/d/x.csv", "file:///a/b c.csv", "file:///z/a/b c/x.csv", "/a/b c/x.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for folder in ("/a/b c", "file:/a/b c/", "file:///a", "/nowhere"):
        for known in [*paths, None, ""]:
            got = df.select(_path_within_like(F.col("p"), folder, known).alias("q"), path_within(F.col("p"), folder).alias("w"))
            assert got.filter("q <> w or q is null").isEmpty()
