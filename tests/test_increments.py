import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewell.operators.models import held_back, load_newest, rounds_used, save_version, time_folds, train_binary, train_forest, versions
from tidewell.plans.etl import run_etl, run_incremental
from tidewell.session import scratch_path
from tidewell.sources.files import read_csv
from tidewell.streaming.windows import bursts

SCHEMA = "a double, b double, note string"


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as file:
        file.write("\n".join(["a,b,note", *lines]) + "\n")


def content(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("source_file", "a", "b", "note").collect()), key=repr)


def test_new_changed_and_failed_files(spark, tmp_path):
    raw, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    put(raw, "one", ["1,2,x", "inf,3,y", "4,,z"])
    put(raw, "two", ["5,6,x", "5,6,x"])
    first = run_incremental(spark, raw, out, state, schema)
    assert sorted(r.source_file for r in first.read.collect()) == ["one.csv", "two.csv"]
    again = run_incremental(spark, raw, out, state, schema)
    assert again.report is None and again.read.count() == 0
    put(raw, "two", ["7,-Inf,x", "8,9,x", "9,NA,q"])
    put(raw, "three", [])
    put(raw, "four", ["1,oops,x", "2,3"])
    with open(f"{raw}/five.csv", "wb") as file:
        file.write(b"a,b,note\xff\xfe\n1,2,x\n")
    last = run_incremental(spark, raw, out, state, schema)
    assert sorted(r.source_file for r in last.read.collect()) == ["five.csv", "four.csv", "three.csv", "two.csv"]
    status = {r.source_file: r.status for r in last.report.collect()}
    assert status["five.csv"] == "failed" and status["three.csv"] == "empty" and status[None] == "failed"
    whole = str(tmp_path / "whole")
    run_etl(spark, raw, whole, schema)
    assert content(spark, out) == content(spark, whole)
    known = {(r.source_file, r.column): r for r in last.known.collect()}
    assert known["one.csv", "a"].n_inf == 1 and known["two.csv", "b"].n_missing == 1 and known["two.csv", "a"].finite_max == 9.0
    assert ("five.csv", "a") not in known
    assert sorted(r.source_file for r in run_incremental(spark, raw, out, state, schema).read.collect()) == ["five.csv"]


def test_second_tier_of_the_csv_reader(spark, tmp_path):
    put(str(tmp_path / "raw"), "x", ['1.5, Infinity ,"quoted, ""text"""', "NULL,-nan,#N/A", ' "+inf",-iNf,plain', "1e3,1.#IND,", "two,3,odd"])
    got = [tuple(r) for r in read_csv(spark, str(tmp_path / "raw"), spark.createDataFrame([], SCHEMA).schema).collect()]
    inf = float("inf")
    assert got[0] == (1.5, inf, 'quoted, "text"') and got[2] == (inf, -inf, "plain") and got[3] == (1000.0, None, None)
    assert got[1][0] is None and got[1][1] != got[1][1] and got[1][2] is None and got[4] == (None, 3.0, "odd")


def frame(spark, n=400):
    at = dt.datetime(2024, 1, 1)
    rows = [(i, at + dt.timedelta(hours=i), float(i % 7), float((i * 31) % 11), int(i % 7 > 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, at timestamp, p double, q double, y int")


def test_rounds_end_and_folds_follow_time(spark):
    df = frame(spark).withColumn("held", held_back(["id"], 0.3))
    assert 0.2 < df.filter("held").count() / 400 < 0.4
    noise = df.withColumn("y", (F.pmod(F.xxhash64("id"), F.lit(2))).cast("int"))
    limits = {"maxIter": 12, "maxDepth": 3, "stepSize": 0.5}
    assert rounds_used(train_binary(noise, ["p", "q"], "y", validation="held", **limits)) < 12
    for before, after in time_folds(df, "at", 3):
        assert df.filter(before).agg(F.max("at")).first()[0] < df.filter(after).agg(F.min("at")).first()[0]
        assert abs(df.filter(after).count() - 100) < 5


def test_versions_and_what_they_refuse(spark):
    folder = scratch_path(spark, "versions")
    df = frame(spark, 60)
    model = train_forest(df, ["p", "q"], "y", numTrees=2, maxDepth=2)
    names = [save_version(model, folder, df.schema, {"n": i}, {"auc": 0.5}) for i in range(2)]
    assert [r.version for r in versions(spark, folder).collect()] == names[::-1]
    loaded, manifest = load_newest(folder, df.schema)
    assert manifest["params"] == {"n": 1} and manifest["metrics"] == {"auc": 0.5} and manifest["features"] == ["p", "q"]
    with pytest.raises(ValueError, match="q"):
        load_newest(folder, df.drop("q").schema)


def test_bursts_of_a_table(spark):
    at = dt.datetime(2024, 1, 1)
    minutes = {"a": [0, 5, 9, 30, 31], "b": [0], None: [3, 4]}
    rows = [(k, at + dt.timedelta(minutes=m)) for k, ms in minutes.items() for m in ms] + [("a", None)]
    found = bursts(spark.createDataFrame(rows, "k string, at timestamp"), "k", "at", "10 minutes", 2)
    got = sorted(((r.k, int((r.first_at - at).seconds / 60), r.events) for r in found.collect()), key=repr)
    assert got == sorted([("a", 0, 3), ("a", 30, 2), (None, 3, 2)], key=repr)
