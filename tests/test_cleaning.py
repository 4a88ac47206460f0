import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.functions.cells import numeric_columns
from tidewell.operators.fill import forward_fill
from tidewell.operators.infinity import count_infinite, replace_infinite
from tidewell.operators.missing import count_missing, drop_missing, drop_sparse_columns, fill_missing
from tidewell.operators.profile import profile
from tidewell.plans.etl import clean_table

INF, NAN = math.inf, math.nan
EDGE = [1.0, NAN, INF, None, -INF, 0.0, -0.0]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def edge(spark):
    rows = [("a", i, v, "s") for i, v in enumerate(EDGE)] + [("b", 0, INF, None), ("b", 1, -INF, "t")]
    return frame(spark, rows, "f string, i int, x double, s string")


def values(df, column="x", order=("f", "i")):
    return [r[column] for r in df.orderBy(*order).select(column).collect()]


def test_profile_counts(edge):
    cells = {(r["f"], r["column"]): r for r in profile(edge, ["f"]).cells.collect()}
    x = cells["a", "x"]
    assert (x["rows"], x["n_inf"], x["n_missing"], x["finite_max"], x["finite_min"]) == (7, 2, 2, 1.0, 0.0)
    assert cells["b", "x"]["finite_max"] is None
    assert cells["b", "s"]["n_missing"] == 1
    assert cells["a", "*missing"]["n_missing"] == 2
    assert cells["a", "*dirty"]["n_missing"] == 4


def test_counts(edge):
    assert {r["f"]: r["n_inf"] for r in count_infinite(edge, ["f"]).collect()} == {"a": 2, "b": 2}
    assert {r["f"]: r["n_missing"] for r in count_missing(edge, ["f"]).collect()} == {"a": 2, "b": 1}


def test_max_per_group_with_fallback(edge):
    out = values(replace_infinite(edge, ["f"]))
    assert out[2] == out[4] == 1.0
    assert out[3] is None and math.isnan(out[1])
    assert out[7:] == [1e9, 1e9]


def test_max_signed(edge):
    out = values(replace_infinite(edge, ["f"], signed=True))
    assert out[2] == 1.0 and out[4] == 0.0


def test_max_over_split_without_fallback(spark, edge):
    assert values(replace_infinite(edge, (), fallback=None))[7:] == [1.0, 1.0]
    only = frame(spark, [(INF,), (NAN,)], "x double")
    assert [r[0] for r in replace_infinite(only, (), fallback=None).collect()][0] is None


def test_fit_on_train_apply_to_test(spark, edge):
    train = frame(spark, [("a", 0, 5.0, "s"), ("a", 1, 3.0, "s")], edge.schema)
    out = values(replace_infinite(edge, (), fitted=profile(train)))
    assert out[2] == out[4] == 5.0 and out[7] == 5.0


def test_drop_touches_only_groups_with_infinity(spark):
    rows = [("a", 0, INF), ("a", 1, NAN), ("a", 2, 1.0), ("b", 0, NAN), ("b", 1, 2.0)]
    df = frame(spark, rows, "f string, i int, x double")
    kept = replace_infinite(df, ["f"], "drop").orderBy("f", "i").collect()
    assert [(r["f"], r["i"]) for r in kept] == [("a", 2), ("b", 0), ("b", 1)]
    assert replace_infinite(df.filter("f = 'b'"), (), "drop").count() == 2


def test_null_group_keeps_its_statistics(spark):
    df = frame(spark, [(None, 4.0), (None, INF), ("a", 1.0)], "f string, x double")
    out = replace_infinite(df, ["f"]).filter("f is null").orderBy("x").collect()
    assert [r["x"] for r in out] == [4.0, 4.0]


def test_drop_missing_covers_nan_and_null(edge):
    assert drop_missing(edge).count() == 6


def test_fill_mean_and_median_per_group(spark):
    rows = [("a", 0, 1.0, 1), ("a", 1, None, 2), ("a", 2, 4.0, None), ("a", 3, NAN, 9), ("b", 0, 7.0, 5)]
    df = frame(spark, rows, "f string, i int, x double, n long")
    assert values(fill_missing(df, ["f"], "mean")) == [1.0, 2.5, 4.0, 2.5, 7.0]
    assert values(fill_missing(df, ["f"], "mean"), "n") == [1.0, 2.0, 4.0, 9.0, 5.0]
    assert values(fill_missing(df, ["f"], "median"), "n") == [1.0, 2.0, 2.0, 9.0, 5.0]


def test_fill_all_missing_group_stays_missing(spark):
    df = frame(spark, [("a", 0, None), ("b", 0, 1.0)], "f string, i int, x double")
    assert values(fill_missing(df, ["f"], "median")) == [None, 1.0]


def test_fill_fitted_elsewhere(spark):
    train = frame(spark, [(2.0,), (4.0,)], "x double")
    df = frame(spark, [(None,), (10.0,)], "x double")
    for how in ("mean", "median"):
        assert sorted(r[0] for r in fill_missing(df, (), how, fit_on=train).collect()) == [3.0, 10.0]


def test_sparse_columns(spark):
    df = frame(spark, [(1, None, 1.0), (2, None, NAN), (3, 5, NAN), (4, None, 2.0)], "a int, b int, c double")
    assert drop_sparse_columns(df).columns == ["a", "c"]
    assert drop_sparse_columns(df, 0.49).columns == ["a"]


@pytest.mark.parametrize("bucket", [1, 3, 7, 1000])
def test_forward_fill_equals_pandas(spark, bucket):
    rng = np.random.default_rng(5)
    rows = []
    for group, size in (("a", 40), ("b", 3), ("c", 11), (None, 5)):
        for i in range(size):
            x = None if rng.random() < 0.6 or group == "b" else float(rng.integers(100))
            s = None if rng.random() < 0.5 or i < 2 else f"s{i}"
            rows.append((group, i, NAN if x is None and i % 2 else x, s))
    df = frame(spark, rows, "f string, i int, x double, s string").repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", bucket)
    try:
        got = forward_fill(df, ["f"], ["i"]).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = got.sort_values(["f", "i"], na_position="last").reset_index(drop=True)
    want = pd.DataFrame(rows, columns=["f", "i", "x", "s"]).sort_values(["f", "i"], na_position="last").reset_index(drop=True)
    want[["x", "s"]] = want.groupby("f", dropna=False)[["x", "s"]].ffill()
    assert got["x"].fillna(-1).tolist() == want["x"].fillna(-1).tolist()
    assert got["s"].fillna("-").tolist() == want["s"].fillna("-").tolist()


def pandas_clean(pdf, infinity, missing):
    """The semantics in pandas, for one file."""
    pdf = pdf.copy()
    stats = {"rows_dropped_inf": 0, "rows_dropped_nan": 0, "missing_values": 0}
    numbers = pdf.select_dtypes(include=[np.number]).columns
    stats["infinity_values"] = int(np.isinf(pdf[numbers].to_numpy()).sum())
    if stats["infinity_values"]:
        if infinity == "drop":
            before = len(pdf)
            pdf = pdf.replace([np.inf, -np.inf], np.nan).dropna()
            stats["rows_dropped_inf"] = before - len(pdf)
        elif infinity == "max":
            for c in numbers:
                finite = pdf[c][np.isfinite(pdf[c])]
                pdf[c] = pdf[c].replace([np.inf, -np.inf], finite.max() if len(finite) else 1e9)
        else:
            pdf = pdf.replace([np.inf, -np.inf], 1e9)
    stats["missing_values"] = int(pdf.isna().sum().sum())
    if stats["missing_values"]:
        if missing == "drop":
            before = len(pdf)
            pdf = pdf.dropna()
            stats["rows_dropped_nan"] = before - len(pdf)
        elif missing == "forward_fill":
            pdf = pdf.ffill()
        else:
            pdf[numbers] = pdf[numbers].fillna(getattr(pdf[numbers], missing)())
    return pdf, stats


@pytest.fixture(scope="module")
def messy():
    rng = np.random.default_rng(11)
    parts = []
    for name, size, dirt in (("one", 60, 0.2), ("two", 30, 0.0), ("three", 25, 0.1)):
        x = rng.normal(size=size).round(3)
        y = rng.normal(size=size).round(3)
        draw = rng.random(size)
        x[draw < dirt] = np.inf
        x[(draw > 0.5) & (draw < 0.5 + dirt)] = -np.inf
        y[rng.random(size) < 0.15] = np.nan
        if name == "three":
            y[:] = np.where(np.arange(size) % 2 == 0, np.inf, np.nan)
        s = np.where(rng.random(size) < 0.1, None, "k")
        parts.append(pd.DataFrame({"source_file": name, "i": range(size), "x": x, "y": y, "s": s}))
    return pd.concat(parts, ignore_index=True)


@pytest.mark.parametrize("infinity", ["max", "large_int", "drop"])
@pytest.mark.parametrize("missing", ["drop", "median", "mean", "forward_fill"])
def test_clean_table_equals_pandas(spark, messy, infinity, missing):
    rows = [tuple(None if v is None else v for v in r) for r in messy.itertuples(index=False)]
    df = spark.createDataFrame(rows, "source_file string, i long, x double, y double, s string")
    out = clean_table(df, ["source_file"], infinity, missing, row_order=["i"])
    got = out.frame.toPandas()
    stats = {r["source_file"]: r.asDict() for r in out.stats.collect()}
    for name, part in messy.groupby("source_file"):
        want, expected = pandas_clean(part, infinity, missing)
        mine = got[got["source_file"] == name].sort_values("i")
        assert mine["i"].tolist() == want["i"].tolist()
        for c in ("x", "y"):
            np.testing.assert_allclose(mine[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-12)
        assert mine["s"].fillna("-").tolist() == want["s"].fillna("-").tolist()
        row = stats[name]
        for key, value in expected.items():
            assert row[key] == value, (name, key)
        assert row["original_rows"] == len(part)
        assert row["final_rows"] == len(want)
        assert row["total_rows_dropped"] == len(part) - len(want)


def test_clean_columns_are_not_rewritten(spark):
    df = frame(spark, [("a", 1.0, 2.0)], "f string, x double, y double")
    assert replace_infinite(df, ["f"]) is df
    assert fill_missing(df, ["f"]) is df
    assert numeric_columns(df) == ["x", "y"]


def test_bad_strategies(spark):
    df = frame(spark, [(1.0,)], "x double")
    for call in (lambda: replace_infinite(df, (), "nope"), lambda: fill_missing(df, (), "nope"), lambda: clean_table(df, (), missing="nope")):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError):
        clean_table(df.withColumn("f", F.lit("a")), ["f"], missing="forward_fill")
