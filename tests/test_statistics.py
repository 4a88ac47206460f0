import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.correlation import correlated_columns, correlation_matrix
from tidewell.operators.quality import duplicate_counts, quality_report, schema_diff, type_check, validate_all
from tidewell.operators.quantiles import quantiles
from tidewell.operators.running import running_totals
from tidewell.operators.sampling import sample_exact
from tidewell.operators.scaling import fit_scaler
from tidewell.operators.statistics import class_distribution, describe, low_variance, variances

NAN, INF = math.nan, math.inf


@pytest.fixture(scope="module")
def skewed():
    """One group with most rows; long runs of one value, heavy tails, few distinct values."""
    rng = np.random.default_rng(3)
    n = 6000
    group = np.where(np.arange(n) < 4500, "hot", np.where(np.arange(n) < 5990, "mid", "tiny"))
    tail = np.exp(rng.normal(size=n) * 6)
    runs = np.where(rng.random(n) < 0.49, 7.0, rng.normal(size=n))
    few = rng.integers(0, 3, size=n).astype(float)
    few[rng.random(n) < 0.1] = np.nan
    return pd.DataFrame({"g": group, "tail": tail, "runs": runs, "few": few})


@pytest.mark.parametrize("settle_at", [20, 700, 200_000])
def test_exact_quantiles(spark, skewed, settle_at):
    probs = [0.0, 0.25, 0.5, 0.505, 0.75, 0.99, 1.0]
    df = spark.createDataFrame(skewed)
    got = quantiles(df, ["tail", "runs", "few"], probs, ["g"], settle_at=settle_at).collect()
    assert len(got) == 3 * 3 * len(probs)
    for r in got:
        want = skewed[skewed["g"] == r["g"]][r["column"]].quantile(r["probability"])
        assert r["value"] == pytest.approx(want, rel=1e-12, abs=1e-300), r


def test_quantiles_of_one_run(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4990, 3.0).otherwise(F.col("id").cast("double")).alias("x"))
    got = {r["probability"]: r["value"] for r in quantiles(df, ["x"], [0.5, 1.0], settle_at=50).collect()}
    assert got == {0.5: 3.0, 1.0: 4999.0}


def test_approximate_quantiles(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = quantiles(df, ["tail"], [0.5], exact=False).first()["value"]
    assert got == pytest.approx(skewed["tail"].median(), rel=0.05)


def test_correlation_equals_pandas(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd"))
    pdf["e"] = pdf["a"] * 3 + 1e6
    pdf["f"] = 2.5
    pdf.loc[rng.random(500) < 0.3, "b"] = np.nan
    pdf.loc[rng.random(500) < 0.3, "c"] = np.nan
    want = pdf.corr()
    for r in correlation_matrix(spark.createDataFrame(pdf).repartition(5)).collect():
        w = want.loc[r["column_i"], r["column_j"]]
        if np.isnan(w):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(w, abs=1e-9)


def test_correlated_columns_are_not_greedy(spark):
    x = np.linspace(0, 1, 50)
    pdf = pd.DataFrame({"a": x, "b": 2 * x, "c": -x, "d": np.sin(20 * x), "e": 1.0})
    got = {r["column"] for r in correlated_columns(spark.createDataFrame(pdf)).collect()}
    assert got == {"b", "c"}


def test_variance_is_population(spark):
    df = spark.createDataFrame([(1.0, 5, 0.1), (3.0, 5, 0.1), (NAN, 5, 0.1)], "a double, b long, c double")
    got = {r["column"]: r["variance"] for r in variances(df).collect()}
    assert got["a"] == 1.0 and got["b"] == 0.0
    assert {r["column"] for r in low_variance(df).collect()} == {"b", "c"}


def test_describe(spark, skewed):
    got = {r["column"]: r for r in describe(spark.createDataFrame(skewed)).collect()}
    want = skewed.describe()
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "25%": "q25", "50%": "q50", "75%": "q75", "max": "max"}
    for c in ("tail", "runs", "few"):
        for theirs, ours in names.items():
            assert got[c][ours] == pytest.approx(want.loc[theirs, c], rel=1e-9)


def test_class_distribution(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("y",)], "label string")
    assert [tuple(r) for r in class_distribution(df, "label").collect()] == [("x", 3, 75.0), ("y", 1, 25.0)]


@pytest.mark.parametrize("small", [0, 10**6])
def test_running_totals(spark, small):
    pdf = pd.DataFrame({"g": ["a"] * 70 + ["b"] * 5, "o": list(range(70)) + list(range(5)), "v": range(75)})
    df = spark.createDataFrame(pdf).repartition(6)
    got = running_totals(df, ["v"], ["o"], ["g"], small=small, bucket_rows=4).toPandas().sort_values(["g", "o"])
    want = pdf.groupby("g")["v"].cumsum() - pdf["v"]
    assert got["v_before"].tolist() == want.tolist()


def test_sample_exact(spark):
    df = spark.range(5000)
    first = sorted(r[0] for r in sample_exact(df, 700, ["id"]).collect())
    again = sorted(r[0] for r in sample_exact(df.repartition(7), 700, ["id"]).collect())
    assert first == again and len(set(first)) == 700
    other = {r[0] for r in sample_exact(df, 700, ["id"], seed=1).collect()}
    assert other != set(first)
    assert sample_exact(df, 9000, ["id"]).count() == 5000


def test_sample_exact_of_equal_rows(spark):
    df = spark.range(1000).select(F.lit(1).alias("x"))
    assert sample_exact(df, 130).count() == 130


def test_scalers(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (NAN, 5.0)], "x double, c double")
    test = spark.createDataFrame([(8.0, 7.0)], "x double, c double")
    x = np.array([1.0, 2.0, 4.0])
    got = fit_scaler(train, ["x", "c"], "standard").transform(test).first()
    assert got["x"] == pytest.approx((8 - x.mean()) / x.std()) and got["c"] == 2.0
    got = fit_scaler(train, ["x", "c"], "minmax").transform(test).first()
    assert got["x"] == pytest.approx(7 / 3) and got["c"] == 2.0
    assert fit_scaler(train, ["c"], "minmax").transform(train).first()["c"] == 0.0
    got = fit_scaler(train, ["x", "c"], "robust").transform(test).first()
    assert got["x"] == pytest.approx((8 - 2) / (3 - 1.5)) and got["c"] == 2.0
    assert fit_scaler(train, ["x"], "other").method == "standard"


@pytest.fixture
def copies(spark):
    rows = [("a", 1.0, None), ("a", 1.0, None), ("a", NAN, "s"), ("a", NAN, "s"), ("a", 0.0, "s"), ("a", -0.0, "s"), ("b", INF, "s")]
    return spark.createDataFrame(rows, "f string, x double, s string")


@pytest.mark.parametrize("method", ["rows", "fingerprint"])
def test_duplicates(spark, copies, method):
    got = {r["f"]: r["duplicate_rows"] for r in duplicate_counts(copies, ["f"], method).collect()}
    assert got == {"a": 3, "b": 0}
    shifted = spark.createDataFrame([("a", None, "p"), ("a", "p", None)], "f string, s string, t string")
    assert duplicate_counts(shifted, ["f"], method).first()["duplicate_rows"] == 0


def test_quality_report(copies):
    got = {r["f"]: r for r in quality_report(copies, ["f"]).collect()}
    a, b = got["a"], got["b"]
    assert (a["total_rows"], a["missing_values"], a["duplicate_rows"], a["issues_count"]) == (6, 4, 3, 2)
    assert (b["infinity_values"], b["issues_count"], b["quality_score"]) == (1, 1, "FAIL")
    assert a["columns"] == ["x", "s"] and a["total_columns"] == 2


def test_validate_all(copies):
    got = {r["f"]: r for r in validate_all(copies, ["f"], ["s", "x"]).collect()}
    assert got["a"]["no_infinity"] and not got["a"]["no_missing"] and got["a"]["schema_valid"]
    assert not got["b"]["no_infinity"] and not got["b"]["validation_passed"]
    clean = validate_all(copies.filter("s is not null and x = 0"), ["f"]).first()
    assert clean["validation_passed"] and clean["duplicate_count"] == 1
    assert not validate_all(copies, ["f"], ["x"]).first()["schema_valid"]
    expected = T.StructType([T.StructField("x", T.LongType())])
    assert not validate_all(copies, ["f"], None, expected).first()["data_types_valid"]


def test_schema_diff():
    diff = schema_diff(["a", "b"], ["b", "c"])
    assert diff.missing == ("c",) and diff.extra == ("a",) and not diff.valid
    assert schema_diff(["b", "a"], ["a", "b"]).valid and schema_diff(["a"], None).valid


def test_type_check(spark):
    df = spark.createDataFrame([("1", "x"), ("z", "y"), (None, "1")], "a string, b string")
    expected = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    got = {r["column"]: (r["matches"], r["n_bad"]) for r in type_check(df, expected).collect()}
    assert got == {"a": (False, 1), "b": (True, 0)}


def test_duplicates_stay_exact_when_all_hashes_clash(spark, monkeypatch):
    from tidewell.operators import quality

    rows = [("a", 1.0, "x"), ("a", 1.0, "x"), ("a", 2.0, None), ("b", float("nan"), "x"), ("b", float("nan"), "x"), ("b", 0.0, "y"), ("b", -0.0, "y"), (None, 1.0, "z")]
    df = spark.createDataFrame(rows, "s string, v double, t string")
    want = {"a": (3, 1, 1), "b": (4, 2, 2), None: (1, 0, 0)}
    for clash in (False, True):
        if clash:
            monkeypatch.setattr(quality, "row_hashes", lambda df: (F.lit(1).cast("long"), F.lit(2).cast("long")))
        got = {r.s: (r.total_rows, r.missing_values, r.duplicate_rows) for r in quality.checked_rows(df, ["s"]).collect()}
        assert got == want
        whole = quality.checked_rows(df.drop("s"), []).first()
        assert (whole.total_rows, whole.duplicate_rows) == (8, 3)


def test_profile_of_keys_with_nulls_and_no_rows(spark):
    from tidewell.operators.profile import profile_cells

    rows = [("a", 1, 1.0), (None, 1, float("inf")), (None, 1, None), ("a", 2, 3.0), ("a", 1, float("nan"))]
    df = spark.createDataFrame(rows, "s string, k int, v double")
    got = {(r.s, r.k, r.column): tuple(r)[3:] for r in profile_cells(df, ["s", "k"]).collect()}
    assert got[("a", 1, "v")] == (2, 0, 1, 1.0, 1.0, 1.0)
    assert got[(None, 1, "v")] == (2, 1, 1, None, None, None)
    assert got[(None, 1, "*dirty")][2] == 2 and got[(None, 1, "*missing")][2] == 1
    assert profile_cells(df.filter("k > 5"), ["s"]).count() == 0
