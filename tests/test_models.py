import json

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

import tidewell.operators.evaluation as evaluation
from tidewell.operators.balance import class_weights, smote, with_class_weights
from tidewell.operators.evaluation import (
    binary_metrics,
    class_metrics,
    confusion_matrix,
    confusion_wide,
    roc_points,
    score_curve,
)
from tidewell.operators.models import leaderboard, load_model, model_importance, score_binary, train_forest
from tidewell.operators.neighbors import nearest_vectors
from tidewell.plans.feature_selection import clean_split, select_features, top_features, write_reports
from tidewell.plans.training import run_binary, run_multiclass, write_training

RNG = np.random.default_rng(17)


def brute_force(points, k):
    """Sorted distances to the k closest other points, per group."""
    out = {}
    for g, part in points.groupby("g"):
        x = np.stack(part["x"].to_list())
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
        for i in range(len(x)):
            out[g, tuple(x[i])] = np.sort(np.delete(d[i], i))[:k]
    return out


@pytest.mark.parametrize("cell_rows,chunk_rows,dims", [(10_000, 10_000, 3), (40, 64, 2), (25, 10, 8)])
def test_neighbors_equal_brute_force(spark, cell_rows, chunk_rows, dims):
    clumped = np.concatenate([RNG.normal(size=(150, dims)), RNG.normal(size=(150, dims)) * 1e-4 + 9])
    rows = [("big", v.tolist(), 1) for v in clumped] + [("few", v.tolist(), 2) for v in RNG.normal(size=(4, dims))]
    df = spark.createDataFrame(rows, "g string, x array<double>, m bigint").repartition(5)
    got = nearest_vectors(df, df, 5, "g", "x", "m", cell_rows, chunk_rows).collect()
    want = brute_force(pd.DataFrame(rows, columns=["g", "x", "m"]), 5)
    assert len(got) == len(rows)
    for r in got:
        expected = want[r["g"], tuple(r["x"])]
        np.testing.assert_allclose([n["dist"] for n in r["neighbors"]], expected, rtol=1e-9)
        assert all(n["m"] == (1 if r["g"] == "big" else 2) for n in r["neighbors"])


def test_neighbors_of_some_queries(spark):
    rows = [("a", [float(i)], 1) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, x array<double>, m bigint")
    got = nearest_vectors(df, df.filter("x[0] < 3"), 2, "g", "x", "m", 20, 16).collect()
    assert {r["x"][0]: sorted(n["y"][0] for n in r["neighbors"]) for r in got} == {0.0: [1, 2], 1.0: [0, 2], 2.0: [1, 3]}


def test_smote_balances_within_segments(spark):
    pdf = pd.DataFrame({"x": RNG.normal(size=60), "z": RNG.normal(size=60), "c": ["big"] * 40 + ["mid"] * 17 + ["tiny"] * 3})
    out = smote(spark.createDataFrame(pdf), ["x", "z"], "c").toPandas()
    assert out.groupby("c").size().to_dict() == {"big": 40, "mid": 40, "tiny": 40}
    assert (~out["synthetic"]).sum() == 60
    for name in ("mid", "tiny"):
        own = pdf[pdf["c"] == name][["x", "z"]].to_numpy()
        dist = np.sqrt(((own[:, None] - own[None]) ** 2).sum(2))
        k = min(5, len(own) - 1)
        near = np.argsort(dist, axis=1)[:, 1 : k + 1]
        for p in out[(out["c"] == name) & out["synthetic"]][["x", "z"]].to_numpy():
            gaps = []
            for i, row in enumerate(near):
                for j in row:
                    d = own[j] - own[i]
                    u = np.clip(((p - own[i]) @ d) / (d @ d), 0, 1)
                    gaps.append(np.linalg.norm(own[i] + u * d - p))
            assert min(gaps) < 1e-9


def test_smote_is_reproducible_and_spreads_seeds(spark):
    rows = [("a", float(i), 0.0) for i in range(50)] + [("b", float(i), 5.0) for i in range(8)]
    df = spark.createDataFrame(rows, "c string, x double, z double")
    first = sorted(tuple(r) for r in smote(df, ["x", "z"], "c").collect())
    assert first == sorted(tuple(r) for r in smote(df.repartition(7), ["x", "z"], "c").collect())
    assert first != sorted(tuple(r) for r in smote(df, ["x", "z"], "c", seed=7).collect())


def test_smote_with_copies(spark):
    """A class that is mostly one repeated row, with more copies wanted than one chunk holds."""
    rows = [("a", float(i)) for i in range(5000)] + [("b", 1.0)] * 30 + [("b", 2.0), ("b", 3.0)]
    df = spark.createDataFrame(rows, "c string, x double")
    out = smote(df, ["x"], "c").filter("c = 'b'").toPandas()
    assert len(out) == 5000
    made = out[out["synthetic"]]["x"]
    assert made.between(1, 3).all() and (made == 1.0).mean() > 0.8


def test_smote_edges(spark):
    with pytest.raises(ValueError, match="one row"):
        smote(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "c string, x double"), ["x"], "c")
    even = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    assert smote(even, ["x"], "c").count() == 2


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    assert {r["c"]: r["weight"] for r in class_weights(df, "c").collect()} == {"a": 4 / 6, "b": 2.0}
    assert with_class_weights(df, "c").agg(F.sum("weight")).first()[0] == pytest.approx(4.0)


@pytest.fixture(scope="module")
def scored():
    y = RNG.integers(0, 2, size=400)
    p = np.clip((y * 0.3 + RNG.random(400) * 0.7).round(2), 0, 1)
    return pd.DataFrame({"label": y, "score": p})


def test_binary_metrics(spark, scored):
    df = spark.createDataFrame(scored)
    row = binary_metrics(df).first()
    auc = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(df)
    assert row["auc"] == pytest.approx(auc, abs=1e-12)
    y, p = scored["label"], scored["score"]
    called = p >= 0.5
    tp, fp, fn = (called & (y == 1)).sum(), (called & (y == 0)).sum(), (~called & (y == 1)).sum()
    q = p.clip(1e-15, 1 - 1e-15)
    assert row["logloss"] == pytest.approx(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())
    assert row["accuracy"] == pytest.approx((called == (y == 1)).mean())
    assert row["precision"] == pytest.approx(tp / (tp + fp)) and row["recall"] == pytest.approx(tp / (tp + fn))
    assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    best = binary_metrics(df, best=True).first()
    by_cut = [((p >= c) == (y == 1)).mean() for c in sorted(set(p))]
    assert best["accuracy"] == pytest.approx(max(by_cut)) and best["recall"] == 1.0


def test_score_curve_at_scale_path(spark, scored, monkeypatch):
    df = spark.createDataFrame(scored)
    small = sorted(tuple(r) for r in score_curve(df).collect())
    whole = evaluation.running_totals
    monkeypatch.setattr(evaluation, "running_totals", lambda *a, **k: whole(*a, **k, small=0, bucket_rows=7))
    assert sorted(tuple(r) for r in score_curve(df).collect()) == small


def test_one_class_has_no_auc(spark):
    row = binary_metrics(spark.createDataFrame([(1, 0.9), (1, 0.2)], "label int, score double")).first()
    assert row["auc"] is None and row["recall"] == 0.5


def test_roc_points(spark, scored):
    points = roc_points(spark.createDataFrame(scored), bins=10).orderBy("threshold").collect()
    assert points[0]["tpr"] == points[0]["fpr"] == 1.0
    for r in points:
        hit = scored[(scored["score"] * 10).astype(int).clip(upper=9) / 10 >= r["threshold"] - 1e-12]
        assert r["tp"] == hit["label"].sum() and r["fp"] == (1 - hit["label"]).sum()
    assert roc_points(spark.createDataFrame(scored), bins=5000).count() == (scored["score"] * 5000).astype(int).nunique()


def test_confusion_and_class_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    assert {tuple(r) for r in confusion_matrix(df).collect()} == {(0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 1, 1)}
    wide = {r["label"]: (r["0"], r["1"], r["2"]) for r in confusion_wide(df, [0, 1, 2]).collect()}
    assert wide[2] == (0, 1, 0)
    got = {r["class"]: r for r in class_metrics(df).collect()}
    assert got[1]["precision"] == pytest.approx(1 / 3) and got[1]["recall"] == 1.0
    assert got[2]["f1"] == 0.0 and got[0]["support"] == 2


@pytest.fixture(scope="module")
def labelled(spark):
    n = 400
    x = RNG.normal(size=n)
    pdf = pd.DataFrame(
        {
            "x": x, "twice": 2 * x, "noise": RNG.normal(size=n), "flat": 1.0, "user_id": np.arange(n),
            "word": "w", "Label": np.where(x > 0.2, np.where(x > 1, "PortScan", "DoS"), "BENIGN"),
        }
    )
    return spark.createDataFrame(pdf)


def test_select_features(spark, labelled, tmp_path):
    out = select_features(labelled, rows=300, key=["user_id"], numTrees=10, maxDepth=4)
    got = {r["feature"]: r for r in out.collect()}
    assert {c: got[c]["drop_reason"] for c in got} == {
        "x": None, "noise": None, "twice": "correlated", "flat": "low_variance", "user_id": "identity", "word": "not_numeric",
    }
    assert got["x"]["rank"] == 1 and got["x"]["selected"] and not got["twice"]["selected"]
    assert got["x"]["importance"] + got["noise"]["importance"] == pytest.approx(1.0)
    ranked = out.filter("rank is not null").select("feature", "importance")
    assert top_features(ranked, 1) == ["x"]
    write_reports(out, str(tmp_path / "r"))
    stored = json.loads(spark.read.text(str(tmp_path / "r/selected_features")).first()[0])
    assert stored == {"selected_features": ["x", "noise"], "count": 2}
    assert spark.read.option("header", "true").csv(str(tmp_path / "r/feature_importance")).first()["feature"] == "x"


def test_clean_split(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (float("nan"),)], "x double")
    test = spark.createDataFrame([(float("-inf"),), (9.0,), (None,)], "x double")
    assert sorted(r[0] for r in clean_split(train).collect()) == [1.0, 3.0, 3.0]
    assert sorted(r[0] for r in clean_split(test).collect()) == [9.0, 9.0]
    assert sorted(r[0] for r in clean_split(test, fit_on=train).collect()) == [3.0, 9.0]
    assert sorted(r[0] for r in clean_split(test, missing="median", fit_on=train).collect()) == [3.0, 3.0, 9.0]
    assert clean_split(train, "null").count() == 2
    assert sorted(r[0] for r in clean_split(train, "null", "mean").collect()) == [1.0, 2.0, 2.0, 3.0]


def test_binary_training(spark, labelled, tmp_path):
    done = run_binary(labelled, labelled, ["x", "noise"], "Label", maxIter=3, maxDepth=3)
    assert done.metrics.first()["auc"] > 0.95
    assert done.importance.first()["feature"] == "x" and done.importance.first()["scaled"] == 1.0
    write_training(done, labelled, "Label", str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m/model"))
    assert again.transform(labelled).count() == 400
    stored = spark.read.parquet(str(tmp_path / "m/scored"))
    assert stored.columns == ["x", "noise", "Label", "prediction", "probabilities"]
    assert spark.read.json(str(tmp_path / "m/metrics")).first()["n"] == 400


@pytest.mark.parametrize("method,params", [("forest", {"numTrees": 5}), ("boosted", {"maxIter": 2, "maxDepth": 3})])
def test_multiclass_training(labelled, method, params):
    unseen = labelled.filter("Label <> 'PortScan'")
    done = run_multiclass(unseen, labelled, ["x", "noise"], "Label", method, **params)
    got = {r["class"]: r for r in done.metrics.collect()}
    assert got[0]["recall"] > 0.9 and got[2]["recall"] == 0.0  # the class training never saw


def test_leaderboard(labelled):
    df = labelled.withColumn("y", (F.col("x") > 0).cast("int"))
    models = {"good": train_forest(df, ["x"], "y", numTrees=3), "bad": train_forest(df, ["noise"], "y", numTrees=3, maxDepth=1)}
    board = leaderboard(models, df, "y").collect()
    assert [r["model"] for r in board] == ["good", "bad"] and board[0]["auc"] > 0.99
    assert score_binary(models["good"], df).filter("score between 0 and 1").count() == 400
    assert model_importance(models["good"]).first()["importance"] == 1.0


def test_balancing_names_the_column_with_gaps(spark):
    df = spark.createDataFrame([(1.0, None, 0), (2.0, 1.0, 0), (3.0, 1.0, 1), (4.0, 2.0, 1), (5.0, 2.0, 1)], "a double, b double, y int")
    with pytest.raises(ValueError, match="b"):
        smote(df, ["a", "b"], "y")


def test_scores_outside_the_expected_range_keep_their_place(spark):
    df = spark.createDataFrame([(0, -0.5), (1, 0.5), (1, 1.0), (1, 7.25)], "label int, score double")
    got = [(r.threshold, r.tp, r.fp) for r in evaluation.roc_points(df, bins=4).orderBy("threshold").collect()]
    assert got == [(-0.5, 3, 1), (0.5, 3, 0), (0.75, 2, 0), (7.25, 1, 0)]
    with pytest.raises(ValueError):
        evaluation.roc_points(df, bins=0)
