import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators.approximate import approximate_vectors
from tidewell.operators.balance import smote
from tidewell.operators.neighbors import nearest_vectors

SCHEMA = "g string, x array<double>, m bigint"


def named(df):
    return {(r.g, tuple(r.x)): [tuple(n.y) for n in r.neighbors] for r in df.collect()}


def clustered(n, dims, seed, centres=30):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, dims)) * 4
    return at[rng.integers(0, centres, n)] + rng.normal(size=(n, dims))


def test_few_cells_are_visited_and_most_neighbours_found(spark):
    rng = np.random.default_rng(3)
    dense = np.concatenate([clustered(2000, 8, 1), 20 + 0.01 * rng.normal(size=(1000, 8))])  # a third within one spot
    rows = [("big", v.tolist(), 1) for v in dense] + [("few", v.tolist(), 2) for v in rng.normal(size=(4, 8))]
    df = spark.createDataFrame([*rows, ("one", [1.0] * 8, 1)], SCHEMA).repartition(6)
    found, report = approximate_vectors(df, df, 5, "g", "x", "m", cell_rows=25, chunk_rows=100)
    got, want = named(found), named(nearest_vectors(df, df, 5, "g", "x", "m"))
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert {len(v) for (g, _), v in got.items() if g == "few"} == {3}
    big = [q for q in want if q[0] == "big"]
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in big]) >= 0.9
    told = {r.g: r for r in report.collect()}
    assert told["big"].n == 3000 and told["big"].recall >= 0.96 and told["big"].sampled == 500
    assert told["big"].leaves < told["big"].cells / 3
    assert told["few"].cells == 1 and told["few"].recall == 1.0 and told["one"].recall is None
    assert all(n.m == 2 for r in found.filter("g = 'few'").collect() for n in r.neighbors)
    for r in found.filter("g = 'big'").limit(50).collect():
        d = [n.dist for n in r.neighbors]
        assert d == sorted(d) and d == pytest.approx([np.linalg.norm(np.subtract(n.y, r.x)) for n in r.neighbors])


def test_rows_without_group_or_vector_and_no_rows(spark):
    rows = [("a", [0.0], 1), ("a", [1.0], 1), ("a", [3.0], 1), (None, [1.0], 1), ("b", None, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    found, _ = approximate_vectors(df, df.filter("x[0] < 1"), 2, "g", "x", "m", cell_rows=1)
    assert named(found) == {("a", (0.0,)): [(1.0,), (3.0,)]}
    none = spark.createDataFrame([], SCHEMA)
    found, report = approximate_vectors(none, none, 2, "g", "x", "m")
    assert found.count() == 0 and report.count() == 0


def test_balancing_with_approximate_neighbours(spark):
    rows = [("a", float(i), 0.0) for i in range(60)] + [("b", float(i), 5.0) for i in range(12)] + [("c", 1.0, 1.0)] * 3 + [("c", 2.0, 2.0)]
    out = smote(spark.createDataFrame(rows, "c string, x double, z double"), ["x", "z"], "c", approximate=True)
    counts = {r.c: (r.n, r.made) for r in out.groupBy("c").agg(F.count("*").alias("n"), F.count_if("synthetic").alias("made")).collect()}
    assert counts == {"a": (60, 0), "b": (60, 48), "c": (60, 56)}
    assert out.filter("x is null or z is null").isEmpty()
    assert out.filter("c = 'b' and not (x between 0 and 11 and z = 5)").isEmpty()
