import numpy as np
import pytest

import tidewell.operators.approximate as approximate
import tidewell.operators.neighbors as neighbors
from tidewell.session import durable

SCHEMA = "g string, x array<double>, m bigint"


@pytest.fixture
def written(monkeypatch):
    """Rows of every table that a search writes, by its tag."""
    counts = {}

    def counted(df, tag="stage"):
        table = durable(df, tag)
        counts[tag] = max(counts.get(tag, 0), table.count())
        return table

    for module in (neighbors, approximate):
        monkeypatch.setattr(module, "durable", counted)
    return counts


def made(spark, n, dims, seed):
    rng = np.random.default_rng(seed)
    near = rng.normal(size=(n // 3, dims)) * 0.01 + 7
    return spark.createDataFrame(
        [("big", v.tolist(), 1) for v in np.concatenate([rng.normal(size=(n - len(near), dims)), near])]
        + [("few", v.tolist(), 2) for v in rng.normal(size=(4, dims))],
        SCHEMA,
    ).repartition(4)


def distances(rows):
    return {(r.g, tuple(r.x)): [n.dist for n in r.neighbors] for r in rows}


def true_distances(df, k):
    out = {}
    for g in ("big", "few"):
        x = np.array([r.x for r in df.filter(df.g == g).collect()])
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) + np.diag([np.inf] * len(x))
        out |= {(g, tuple(v)): [e for e in np.sort(line)[:k] if e < np.inf] for v, line in zip(x, d)}
    return out


@pytest.mark.parametrize("cell_rows,pivot_bytes", [(12, 64 << 20), (90, 64 << 20), (12, 0)])
def test_neighbors_over_several_blocks(spark, monkeypatch, cell_rows, pivot_bytes):
    monkeypatch.setattr(neighbors, "BLOCK_BYTES", 0)  # so a block holds no more than chunk_rows
    monkeypatch.setattr(neighbors, "CHUNK_BYTES", 0)
    monkeypatch.setattr(neighbors, "PIVOT_BYTES", pivot_bytes)
    df = made(spark, 240, 3, 5)
    got = distances(neighbors.nearest_vectors(df, df, 5, "g", "x", "m", cell_rows, 40).collect())
    want = true_distances(df, 5)
    assert set(got) == set(want)
    for q, d in want.items():
        np.testing.assert_allclose(got[q], d, rtol=1e-9)


def test_no_row_is_written_per_query_and_cell(spark, written):
    df = made(spark, 900, 24, 6)  # 24 even directions: hardly a cell can be left out
    neighbors.nearest_vectors(df, df, 5, "g", "x", "m", 10, 30).count()
    assert max(written.values()) <= 904


def test_no_row_is_written_per_visit(spark, written):
    df = made(spark, 900, 24, 7)
    found, report = approximate.approximate_vectors(df, df, 5, "g", "x", "m", cell_rows=10, chunk_rows=30)
    assert found.count() == 904
    assert report.filter("g = 'big'").first().leaves > 10
    assert written["visits"] == 904 and written["found"] == 904


def test_visits_over_several_blocks(spark, monkeypatch):
    for name in ("BLOCK_BYTES", "CHUNK_BYTES"):
        monkeypatch.setattr(approximate, name, 0)
    df = made(spark, 400, 3, 8)
    got = distances(approximate.approximate_vectors(df, df, 5, "g", "x", "m", target=1.0, cell_rows=9, chunk_rows=30)[0].collect())
    want = true_distances(df, 5)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert np.mean([np.allclose(got[q], want[q]) for q in want]) > 0.9
