import math

import numpy as np
import pytest

from tests.llm.support import sorted_rows
from tidewell.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, anchors, least=80, most=100, positives=5, negatives=5):
    """All scores of all anchors, sorted."""
    usable = []
    for vec_id, vector, label in rows:
        if None not in (vec_id, vector, label) and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    usable, out = sorted(set(usable)), []
    for a in sorted({u[0] for u in usable if u[0] in anchors}):
        _, label, v = next(u for u in usable if u[0] == a)
        met = sorted((-sum(x * y for x, y in zip(v, u[2])), u[0], u[1]) for u in usable if u[0] != a and len(u[2]) == len(v))
        for score, positive, _ in [m for m in met if m[2] == label][:positives]:
            near = [m for m in met if m[2] != label and -least * score <= -100 * m[0] <= -most * score][:negatives]
            out += [(a, positive, n + 1, m[1], -score, -m[0]) for n, m in enumerate(near)]
    return sorted(out, key=repr)


def mined(spark, rows, anchors, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted_rows(negatives.mine(df, df.filter(df.vec_id.isin(list(anchors))), **how))


def random_rows(seed, n, d, labels=4, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(int(i), [float(v) for v in row], int(rng.integers(0, labels))) for i, row in enumerate(x)]


@pytest.mark.parametrize("components", [1 << 18, 2000])
def test_against_all_pairs_with_copies(spark, monkeypatch, components):
    monkeypatch.setattr(negatives, "BLOCK_COMPONENTS", components)
    rows = random_rows(1, 500, 24)
    rows += [(1000 + i, rows[0][1], i % 4) for i in range(150)] + [rows[3], rows[3]]
    anchors = set(range(0, 500, 20)) | {1003}
    assert mined(spark, rows, anchors) == plain(rows, anchors)


def test_thresholds_lowered_to_the_end(spark):
    """Unlike rows, few rows of a label, windows that do not fill and scores below zero."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=8)], int(i % 40 == 0)) for i in range(160)]
    rows += [(900, [-10.0] * 8, 7), (901, [10.0] * 8, 7), (902, [0.0] * 8, 8), (903, [0.0] * 8, 8)]
    anchors = {0, 40, 80, 900, 901, 902, 5}
    got = mined(spark, rows, anchors)
    assert got == plain(rows, anchors) and {40, 902} <= {r[0] for r in got} < anchors
    how = {"least": 10, "most": 50, "positives": 3, "negatives": 7}
    assert mined(spark, rows, anchors, **how) == plain(rows, anchors, **how)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 0.5]
    rows = [
        (0, good, 1), (1, good, 1), (2, good, 2), (2, good, 2), (3, None, 1), (4, [None, 1.0], 2), (5, [nan, 1.0], 2),
        (6, [inf, 1.0], 2), (7, good, None), (None, good, 2), (8, [1.0], 1), (9, [], 1), (10, [], 2), (11, [1.0, 0.45], 3),
        (0, [0.1, 0.1], 2), (12, [0.9, 0.5], 2),
    ]
    anchors = {0, 2, 3, 7, 8, 9, 11}
    got = mined(spark, rows, anchors)
    assert got == plain(rows, anchors) and (0, 1, 1, 2, 81920, 81920) in got
    assert mined(spark, [], anchors) == []
    clash = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "dims", "rank", "block", "aid"):
        clash = clash.selectExpr("*", f"1 AS {name}")
    assert sorted_rows(negatives.mine(clash, clash.filter(clash.vec_id.isin(list(anchors))))) == got


def test_index_leaves_out_components_and_loses_no_row():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.normal(size=(400, 32)) / 6).astype(np.int64)
    index = negatives.Postings(x)
    q = x[0]
    norm = float(np.sqrt(q @ q))
    for share in (0.05, 0.3, 0.7):
        least = int(share * norm * index.norm.max())
        index.build(least / norm)
        alive, scores = index.reach(q, least)
        assert set(np.flatnonzero(x @ q >= least)) <= set(alive.tolist())
        assert (scores == x[alive] @ q).all()
    assert sum(map(len, index.rows)) < x.size / 2 and len(alive) < len(x) / 4


def test_scores_beyond_double_precision(spark):
    big = [2.0**21, 1.0, 3.0]
    rows = [(0, big, 1), (1, [2.0**21, 0.5, 3.0], 1), (2, [2.0**21, 0.25, 3.0], 2), (3, [2.0**21, 0.5, 2.5], 2)]
    assert mined(spark, rows, {0}) == plain(rows, {0})
