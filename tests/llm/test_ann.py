import numpy as np

from tidewell.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score double"


def exact(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[q] = np.inf
    return [(int(ids[i]), float(d[i])) for i in np.lexsort((ids, d))[:k] if np.isfinite(d[i])]


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row], 0.0) for i, row in zip(ids, x)], SCHEMA)


def test_recall_order_and_hot_cells(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[rng.integers(0, 12, 2000)] + 0.3 * rng.normal(size=(2000, 16)), np.repeat(centres[:1], 700, 0)])
    x = x.astype(np.float32).astype(float)
    ids = np.arange(len(x))
    monkeypatch.setattr(ann, "CELL_ROWS", 200)
    monkeypatch.setattr(ann, "CELL_QUERIES", 5)
    df = frame(spark, ids, x)
    got = {}
    for r in ann.search(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in range(0, len(x), 50):
        rows = sorted(got[q])
        want = exact(ids, x, q, 10)
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
        hits += len({i for _, i, _ in rows} & {i for i, _ in want})
        total += 10
        if q >= 2000:  # copies: distance zero, ties to smaller ids
            assert [i for _, i, _ in rows] == [i for i, _ in want]
    assert hits / total >= 0.9


def test_blocks_of_rows_and_queries_give_what_one_block_gives(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(300, 6)), 5 + 1e-3 * rng.normal(size=(300, 6))])  # half within one cell
    df = frame(spark, np.arange(600), x)
    told = lambda: sorted(map(tuple, ann.search(df, df, 4).collect()))
    whole = told()
    monkeypatch.setattr(ann, "CELL_ROWS", 64)
    monkeypatch.setattr(ann, "CELL_QUERIES", 50)
    assert told() == whole and len(whole) == 2400


def test_few_rows_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0.0),
        (100, [0.0, 1.0], 0.0),
        (3, [1.0, 0.0], 0.0),
        (4, None, 0.0),
        (200, [0.0, 0.0], 0.0),
        (300, [nan, 1.0], 0.0),
        (5, [inf, 1.0], 0.0),
        (6, [None, 1.0], 0.0),
        (7, [1.0, 2.0, 3.0], 0.0),
        (None, [5.0, 5.0], 0.0),
        (400, [], 0.0),
        (3, [1.0, 0.0], 0.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.search(df, df.filter("vec_id % 100 = 0")).collect())
    root = round(2**0.5, 9)
    assert got == [(0, 1, 3, 0.0), (0, 2, 100, root), (100, 1, 0, root), (100, 2, 3, root)]
    none = spark.createDataFrame([], SCHEMA)
    assert ann.search(none, none).count() == 0
    assert ann.search(df, none).count() == 0


def test_probes_come_in_order_of_boundary_distance():
    places = np.random.default_rng(2).uniform(-3, 3, size=(20, 4))
    cells = ann.probe_cells(places, 81)
    for row, p in zip(cells, places):
        own, inner = np.floor(p).astype(int), p - np.floor(p)
        every = {}
        for move in np.ndindex(3, 3, 3, 3):
            step = np.array(move) - 1
            cost = sum((i**2, 0.0, (1 - i) ** 2)[m] for i, m in zip(inner, move))
            every[int(ann.cell_number(own + step))] = cost
        costs = [every[int(c)] for c in row]
        assert len(set(row.tolist())) == 81 and (np.diff(costs) >= -1e-12).all()
        assert (ann.probe_cells(p[None], 10)[0] == row[:10]).all()
