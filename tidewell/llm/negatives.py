"""Hard negatives: threshold joins of vectors by integer inner product, after L2AP, lowered until windows fill.

Components become ``floor(256 x)``, so scores are exact integers.  Two searches, each a threshold join that is repeated
for the windows it leaves open: first an anchor's best rows of its own label (its positives), then, for each
positive, the best rows of other labels with ``LEAST`` to ``MOST`` percent of the positive's score.  A join at threshold t
finds every row that scores t or more, so a window that fills holds its first rows; one that does not is searched again
at a lower threshold, the last of which is the window's own lower bound (for positives: none).

A join deals rows and anchors into blocks of bounded size by hash, and each pair of blocks is one group.  There:
an inverted index holds a row's largest components only: the rest is left out as long as its norm, times any anchor's,
stays below the threshold.  An anchor goes through its own components from the largest on and adds up partial scores
from the postings; once the remaining norms leave few rows that can reach the threshold, those are scored exactly.
Only the first rows of each window leave a block.  Anchors without open windows are not sent again.

Edge cases: rows with a null id, label, vector or component, or a component that is not finite, take no part.  Vectors of
different lengths never meet.  Rows equal in id, label and vector are one row; an id listed with different ones is
as many rows, and as an anchor it is the smallest of them.  Ties go to the smaller id.  Scores must fit a long: squared
norms from 2^62 on are an error.  Fewer rows than asked for are returned where there are no more; no rows, no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import durable, settle

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST = 80
MOST = 100
#: Thresholds tried for positives, as shares of the anchor's norm times the largest norm; then without one.
STARTS = (0.45, 0.3)
#: Then for negatives: how far the threshold lies below the positive's score, as shares of the window.
DEPTHS = (0.35,)
BLOCK_COMPONENTS = 1 << 18
SLICE = 128
CHECK_EVERY = 8
FEW = 16
EXACT = float(1 << 52)
NONE = -(1 << 63)
FOUND = "aid long, w int, score long, id long"


def prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """``id, label, v, dims, norm2``: rows that take part, as integers, each once."""
    vector = F.col(vector_col)
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vector.isNotNull() & F.coalesce(whole, F.lit(False)))
    own = usable.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("v"),
    ).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    fits = F.when(square < float(1 << 62), square).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("double"))
    return own.select("*", F.size("v").alias("dims"), fits.alias("norm2"))


def _stacked(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


class Postings:
    """An inverted index over a block of rows that may leave out what cannot lift a row to ``cut``.

    ``cut`` is the least threshold over the anchors, divided by the anchor's norm.
    """

    def __init__(self, x: np.ndarray):
        self.x, self.xf = x, x.astype(np.float64)
        self.order = np.argsort(-np.abs(self.xf), axis=1, kind="stable")
        squares = np.take_along_axis(self.xf**2, self.order, 1)
        tail = np.cumsum(squares[:, ::-1], 1)[:, ::-1]
        self.tail = np.sqrt(np.concatenate([tail, np.zeros((len(x), 1))], 1))  # norm of all but the j largest
        self.norm = self.tail[:, 0]

    def build(self, cut: float) -> None:
        n, d = self.x.shape
        size = (self.tail[:, :-1] >= cut).sum(1) if cut > 0 else np.full(n, d)
        self.left_out = self.tail[np.arange(n), size]
        self.indexed = np.sqrt(np.maximum(self.norm**2 - self.left_out**2, 0))
        held = np.zeros((n, d), bool)
        np.put_along_axis(held, self.order, np.arange(d)[None, :] < size[:, None], 1)
        self.rows = [np.flatnonzero(held[:, j]) for j in range(d)]
        self.values = [self.xf[rows, j] for j, rows in enumerate(self.rows)]

    def exact(self, q: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        qf = q.astype(np.float64)
        if np.sqrt(qf @ qf) * self.norm.max(initial=0.0) < EXACT:
            return np.rint(self.xf[at] @ qf).astype(np.int64)
        return (self.x[at] * q).sum(1)

    def reach(self, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may score ``least`` or more, and their exact scores."""
        if least == NONE:
            return np.arange(len(self.x)), self.exact(q, slice(None))
        qf = q.astype(np.float64)
        by = np.argsort(-np.abs(qf), kind="stable")
        rest = np.sqrt(np.append(np.cumsum((qf[by] ** 2)[::-1])[::-1], 0.0))  # norm of q without its j largest
        slack = 1e-6 * (1.0 + rest[0] * self.norm.max(initial=0.0))  # of sums in floating point
        partial = rest[0] * self.left_out
        alive = np.arange(len(self.x))
        for j, dim in enumerate(by.tolist()):
            partial[self.rows[dim]] += qf[dim] * self.values[dim]
            if (j + 1) % CHECK_EVERY == 0 or j + 1 == len(by):
                alive = np.flatnonzero(partial + rest[j + 1] * self.indexed >= least - slack)
                if len(alive) * FEW <= len(self.x):
                    break
        return alive, self.exact(q, alive)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by id."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _met(k: int):
    """Of one block of rows, the first ``k`` of every window of a block of anchors."""

    def step(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        if rows.num_rows and anchors.num_rows:
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            index = Postings(_stacked(rows.column("v"), rows.num_rows))
            qs = _stacked(anchors.column("v"), anchors.num_rows)
            names, own = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
            windows = anchors.column("windows").to_pylist()
            least = np.array([min(w["lo"] for w in ws) for ws in windows], np.int64)
            share = np.where(least == NONE, -np.inf, least / np.maximum(np.sqrt((qs.astype(np.float64) ** 2).sum(1)), 1e-9))
            by = np.argsort(-share, kind="stable")
            for at in range(0, len(by), SLICE):
                some = by[at : at + SLICE]
                if np.isfinite(share[some[-1]]):
                    index.build(share[some[-1]])
                for a in some.tolist():
                    # without a threshold all rows are scored, and the index is not looked at
                    bound = least[a] if np.isfinite(share[some[-1]]) else NONE
                    alive, scores = index.reach(qs[a], bound)
                    same, other = labels[alive] == own[a], ids[alive] != names[a]
                    for w in windows[a]:
                        inside = other & (same == w["same"]) & (scores >= w["lo"]) & (scores <= w["hi"])
                        pick = np.flatnonzero(inside)
                        pick = pick[_first(scores[pick], ids[alive[pick]], k)]
                        out.append((names[a], w["w"], scores[pick], ids[alive[pick]]))
        counts = [len(o[2]) for o in out]
        none = np.array([], np.int64)
        return pa.table(
            {
                "aid": np.repeat(np.array([o[0] for o in out], np.int64), counts),
                "w": np.repeat(np.array([o[1] for o in out], np.int32), counts),
                "score": np.concatenate([o[2] for o in out] or [none]),
                "id": np.concatenate([o[3] for o in out] or [none]),
            }
        )

    return step


def threshold_join(rows: DataFrame, anchors: DataFrame, windows: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """``aid, w, score, id, rank``: the first ``k`` rows of every window (``aid, w, same, hi, lo``)."""
    asked = windows.groupBy("aid").agg(F.collect_list(F.struct("w", "same", "hi", "lo")).alias("windows"))
    asked = anchors.join(asked, anchors["id"] == asked["aid"]).drop("aid").join(blocks, "dims")
    count = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = asked.select("dims", "id", "label", "v", "windows", F.pmod(F.xxhash64("id"), "groups").alias("team"), count("blocks").alias("block"))
    dealt = rows.join(blocks, "dims").select(
        "dims", "id", "label", "v", F.pmod(F.xxhash64("id", "label", "v"), "blocks").alias("block"), count("groups").alias("team")
    )
    key = ["dims", "block", "team"]
    met = dealt.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_met(k), FOUND)
    order = Window.partitionBy("aid", "w").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def filled(rows: DataFrame, anchors: DataFrame, windows: DataFrame, blocks: DataFrame, k: int, floors: list[Column]) -> DataFrame:
    """The first ``k`` rows of every window, from joins at lower and lower thresholds.

    ``floors`` are the thresholds to try, highest first, as columns of ``windows``; the last one is final.
    """
    found = None
    for turn, floor in enumerate(floors):
        last = turn == len(floors) - 1
        got = durable(threshold_join(rows, anchors, windows.withColumn("lo", floor), blocks, k), "met")
        full = got.groupBy("aid", "w").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select("aid", "w")
        part = got if last else got.join(full, ["aid", "w"], "left_semi")
        found = part if found is None else found.unionByName(part)
        if not last:
            windows = durable(windows.join(full, ["aid", "w"], "left_anti"), "open")
            if windows.isEmpty():
                break
    return durable(found, "windows")


def _percent(score: str, percent: int, up: bool) -> Column:
    """``percent`` of a score in whole numbers, rounded up or down."""
    product = f"(CAST({score} AS DECIMAL(28, 0)) * {percent} + {99 if up else 0})"  # may be larger than a long
    return F.expr(f"CAST(({product} - pmod({product}, 100)) div 100 AS BIGINT)")


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``anchors``, rows of ``rows``."""
    own = durable(prepared(rows, id_col, vector_col, label_col), "vectors")
    asked = prepared(anchors, id_col, vector_col, label_col)
    smallest = F.min(F.struct("label", "v", "dims", "norm2")).alias("s")
    asked = durable(asked.groupBy("id").agg(smallest).select("id", "s.*"), "anchors")
    sizes = own.groupBy("dims").agg(F.count("*").alias("n"), F.sqrt(F.max("norm2")).alias("longest"))
    wanted = asked.groupBy("dims").agg(F.count("*").alias("m"))
    number = lambda n: F.greatest(F.lit(1).cast("long"), F.ceil(F.col(n) * F.col("dims") / BLOCK_COMPONENTS))
    sizes = settle(sizes.join(wanted, "dims").select("dims", "longest", number("n").alias("blocks"), number("m").alias("groups")))
    blocks = sizes.select("dims", "blocks", "groups")

    top = F.lit((1 << 63) - 1)
    windows = asked.join(sizes, "dims").select(
        F.col("id").alias("aid"),
        F.lit(0).alias("w"),
        F.lit(True).alias("same"),
        top.alias("hi"),
        F.lit(NONE).alias("floor"),
        (F.sqrt("norm2") * F.col("longest")).alias("span"),
    )
    starts = [F.ceil(F.col("span") * share).cast("long") for share in STARTS]
    near = filled(own, asked, windows, blocks, positives, [*starts, F.col("floor")])
    near = near.select("aid", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

    low, high = _percent("positive_score", least, True), _percent("positive_score", most, False)
    windows = near.select("aid", "w", F.lit(False).alias("same"), high.alias("hi"), low.alias("floor")).filter("floor <= hi")
    depths = [F.greatest("floor", F.col("hi") - F.ceil((F.col("hi") - F.col("floor")) * share)) for share in DEPTHS]
    hard = filled(own, asked, windows, blocks, negatives, [*depths, F.col("floor")])
    return hard.join(near, ["aid", "w"]).select(
        F.col("aid").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

