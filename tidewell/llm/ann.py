"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell ``floor((a.v + b) / w)`` of a few Gaussian projections.  A query visits, per table, the
cells next to its own in order of estimated success: the sum of the squared distances to the boundaries that have to be
crossed.  Rows of a visited cell are compared exactly, cell by cell in blocks, and only the best of a block leave it; the
candidates of all tables are merged and ranked by exact distance.

Parameters come from a hashed sample of at most about ``SAMPLE`` vectors: cell width and number of probes are the cheapest
that find ``TARGET`` of the sample's own neighbours; neighbours in the whole table are nearer and easier to find.
Every vector is indexed.  A cell with more rows than ``CELL_ROWS`` is dealt out over several blocks by a hash, so a cell that
holds a third of the table is no hot group; the queries of a cell are dealt out by ``CELL_QUERIES`` in the same way, and every
block of rows meets every block of queries.  Queries that met fewer than ``k`` rows are compared with all rows, in blocks.

Null vectors, zero vectors and vectors with null or non-finite components take no part, neither as rows nor as queries; rows
with a null id neither.  Vectors of different lengths are never compared.  An id that is listed twice is a row each time
it has another vector.  Ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import sampled
from tidewell.session import durable

K = 10
TABLES = 4
SAMPLE = 3_000
SAMPLE_QUERIES = 200
TARGET = 0.97
CELL_ROWS = 4_096
CELL_QUERIES = 4_096
ROWS_PER_CELL = 2_048  # aimed at by the number of projections
MAX_PROBES = 4_096
WIDTHS = (1.0, 1.5, 2.0, 3.0, 4.0)  # of the median neighbour distance
SCAN = -1  # table number of the exact comparison
SEED = 90_210


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array<double>) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("id").isNotNull() & fine & F.exists("v", lambda x: x != 0)).distinct()


@dataclass
class Index:
    dimension: int
    projections: int
    width: float
    probes: int

    def planes(self, table: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([SEED, self.dimension, table])
        a = rng.normal(size=(self.dimension, self.projections))
        return a, rng.uniform(0, self.width, self.projections)

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        a, b = self.planes(table)
        return (x @ a + b) / self.width

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        return cell_number(np.floor(self.places(x, table)).astype(np.int64))

    def probed(self, x: np.ndarray, table: int) -> np.ndarray:
        """Cells to visit per vector, best first: rows x probes."""
        return probe_cells(self.places(x, table), self.probes)


def cell_number(parts: np.ndarray) -> np.ndarray:
    """One 64-bit number of a cell's coordinates (last axis)."""
    out = np.zeros(parts.shape[:-1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(parts.shape[-1]):
            out = (out ^ parts[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return out.view(np.int64)


def probe_cells(places: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` most promising cells: coordinates moved by -1, 0 or 1, ordered by squared boundary distance.

    Built one projection at a time; a prefix outside the best ``probes`` cannot lead to a cell among them.
    """
    own = np.floor(places).astype(np.int64)
    inner = places - own
    costs = np.stack([inner**2, np.zeros_like(inner), (1 - inner) ** 2], axis=2)  # rows x projections x moves
    best = np.zeros((len(places), 1))
    moves = np.zeros((len(places), 1, 0), np.int64)
    for k in range(places.shape[1]):
        total = (best[:, :, None] + costs[:, k, None, :]).reshape(len(places), -1)
        longer = np.concatenate(
            [np.repeat(moves, 3, axis=1), np.tile(np.array([-1, 0, 1]), moves.shape[1])[None, :, None].repeat(len(places), 0)],
            axis=2,
        )
        order = np.argsort(total, axis=1, kind="stable")[:, :probes]
        best = np.take_along_axis(total, order, 1)
        moves = np.take_along_axis(longer, order[:, :, None], 1)
    return cell_number(own[:, None, :] + moves)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances, each from the differences themselves (no cancellation)."""
    out = np.empty((len(q), len(x)))
    for i in range(len(q)):
        d = x - q[i]
        out[i] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def fit(sample: np.ndarray, rows: int, k: int) -> Index:
    """Cheapest width and number of probes that reach ``TARGET`` on the sample's own neighbours."""
    n, dimension = sample.shape
    projections = max(2, int(np.ceil(np.log(max(1, rows) / ROWS_PER_CELL) / np.log(3)))) if rows > ROWS_PER_CELL else 2
    q = np.arange(min(n, SAMPLE_QUERIES))
    d = distances(sample[q], sample)
    d[q, q] = np.inf
    near = np.argsort(d, axis=1, kind="stable")[:, : max(1, min(k, n - 1))]
    reach = np.take_along_axis(d, near, 1)
    scale = float(np.median(reach[np.isfinite(reach)])) if np.isfinite(reach).any() else 1.0
    most = min(MAX_PROBES, 3**projections)
    best, cheapest = Index(dimension, projections, 4 * max(scale, 1e-12), most), np.inf
    for factor in WIDTHS:
        index = Index(dimension, projections, factor * max(scale, 1e-12), most)
        met = np.full(near.shape, most)
        load = np.zeros(most)
        for table in range(TABLES):
            cells, probed = index.cells(sample, table), index.probed(sample[q], table)
            hit = probed[:, None, :] == cells[near][:, :, None]
            met = np.minimum(met, np.where(hit.any(2), hit.argmax(2), most))
            load += np.cumsum((probed[:, :, None] == cells[None, None, :]).sum(2).mean(0))
        found = np.array([(met < t).mean() for t in range(1, most + 1)])
        enough = np.flatnonzero(found >= TARGET)
        if len(enough) and load[enough[0]] + enough[0] < cheapest:
            cheapest = load[enough[0]] + enough[0]
            best = Index(dimension, projections, index.width, int(enough[0]) + 1)
    return best


def _stacked(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _spread(rows: DataFrame, indexes: dict[int, Index], probe: bool) -> DataFrame:
    """``tab, dim, cell, id, v``: the cell of each row in each table, or the cells a query visits."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                x = _stacked(part.column(1))
                for table in range(TABLES):
                    index = indexes[dim]
                    cells = index.probed(x, table) if probe else index.cells(x, table)[:, None]
                    at = np.repeat(np.arange(len(x)), cells.shape[1])
                    for lo in range(0, len(at), 20_000):
                        some = pa.array(at[lo : lo + 20_000])
                        m = len(some)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(m, table, np.int32)),
                                pa.array(np.full(m, dim, np.int32)),
                                pa.array(cells.reshape(-1)[lo : lo + 20_000]),
                                part.column(0).take(some),
                                part.column(1).take(some),
                            ],
                            names=["tab", "dim", "cell", "id", "v"],
                        )

    return rows.mapInArrow(run, "tab int, dim int, cell long, id long, v array<double>")


def _nearest(k: int):
    def step(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_i, out_d = [], [], []
        if rows.num_rows and queries.num_rows:
            x, ids = _stacked(rows.column("v").combine_chunks()), rows.column("id").to_numpy()
            qs, names = _stacked(queries.column("v").combine_chunks()), queries.column("id").to_numpy()
            by = np.argsort(ids, kind="stable")
            x, ids = x[by], ids[by]
            for i in range(len(qs)):
                d = distances(qs[i : i + 1], x)[0]
                d[ids == names[i]] = np.inf
                order = np.argsort(d, kind="stable")[:k]
                order = order[np.isfinite(d[order])]
                out_q.append(np.full(len(order), names[i]))
                out_i.append(ids[order])
                out_d.append(d[order])
        joined = [np.concatenate(c) if c else np.array([], t) for c, t in ((out_q, np.int64), (out_i, np.int64), (out_d, np.float64))]
        return pa.table(dict(zip(["query_id", "vec_id", "score"], joined)))

    return step


def _blocks(df: DataFrame, key: list[str], most: int, name: str) -> DataFrame:
    """``key, name``: the number of blocks of the cells that hold more than ``most`` rows."""
    sizes = df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > most)
    return sizes.select(*key, F.ceil(F.col("n") / most).alias(name))


def _matched(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of every block of a visited cell, for every block of the cell's queries."""
    key = ["tab", "dim", "cell"]
    one = F.lit(1).cast("long")
    rows, queries = _blocks(index, key, CELL_ROWS, "rows"), _blocks(probes, key, CELL_QUERIES, "queries")
    grid = rows.join(queries, key, "full")

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.coalesce(own, one))
        met = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(other, one) - 1))
        return df.join(grid, key, "left").select(*key, "id", "v", mine.alias(f"{own}_block"), met.alias(f"{other}_block"))

    block = [*key, "rows_block", "queries_block"]
    both = placed(index, "rows", "queries").groupBy(*block).cogroup(placed(probes, "queries", "rows").groupBy(*block))
    return both.applyInArrow(_nearest(k), "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest found rows of another id."""
    rows = durable(usable(vectors, id_col, vector_col), "vectors")
    asked = durable(usable(queries, id_col, vector_col), "queries")
    sizes = {r.dim: r.n for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    indexes = {}
    for dim, n in sizes.items():
        sample = sampled(rows.filter(F.size("v") == dim), "id", SAMPLE, n).orderBy(F.xxhash64("id"), "id").collect()
        indexes[dim] = fit(np.array([r.v for r in sample]).reshape(-1, dim), n, k) if sample else Index(dim, 2, 1.0, 9)
    asked = asked.filter(F.size("v").isin(list(sizes)))
    if not sizes:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    probes = _spread(asked, indexes, True)
    index = _spread(rows, indexes, False)
    visited = probes.select("tab", "dim", "cell").distinct()
    index = durable(index.join(visited, ["tab", "dim", "cell"], "left_semi"), "cells")
    found = durable(_ranked(_matched(index, probes, k), k), "found")
    # a query that met fewer than k rows though there are more
    counts = found.groupBy("query_id").agg(F.count("*").alias("met"))
    there = F.create_map(*[F.lit(x) for dim, n in sizes.items() for x in (dim, n)])
    short = asked.join(counts, asked["id"] == counts["query_id"], "left").filter(
        F.coalesce("met", F.lit(0)) < F.least(F.lit(k), F.element_at(there, F.size("v")) - 1)
    )
    scan = lambda df: df.select(F.lit(SCAN).alias("tab"), F.size("v").alias("dim"), F.lit(0).cast("long").alias("cell"), "id", "v")
    rest = _matched(scan(rows), durable(scan(short), "short"), k)
    return _ranked(found.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
