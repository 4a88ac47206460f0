"""Exact nearest neighbours among distinct points of the same group, without pairing all rows.

Points are assigned to cells around pivots, and consecutive cells are packed into blocks of bounded bytes.  A task compares a
chunk of queries with one block, cell by cell: first each query's own cell, which bounds the distance of its k-th neighbour; by
the triangle inequality another cell can only hold a closer point if ``d(query, pivot) - radius(cell)`` is within that bound,
and only those cells are compared, while the bound shrinks.  One row with at most k neighbours leaves a task per query, however
many cells it looked into.  Groups of several blocks are searched twice: first the block of the query, then, with the bound
found there, the other blocks that hold a cell within it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.session import durable, settle

CELL_ROWS = 4096
CHUNK_ROWS = 4096
MAX_PIVOTS = 512
PIVOT_BYTES = 64 << 20
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 1 << 16  # vectors of a block of points
CHUNK_BYTES = 2 << 20  # vectors of a chunk of queries
STEP = 1 << 20  # distances computed at once
SHORTLIST = 4  # times k: longer lists of candidates are cut to the closest ones first


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow column of vectors of one width; missing numbers are NaN."""
    vectors = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if not len(vectors):
        return np.zeros((0, 0))
    lengths = np.diff(vectors.offsets.to_numpy())
    if vectors.null_count or (lengths != lengths[0]).any():
        raise ValueError("vectors are missing or differ in width")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(vectors), lengths[0])


def _distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    squared = (queries**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * queries @ points.T
    return np.sqrt(np.maximum(squared, 0.0))


def _closest(queries: np.ndarray, points: np.ndarray, k: int, reach: np.ndarray):
    """``(query row, point row, distance)`` of the k closest other points within ``reach``, and maybe of more.

    The fast expansion only shortlists; distances are recomputed from differences, and the
    shortlist is wide enough for the rounding of the expansion.
    """
    squared = (queries**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * queries @ points.T
    slack = 1e-12 * ((queries**2).sum(1)[:, None] + (points**2).sum(1).max()) + 1e-300
    with np.errstate(over="ignore"):
        within = squared <= (reach**2)[:, None] + 2 * slack
    if np.count_nonzero(within) > SHORTLIST * k * len(queries):
        kept = min(k + 1, points.shape[0])  # one more: a point may be the query itself
        within &= squared <= np.partition(squared, kept - 1, axis=1)[:, [kept - 1]] + 2 * slack
    qi, si = np.nonzero(within)
    exact = np.sqrt(((queries[qi] - points[si]) ** 2).sum(1))
    same = (queries[qi] == points[si]).all(1)
    keep = ~same & (exact <= reach[qi] * (1 + 1e-12))
    return qi[keep], si[keep], exact[keep]


class _Nearest:
    """The k closest points met so far by each query of a chunk; ties in distance go to the smaller place."""

    def __init__(self, queries: np.ndarray, points: np.ndarray, k: int, reach: np.ndarray):
        self.queries, self.points, self.k, self.limit = queries, points, k, reach.copy()
        self.dist = np.full((len(queries), k), np.inf)
        self.place = np.full((len(queries), k), len(points))

    def meet(self, rows: np.ndarray, places: np.ndarray) -> None:
        """Compare some queries with some points, each pair once over all calls."""
        for at in range(0, len(places), CHUNK_ROWS):
            some = places[at : at + CHUNK_ROWS]
            step = max(1, STEP // len(some))
            for start in range(0, len(rows), step):
                self._merge(rows[start : start + step], some)

    def _merge(self, rows: np.ndarray, places: np.ndarray) -> None:
        k = self.k
        qi, si, dist = _closest(self.queries[rows], self.points[places], k, self.limit[rows])
        if not len(qi):
            return
        order = np.lexsort((places[si], dist, qi))
        qi, si, dist = qi[order], si[order], dist[order]
        asked, first, counts = np.unique(qi, return_index=True, return_counts=True)
        rank = np.arange(len(qi)) - np.repeat(first, counts)
        line, top = np.repeat(np.arange(len(asked)), counts), rank < k
        found, found_at = np.full((len(asked), k), np.inf), np.full((len(asked), k), len(self.points))
        found[line[top], rank[top]], found_at[line[top], rank[top]] = dist[top], places[si[top]]
        asked = rows[asked]
        dist, place = np.hstack([self.dist[asked], found]), np.hstack([self.place[asked], found_at])
        best = np.lexsort((place, dist), axis=1)[:, :k]
        self.dist[asked], self.place[asked] = np.take_along_axis(dist, best, 1), np.take_along_axis(place, best, 1)
        self.limit[asked] = np.minimum(self.limit[asked], self.dist[asked, -1])


def _by_vector(points: np.ndarray) -> np.ndarray:
    """The order of the rows by their numbers from left to right."""
    order = np.argsort(points[:, 0], kind="stable") if points.shape[1] else np.arange(len(points))
    if points.shape[1] > 1 and not (np.diff(points[order, 0]) > 0).all():
        order = np.lexsort(points.T[::-1])
    return order


def _search(asked: DataFrame, placed: DataFrame, k: int, types: dict[str, str], choose: Callable) -> DataFrame:
    """The columns ``types`` of ``asked`` and ``s: array<struct<dist, y, m>>``: for each row the closest points of its ``(g, block, a)``.

    ``choose(q, x, cells)`` tells for some rows of ``asked``, their vectors and the block's cells which pairs of rows and
    cells are compared: a list of ``(cell index, rows)`` to begin with, and a function of the cell index and each row's
    bound so far for the rest.
    """

    def block(q: pa.Table, p: pa.Table) -> pa.Table:
        names = [*types]
        n = q.num_rows
        taken, counts, dists = [], np.zeros(n, int), []
        if n and p.num_rows:
            points = _matrix(p.column("x"))
            order = _by_vector(points)
            p, points = p.take(pa.array(order)), points[order]
            cells, cell = np.unique(p.column("cell").to_numpy(), return_inverse=True)
            inside = np.split(np.argsort(cell, kind="stable"), np.cumsum(np.bincount(cell))[:-1])
            for lo in range(0, n, CHUNK_ROWS):
                part = q.slice(lo, CHUNK_ROWS)
                x = _matrix(part.column("x"))
                if x.shape[1] != points.shape[1]:
                    raise ValueError("vectors are missing or differ in width")
                reach = part.column("reach").to_numpy().astype(float)
                near = _Nearest(x, points, k, reach)
                first, later = choose(part, x, cells)
                for c, rows in first:
                    near.meet(rows, inside[c])
                for c in range(len(cells)):
                    near.meet(later(c, near.limit), inside[c])
                met = near.place < len(points)
                counts[lo : lo + len(x)] = met.sum(1)
                taken.append(near.place[met])
                dists.append(near.dist[met])
        places = np.concatenate(taken) if taken else np.array([], int)
        chosen = p.select(["x", "m"]).take(pa.array(places)).combine_chunks()
        held = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in (chosen.column("x"), chosen.column("m"))]
        listed = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(dists) if dists else np.array([], float)), *held], names=["dist", "y", "m"]
        )
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return q.select(names).append_column("s", pa.ListArray.from_arrays(ends, listed))

    keys = ["g", "block", "a"]
    needed = [*dict.fromkeys([*keys, *types, "x", "reach", *[c for c in ("cell", "base", "bits") if c in asked.columns]])]
    both = asked.select(*needed).groupBy(*keys).cogroup(placed.select(*keys, "x", "m", "cell").groupBy(*keys))
    told = ", ".join(f"{name} {kind}" for name, kind in types.items())
    return both.applyInArrow(block, f"{told}, s array<struct<dist: double, y: array<double>, m: bigint>>")


def _united(found: DataFrame, k: int) -> DataFrame:
    """``g, x, s``: the k closest of a query's lists, in order."""
    united = found.groupBy("g", "x").agg(F.flatten(F.collect_list("s")).alias("s"))
    return united.select("g", "x", F.slice(F.sort_array("s"), 1, k).alias("s"))


def _listed(found: DataFrame, group: str, vector: str) -> DataFrame:
    """The rows of ``nearest_vectors`` from ``g, x, s``; a query without a neighbour has none."""
    return found.filter(F.size("s") > 0).select(
        F.col("g").alias(group),
        F.col("x").alias(vector),
        F.transform("s", lambda s: F.struct(s["y"].alias("y"), s["m"].alias("m"), s["dist"].alias("dist"))).alias("neighbors"),
    )


def _rows_of(width: int, bytes_: int, least: int, most: int = BLOCK_ROWS) -> int:
    return max(least, min(most, bytes_ // (8 * max(width, 1))))


def _width(rows: DataFrame) -> int:
    return rows.agg(F.max(F.size("x"))).first()[0] or 1


def _blocks(shape: DataFrame, rows: int) -> DataFrame:
    """``shape`` with ``lo, blocks`` of each cell: cells in order, packed; one of more than ``rows`` is spread over several."""
    before = W.partitionBy("g").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    lo = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / rows).cast("int")
    return shape.withColumns({"lo": lo, "blocks": F.ceil(F.col("n") / rows).cast("int")})


def _in_block(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """Rows with the ``block`` of their cell that their hash picks."""
    picked = F.col("lo") + F.pmod(F.xxhash64("x", F.lit(7)), F.col("blocks").cast("long")).cast("int")
    return rows.join(shape.select("g", "cell", "lo", "blocks"), ["g", "cell"]).withColumn("block", picked).drop("lo", "blocks")


def _chunk(chunks: str):
    return F.pmod(F.xxhash64("x", F.lit(11)), F.col(chunks).cast("long")).cast("int").alias("a")


def _spread(chunks: str):
    return F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)).alias("a")


def _chunks(rows: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """``keys, chunks``: over how many chunks of about ``chunk`` rows the queries of a key are dealt."""
    return settle(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")))


def nearest_vectors(
    points: DataFrame, queries: DataFrame, k: int, group: str, vector: str, weight: str,
    cell_rows: int = CELL_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``group, vector, neighbors: array<struct<y, m, dist>>``: the k closest other points of the group.

    ``points`` and ``queries`` hold distinct vectors per group; ``queries`` is part of ``points``.
    Neighbours come in order of distance, with their ``weight`` as ``m``.  Chunks and blocks hold ``chunk_rows`` rows, or
    more where ``CHUNK_BYTES`` and ``BLOCK_BYTES`` have room for more.
    """
    group_type = points.schema[group].dataType.simpleString()
    # groups are read through Arrow, as tasks see them
    counts = points.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n")).filter("g is not null")
    sizes = {r["g"]: r["n"] for r in counts.toArrow().to_pylist()}
    pivots = _pivots(points, sizes, group, vector, cell_rows)
    placed = durable(_assign(points, pivots, group, vector, weight, group_type), "cells")
    if queries is points:
        asked = placed.drop("m").toDF("g", "x", "cell", "d")
    else:
        asked = durable(
            _assign(queries.withColumn("__w", F.lit(0).cast("long")), pivots, group, vector, "__w", group_type), "asked"
        ).drop("m")
    width = _width(placed)
    chunk = _rows_of(width, CHUNK_BYTES, chunk_rows)
    shape = placed.filter("g is not null").groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius"))
    shape = settle(_blocks(shape, _rows_of(width, BLOCK_BYTES, chunk_rows)))
    plan: dict = {}  # cells of the groups that have pivots or several blocks
    last = W.partitionBy("g")
    wide = shape.withColumn("all", F.max(F.col("lo") + F.col("blocks")).over(last))
    for r in wide.filter((F.col("all") > 1) | F.col("g").isin(list(pivots))).toArrow().to_pylist():
        plan.setdefault(r["g"], {})[r["cell"]] = (r["radius"], r["lo"], r["blocks"])
    several = {g for g, cells in plan.items() if max(lo + n for _, lo, n in cells.values()) > 1}

    placed, asked = _in_block(placed, shape), _in_block(asked, shape)
    load = _chunks(asked, ["g", "block"], chunk)
    right = placed.join(load, ["g", "block"]).select("*", _spread("chunks"))
    left = asked.withColumn("reach", F.lit(float("inf"))).join(load, ["g", "block"]).select("*", _chunk("chunks"))
    kept = {"g": group_type, "x": "array<double>"}
    home = _search(left, right, k, {**kept, "cell": "int", "block": "int"}, _choice(pivots, plan, True))
    if not several:
        return _listed(home, group, vector)
    home = durable(home, "home")
    reached = home.filter(F.col("g").isin(list(several)))
    bound = F.when(F.size("s") >= k, F.element_at("s", -1)["dist"]).otherwise(F.lit(float("inf")))
    probes = _probe(reached.withColumn("reach", bound), pivots, plan, group_type)
    load = _chunks(reached, ["g"], chunk)
    right = placed.join(load, "g").select("*", _spread("chunks"))
    left = probes.join(load, "g").select("*", _chunk("chunks"))
    away = _search(left, right, k, kept, _choice(pivots, plan, False))
    best = _united(home.filter(F.col("g").isin(list(several))).select("g", "x", "s").unionByName(away), k)
    return _listed(home.filter(~F.col("g").isin(list(several))).select("g", "x", "s").unionByName(best), group, vector)


def _choice(pivots: dict, plan: dict, own_first: bool) -> Callable:
    """What a query is compared with: its own cell, then the cells that may hold a point within its bound."""

    def choose(q: pa.Table, x: np.ndarray, cells: np.ndarray):
        g, own = q.column("g")[0].as_py(), q.column("cell").to_numpy()
        if g not in pivots:
            return [], lambda c, limit: np.arange(len(x))
        dist = _distances(x, pivots[g][cells])
        radius = np.array([plan[g][c][0] for c in cells.tolist()])
        gap = _gap(dist, radius)
        mine = own[:, None] == cells[None, :]
        first = [(c, np.flatnonzero(mine[:, c])) for c in np.flatnonzero(mine.any(0))] if own_first else []
        if own_first:
            gap[mine] = np.inf
        else:
            gap[mine] = -np.inf
        return first, lambda c, limit: np.flatnonzero((gap[:, c] <= limit * (1 + 1e-9)) & (gap[:, c] < np.inf))

    return choose


def _gap(dist: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How close a point of a cell may be to a query at this distance from its pivot, with room for rounding."""
    return dist - radius[None, :] - 1e-6 * (1 + dist)


def _pivots(points, sizes, group, vector, cell_rows) -> dict:
    """Pivot vectors per group that needs more than one cell; their total size is bounded."""
    big = {g: n for g, n in sizes.items() if n > cell_rows}
    if not big:
        return {}
    width = len(points.select(vector).first()[0])
    most = min(MAX_PIVOTS, PIVOT_BYTES // (8 * width * len(big)))
    if most < 2:
        return {}
    order = W.partitionBy(group).orderBy(F.xxhash64(vector), vector)
    head = points.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= most)
    chosen: dict = {}
    for r in head.select(F.col(group).alias("g"), F.col(vector).alias("x"), "__rank").toArrow().to_pylist():
        if r["g"] in big and r["__rank"] <= -(-big[r["g"]] // cell_rows):
            chosen.setdefault(r["g"], []).append((r["__rank"], r["x"]))
    return {g: np.array([v for _, v in sorted(rows)], dtype=float) for g, rows in chosen.items()}


def _assign(df, pivots, group, vector, weight, group_type) -> DataFrame:
    """``g, x, m, cell, d``: the closest pivot and its distance (cell 0, distance 0 without pivots)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.array(batch.column(0).to_pylist(), dtype=object)
            cell, near = np.zeros(len(groups), dtype=np.int32), np.zeros(len(groups))
            for g, centers in pivots.items():
                rows = np.flatnonzero(groups == g)
                if len(rows):
                    values = _matrix(batch.column(1).take(pa.array(rows)))
                    dist = _distances(values, centers)
                    cell[rows], near[rows] = dist.argmin(1), dist.min(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(near)], names=["g", "x", "m", "cell", "d"]
            )

    narrow = df.select(
        F.col(group).alias("g"), F.col(vector).cast("array<double>").alias("x"), F.col(weight).cast("long").alias("m")
    )
    return narrow.mapInArrow(place, f"g {group_type}, x array<double>, m bigint, cell int, d double")


def _probe(reached, pivots, plan, group_type) -> DataFrame:
    """``g, x, cell, reach, block``: the other blocks each query still has to look into, with its own cell."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.array(batch.column(0).to_pylist(), dtype=object)
            own, home, reach = (batch.column(i).to_numpy() for i in (2, 3, 4))
            for g, cells in plan.items():
                rows = np.flatnonzero(groups == g)
                if not len(rows):
                    continue
                ids = np.array(sorted(cells))
                radius, lo, blocks = (np.array([cells[c][i] for c in ids.tolist()]) for i in range(3))
                holds = np.arange((lo + blocks).max())[None, :] >= lo[:, None]
                holds &= np.arange((lo + blocks).max())[None, :] < (lo + blocks)[:, None]
                for start in range(0, len(rows), 1024):
                    part = rows[start : start + 1024]
                    if g in pivots:
                        values = _matrix(batch.column(1).take(pa.array(part)))
                        near = _gap(_distances(values, pivots[g][ids]), radius) <= reach[part][:, None] * (1 + 1e-9)
                        near |= own[part][:, None] == ids[None, :]
                    else:
                        near = np.ones((len(part), len(ids)), bool)
                    need = near.astype(np.float32) @ holds.astype(np.float32) > 0
                    need[np.arange(len(part)), home[part]] = False
                    qi, block = np.nonzero(need)
                    for lo_row in range(0, len(qi), 10_000):
                        some = part[qi[lo_row : lo_row + 10_000]]
                        taken = pa.array(some)
                        yield pa.RecordBatch.from_arrays(
                            [
                                *[batch.column(i).take(taken) for i in range(3)],
                                pa.array(reach[some]),
                                pa.array(block[lo_row : lo_row + 10_000].astype(np.int32)),
                            ],
                            names=["g", "x", "cell", "reach", "block"],
                        )

    return reached.select("g", "x", "cell", "block", "reach").mapInArrow(
        probe, f"g {group_type}, x array<double>, cell int, reach double, block int"
    )
