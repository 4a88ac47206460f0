"""Approximate nearest neighbours among distinct points of the same group, by two levels of pivots.

A group of n points has about sqrt(n / cell_rows) top pivots, and every top cell one pivot per ``cell_rows`` points of its
own, so neither list grows faster than the root of the group.  Points reach their cells by two joins: chunks of bounded
size meet the pivots they choose from.  A query visits the closest top cells, and of the pivots in these the closest leaves.

How many are visited is measured, not assumed: up to ``SAMPLE`` queries of each group are compared with all its points, in
blocks, and visits are the fewest that find ``target`` of their true neighbours.  Queries that met fewer than ``k`` points
though there are more are compared with all points of their group, in blocks.

Cells are packed into blocks of bounded bytes.  A task that routes queries holds the pivots of their group, and names the cells
a query visits in one row per block, as bits; no row is made per visit.  The task that compares them emits one row per query.

Points without a group or a vector take no part.  Ties in distance go to the smaller vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.operators.neighbors import (
    BLOCK_BYTES,
    CELL_ROWS,
    CHUNK_BYTES,
    CHUNK_ROWS,
    _blocks,
    _chunk,
    _chunks,
    _distances,
    _in_block,
    _listed,
    _matrix,
    _rows_of,
    _search,
    _spread,
    _united,
    _width,
)
from tidewell.session import durable, settle

SAMPLE = 100
TARGET = 0.96  # of the sample's neighbours, in the leaves visited
TOP_TARGET = 0.99  # of the sample's neighbours, in the top cells visited
ROUTED_ROWS = 20_000  # rows that leave one task's chunk
NOWHERE = 1 << 30  # rank of a cell that is not visited


def _first_rows(rows: DataFrame, keys: list[str], wanted: DataFrame, seed: int) -> DataFrame:
    """``wanted`` rows of each key, first in the order of a hash: the same on every run; ``at`` counts them from 0."""
    most = wanted.agg(F.max("wanted")).first()[0] or 0
    order = W.partitionBy(*keys).orderBy(F.xxhash64("x", F.lit(seed)), "x")
    head = rows.withColumn("at", F.row_number().over(order) - 1).filter(F.col("at") < int(most))
    return head.join(wanted, keys).filter(F.col("at") < F.col("wanted")).select(*keys, F.col("at").cast("int"), "x")


def _routed(rows: DataFrame, pivots: DataFrame, group_type: str) -> DataFrame:
    """``g, top, x, m, at, d``: each row with the ``best`` closest pivots of its ``(g, top)`` and their distances."""
    keys = ["g", "top"]
    load = rows.groupBy(*keys).agg(F.ceil(F.sum("best") / ROUTED_ROWS).alias("chunks"))
    load = settle(load.withColumn("chunks", F.greatest("chunks", F.lit(1).cast("long"))))
    left = rows.join(load, keys).withColumn("chunk", F.pmod(F.xxhash64("x", F.lit(5)), F.col("chunks")))
    right = pivots.join(load, keys).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))

    def route(part: pa.Table, centers: pa.Table) -> pa.Table:
        part, centers = part.combine_chunks(), centers.combine_chunks().sort_by("at")
        if not part.num_rows or not centers.num_rows:
            rows, cells, near = np.array([], int), np.array([], np.int32), np.array([])
        else:
            c, x = _matrix(centers.column("x")), _matrix(part.column("x"))
            best = np.minimum(part.column("best").to_numpy(), len(c))
            rows, cells, near = [], [], []
            for lo in range(0, len(x), max(1, (1 << 21) // len(c))):
                some = slice(lo, lo + max(1, (1 << 21) // len(c)))
                dist = _distances(x[some], c)
                order = np.argsort(dist, axis=1, kind="stable")
                i, j = np.nonzero(np.arange(len(c))[None, :] < best[some, None])
                rows.append(i + lo)
                cells.append(order[i, j])
                near.append(dist[i, order[i, j]])
            rows, cells, near = (np.concatenate(a) for a in (rows, cells, near))
        kept = part.select(["g", "top", "x", "m"]).take(pa.array(rows))
        return kept.append_column("at", pa.array(cells.astype(np.int32))).append_column("d", pa.array(near))

    chunk = [*keys, "chunk"]
    both = left.select(*chunk, "x", "m", "best").groupBy(*chunk).cogroup(right.select(*chunk, "at", "x").groupBy(*chunk))
    return both.applyInArrow(route, f"g {group_type}, top bigint, x array<double>, m bigint, at int, d double")


def _leaf(top: str, at: str):
    return F.shiftleft(F.col(top).cast("long"), 32) + F.col(at)


class _Pivots:
    """The pivots of a group in one task: its leaves in order of ``(top, at)``, the cells they stand for and their blocks."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks().sort_by([("leaf", "ascending"), ("top", "ascending"), ("at", "ascending")])
        leaf = rows.column("leaf").to_numpy(zero_copy_only=False).astype(bool)
        x, top, at = _matrix(rows.column("x")), rows.column("top").to_numpy(), rows.column("at").to_numpy()
        self.tops, self.leaves, self.top = x[~leaf], x[leaf], top[leaf]
        self.cells = (self.top << 32) + at[leaf]
        self.blocks = [rows.column(c).to_numpy()[leaf] for c in ("lo", "blocks", "ord")]

    def ranks(self, x: np.ndarray, tops: int) -> np.ndarray:
        """How many leaves come before a leaf for a row, of those in its ``tops`` closest top cells; NOWHERE outside of these."""
        near = np.argsort(_distances(x, self.tops), axis=1, kind="stable")[:, :tops]
        dist = np.full((len(x), len(self.leaves)), np.inf)
        for t in np.unique(near):
            rows, inside = np.flatnonzero((near == t).any(1)), np.flatnonzero(self.top == t)
            if len(inside):
                dist[np.ix_(rows, inside)] = _distances(x[rows], self.leaves[inside])
        ranks = np.empty(dist.shape, np.int64)
        np.put_along_axis(ranks, np.argsort(dist, axis=1, kind="stable"), np.arange(dist.shape[1])[None, :], 1)
        return np.where(np.isfinite(dist), ranks, NOWHERE)

    def steps(self, rows: int) -> list[slice]:
        step = max(1, (1 << 20) // max(1, len(self.leaves)))
        return [slice(lo, lo + step) for lo in range(0, rows, step)]


def _all_pivots(tops: DataFrame, leaves: DataFrame, shape: DataFrame) -> DataFrame:
    """``g, leaf, top, at, x, lo, blocks, ord``: a group's pivots, leaves with the blocks that hold their cells."""
    none = {c: F.lit(0).alias(c) for c in ("lo", "blocks", "ord")}
    first = tops.select("g", F.lit(False).alias("leaf"), "top", "at", "x", *none.values())
    held = shape.select("g", "cell", "lo", "blocks", "ord")
    second = leaves.withColumn("cell", _leaf("top", "at")).join(held, ["g", "cell"], "left").select(
        "g", F.lit(True).alias("leaf"), "top", "at", "x", *[F.coalesce(c, F.lit(0)).alias(c) for c in none]
    )
    return first.unionByName(second)


def _sampled_ranks(truth: DataFrame, pivots: DataFrame, plan: DataFrame, group_type: str) -> DataFrame:
    """``g, rank``: of each true neighbour's cell among the leaves that its query could visit in its ``tops`` top cells."""
    asked = truth.groupBy("g", "x").agg(F.collect_list("cell").alias("cells")).join(plan.select("g", "tops"), "g")

    def ranked(q: pa.Table, p: pa.Table) -> pa.Table:
        out, keys = [], []
        if q.num_rows and p.num_rows:
            held = _Pivots(p)
            x, tops, cells = _matrix(q.column("x")), q.column("tops")[0].as_py(), q.column("cells").to_pylist()
            for some in held.steps(len(x)):
                ranks = held.ranks(x[some], tops)
                for line, wanted in zip(ranks, cells[some]):
                    out.append(np.minimum(line[np.searchsorted(held.cells, wanted)] + 1, NOWHERE))
            keys = [q.column("g")[0].as_py()] * sum(map(len, out))
        ranks = np.concatenate(out) if out else np.array([], int)
        return pa.table({"g": pa.array(keys, q.schema.field("g").type), "rank": pa.array(ranks.astype(np.int32))})

    both = asked.select("g", "x", "tops", "cells").groupBy("g").cogroup(pivots.groupBy("g"))
    return both.applyInArrow(ranked, f"g {group_type}, rank int")


def _visits(asked: DataFrame, pivots: DataFrame, plan: DataFrame, chunk: int, group_type: str) -> DataFrame:
    """``g, x, block, base, bits``: the cells of a block that a query visits, by their ``ord`` from ``base``; at least one row per query.

    It visits the closest ``leaves`` of the leaves in its ``tops`` closest top cells.
    """
    load = _chunks(asked, ["g"], chunk)
    left = asked.join(plan, "g").join(load, "g").select("g", "x", "tops", "leaves", _chunk("chunks"))
    right = pivots.join(load, "g").select("*", _spread("chunks"))

    def visits(q: pa.Table, p: pa.Table) -> pa.Table:
        rows, blocks, bases, bits = [np.array([], int)], [np.array([], int)], [np.array([], int)], []
        if q.num_rows and p.num_rows:
            held, x = _Pivots(p), _matrix(q.column("x"))
            tops, leaves = q.column("tops")[0].as_py(), q.column("leaves")[0].as_py()
            lo, spread, ord_ = held.blocks
            for some in held.steps(len(x)):
                seen = held.ranks(x[some], tops) < leaves
                unseen = np.ones(len(seen), bool)
                for b in range(max(lo + spread, default=0)):
                    inside = np.flatnonzero((lo <= b) & (b < lo + spread))  # in order: a block holds consecutive cells
                    met = np.flatnonzero(seen[:, inside].any(1))
                    unseen[met] = False
                    rows.append(met + some.start)
                    blocks.append(np.full(len(met), b))
                    bases.append(np.full(len(met), ord_[inside[0]] if len(inside) else 0))
                    bits += [line.tobytes() for line in np.packbits(seen[np.ix_(met, inside)], axis=1, bitorder="little")]
                left_over = np.flatnonzero(unseen)
                rows.append(left_over + some.start)
                blocks.append(np.zeros(len(left_over), int))
                bases.append(np.zeros(len(left_over), int))
                bits += [b""] * len(left_over)
        kept = q.select(["g", "x"]).take(pa.array(np.concatenate(rows)))
        for name, numbers in (("block", blocks), ("base", bases)):
            kept = kept.append_column(name, pa.array(np.concatenate(numbers).astype(np.int32)))
        return kept.append_column("bits", pa.array(bits, pa.binary()))

    both = left.groupBy("g", "a").cogroup(right.groupBy("g", "a"))
    return both.applyInArrow(visits, f"g {group_type}, x array<double>, block int, base int, bits binary")


def _by_bits(q: pa.Table, x: np.ndarray, cells: np.ndarray):
    """The pairs of rows and cells that ``bits`` name; cells are numbered by ``ord``, bits from ``base``."""
    named = q.column("bits").to_pylist()
    width = max(1, max(map(len, named)))
    bits = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in named), np.uint8).reshape(len(x), width)
    seen = np.unpackbits(bits, axis=1, bitorder="little").astype(bool)
    base = q.column("base").to_numpy()

    def visited(c: int, limit: np.ndarray) -> np.ndarray:
        at = cells[c] - base
        inside = (at >= 0) & (at < seen.shape[1])
        return np.flatnonzero(inside & seen[np.arange(len(x)), np.where(inside, at, 0)])

    return [], visited


def _everywhere(q: pa.Table, x: np.ndarray, cells: np.ndarray):
    return [], lambda c, limit: np.arange(len(x))


def _met(asked: DataFrame, placed: DataFrame, load: DataFrame, k: int, group_type: str, choose) -> DataFrame:
    """``g, x, s``: the closest points of each query in the blocks it is listed for, which hold ``cell`` numbers of ``placed``."""
    left = asked.withColumn("reach", F.lit(float("inf"))).join(load, "g").select("*", _chunk("chunks"))
    right = placed.join(load, "g").select("*", _spread("chunks"))
    return _search(left, right, k, {"g": group_type, "x": "array<double>"}, choose)


def _scanned(asked: DataFrame, points: DataFrame, sizes: DataFrame, k: int, group_type: str, chunk: int, block: int) -> DataFrame:
    """``g, x, s``: the true neighbours of ``asked``, each compared with all points of its group, in blocks."""
    whole = _blocks(sizes.select("g", F.lit(0).alias("cell"), "n"), block)
    placed = _in_block(points.withColumn("cell", F.lit(0)), whole)
    every = asked.join(whole, "g").select("g", "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return _united(_met(every, placed, _chunks(asked, ["g"], chunk), k, group_type, _everywhere), k)


def _share(rank: str, share: float):
    """The smallest rank that ``share`` of the rows do not exceed."""
    return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY {rank})").cast("int")


def approximate_vectors(
    points: DataFrame, queries: DataFrame, k: int, group: str, vector: str, weight: str,
    target: float = TARGET, cell_rows: int = CELL_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(neighbors, report)``: the rows of ``nearest_vectors``, and what was visited per group.

    ``report``: ``group, n, cells, tops, leaves, sampled, recall``, the recall being that of the sampled queries.
    """
    group_type = points.schema[group].dataType.simpleString()
    columns = [F.col(group).alias("g"), F.col(vector).cast("array<double>").alias("x")]
    rows = durable(points.select(*columns, F.col(weight).cast("long").alias("m")).filter("g is not null and x is not null"), "points")
    if queries is points:
        asked = rows.select("g", "x")
    else:
        asked = durable(queries.select(*columns).filter("g is not null and x is not null"), "asked")
    width = _width(rows)
    chunk, packed = _rows_of(width, CHUNK_BYTES, chunk_rows), _rows_of(width, BLOCK_BYTES, chunk_rows)

    sizes = settle(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    zero = F.lit(0).cast("long")
    wanted = settle(sizes.select("g", F.ceil(F.sqrt(F.ceil(F.col("n") / cell_rows))).alias("wanted")))
    tops = durable(_first_rows(rows, ["g"], wanted, 1).select("g", zero.alias("top"), "at", "x"), "tops")
    one = F.lit(1)
    placed = _routed(rows.select("g", zero.alias("top"), "x", "m", one.alias("best")), tops, group_type)
    placed = durable(placed.select("g", F.col("at").cast("long").alias("top"), "x", "m"), "placed")
    inner = settle(placed.groupBy("g", "top").agg(F.ceil(F.count(F.lit(1)) / cell_rows).alias("wanted")))
    leaves = durable(_first_rows(placed, ["g", "top"], inner, 2), "leaves")
    cells = _routed(placed.withColumn("best", one), leaves, group_type)
    cells = durable(cells.select("g", "x", "m", "top", _leaf("top", "at").alias("cell")), "cells")
    shape = _blocks(cells.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n")), packed)
    shape = settle(shape.withColumn("ord", F.row_number().over(W.partitionBy("g").orderBy("cell")) - 1))
    pivots = durable(_all_pivots(tops, leaves, shape), "pivots")

    # the fewest visits that find the neighbours of a sample
    # in an order of its own: pivots lie at the centre of their cells and would promise too much
    wish = settle(sizes.select("g", F.lit(SAMPLE).alias("wanted")))
    some = durable(_first_rows(asked, ["g"], wish, 3).select("g", "x"), "sample")
    truth = _scanned(some, rows, sizes, k, group_type, chunk, packed).select("g", "x", F.explode("s.y").alias("y"))
    home = cells.select("g", F.col("x").alias("y"), "top", "cell")
    truth = durable(truth.join(home, ["g", "y"]), "truth")
    start = some.join(wanted, "g").select("g", zero.alias("top"), "x", zero.alias("m"), F.col("wanted").cast("int").alias("best"))
    order = W.partitionBy("g", "x").orderBy("d", "at")
    near = _routed(start, tops, group_type)
    near = near.select("g", "x", F.col("at").cast("long").alias("top"), F.row_number().over(order).alias("rank"))
    plan = truth.join(near, ["g", "x", "top"]).groupBy("g").agg(_share("rank", TOP_TARGET).alias("tops"))
    plan = settle(sizes.select("g").join(plan, "g", "left").select("g", F.coalesce("tops", one).alias("tops")))
    most = settle(inner.groupBy("g").agg(F.max("wanted").cast("int").alias("each"), F.sum("wanted").alias("cells")))
    wide = plan.join(most, "g").select("g", (F.col("tops") * F.col("each")).cast("int").alias("all"))
    met = durable(_sampled_ranks(truth, pivots, plan, group_type), "met")
    fitted = met.groupBy("g").agg(_share("rank", target).alias("leaves"), F.count(F.lit(1)).alias("sampled"))
    plan = plan.join(fitted, "g", "left").select("g", "tops", F.coalesce("leaves", one).alias("leaves"), F.coalesce("sampled", zero).alias("sampled"))
    # a target that these top cells miss takes all their leaves
    plan = settle(plan.join(wide, "g").withColumn("leaves", F.least("leaves", "all")).drop("all"))
    recall = met.join(plan, "g").groupBy("g").agg(F.avg((F.col("rank") <= F.col("leaves")).cast("double")).alias("recall"))
    report = plan.join(sizes, "g").join(most, "g").join(recall, "g", "left").select(
        F.col("g").alias(group), "n", "cells", "tops", "leaves", "sampled", "recall"
    )

    visits = durable(_visits(asked, pivots, plan.select("g", "tops", "leaves"), chunk, group_type), "visits")
    placed = _in_block(cells.drop("top"), shape).join(shape.select("g", "cell", "ord"), ["g", "cell"])
    placed = placed.select("g", "x", "m", "block", F.col("ord").alias("cell"))
    found = _met(visits, placed, _chunks(asked, ["g"], chunk), k, group_type, _by_bits)
    if shape.agg(F.max(F.col("lo") + F.col("blocks"))).first()[0] not in (None, 1):
        found = _united(found, k)
    found = durable(found, "found")
    lacks = F.size("s") < F.least(F.lit(k).cast("long"), F.col("n") - 1)
    found = found.join(sizes, "g").withColumn("short", lacks)
    short = durable(found.filter("short").select("g", "x"), "short")
    found = found.filter("not short").select("g", "x", "s")
    if not short.isEmpty():
        found = found.unionByName(_scanned(short, rows, sizes, k, group_type, chunk, packed))
    neighbors = _listed(found, group, vector)
    return neighbors, report
