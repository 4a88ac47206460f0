"""Exact interpolated quantiles per group and column, without holding a group in one task.

The first scan counts and sketches the values of every group and column at once (``percentile_approx`` merges
map-side in bounded space); one sketch serves all wanted ranks.  Groups of at most ``settle_at`` values then go
through ``percentile`` in one aggregate.  Larger ones get, per wanted rank, the two sketch points that are sure to
enclose it; while too many values lie between them, a round sketches only those and tightens the bracket about
80-fold.  The last scans count the values below each bracket and the distinct values within it, which
gives the exact order statistics.  Runs of one value, however long, collapse in the partial count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.cells import ref
from tidewell.operators.grouping import attach
from tidewell.operators.profile import explode_cells
from tidewell.session import settle

SETTLE_AT = 200_000
GRID = 500
ACCURACY = 10_000


def quantile_values(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    name: str = "q",
    exact: bool = True,
    settle_at: int = SETTLE_AT,
) -> DataFrame:
    """``by..., name: array<double>``, column-major: all probabilities of the first column first."""
    keys = [ref(k) for k in by]
    cells = explode_cells(df, by, columns)
    cells = cells.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    grouped = cells.groupBy(*keys, "pos")
    points = [float(p) for p in probabilities]
    if not exact:
        slots = grouped.agg(F.percentile_approx("v", points, ACCURACY).alias("x"))
    else:
        first = settle(grouped.agg(F.count(F.lit(1)).alias("n"), _sketch(F.col("v")).alias("edges")))
        largest = first.agg(F.max("n")).first()[0] or 0
        if largest <= settle_at:
            slots = grouped.agg(F.percentile("v", points).alias("x"))
        else:
            slots = _narrowed(cells, first, points, by, settle_at)
    absent = F.array(*[F.lit(None).cast("double")] * len(points))
    lookup = slots.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("pos", "x"))).alias("m"))
    ordered = F.concat(*[F.coalesce(F.try_element_at("m", F.lit(i)), absent) for i in range(len(columns))])
    return settle(lookup.select(*keys, ordered.alias(name)))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
    settle_at: int = SETTLE_AT,
) -> DataFrame:
    """Long form: ``by..., column, probability, value``."""
    packed = quantile_values(df, columns, probabilities, by, "q", exact, settle_at)
    slots = [(c, float(p)) for c in columns for p in probabilities]
    return packed.select(*[ref(k) for k in by], F.posexplode("q").alias("slot", "value")).select(
        *[ref(k) for k in by],
        F.element_at(F.array(*[F.lit(c) for c, _ in slots]), F.col("slot") + 1).alias("column"),
        F.element_at(F.array(*[F.lit(p) for _, p in slots]), F.col("slot") + 1).alias("probability"),
        "value",
    )


def _sketch(value):
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _edges(k1, k2, below, m):
    """Grid steps that enclose the ranks ``k1..k2`` among ``m`` sketched values with ``below`` values under them.

    Two steps of margin on both sides cover the sketch's rank error; a rank outside the grid keeps the old edge.
    """
    some = F.greatest(m, F.lit(1))
    left = F.floor((k1 - below) * GRID / some) - 2
    right = F.ceil((k2 - below) * GRID / some) + 2
    left = F.when(m > 0, F.least(F.greatest(left, F.lit(0)), F.lit(GRID))).otherwise(0)
    right = F.when(m > 0, F.least(F.greatest(right, F.lit(0)), F.lit(GRID))).otherwise(GRID)
    return left, right


def _tightened(m, below, lo, hi):
    left, right = _edges(F.col("k1"), F.col("k2"), below, m)
    return {
        "lo": F.when(left > 0, F.element_at("edges", (left + 1).cast("int"))).otherwise(lo),
        "hi": F.when(right < GRID, F.element_at("edges", (right + 1).cast("int"))).otherwise(hi),
        "inside": ((F.greatest(right - left, F.lit(0)) / F.lit(GRID) + 2.0 / ACCURACY) * m).cast("double"),
    }


def _narrowed(cells, first, points, by, settle_at):
    """``by..., pos, x: array<double>`` by bracket narrowing."""
    keys = [*by, "pos"]
    refs = [ref(k) for k in keys]
    at = (F.col("n") - 1) * F.col("p")
    state = (
        first.withColumn("slot", F.explode(F.array(*[F.lit(i) for i in range(len(points))])))
        .withColumn("p", F.element_at(F.array(*[F.lit(p) for p in points]), F.col("slot") + 1))
        .withColumn("k1", F.floor(at))
        .withColumn("k2", F.ceil(at))
        .withColumn("frac", at - F.floor(at))
    )
    open_end = F.lit(None).cast("double")
    state = state.withColumns(_tightened(F.col("n"), F.lit(0), open_end, open_end)).drop("edges", "n", "p")
    state = settle(state)
    while (state.agg(F.max("inside")).first()[0] or 0) > settle_at:
        state = settle(_tighten(cells, state, keys, len(points)))
    bracketed = _with_brackets(cells, state, keys)
    below = _below(bracketed, keys, len(points))
    inner = bracketed.select(*refs, "v", F.explode(F.filter("__b", lambda b: ~_under(b) & ~_over(b))).alias("b"))
    counted = inner.groupBy(*refs, F.col("b.slot").alias("slot"), "v").agg(F.count(F.lit(1)).alias("c"))
    # at most settle_at distinct values and the two edges per slot
    running = W.partitionBy(*refs, "slot").orderBy("v")
    ranked = counted.withColumn("upto", F.sum("c").over(running))
    joined = _beside(ranked, state.select(*refs, "slot", "k1", "k2", "frac"), [*keys, "slot"])
    joined = _beside(joined, below, [*keys, "slot"]).withColumn("upto", F.col("upto") + F.col("below"))
    picked = joined.groupBy(*refs, "slot").agg(
        F.min(F.when(F.col("upto") > F.col("k1"), F.col("v"))).alias("x1"),
        F.min(F.when(F.col("upto") > F.col("k2"), F.col("v"))).alias("x2"),
        F.max("frac").alias("frac"),
    )
    value = F.when(F.col("x1") == F.col("x2"), F.col("x1")).otherwise(
        F.col("x1") + (F.col("x2") - F.col("x1")) * F.col("frac")
    )
    return picked.groupBy(*refs).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", value.alias("x")))), lambda s: s["x"]).alias("x")
    )


def _beside(left, right, keys):
    """Inner join on ``keys`` where NULL matches NULL; columns of ``left`` first."""
    renamed = right.select(
        *[ref(k).alias(f"__s{i}") for i, k in enumerate(keys)], *[ref(c) for c in right.columns if c not in keys]
    )
    same = [ref(k).eqNullSafe(F.col(f"__s{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, same).drop(*[f"__s{i}" for i in range(len(keys))])


def _under(b):
    return b["lo"].isNotNull() & (F.col("v") < b["lo"])


def _over(b):
    return b["hi"].isNotNull() & (F.col("v") > b["hi"])


def _with_brackets(cells, state, keys):
    """Every cell once, next to the brackets of its group and column in order of slot: ``__b``."""
    brackets = state.groupBy(*[ref(k) for k in keys]).agg(
        F.sort_array(F.collect_list(F.struct("slot", "lo", "hi"))).alias("__b")
    )
    return attach(cells, settle(brackets), keys)


def _below(bracketed, keys, slots):
    """``keys..., slot, below``: values under each bracket."""
    counts = bracketed.groupBy(*[ref(k) for k in keys]).agg(
        F.array(*[F.count_if(_under(F.col("__b")[i])) for i in range(slots)]).alias("counts")
    )
    return counts.select(*[ref(k) for k in keys], F.posexplode("counts").alias("slot", "below"))


def _tighten(cells, state, keys, slots):
    """One narrowing round: sketch the strict inside, move both edges, bound what remains."""
    bracketed = _with_brackets(cells, state, keys)
    strictly = F.filter(
        "__b", lambda b: (b["lo"].isNull() | (F.col("v") > b["lo"])) & (b["hi"].isNull() | (F.col("v") < b["hi"]))
    )
    inner = bracketed.select(*[ref(k) for k in keys], "v", F.explode(strictly).alias("b"))
    seen = inner.groupBy(*[ref(k) for k in keys], F.col("b.slot").alias("slot")).agg(
        F.count(F.lit(1)).alias("m"), _sketch(F.col("v")).alias("edges")
    )
    at_most = bracketed.groupBy(*[ref(k) for k in keys]).agg(
        F.array(
            *[
                F.count_if(F.col("__b")[i]["lo"].isNotNull() & (F.col("v") <= F.col("__b")[i]["lo"]))
                for i in range(slots)
            ]
        ).alias("counts")
    )
    at_most = at_most.select(*[ref(k) for k in keys], F.posexplode("counts").alias("slot", "below"))
    renamed = seen.select(*[ref(k).alias(f"__s{i}") for i, k in enumerate(keys)], F.col("slot").alias("__slot"), "m", "edges")
    same = [ref(k).eqNullSafe(F.col(f"__s{i}")) for i, k in enumerate(keys)]
    old = _beside(state.drop("inside"), at_most, [*keys, "slot"])
    old = old.join(renamed, [*same, F.col("slot") == F.col("__slot")], "left")
    m = F.coalesce(F.col("m"), F.lit(0))
    moved = _tightened(m, F.col("below"), F.col("lo"), F.col("hi"))
    return old.select(*[ref(k) for k in keys], "slot", "k1", "k2", "frac", *[c.alias(n) for n, c in moved.items()])
