"""Class imbalance: weights, and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import missing, ref
from tidewell.operators.approximate import approximate_vectors
from tidewell.operators.grouping import attach
from tidewell.operators.neighbors import nearest_vectors
from tidewell.operators.running import running_totals
from tidewell.session import durable, settle

NEIGHBORS = 5  # fixed value: neighbours a synthetic row may lean towards
SEED = 42  # fixed value
_CHUNK = 1000
_UNIT = float(1 << 53)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, n, weight`` with weight = N / (classes * n)."""
    counts = settle(df.groupBy(ref(label)).agg(F.count(F.lit(1)).alias("n")))
    totals = counts.agg(F.sum("n").alias("__rows"), F.count(F.lit(1)).alias("__classes"))
    return attach(counts, totals, []).select(
        ref(label), "n", (F.col("__rows") / (F.col("__classes") * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(ref(label), F.col("weight").alias(output))
    return attach(df, settle(weights), [label])


def smote(
    df: DataFrame, features: Sequence[str], label: str, k: int = NEIGHBORS, seed: int = SEED, approximate: bool = False
) -> DataFrame:
    """``features..., label, synthetic``: every class raised to the size of the largest.

    A synthetic row is ``x + u * (nn - x)`` with ``nn`` one of the ``k`` nearest other rows of the
    class of ``x`` and ``u`` uniform in [0, 1).  Seeds are spread evenly over the rows of a class;
    ``nn`` and ``u`` are hashes of the row and copy number, so a retried task makes the same rows.
    A class smaller than ``k + 1`` uses the neighbours it has; a class of one row is an error.

    Equal rows are handled as one point with a multiplicity, so copies cost nothing.  With ``approximate`` neighbours
    come from ``approximate_vectors``: nearly all of them the nearest, without comparing a large class with itself.
    """
    known = df.filter(ref(label).isNotNull())
    gaps = known.agg(*[F.count_if(missing(df, c)).alias(c) for c in features]).first()
    if holed := [c for c in features if gaps[c]]:
        raise ValueError(f"missing values in {holed}: fill or drop them first")
    counts = settle(known.groupBy(ref(label).alias("__class")).agg(F.count(F.lit(1)).alias("__size")))
    largest = counts.agg(F.max("__size")).first()[0]
    originals = df.select(*[ref(c).cast("double").alias(c) for c in features], ref(label), F.lit(False).alias("synthetic"))
    if largest is None:
        return originals
    small = counts.filter(F.col("__size") < largest)
    single = small.filter(F.col("__size") == 1).first()
    if single is not None:
        raise ValueError(f"class {single['__class']!r} has one row and no neighbour")
    plan = settle(small.withColumn("__wanted", F.lit(largest) - F.col("__size")))
    rows = df.select(ref(label).alias("__class"), F.array(*[ref(c).cast("double") for c in features]).alias("x"))
    minority = rows.join(plan.select("__class"), "__class", "left_semi")
    points = minority.groupBy("__class", "x").agg(F.count(F.lit(1)).alias("m"))
    points = durable(points.withColumn("vid", F.xxhash64("x")), "points")
    spread = running_totals(points, ["m"], [F.xxhash64("vid", F.lit(seed)), F.col("x")], ["__class"])
    spread = attach(spread, plan, ["__class"])

    def quota(upto):
        return F.floor(upto.cast("decimal(38,0)") * F.col("__wanted") / F.col("__size"))

    before = F.col("m_before")
    copies = (quota(before + F.col("m")) - quota(before)).cast("long")
    seeds = durable(
        spread.withColumn("copies", copies).filter("copies > 0").select("__class", "x", "m", "copies"), "seeds"
    )
    if approximate:
        found, _ = approximate_vectors(points, seeds, k, "__class", "x", "m")
    else:
        found = nearest_vectors(points, seeds, k, "__class", "x", "m")
    leaning = seeds.join(found, ["__class", "x"], "left")
    others = F.coalesce("neighbors", F.expr("cast(array() as array<struct<y:array<double>,m:bigint,dist:double>>)"))
    own = F.array_repeat("x", F.least(F.col("m") - 1, F.lit(k)).cast("int"))
    repeated = F.flatten(
        F.transform(others, lambda s: F.array_repeat(s["y"], F.least(s["m"], F.lit(k)).cast("int")))
    )
    pool = F.slice(F.concat(own, repeated), 1, k)
    chunked = leaning.select(
        "__class",
        "x",
        "copies",
        pool.alias("pool"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _CHUNK))).alias("chunk"),
    )
    # a point with many copies is many chunks, which the round-robin shuffle spreads over tasks
    width = max(1, df.sparkSession.sparkContext.defaultParallelism)
    copy = F.col("chunk") * _CHUNK + F.col("i")
    made = (
        chunked.repartition(width, "x", "chunk")
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("copies") - F.col("chunk") * _CHUNK, F.lit(_CHUNK)) - 1)))
        .withColumn("copy", copy)
    )
    pick = F.pmod(F.xxhash64("x", "copy", F.lit(seed)), F.size("pool").cast("long")).cast("int")
    unit = F.shiftrightunsigned(F.xxhash64("x", "copy", F.lit(seed + 1)), 11) / F.lit(_UNIT)
    placed = made.select("__class", "x", F.get("pool", pick).alias("nn"), unit.alias("u"))
    moved = placed.select("__class", F.zip_with("x", "nn", lambda a, b: a + (b - a) * F.col("u")).alias("z"))
    synthetic = moved.select(
        *[F.col("z")[i].alias(c) for i, c in enumerate(features)],
        F.col("__class").alias(label),
        F.lit(True).alias("synthetic"),
    )
    return originals.unionByName(synthetic)
