"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Document statistics (one narrow Arrow pass over the texts) are
standardised and mapped to random Fourier features, which approximate a Gaussian kernel.  Ridge scores come
from normal equations summed per partition; a task emits one Gram matrix, and Spark adds the matrices row by
row, so what reaches the driver is one matrix.  Isotonic regression on training rows that the equations did
not see turns scores into probabilities.

Learning uses at most about ``MAX_TRAIN`` labelled rows, chosen by a hash of ``doc_id`` and spread over at
most ``TRAIN_PARTITIONS`` tasks; rows whose crc32 remainder is held out are never learned from.  Scoring
covers every row.  Null and empty texts have statistics of zero and get a score like any other; rows with a
null or conflicting label teach as they are listed, null labels not at all.  Without any usable label (or
with one class only) every score is that of the constant model: the share of label 1, else 0.5.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import held_out, ids_and_texts, map_batches, sampled
from tidewell.session import durable

MAX_TRAIN = 100_000
TRAIN_PARTITIONS = 32
SLICE = 1_024
FEATURES = 384
LENGTH_SCALE = 3.0
RIDGE = 1e-3
BINS = 512
THRESHOLD = 0.7
SEED = 20_24
SLICE = 1 << 20
PLAIN_PUNCTUATION = ".,;:'’\"()-?"
OTHER, LOWER, UPPER, DIGIT, PLAIN, SYMBOL = range(6)

STATISTICS = (
    "log_words log_chars word_length word_length_spread upper_share digit_share symbol_share punctuation_share "
    "symbol_words distinct_words top_word repeated_neighbours distinct_lines line_words "
    "repeated_pairs capital_words"
).split()


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """Kind of every code point of the first plane; beyond it everything counts as a letter."""
    kinds = np.full(1 << 16, OTHER, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            kinds[code] = UPPER if c.isupper() else LOWER
        elif c.isdigit():
            kinds[code] = DIGIT
        elif c in PLAIN_PUNCTUATION:
            kinds[code] = PLAIN
        elif not (c.isalnum() or c.isspace() or c == "_"):
            kinds[code] = SYMBOL
    return kinds


def statistics(text: str) -> list[float]:
    """Shares and means over the whole text, all bounded or logarithmic."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0, math.log1p(chars)] + [0.0] * (len(STATISTICS) - 2)
    kinds = np.zeros(6, np.int64)
    for at in range(0, chars, SLICE):
        codes = np.frombuffer(text[at : at + SLICE].encode("utf-32-le", "replace"), np.uint32)
        found = character_kinds()[np.minimum(codes, 0xFFFF)]
        kinds += np.bincount(np.where(codes > 0xFFFF, LOWER, found), minlength=6)
    _, lower, upper, digits, plain, symbols = kinds.tolist()
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    later = words[1:]
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(n),
        math.log1p(chars),
        float(min(lengths.mean(), 40.0)),
        float(min(lengths.std(), 40.0)),
        upper / max(1, upper + lower),
        digits / chars,
        symbols / chars,
        (plain + symbols) / chars,
        min(1.0, symbols / n),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, later)) / n,
        len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        1.0 - len(set(zip(words, later))) / (n - 1) if n > 1 else 0.0,
        sum(map(str.isupper, words)) / n,
    ]


def with_statistics(rows: DataFrame, extra: str) -> DataFrame:
    """``text`` and the columns named in the schema ``extra`` -> ``stats array<double>`` and those columns."""
    names = [part.split()[0] for part in extra.split(", ")]

    def make():
        def step(batch):
            found = [statistics(t.as_py()) for t in batch.column(0)]
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), *batch.columns[1:]], names=["stats", *names]
            )

        return step

    return map_batches(rows.select("text", *names), make, f"stats array<double>, {extra}")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _slices(*arrays: np.ndarray):
    """``SLICE`` rows at a time: features are wide, and a worker keeps the memory that it once took."""
    for at in range(0, max(1, len(arrays[0])), SLICE):
        parts = [a[at : at + SLICE] for a in arrays]
        yield parts if len(parts) > 1 else parts[0]


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None
    levels: np.ndarray  # calibration: score level -> probability, piecewise linear
    rates: np.ndarray
    prior: float

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosine and sine features of the standardised statistics, their linear part and a constant."""
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        rng = np.random.default_rng(SEED)
        w = rng.normal(size=(x.shape[1], FEATURES // 2)) / LENGTH_SCALE
        waves = z @ w
        return np.hstack([np.cos(waves), np.sin(waves)]) * np.sqrt(2.0 / FEATURES), z, np.ones((len(z), 1))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.hstack(self.features(part)) @ self.weights for part in _slices(x)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return np.clip(np.interp(self.raw(x), self.levels, self.rates), 0.0, 1.0)


def _summed(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations: every task sums its own Gram matrix, Spark adds them row by row."""
    width = FEATURES + len(STATISTICS) + 1

    def partial(batches):
        gram = np.zeros((width, width + 1))
        for batch in batches:
            if batch.num_rows:
                y = batch.column(1).to_numpy(zero_copy_only=False)
                weight = batch.column(2).to_numpy(zero_copy_only=False)
                for x, ys, ws in _slices(matrix(batch.column(0), len(STATISTICS)), y, weight):
                    z = np.hstack(model.features(x))
                    gram += (z * ws[:, None]).T @ np.hstack([z, ys[:, None]])
        rows = np.arange(width, dtype=np.int32)
        cells = pa.ListArray.from_arrays(
            pa.array(np.arange(0, width * (width + 1) + 1, width + 1, dtype=np.int32)), pa.array(gram.reshape(-1))
        )
        yield pa.RecordBatch.from_arrays([pa.array(rows), cells], names=["row", "cells"])

    def total(group: pa.Table) -> pa.Table:
        cells = matrix(group.column("cells").combine_chunks(), width + 1).sum(0)
        return pa.table({"row": group.column("row").slice(0, 1), "cells": pa.array([cells], pa.list_(pa.float64()))})

    schema = "row int, cells array<double>"
    sums = train.mapInArrow(partial, schema).groupBy("row").applyInArrow(total, schema)
    found = np.array([r.cells for r in sums.orderBy("row").collect()])
    return found[:, :-1], found[:, -1]


def _isotonic(means: np.ndarray, hits: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: non-decreasing rates for levels in ascending order."""
    blocks: list[list[float]] = []
    for h, w in zip(hits.tolist(), weights.tolist()):
        blocks.append([h, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], top)]
    return np.concatenate([np.full(int(n), h / w) for h, w, n in blocks])


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn from ``labels`` (``doc_id, label`` in {0, 1}) of the documents they name.

    The labelled rows that are learned from are a sample of bounded size, so they are broadcast and only the
    texts they name are read for learning.
    """
    usable = labels.select("doc_id", F.col("label").cast("double").alias("y")).filter(
        F.col("y").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & ~held_out()
    )
    chosen = sampled(usable, "doc_id", max_train, usable.count())  # about max_train rows of 16 bytes
    rows = ids_and_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    train = with_statistics(rows.join(F.broadcast(chosen), "doc_id"), "doc_id long, y double")
    train = durable(train.repartition(TRAIN_PARTITIONS, "doc_id"), "train")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3))
    n = len(STATISTICS)
    moments = train.agg(
        F.count("*"), F.sum("y"), *[f(F.col("stats")[i]) for i in range(n) for f in (F.avg, F.stddev_pop)]
    ).first()
    rows, ones = moments[0], moments[1] or 0.0
    prior = ones / rows if rows else 0.5
    if not 0 < ones < rows:
        return Model(np.zeros(n), np.ones(n), None, np.array([0.0]), np.array([prior]), prior)
    mean, spread = np.array(moments[2::2], float), np.array(moments[3::2], float)
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(1), np.array([0.0]), np.array([prior]), prior)
    balance = F.when(F.col("y") == 1, 0.5 / prior).otherwise(0.5 / (1 - prior))
    gram, right = _summed(train.filter(fold > 0).select("stats", "y", balance.alias("w")), model)
    scale = RIDGE * max(1.0, np.trace(gram) / len(gram))
    model.weights = np.linalg.solve(gram + scale * np.eye(len(gram)), right)

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                raw = model.raw(matrix(batch.column(0), n))
                yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1)], names=["raw", "y"])

    scored = train.filter(fold == 0).select("stats", "y").mapInArrow(binned, "raw double, y double")
    low, high, count = scored.agg(F.min("raw"), F.max("raw"), F.count("*")).first()
    if not count:
        model.levels, model.rates = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    width = max((high - low) / BINS, 1e-9)
    bins = (
        scored.groupBy(F.floor((F.col("raw") - low) / width).alias("bin"))
        .agg(F.avg("raw").alias("level"), F.sum("y").alias("hits"), F.count("*").alias("w"))
        .orderBy("bin")
        .collect()
    )  # at most BINS + 1 rows
    level = np.array([b.level for b in bins])
    weights = np.array([float(b.w) for b in bins])
    rates = _isotonic(level, np.array([b.hits for b in bins]), weights)
    slope = np.linspace(0, 1e-3, len(rates))  # keeps scores of one block apart
    model.levels, model.rates = level, rates * (1 - 1e-3) + slope
    return model


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; ``labels``: ``doc_id, label``."""
    model = fit(docs, labels)
    source = ids_and_texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch):
            x = np.array([statistics(t.as_py()) for t in batch.column(1)])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.probability(x))], names=["doc_id", "score"]
            )

        return step

    scored = map_batches(source, make, f"doc_id {kind}, score double")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores below ``threshold``; columns as they were, no shuffle."""
    model = fit(docs, labels)
    at = docs.columns.index(text_col)

    def make():
        def step(batch):
            x = np.array([statistics(t.as_py() or "") for t in batch.column(at)])
            return batch.filter(pa.array(model.probability(x) >= threshold))

        return step

    return map_batches(docs, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
