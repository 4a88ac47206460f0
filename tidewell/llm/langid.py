"""Language identification with error-correcting output codes.

Every language gets a binary codeword.  Each bit is a binary classifier over hashed character n-grams: the
log-odds of an n-gram in the languages whose bit is 1 against those whose bit is 0, averaged over the n-grams of
a text.  Decoding adds, per language, the logistic loss of all bits, weighted by how well a bit tells that language's
training texts; the nearest codeword wins and a small lead over the next one flags ambiguity.

Counts per language come from a bounded, hashed sample of at most about ``DOCS_PER_LANGUAGE`` learnable texts of each
language (whole texts); tasks add up their counts, Spark adds the tasks.  Prediction is one narrow Arrow pass over all
texts.  Null texts and texts without a letter are ``und`` with score 0; with no learnable language every text is.
Texts of languages never learned get the nearest learned one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import held_out, map_batches
from tidewell.session import durable

DOCS_PER_LANGUAGE = 4_000
MAX_LANGUAGES = 2_000
ORDERS = (1, 2, 3)
DIMENSIONS = 1 << 13
SMOOTHING = 0.5
SHARPNESS = 4.0
AMBIGUOUS_LEAD = 0.1
SLICE = 1 << 18
SEED = 77
UNDETERMINED = "und"


def codewords(n: int) -> np.ndarray:
    """``n`` rows of +1/-1: all splits of up to five classes, else random rows picked for distance."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        bits = np.arange(1, 1 << (n - 1))
        return np.array([[1 if i == 0 or not (b >> (i - 1)) & 1 else -1 for b in bits.tolist()] for i in range(n)])
    width = int(np.ceil(10 * np.log2(n)))
    rng, best, widest = np.random.default_rng(SEED), None, -1
    for _ in range(64):
        code = rng.choice([-1, 1], size=(n, width))
        apart = (width - code @ code.T) // 2 + width * np.eye(n, dtype=int)
        mixed = (np.abs(code.sum(0)) < n).all()
        if mixed and apart.min() > widest:
            best, widest = code, int(apart.min())
    return best


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def profile(text: str) -> np.ndarray:
    """Counts of the hashed character n-grams of the whole text: lower case, non-letters as one space."""
    counts = np.zeros(DIMENSIONS, np.int64)
    overlap = max(ORDERS) - 1
    for at in range(0, len(text), SLICE):  # slices overlap so that no n-gram is lost
        lead = min(at, overlap)
        part = text[at - lead : at + SLICE]
        part = part.lower() if len(part.lower()) == len(part) else "".join(c.lower()[:1] for c in part)
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        plain = (codes < 97) | ((codes > 122) & (codes < 170))
        codes = np.where(plain, np.uint64(32), codes)
        gram = np.zeros(len(codes), np.uint64)
        for k in range(1, max(ORDERS) + 1):
            gram = gram[: len(codes) - k + 1] * np.uint64(0x100000001B3) + codes[k - 1 :]
            if k in ORDERS and len(gram):
                mixed = (gram + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
                bucket = (mixed >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)
                new = bucket[max(0, lead - k + 1) :]
                counts += np.bincount(new, minlength=DIMENSIONS)
    return counts


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # n-grams x bits
    trust: np.ndarray  # languages x bits, rows add up to 1

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return (counts @ self.weights) / np.maximum(1, counts.sum(1, keepdims=True)) * SHARPNESS

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Texts x languages: weighted logistic loss of a codeword's bits."""
        signed = margins[:, None, :] * self.code[None]
        return (np.logaddexp(0, -signed) * self.trust[None]).sum(2)


def _task_counts(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = profile(text)
            # a text weighs the root of its length, so that no long one outvotes the rest
            totals[lang] = totals.get(lang, 0) + found / np.sqrt(max(1, found.sum()))
    names = sorted(totals)
    cells = [totals[x] for x in names]
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(cells, pa.list_(pa.float64()))], names=["lang", "cells"]
    )


def _added(group: pa.Table) -> pa.Table:
    cells = group.column("cells").combine_chunks()
    total = cells.flatten().to_numpy().reshape(-1, DIMENSIONS).sum(0)
    return pa.table({"lang": group.column("lang").slice(0, 1), "cells": pa.array([total], pa.list_(pa.float64()))})


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, lang_col: str = "lang") -> Model | None:
    """Learn from ``text`` and the non-null ``lang_col`` of rows that are not held out."""
    rows = docs.select(F.col("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col("text"))
    rows = rows.filter("lang is not null and text is not null").filter(~held_out())
    sizes = rows.groupBy("lang").count()
    if sizes.count() > MAX_LANGUAGES:  # a model row per language must fit the driver and every task
        raise ValueError(f"more than {MAX_LANGUAGES} values of {lang_col}")
    spin = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    share = F.least(F.lit(1.0), per_language / F.col("count"))
    chosen = rows.join(F.broadcast(sizes), "lang").filter(spin < share * (1 << 30)).select("text", "lang")
    sample = durable(chosen, "languages")  # at most about per_language texts of each language
    schema = "lang string, cells array<double>"
    sums = sample.mapInArrow(_task_counts, schema).groupBy("lang").applyInArrow(_added, schema)
    found = sums.orderBy("lang").collect()  # one row a language
    if not found:
        return None
    counts = np.array([r.cells for r in found])
    rates = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True)
    languages = [r.lang for r in found]
    code = codewords(len(found))
    weights = np.zeros((DIMENSIONS, code.shape[1]))
    for b in range(code.shape[1]):
        one, zero = rates[code[:, b] > 0], rates[code[:, b] < 0]
        if len(one) and len(zero):
            weights[:, b] = np.log(one.mean(0) / zero.mean(0))
    model = Model(languages, code, weights, np.full(code.shape, 1.0 / code.shape[1]))

    def right(batches):
        hits = np.zeros(code.shape)
        seen = np.zeros(len(languages))
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = languages.index(lang)
                hits[at] += (model.margins(profile(text)[None])[0] * code[at]) > 0
                seen[at] += 1
        cells = np.hstack([hits, seen[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(languages)), pa.int32()), pa.array(cells.tolist(), pa.list_(pa.float64()))],
            names=["at", "cells"],
        )

    width = code.shape[1] + 1
    told = sample.mapInArrow(right, "at int, cells array<double>").groupBy("at")
    told = told.agg(*[F.sum(F.col("cells")[b]).alias(f"b{b}") for b in range(width)]).orderBy("at").collect()
    cells = np.array([list(r)[1:] for r in told])
    accuracy = (cells[:, :-1] + 1) / (cells[:, -1:] + 2)
    model.trust = accuracy / accuracy.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for every row."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch):
            names, scores, close = [], [], []
            for text in batch.column(1).to_pylist():
                if model is None or not has_letter(text):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    close.append(True)
                    continue
                loss = model.losses(model.margins(profile(text)[None]))[0]
                order = np.argsort(loss, kind="stable")
                odds = np.exp((loss.min() - loss) * SHARPNESS * 2)
                names.append(model.languages[order[0]])
                scores.append(float(1.0 / odds.sum()))
                close.append(bool(len(order) > 1 and loss[order[1]] - loss[order[0]] < AMBIGUOUS_LEAD))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array(scores), pa.array(close)],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

        return step

    return map_batches(source, make, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row, learned from the rows not held out."""
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
