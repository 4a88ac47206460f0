"""SimHash fingerprints and near-duplicate groups.

A 64-bit fingerprint is cut into two segments of 32 bits.  Two fingerprints that differ in at most three
bits differ in at most one bit in one of the segments, so deleting that bit leaves equal variants: every
distinct fingerprint is indexed under 2 x 32 one-wildcard variants (segment, position, the other 31 bits)
and equal variants are compared and verified.  Only distinct fingerprints are indexed, so any number of copies is
one entry.  Fingerprints under one variant are not paired up: the links among them are reduced to one
spanning star per connected part before they leave the task, and the stars meet in a components pass.

Null and empty texts have no shingle and fingerprint zero, which is linked like any other.  A row gives a
row, repeated rows too; rows with a null id get the group of their fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, map_batches, packed, text_key
from tidewell.llm.components import components
from tidewell.session import durable

WORDS_PER_SHINGLE = 3
HASH_SEED = 42
MAX_BITS = 3
SEGMENT_BITS = 32
BLOCK = 1024
SLICE = 1 << 16


def shingle_hashes(text: str, k: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """XXH64 of every ``k``-word shingle of the text with A-Z lower-cased, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return np.array([], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - k + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[len(ends) - n :].tolist())
    return np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in spans), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes (signed 64-bit)."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[at : at + SLICE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0]) if len(hashes) else 0


def fingerprint(text: str, k: int = WORDS_PER_SHINGLE) -> int:
    """Bit b is set if it is set in over half of the shingle hashes (signed 64-bit)."""
    return majority(shingle_hashes(text, k))


def fingerprints(docs: DataFrame, k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp`` for every row; narrow."""
    source = ids_and_texts(docs).select("doc_id", text_key().alias("text_key"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch):
            fps = [fingerprint(t, k) for t in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "text_key", "fp"]
            )

        return step

    return map_batches(source, make, f"doc_id {kind}, text_key long, fp long")


def _variants(fps: DataFrame) -> DataFrame:
    """``(sig, fp)``: segment, wildcard position and the segment without that bit, packed in a long."""
    low = F.lit((1 << SEGMENT_BITS) - 1)
    spots = F.sequence(F.lit(0), F.lit(2 * SEGMENT_BITS - 1))
    spread = fps.select("fp", F.explode(spots).alias("spot"))
    segment = F.when(F.col("spot") < SEGMENT_BITS, F.col("fp").bitwiseAND(low)).otherwise(
        F.expr(f"shiftrightunsigned(fp, {SEGMENT_BITS})")
    )
    spread = spread.select("fp", "spot", segment.alias("s"))
    rest = F.expr(
        f"(shiftleft(shiftright(s, spot % {SEGMENT_BITS} + 1), spot % {SEGMENT_BITS}))"
        f" | (s & (shiftleft(1L, spot % {SEGMENT_BITS}) - 1))"
    )
    return spread.select(F.expr(f"shiftleft(cast(spot as long), {SEGMENT_BITS})").bitwiseOR(rest).alias("sig"), "fp")


def _star(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star per connected part of fingerprints within ``max_bits`` of each other."""
    m = len(fps)
    labels = np.arange(m)
    bits = fps.view(np.uint64)
    while True:  # labels only fall; blocks bound the memory whatever the length of the run
        before = labels.copy()
        for i in range(0, m, BLOCK):
            for j in range(0, m, BLOCK):
                near = np.bitwise_count(bits[i : i + BLOCK, None] ^ bits[None, j : j + BLOCK]) <= max_bits
                least = np.where(near, labels[None, j : j + BLOCK], m).min(1)
                labels[i : i + BLOCK] = np.minimum(labels[i : i + BLOCK], least)
        labels = labels[labels]
        if (labels == before).all():
            break
    moved = np.flatnonzero(labels != np.arange(m))
    return fps[moved], fps[labels[moved]]


def _links_of_runs(sig: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.array([], int)
    sizes = np.diff(np.concatenate([starts, [len(sig)]]))
    two = starts[sizes == 2]
    near = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= max_bits
    us, vs = [fp[two + 1][near]], [fp[two][near]]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        u, v = _star(fp[s : s + n], max_bits)
        us.append(u)
        vs.append(v)
    return np.concatenate(us), np.concatenate(vs)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links ``(u, v)`` among distinct fingerprints (column ``fp``) within ``max_bits`` bits.

    ``max_bits`` up to 3: that is what two segments with one wildcard bit find in full.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with one wildcard find at most three differing bits")
    spread = _variants(fps).repartition("sig").sortWithinPartitions("sig", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # the run that may go on in the next batch

        def linked(sig, fp):
            u, v = _links_of_runs(sig, fp, max_bits)
            pairs = np.unique(np.stack([u, v], 1), axis=0) if len(u) else np.empty((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        for batch in batches:
            sig, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(sig):
                continue
            if held and sig[0] == sig[-1] == held[0][0][0]:
                held.append((sig, fp))
                continue
            sig = np.concatenate([*(h[0] for h in held), sig])
            fp = np.concatenate([*(h[1] for h in held), fp])
            cut = int(np.searchsorted(sig, sig[-1], "left"))
            held = [(sig[cut:], fp[cut:])]
            yield linked(sig[:cut], fp[:cut])
        if held:
            yield linked(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    return spread.mapInArrow(run, "u long, v long")


def grouped(docs: DataFrame, k: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_key, fp)`` of every row, and ``(fp, root)`` of every distinct fingerprint."""
    prints = durable(fingerprints(docs, k), "fingerprints")
    known = durable(prints.select("fp").distinct(), "distinct")
    roots = components(links(known, max_bits)).withColumnRenamed("u", "fp")
    return prints, known.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, k: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the smallest id reachable over links of ``max_bits`` bits."""
    prints, roots = grouped(docs, k, max_bits)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    named = roots.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return prints.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, k: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: the smallest ``doc_id`` (then the smallest text hash)."""
    prints, roots = grouped(docs, k, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    least = prints.groupBy("fp").agg(first.alias("one")).join(roots, "fp")
    chosen = least.groupBy("root").agg(F.min("one").alias("one")).select("one.doc_id", "one.text_key")
    return listed_once(docs, prints, durable(chosen, "kept"))


def listed_once(docs: DataFrame, prints: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names by ``doc_id, text_key``, each once; ``prints`` has a row per row."""
    own = packed(docs)
    same = own["doc_id"].eqNullSafe(chosen["doc_id"]) & (own["text_key"] == chosen["text_key"])
    kept = own.join(chosen, same, "left_semi")
    rows = prints.count()
    if prints.select("doc_id", "text_key").distinct().count() < rows:  # a row may be listed more than once
        kept = kept.dropDuplicates(["doc_id", "text_key"])
    return kept.select("row.*")
