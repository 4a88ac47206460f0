"""Removal of repeated word windows.

Every window of ``size`` consecutive words of every text gets a Rabin-Karp hash (two polynomials mod 2^64 over word
hashes, 64 + up to 64 bits kept).  A task works through its documents in batches of bounded size: a window that the batch has
seen before is known to be a later copy, so each batch sends a window once however often it holds it.  Windows are dealt to
buckets by hash; a bucket's share of a batch travels as one packed row, in the order of the text: the hash and a few
bits of position per window.  A bucket finds the hashes that several batches sent and returns every window but the earliest.
Copies meet per document, merge into maximal intervals, and the words inside are cut from the text.

The bits that tell windows apart (those of the bucket and those kept) grow with twice the logarithm of the number of
windows, so that any two different windows of the whole corpus agree with a probability below 2^-20.

Earlier means a smaller ``(doc_id, text hash)``, or an earlier start in the same document; a document listed twice is one
document.  Null and empty texts have no words; texts with fewer words than a window lose none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, map_batches, release_shuffles, text_key
from tidewell.session import durable

WINDOW = 20
BATCH_WORDS = 600_000
BUCKET_WINDOWS = 1_000_000
MIN_BUCKETS = 256
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[bytes]:
    return text.encode().split()


def rolled(words: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of every window of ``size`` numbers, by doubling: O(n log size)."""
    done, out, power, block = 0, None, base, words
    length, scale = 1, base
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, done, power = block.copy(), length, scale
            else:
                n = min(len(out), len(block) - done)
                out = out[:n] * scale + block[done : done + n]
                done += length
        rest >>= 1
        if rest:
            n = len(block) - length
            if n <= 0:
                return np.array([], np.uint64)
            block = block[:n] * scale + block[length:]
            scale, length = scale * scale, length * 2
    return out[: max(0, len(words) - size + 1)]


def window_hashes(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        found = []
        for base in BASES:
            mixed = (words ^ (words >> np.uint64(31))) * (base | np.uint64(1))
            h = rolled(mixed, size, base)
            h = (h ^ (h >> np.uint64(32))) * SPREAD
            found.append(h ^ (h >> np.uint64(29)))
    return found[0], found[1]


def hash_bytes(windows: int, buckets: int) -> int:
    """Bytes of hash kept per window, besides the bits its bucket shows."""
    bits = 2 * math.log2(max(2, windows)) + 20 - math.floor(math.log2(buckets))
    return min(16, max(8, math.ceil(bits / 8)))


def spans_of(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal intervals covered by windows at the ascending ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > size)
    first = starts[np.concatenate([[0], cut + 1])]
    last = starts[np.concatenate([cut, [len(starts) - 1]])] + size
    return list(zip(first.tolist(), last.tolist()))


PART_SCHEMA = "bucket long, ids binary, counts binary, hashes binary, starts binary"


def _parts(keys: list[tuple[int, int]], texts: list[list[bytes]], size: int, buckets: int, width: int):
    """One packed row per bucket for a batch of documents; known later copies go along without their hash."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    keys, texts = [keys[i] for i in order], [texts[i] for i in order]
    counts = np.array([len(w) for w in texts])
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in texts for w in ws), np.uint64, int(counts.sum()))
    if len(words) < size:
        return
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(words)) - np.repeat(ends - counts, counts)
    n = len(words) - size + 1
    inside = doc[:n] == doc[size - 1 :]
    one, two = (h[inside] for h in window_hashes(words, size))
    doc, start = doc[:n][inside], start[:n][inside]
    # documents are sorted by key; equal keys are one document
    rank = np.cumsum([k > 0 and keys[k] != keys[k - 1] for k in range(len(keys))])
    by = np.lexsort((start, rank[doc], two, one))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (one[by[1:]] != one[by[:-1]]) | (two[by[1:]] != two[by[:-1]])
    head = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
    same_place = (rank[doc[by]] == rank[doc[head]]) & (start[by] == start[head])
    first = np.zeros(len(by), bool)
    first[by] = fresh
    copy = np.zeros(len(by), bool)
    copy[by] = ~fresh & ~same_place
    ids = np.array(keys, np.int64).reshape(-1, 2)

    def packed(bucket: int, at: np.ndarray, hashed: bool):
        docs, sizes = np.unique(doc[at], return_counts=True)
        raw = b""
        if hashed:
            both = np.stack([one[at], two[at]], 1).view(np.uint8).reshape(-1, 16)
            raw = np.ascontiguousarray(both[:, :width]).tobytes()
        gaps = np.diff(start[at], prepend=0)
        gaps[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = start[at][np.concatenate([[0], np.cumsum(sizes)[:-1]])]
        return bucket, _short_keys(ids[docs]), _short(sizes), raw, _short(gaps)

    for at in np.array_split(np.flatnonzero(copy), max(1, int(copy.sum()) // 100_000)):
        if len(at):
            yield packed(int(ids[doc[at[0]]].sum()) % buckets, at, False)
    sent = np.flatnonzero(first)
    bucket = (two[sent] >> np.uint64(20)) % np.uint64(buckets)
    by = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[by])) + 1
    for at in np.split(by, edges):
        if len(at):
            yield packed(int(bucket[at[0]]), sent[at], True)


def _short(gaps: np.ndarray) -> bytes:
    """Gaps as 16-bit numbers, a large one as 65535 and then itself in two of them."""
    if not len(gaps) or gaps.max() < 65535:
        return gaps.astype("<u2").tobytes()
    out = []
    for g in gaps.tolist():
        out += [g] if g < 65535 else [65535, g & 65535, g >> 16]
    return np.array(out, "<u2").tobytes()


def _short_keys(keys: np.ndarray) -> bytes:
    """Ascending document keys: gaps of the ids where these are small and alone tell documents apart."""
    gaps = np.diff(keys[:, 0])
    if keys[:, 1].any() or (len(gaps) and (gaps.min() < 0 or gaps.max() >= 1 << 32)):
        return b"w" + keys.tobytes()
    return b"g" + keys[:1, 0].tobytes() + _short(gaps)


def _long_keys(raw: bytes, n: int) -> np.ndarray:
    if raw[:1] == b"w":
        return np.frombuffer(raw[1:], np.int64).reshape(-1, 2)
    first = np.frombuffer(raw[1:9], np.int64)
    ids = np.concatenate([first, first + np.cumsum(_long(raw[9:], n - 1))])
    return np.stack([ids, np.zeros_like(ids)], 1)


def _long(raw: bytes, n: int | None = None) -> np.ndarray:
    gaps = np.frombuffer(raw, "<u2").astype(np.int64)
    if len(gaps) == n or not (gaps == 65535).any():
        return gaps
    out, i, values = [], 0, gaps.tolist()
    while i < len(values):
        if values[i] == 65535:
            out.append(values[i + 1] | values[i + 2] << 16)
            i += 3
        else:
            out.append(values[i])
            i += 1
    return np.array(out, np.int64)


def _unpacked(ids: bytes, counts: bytes, starts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document keys (two columns) and start of every window of a packed row."""
    sizes = _long(counts)
    total = int(sizes.sum())
    gaps = _long(starts, total)
    summed = np.cumsum(gaps)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    base = summed[begin] - gaps[begin]
    keys = _long_keys(ids, len(sizes))
    return np.repeat(keys, sizes, axis=0), summed - np.repeat(base, sizes), sizes


def _copies(size: int, width: int):
    """Within a bucket: every window of a hash but the earliest."""

    def step(group: pa.Table) -> pa.Table:
        keys, starts, hashes, known_keys, known_starts = [], [], [], [], []
        columns = [group.column(c).to_pylist() for c in ("ids", "counts", "hashes", "starts")]
        for ids, counts, raw, gaps in zip(*columns):
            k, s, _ = _unpacked(ids, counts, gaps)
            if raw:
                keys.append(k)
                starts.append(s)
                hashes.append(np.frombuffer(raw, np.uint8).reshape(-1, width))
            else:
                known_keys.append(k)
                known_starts.append(s)
        if hashes:
            wide = np.zeros((sum(map(len, hashes)), 16), np.uint8)
            wide[:, :width] = np.concatenate(hashes)
            pair = wide.view(np.uint64)
            k, s = np.concatenate(keys), np.concatenate(starts)
            by = np.argsort(pair[:, 0], kind="stable")
            twin = np.zeros(len(by), bool)
            same = pair[by[1:], 0] == pair[by[:-1], 0]
            twin[1:] |= same
            twin[:-1] |= same
            at = by[twin]
            by = at[np.lexsort((s[at], k[at, 1], k[at, 0], pair[at, 1], pair[at, 0]))]
            if len(by):
                fresh = np.ones(len(by), bool)
                fresh[1:] = (pair[by[1:]] != pair[by[:-1]]).any(1)
                head = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
                copy = ((k[by] != k[head]).any(1)) | (s[by] != s[head])
                known_keys.append(k[by[copy]])
                known_starts.append(s[by[copy]])
        if not known_keys:
            return pa.table({"doc_id": pa.array([], pa.int64()), "text_key": pa.array([], pa.int64()), "starts": pa.array([], pa.list_(pa.int32()))})
        k, s = np.concatenate(known_keys), np.concatenate(known_starts)
        by = np.lexsort((s, k[:, 1], k[:, 0]))
        k, s = k[by], s[by]
        edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]).any(1)])) if len(k) else np.array([], int)
        offsets = np.concatenate([edge, [len(k)]]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(s.astype(np.int32)))
        return pa.table({"doc_id": pa.array(k[edge, 0]), "text_key": pa.array(k[edge, 1]), "starts": lists})

    return step


def later_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, starts``: the windows of each document that also start earlier, sorted.

    ``docs``: ``doc_id, text_key, text`` as ``_keyed`` gives them.
    """
    source = docs
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    windows = max(1, int(chars) // 4)
    buckets = max(MIN_BUCKETS, -(-windows // BUCKET_WINDOWS))
    width = hash_bytes(windows, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            rows = list(_parts(keys, texts, size, buckets, width))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64()] + [pa.binary()] * 4
            names = ["bucket", "ids", "counts", "hashes", "starts"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

        keys: list[tuple[int, int]] = []
        texts: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                if len(words) < size:
                    continue
                keys.append((doc, key))
                texts.append(words)
                held += len(words)
                if held >= BATCH_WORDS:
                    yield flush()
                    keys, texts, held = [], [], 0
        if keys:
            yield flush()

    parts = source.mapInArrow(run, PART_SCHEMA)
    found = parts.groupBy("bucket").applyInArrow(
        _copies(size, width), "doc_id long, text_key long, starts array<int>"
    )
    return found.groupBy("doc_id", "text_key").agg(F.array_sort(F.flatten(F.collect_list("starts"))).alias("starts"))


NULL_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``; the text hash is 0 throughout where ``doc_id`` alone is unique."""
    rows = ids_and_texts(docs).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_key().alias("text_key"), "text"
    )
    ids = rows.groupBy("doc_id").count()
    if ids.filter("count > 1").isEmpty():
        return rows.withColumn("text_key", F.lit(0).cast("long"))
    return rows


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row; ``kept``: the words that stay, joined by one space."""
    docs = _keyed(docs)
    gone = durable(later_windows(docs, size), "windows")  # small: only repeated windows
    release_shuffles(docs.sparkSession)  # the windows' shuffle need not lie beside that of the texts
    rows = docs.join(gone, ["doc_id", "text_key"], "left").select("doc_id", "text", "starts")

    def make():
        def step(batch):
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text)
                spans = spans_of(np.asarray(starts.values), size) if starts.is_valid else []
                stay, last = [], 0
                for a, b in spans:
                    stay += words[last:a]
                    last = b
                stay += words[last:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

        return step

    done = map_batches(rows, make, "doc_id long, n_words long, n_removed long, kept string")
    return done.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def report(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row."""
    return remove_repeats(docs, size).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
