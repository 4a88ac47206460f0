"""Byte-level BPE encoding and decoding.

Two tiers.  A minimal perfect hash over the vocabulary (bounded: one entry per token) resolves whole
pre-tokens; its slot is checked against the token's bytes, so a foreign pre-token never passes.
Misses are merged with a heap of adjacent pairs over a doubly linked list of bytes, O(n log n) for a
pre-token of any length.  The vocabulary is read from a path on the driver and broadcast.

Work is narrow: one Arrow pass over the documents, no shuffle.  A task keeps bounded memos of resolved
chunks and pre-tokens, which forget what was not used of late.  Null and empty texts give no ids; every row gives one row; repeated rows repeat.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, map_batches

MEMO_ENTRIES = 250_000
UNEVEN_SPACE = re.compile(r"^ |\s | \s| $").search  # a space next to white space or an end
KEYS_PER_BUCKET = 4
TRIES = 128
SPREAD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # odd multipliers


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in order of rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash by displacement: bucket of a key -> displacement -> one of n slots."""

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // KEYS_PER_BUCKET)
        h = self._hashes(keys)
        bucket = self._bucket(h)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        free = np.ones(n, bool)
        self.slots = np.zeros(n, np.int32)  # slot -> key number
        self.displacement = np.zeros(self.buckets, np.int64)
        last_free = 0
        for k in np.argsort(-sizes, kind="stable"):
            members = order[starts[k] : starts[k + 1]]
            if len(members) == 0:
                break
            if len(members) == 1:  # any free slot, stored directly
                while not free[last_free]:
                    last_free += 1
                at = np.array([last_free])
                self.displacement[k] = -last_free - 1
            else:
                for d in range(0, 1 << 32, TRIES):  # a block of displacements at a time
                    tries = np.arange(d, d + TRIES, dtype=np.uint64)[:, None]
                    places = self._slot(h[members], tries)
                    fits = free[places].all(1)
                    fits[fits] = (np.diff(np.sort(places[fits], 1), axis=1) > 0).all(1)
                    if fits.any():
                        d += int(fits.argmax())
                        break
                    if d > 1000 * n:
                        raise ValueError("keys repeat")
                at = places[fits.argmax()]
                self.displacement[k] = d
            free[at] = False
            self.slots[at] = members
        self.keys = keys

    @staticmethod
    def _hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        return (h % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, h: np.ndarray, d) -> np.ndarray:
        x = (h ^ ((d + np.uint64(1)) * SPREAD)) * MIX
        return ((x ^ (x >> np.uint64(32))) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The number of each key, -1 for keys that are not in the set."""
        if not keys or not self.n:
            return [-1] * len(keys)
        h = self._hashes(keys)
        d = self.displacement[self._bucket(h)]
        slot = np.where(d < 0, -d - 1, self._slot(h, np.maximum(d, 0).astype(np.uint64)))
        known = self.keys
        return [n if known[n] == key else -1 for n, key in zip(self.slots[slot].tolist(), keys)]


def pair_table(tokens: list[bytes]) -> dict[int, int]:
    """Left id and right id, packed -> id of the token that joins them."""
    ids = {token: i for i, token in enumerate(tokens)}
    pairs = {}
    for i, token in enumerate(tokens):
        for cut in range(1, len(token)):
            left, right = ids.get(token[:cut]), ids.get(token[cut:])
            if left is not None and right is not None:
                pairs[(left << 32) | right] = i
    return pairs


def byte_pairs(byte_ids: list[int], pairs: dict[int, int]) -> list[int | None]:
    """Id of the token that joins two bytes, at 256 times the first plus the second."""
    return [pairs.get((x << 32) | y) for x in byte_ids for y in byte_ids]


def merge_bytes(piece: bytes, byte_ids: list[int], pairs: dict[int, int], first: list[int | None]) -> list[int]:
    """Join the pair of lowest rank, leftmost first, until no pair is a token; ``first`` is ``byte_pairs``.

    The parts are a linked list over the bytes; a heap orders the pairs by (rank, position) and
    entries that no longer hold are skipped when they come up.
    """
    size = len(piece)
    bits = size.bit_length()  # small numbers for the heap of a short piece
    last = (1 << bits) - 1
    get = pairs.get
    ids = [byte_ids[b] for b in piece]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    rank = [first[(x << 8) | y] for x, y in zip(piece, piece[1:])]
    heap = [(r << bits) | i for i, r in enumerate(rank) if r is not None]
    rank.append(None)
    heapify(heap)
    while heap:
        top = heappop(heap)
        i, joined = top & last, top >> bits
        if rank[i] != joined:
            continue
        right = after[i]
        end = after[i] = after[right]
        ids[i] = joined
        ids[right] = rank[right] = -1
        if end < size:
            before[end] = i
            r = rank[i] = get((joined << 32) | ids[end])
            if r is not None:
                heappush(heap, (r << bits) | i)
        else:
            rank[i] = None
        left = before[i]
        if left >= 0:
            r = rank[left] = get((ids[left] << 32) | joined)
            if r is not None:
                heappush(heap, (r << bits) | left)
    return [x for x in ids if x >= 0]


class Memo:
    """At most two generations of ``MEMO_ENTRIES`` packed ids: a full one becomes the older, and what is used again
    moves to the newer; the rest of the older one is forgotten with it."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        """Those of ``wanted`` that are not known; all others are in ``new`` from here on."""
        absent = wanted.difference(self.new)
        if not absent:
            return []
        unknown = absent.difference(self.old)
        again = {w: self.old[w] for w in absent.difference(unknown)}
        if len(self.new) + len(absent) > MEMO_ENTRIES:
            again.update((w, self.new[w]) for w in wanted.difference(absent))
            self.old, self.new = self.new, again
        else:
            self.new.update(again)
        return list(unknown)


class Codec:
    """Encoder and decoder for one vocabulary and one pre-token pattern.

    A pre-token of the pattern holds a space only at its start or among white space, so a text may be
    cut before every single space that stands between two other characters and its chunks encoded alone.
    Chunks are memoised as packed ids; their pre-tokens go through the two tiers.
    """

    def __init__(self, tokens: list[bytes], pattern: str, index: PerfectHash | None = None):
        self.tokens, self.pattern = tokens, pattern
        self.index = index or PerfectHash(tokens)
        self._memo, self._words = Memo(), Memo()
        self._split = self._pairs = None

    def __getstate__(self):
        return {"tokens": self.tokens, "pattern": self.pattern, "index": self.index}

    def __setstate__(self, state):
        self.__init__(**state)

    def _prepare(self) -> None:
        self._split = regex.compile(self.pattern).findall
        self._pairs = pair_table(self.tokens)
        single = {token[0]: i for i, token in enumerate(self.tokens) if len(token) == 1}
        self._bytes = [single[b] for b in range(256)]
        self._first = byte_pairs(self._bytes, self._pairs)

    def _resolve(self, missing: list[str]) -> None:
        """Look whole pre-tokens up in the perfect hash; merge those it does not hold."""
        pieces = [m.encode() for m in missing]
        known = self._words.new
        for word, piece, found in zip(missing, pieces, self.index.find(pieces)):
            ids = [found] if found >= 0 else merge_bytes(piece, self._bytes, self._pairs, self._first)
            known[word] = pack(f"<{len(ids)}I", *ids)

    def _packed(self, chunks: list[str]) -> list[bytes]:
        split = [self._split(c) for c in chunks]
        missing = self._words.missing(set(chain.from_iterable(split)))
        if missing:
            self._resolve(missing)
        known = self._words.new.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text; every match of the pattern is encoded separately."""
        if self._split is None:
            self._prepare()
        if not text:
            return np.array([], "<u4")
        if UNEVEN_SPACE(text):
            return np.frombuffer(self._packed([text])[0], "<u4")
        first, *chunks = text.split(" ")
        missing = self._memo.missing(set(chunks))
        known = self._memo.new
        if missing:
            known.update(zip(missing, self._packed([" " + c for c in missing])))
        return np.frombuffer(self._packed([first])[0] + b"".join(map(known.__getitem__, chunks)), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def _shared(df: DataFrame, path: str, pattern: str):
    return df.sparkSession.sparkContext.broadcast(codec(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` as array<int> in ``out`` (replacing a column of that name)."""
    shared = _shared(docs, path, pattern)
    kept = docs.drop(out)
    at = kept.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + f", `{out}` array<int>"

    def make():
        tool = shared.value

        def step(batch):
            ids = [tool.encode(t or "").astype("<i4") for t in batch.column(at).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.array([], "<i4")
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, out])

        return step

    return map_batches(kept, make, schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ids in ``ids_col`` as binary in ``out`` (null ids: empty)."""
    shared = _shared(df, path, pattern)
    kept = df.drop(out)
    at = kept.columns.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + f", `{out}` binary"

    def make():
        tool = shared.value

        def step(batch):
            column = [tool.decode(np.asarray(x or [], np.int64)) for x in batch.column(at).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(column, pa.binary())], names=[*batch.schema.names, out]
            )

        return step

    return map_batches(kept, make, schema)


def checked_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, round_trip``: ids, and whether decoding gives the text's bytes."""
    shared = _shared(docs, path, pattern)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    rows = docs.select(*kept, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def make():
        tool = shared.value

        def step(batch):
            ids, same = [], []
            for text in batch.column(len(kept)).to_pylist():
                ids.append(tool.encode(text))
                same.append(tool.decode(ids[-1]) == text.encode())
            sizes = [len(x) for x in ids]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype("<i4")))
            return pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(sizes, pa.int64()), lists, pa.array(same)],
                names=[*kept, "n_tokens", "ids", "round_trip"],
            )

        return step

    return map_batches(rows, make, types + ", n_tokens long, ids array<int>, round_trip boolean")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, then decode, every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are those of the ids as little-endian unsigned 32-bit integers and of the decoded bytes.
    """
    shared = _shared(docs, path, pattern)

    def make():
        tool = shared.value

        def step(batch):
            counts, sums, texts = [], [], []
            for text in batch.column(1).to_pylist():
                ids = tool.encode(text)
                counts.append(len(ids))
                sums.append(hashlib.sha256(ids.tobytes()).hexdigest())
                texts.append(hashlib.sha256(tool.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums), pa.array(texts)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    return map_batches(
        ids_and_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")),
        make,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
