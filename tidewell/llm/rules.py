"""Quality rules on whole texts, with compression bands.

The base rules count words, symbols, repeated lines and repeated word windows.  A text that they pass is compressed
with zstandard, whole and in chunks of ``CHUNK`` bytes, and must be as compressible as prose of its length: ``BANDS``
gives, from a least number of UTF-8 bytes on, the lowest and highest ratio of raw to compressed bytes.  A ratio below
the band is noise (random strings, encoded binary), one above it is repetitive.  The whole text must lie in its band;
of its chunks, those outside the band of their own length may hold at most ``MAX_BAD_SHARE`` of the bytes, so junk in
one part of a long text is seen although the whole text compresses like prose.

Every row gives a row, in one narrow pass that holds one text at a time.  Words are runs of anything but a space and
the characters 9 to 13.  A null text is an empty one: no words, no ratio, failed by the base rules.  Rows listed twice
and rows without an id are judged like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, map_batches

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
LEVEL = 3
CHUNK = 4096
MAX_BAD_SHARE = 0.25
#: From this many bytes on: lowest and highest ratio of raw to compressed bytes.
BANDS = ((0, 1.0, 2.5), (256, 1.1, 3.0), (1024, 1.35, 3.5), (4096, 1.45, 4.0), (16384, 1.55, 5.0), (65536, 1.6, 6.0))

COLUMNS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "ratio": pa.float64(),
    "n_chunks": pa.int64(),
    "n_bad_chunks": pa.int64(),
}
TYPES = {pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double"}


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice; exact.

    Windows of doubled length are ranked from pairs of shorter ones; a rank nothing shares ends the search.
    """
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    size = 1
    while size < window:
        step = min(size, window - size)  # two overlapping windows spell one of any length between
        pairs = rank[: len(rank) - step] * np.int64(len(words) + 1) + rank[step:]
        distinct, rank = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        size += step
    again = np.bincount(rank)[rank] > 1
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def in_band(size: int, ratio: float, bands=BANDS) -> bool:
    """Whether a ratio is one of prose of ``size`` bytes."""
    low, high = next((low, high) for least, low, high in reversed(bands) if size >= least)
    return low <= ratio <= high


class Judge:
    """The counts and the verdict of one text after the other."""

    def __init__(self, bands=BANDS, chunk: int = CHUNK, level: int = LEVEL, max_bad_share: float = MAX_BAD_SHARE):
        self.bands, self.chunk, self.max_bad_share = bands, chunk, max_bad_share
        self.compress = zstandard.ZstdCompressor(level=level).compress

    def compression(self, data: bytes) -> tuple[bool, float, int, int]:
        """Whether the text is as compressible as prose; its ratio, its chunks and those outside their band."""
        ratio = len(data) / len(self.compress(data))
        if len(data) <= self.chunk:
            fits = in_band(len(data), ratio, self.bands)
            return fits, ratio, 1, int(not fits)
        view, bad, bad_bytes, chunks = memoryview(data), 0, 0, 0
        for at in range(0, len(data), self.chunk):
            part = view[at : at + self.chunk]
            chunks += 1
            if not in_band(len(part), len(part) / len(self.compress(part)), self.bands):
                bad += 1
                bad_bytes += len(part)
        fits = in_band(len(data), ratio, self.bands) and bad_bytes <= self.max_bad_share * len(data)
        return fits, ratio, chunks, bad

    def __call__(self, text: str) -> tuple:
        """One value per entry of ``COLUMNS``."""
        data = text.encode()
        words = data.split()  # of bytes: at a space and the characters 9 to 13
        solid = [line for line in data.split(b"\n") if line.strip(SPACES)]
        repeats = repeated_words(words)
        failed = len(words) < LEAST_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
        fits, ratio, chunks, bad = self.compression(data) if data else (False, None, 0, 0)
        return (
            len(words),
            len(text) - len(data) + len(data.translate(None, SPACES)),
            len(data) - len(data.translate(None, SYMBOLS)),
            len(solid) - len(set(solid)),
            repeats,
            failed,
            fits and not failed,
            ratio,
            chunks,
            bad,
        )


def report(docs: DataFrame, **limits) -> DataFrame:
    """``doc_id`` and ``COLUMNS`` for every row; ``limits`` are those of ``Judge``."""
    source = ids_and_texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def make():
        judge = Judge(**limits)

        def step(batch):
            judged = [judge(text.as_py()) for text in batch.column(1)]
            columns = [pa.array(values, t) for values, t in zip(zip(*judged), COLUMNS.values())]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *COLUMNS])

        return step

    return map_batches(source, make, f"doc_id {kind}, " + ", ".join(f"{n} {TYPES[t]}" for n, t in COLUMNS.items()))


def keep_passing(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` whose text passes all rules, columns unchanged; narrow."""
    whole = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct("*").alias("row"))
    kind = whole.schema["row"].dataType.simpleString()

    def make():
        judge = Judge(**limits)
        passes = list(COLUMNS).index("kept")

        def step(batch):
            kept = pa.array([judge(text.as_py())[passes] for text in batch.column(0)], pa.bool_())
            return pa.RecordBatch.from_arrays([batch.column(1)], names=["row"]).filter(kept)

        return step

    return map_batches(whole, make, f"row {kind}").select("row.*")
