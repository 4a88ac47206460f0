"""Benchmark decontamination: find, mark and remove test n-grams in training texts.

The windows of the benchmark form a hash set that is broadcast.  Its size is proven first: the
benchmark is measured by an aggregate, and one larger than ``SLICE_BYTES`` of UTF-8 is worked off in
slices of its items, each slice a scan of its own whose hits are written before the next slice's set is
built.  A set is a few arrays (about 15 bytes a byte of text, ``tests/llm/test_decontaminate.py`` holds it to 40), so a worker
holds some 60 MB, whatever the size of the benchmark; the hits of all slices are then united per ``(doc_id, text_key)``.  A scan is narrow.  Document words are mapped to the slice's word numbers (0: a word no item has), windows of
numbers are looked up by a rolling hash, and every hash hit is verified on the numbers themselves.

Null and empty texts have no words: such documents have no hits and such items no windows.  Items
without an ``item_id`` mark words but are not counted.  Every document row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, map_batches, text_key
from tidewell.session import durable

WINDOW = 10
SLICE_BYTES = 4_000_000
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
BASE = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words of digits, letters a-z and everything beyond ASCII, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split()


def _rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash mod 2^64 of every window of ``k`` word numbers."""
    mixed = ids.astype(np.uint64)
    mixed = (mixed + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    n = len(ids) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(BASE) + mixed[j : j + n]
    return out


class WindowSet:
    """The windows of some benchmark items, by length: word numbers as one array, windows as places in it.

    Per length: hashes in order, the place of each window, and the item it belongs to (-1: one without an id).  A window that
    several items have is listed once for each.
    """

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.words: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items if item is not None})
        number = {name: i for i, name in enumerate(self.names)}
        texts = [
            (number.get(item, -1), np.fromiter((self.words.setdefault(w, len(self.words) + 1) for w in words_of(text or "")), np.int32))
            for item, text in items
        ]
        texts = [(owner, ids) for owner, ids in texts if len(ids)]
        self.ids = np.concatenate([ids for _, ids in texts]) if texts else np.array([], np.int32)
        starts = np.cumsum([0] + [len(ids) for _, ids in texts])
        lengths = np.array([min(window, len(ids)) for _, ids in texts], np.int64)
        self.by_length = {}
        for k in np.unique(lengths).tolist():
            rolled = _rolling(self.ids, k)
            chosen = np.flatnonzero(lengths == k)
            places = np.concatenate([np.arange(starts[t], starts[t + 1] - k + 1) for t in chosen.tolist()])
            owners = np.repeat([texts[t][0] for t in chosen.tolist()], starts[chosen + 1] - starts[chosen] - k + 1)
            hashes = rolled[places]
            order = np.lexsort((owners, hashes))
            hashes, places, owners = hashes[order], places[order].astype(np.int32), owners[order].astype(np.int32)
            fresh = np.ones(len(order), bool)  # an item's own repeats: one entry for each stretch of equal ones
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
            again = np.flatnonzero(~fresh)
            step = np.arange(k)
            for at in range(0, len(again), 65536):
                some = again[at : at + 65536]
                same = (self.ids[places[some][:, None] + step] == self.ids[places[some - 1][:, None] + step]).all(1)
                fresh[some[~same]] = True
            self.by_length[k] = (hashes[fresh], places[fresh], owners[fresh])

    @property
    def nbytes(self) -> int:
        """Of the arrays, and about that of the words."""
        arrays = self.ids.nbytes + sum(a.nbytes for held in self.by_length.values() for a in held)
        return arrays + sum(len(w) + 120 for w in self.words)

    def hits(self, text: str) -> tuple[int, np.ndarray, set]:
        """Number of words, a mark per word that lies in a window, ids of the items hit."""
        words = words_of(text)
        get = self.words.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        marks, items = np.zeros(len(ids) + 1, np.int64), set()
        for k, (hashes, places, owners) in self.by_length.items():
            if len(ids) < k:
                continue
            foreign = np.concatenate([[0], np.cumsum(ids == 0)])
            starts = np.flatnonzero(foreign[k:] == foreign[:-k])
            if not len(starts):
                continue
            rolled = _rolling(ids, k)[starts]
            first = np.searchsorted(hashes, rolled, "left")
            last = np.searchsorted(hashes, rolled, "right")
            for s, a, b in zip(starts[first < last].tolist(), first[first < last].tolist(), last[first < last].tolist()):
                for w in range(a, b):
                    if (self.ids[places[w] : places[w] + k] == ids[s : s + k]).all():
                        marks[s] += 1
                        marks[s + k] -= 1
                        if owners[w] >= 0:
                            items.add(self.names[owners[w]])
        return len(ids), np.cumsum(marks)[:-1] > 0, items


def _slices(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[int, Iterator[list]]:
    """Number of slices, and the items of each."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-int(total) // SLICE_BYTES))
    at = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return count, ([tuple(r) for r in items.filter(at == k).collect()] for k in range(count))


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


HIT_SCHEMA = "doc_id {id}, text_key long, n_words long, spans array<struct<a:int,b:int>>, items array<string>"


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id"
) -> DataFrame:
    """Per document row: its number of words, the word spans inside benchmark windows, the items found."""
    source = ids_and_texts(docs).select("doc_id", text_key().alias("text_key"), "text")
    count, slices = _slices(benchmark, item_col, "text")
    if count == 1:
        return _scan(source, next(slices), window)[0].drop("text_key")
    hits = _hits(source, slices, window)
    none = [F.array().cast(hits.schema[name].dataType) for name in ("spans", "items")]
    rows = _scan(source, [], window)[0].select("doc_id", "text_key", "n_words").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_key") == F.col("h.text_key"))
    return rows.join(hits.alias("h"), same, "left").select(
        "d.doc_id",
        "d.n_words",
        F.coalesce("h.spans", none[0]).alias("spans"),
        F.coalesce("h.items", none[1]).alias("items"),
    )


def _scan(source: DataFrame, items: list, window: int) -> tuple[DataFrame, Broadcast]:
    """The hits of some items in every row of ``doc_id, text_key, text``, and the broadcast they are read from."""
    known = source.sparkSession.sparkContext.broadcast(WindowSet(items, window))
    struct = pa.struct([("a", pa.int32()), ("b", pa.int32())])

    def make():
        windows = known.value

        def step(batch):
            counts, spans, found = [], [], []
            for text in batch.column(2).to_pylist():
                n, marks, names = windows.hits(text)
                counts.append(n)
                spans.append([{"a": a, "b": b} for a, b in _runs(marks)] if names or marks.any() else [])
                found.append(sorted(names))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(struct)),
                    pa.array(found, pa.list_(pa.string())),
                ],
                names=["doc_id", "text_key", "n_words", "spans", "items"],
            )

        return step

    schema = HIT_SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString())
    return map_batches(source, make, schema), known


def _hits(source: DataFrame, slices: Iterator[list], window: int) -> DataFrame:
    """``doc_id, text_key, spans, items`` of the documents that any slice hits, spans sorted by start.

    A slice's hits are written, then its set is let go: one set at a time is in memory.
    """
    parts = None
    for items in slices:
        found, known = _scan(source, items, window)
        part = durable(found.filter(F.size("spans") > 0).drop("n_words"), "hits")
        known.destroy()
        parts = part if parts is None else parts.unionByName(part)
    # rows equal in id and text have equal hits, so one of them stands for all
    parts = parts.groupBy("doc_id", "text_key").agg(F.collect_set("spans").alias("s"), F.collect_set("items").alias("i"))
    return parts.select(
        "doc_id",
        "text_key",
        F.array_sort(F.array_distinct(F.flatten("s"))).alias("spans"),
        F.array_distinct(F.flatten("i")).alias("items"),
    )


def _covered(spans):
    """Words covered by spans sorted by start; spans of different slices may overlap."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["b"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["end"], s["a"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document."""
    hits = contaminated_spans(docs, benchmark, window)
    n_hit = _covered(F.col("spans"))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, drop_share: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``docs`` without benchmark passages, all other columns kept.

    A document of which at least ``drop_share`` of the words lie in benchmark windows is dropped; in the
    others the characters from the first to the last word of each hit span are cut out.  With several slices the
    hits of all are found on the uncut text first, so the share is judged and the text cut once.
    Documents without hits keep their text byte for byte (null stays null).
    """
    count, slices = _slices(benchmark, "item_id", "text")
    if count == 1:
        known = docs.sparkSession.sparkContext.broadcast(WindowSet(next(slices), window))
        return _without(docs, docs, text_col, drop_share, lambda text, _: known.value.hits(text)[1])
    name = "spans"
    while name in docs.columns:
        name += "_"
    keyed = docs.select(F.col("doc_id"), text_key(text_col).alias("text_key"), F.struct("*").alias("row"))
    source = ids_and_texts(docs, text_col=text_col).select("doc_id", text_key().alias("text_key"), "text")
    hits = _hits(source, slices, window).alias("h")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_key") == F.col("h.text_key"))
    rows = keyed.alias("d").join(hits, same, "left").select("d.row.*", F.col("h.spans").alias(name))
    return _without(rows, docs, text_col, drop_share, _marks_of)


def _marks_of(text: str, spans: list[dict] | None) -> np.ndarray:
    marks = np.zeros(len(words_of(text)) if spans else 0, bool)
    for s in spans or []:
        marks[s["a"] : s["b"]] = True
    return marks


def _without(rows: DataFrame, docs: DataFrame, text_col: str, drop_share: float, marks_of) -> DataFrame:
    """The columns of ``docs`` in ``rows``, each text judged and cut once by its marks.

    ``marks_of`` takes a text and the last column of ``rows`` and gives a mark per word, or none without hits.
    """
    names = docs.columns
    at = names.index(text_col)

    def make():
        def step(batch):
            texts, keep = [], []
            for text, last in zip(batch.column(at).to_pylist(), _spans_column(batch, len(names))):
                marks = marks_of(text or "", last)
                hit = int(marks.sum())
                keep.append(hit == 0 or hit < drop_share * len(marks))
                texts.append(text if hit == 0 or not keep[-1] else _cut(text, marks))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

        return step

    return map_batches(rows, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def _spans_column(batch: pa.RecordBatch, at: int) -> list:
    return batch.column(at).to_pylist() if batch.num_columns > at else [None] * batch.num_rows


def _cut(text: str, marks: np.ndarray) -> str:
    data = text.encode()
    plain = np.frombuffer(data.translate(_WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], plain.astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    out, last = [], 0
    for a, b in _runs(marks):
        out.append(data[last : starts[a]])
        last = int(ends[b - 1])
    out.append(data[last:])
    return b"".join(out).decode()

