"""Near-duplicate documents by SimHash links, verified and completed by exact Jaccard similarity of word shingles.

Two documents are linked if their sets of ``WORDS_PER_SHINGLE``-word shingles have a Jaccard similarity of
``LEAST`` or more; of every connected group one document stays.  Documents with equal sets are one node, so any
number of copies is one entry.

First come the links of ``simhash``: a fingerprint over the distinct shingles of each node, equal fingerprints as a star,
and those that agree in a 32-bit segment but for one wildcard bit.  Each is verified on the shingles themselves, and what is
linked is one group of ``components`` from then on.  Fingerprints find the closer copies: a similarity of 0.8 alone
means about ten differing bits of 64, and no bound on bits finds all such pairs without comparing most documents.

So the groups are completed.  Linked nodes share a band of ``ROWS`` min-hashes, of which there are ``BANDS``: a pair
at similarity 0.8 shares none with a probability of (1 - 0.8^4)^40 < 10^-9.  Nodes of different groups that share a band
are first compared with one hub per band, which joins a large group with as many comparisons
as it has members.  Bands are no measure of similarity from 0.8 on: documents around a common passage share them too.
So the pairs of nodes that are left in different groups of a band are not enumerated.  Their nodes are joined by an exact
prefix filter instead: shingles ordered by how many of these nodes have them, rarest first, two sets of similarity
``LEAST`` share one among the first few of each (``prefixes``), and where two sets first agree, enough must follow in
both.  There too, the nodes of a list are first compared with one of them, the one with the fewest shingles of its own.
What many documents share comes last in that order, so a common passage makes no candidates unless it makes up so much
of them that they are alike.  Every candidate is verified on the shingles.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, map_batches, release_shuffles, text_key
from tidewell.llm.components import components
from tidewell.llm.simhash import links as fingerprint_links
from tidewell.llm.simhash import listed_once, majority, shingle_hashes
from tidewell.session import durable

WORDS_PER_SHINGLE = 5
LEAST = 0.8
ROWS = 4
BANDS = 40
HUB_ROUNDS = 2
SLICE = 512
HELD_BYTES = 16 << 20  # of shingle sets kept for the next pairs
_RNG = np.random.default_rng(42)
_XORS = _RNG.integers(0, 2**64, ROWS * BANDS, np.uint64)
_ODDS = _RNG.integers(0, 2**64, ROWS * BANDS, np.uint64) | np.uint64(1)
_SEEDS = _RNG.integers(0, 2**64, BANDS, np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, k: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, k))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: equal where all min-hashes of the band are equal."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), SLICE):
        mixed = hashes[None, at : at + SLICE] ^ _XORS[:, None]
        mixed *= _ODDS[:, None]
        np.minimum(least, mixed.min(1), out=least)
    keys = _SEEDS.copy()
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ row) * _PRIME
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def sketches(docs: DataFrame, k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``doc_id, text_key, set_key, n, fp, bands`` for every row; no bands for a text without words; narrow."""
    source = ids_and_texts(docs).select("doc_id", text_key().alias("text_key"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch):
            keys, sizes, fps, bands = [], [], [], []
            for text in batch.column(2):
                hashes = shingle_set(text.as_py(), k)
                keys.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                sizes.append(len(hashes))
                fps.append(majority(hashes))
                bands.append(band_keys(hashes) if len(hashes) else np.array([], np.int64))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(fps, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "set_key", "n", "fp", "bands"],
            )

        return step

    return map_batches(source, make, f"doc_id {kind}, text_key long, set_key long, n long, fp long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """The ``(u, v)`` pairs whose shingle sets have a Jaccard similarity of at least ``least``."""
    mine = texts.select(F.col("set_key").alias("u"), F.col("text").alias("text_u"))
    other = texts.select(F.col("set_key").alias("v"), F.col("text").alias("text_v"))
    both = pairs.join(other, "v").join(mine, "u").select("u", "v", "text_u", "text_v")

    def make():
        held: OrderedDict[int, np.ndarray] = OrderedDict()
        size = 0

        def of(key, text):
            nonlocal size
            if key in held:
                held.move_to_end(key)
                return held[key]
            found = held[key] = shingle_set(text.as_py(), k)
            size += found.nbytes
            while size > HELD_BYTES and len(held) > 1:
                size -= held.popitem(last=False)[1].nbytes
            return found

        def step(batch):
            near = []
            us, vs = (batch.column(i).to_pylist() for i in (0, 1))
            for u, v, a, b in zip(us, vs, batch.column(2), batch.column(3)):  # texts become strings one at a time
                one, two = of(u, a), of(v, b)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                near.append(shared / (len(one) + len(two) - shared) >= least)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(near))

        return step

    return map_batches(both, make, "u long, v long")


def _labelled(runs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``runs`` with the group of every node."""
    if roots is None:
        return runs.withColumn("label", F.col("set_key"))
    named = roots.withColumnRenamed("u", "set_key")
    return runs.join(named, "set_key", "left").withColumn("label", F.coalesce("root", "set_key")).drop("root")


def _ordered(u: str, v: str, least: float):
    """Smaller and larger node of a pair, unless their sizes already exclude ``least``."""
    close = F.least("n", "n_hub") >= F.lit(least) * F.greatest("n", "n_hub") - F.lit(1e-6)
    return close, F.least(u, v).alias("u"), F.greatest(u, v).alias("v")


def _fingerprint_pairs(nodes: DataFrame, least: float) -> DataFrame:
    """Nodes with the first node of their fingerprint, and first nodes of fingerprints that ``simhash`` links."""
    prints = durable(nodes.filter("n > 0").select("set_key", "n", "fp"), "fingerprints")
    first = prints.groupBy("fp").agg(F.min(F.struct("set_key", "n")).alias("f"))
    hubs = durable(first.select("fp", F.col("f.set_key").alias("hub"), F.col("f.n").alias("n_hub")), "hubs")
    met = fingerprint_links(hubs.select("fp")).distinct().withColumnRenamed("v", "fp")
    met = met.join(hubs, "fp").select(F.col("u").alias("fp"), "hub", "n_hub")
    across = hubs.select("fp", F.col("hub").alias("set_key"), F.col("n_hub").alias("n")).join(met, "fp")
    both = prints.join(hubs, "fp").unionByName(across).filter("set_key <> hub")
    close, u, v = _ordered("set_key", "hub", least)
    return both.filter(close).select(u, v).distinct()


def _hub_pairs(labelled: DataFrame, turn: int, least: float) -> DataFrame:
    """Every node of a band with the band's hub, another one each turn."""
    band = Window.partitionBy("sig").orderBy(F.xxhash64("set_key", F.lit(turn)), "set_key")
    hub = F.first(F.struct("set_key", "label", F.col("n").alias("n"))).over(band)
    rows = labelled.withColumn("hub", hub).select(
        "set_key", "label", "n", F.col("hub.set_key").alias("h"), F.col("hub.label").alias("hl"), F.col("hub.n").alias("n_hub")
    )
    close, u, v = _ordered("set_key", "h", least)
    return rows.filter((F.col("label") != F.col("hl")) & close).select(u, v).distinct()


def _open_nodes(labelled: DataFrame) -> DataFrame:
    """``set_key`` of the nodes that share a band with a node of another group."""
    span = labelled.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return labelled.join(span.filter("low <> high").select("sig"), "sig").select("set_key").distinct()


def _shingles(texts: DataFrame, k: int) -> DataFrame:
    """``set_key, n, h``: the distinct shingle hashes of each text; narrow."""

    def make():
        def step(batch):
            sets = [shingle_set(text.as_py(), k) for text in batch.column(1)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["set_key", "n", "hs"],
            )

        return step

    sets = map_batches(texts.select("set_key", "text"), make, "set_key long, n long, hs array<long>")
    return sets.select("set_key", "n", F.explode("hs").alias("h"))


def _rounded_up(x):
    return F.ceil(x - F.lit(1e-6))


def prefixes(shingles: DataFrame, least: float) -> DataFrame:
    """``set_key, n, h, at, short``: the first shingles of each set, rarest first, ``at`` counted from 0.

    A set of n shingles meets sets of its size or smaller ones through its first n - least n + 1; a set need
    only be found by others through its first n - 2 least / (1 + least) n + 1 (``short``).  Shingles that no other
    set has lead nowhere: they are counted, not listed.
    """
    df = shingles.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    shared = shingles.join(df, "h").groupBy("set_key").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "h"))).alias("s"))
    alone = F.col("n") - F.size("s")
    rows = shared.select("set_key", "n", alone.alias("alone"), F.posexplode("s").alias("i", "x"))
    rows = rows.select("set_key", "n", "x.h", (F.col("alone") + F.col("i")).alias("at"))
    rows = rows.filter(F.col("at") <= F.col("n") - _rounded_up(F.col("n") * least))
    return rows.withColumn("short", F.col("at") <= F.col("n") - _rounded_up(F.col("n") * (2 * least / (1 + least))))


def _open_lists(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``lists`` with the group of every node, without the shingles all of whose nodes are in one group."""
    rows = _labelled(lists, roots)
    groups = rows.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return rows.join(groups.select("h"), "h", "left_semi")


def _first_pairs(lists: DataFrame, least: float) -> DataFrame:
    """Every node of a shingle's list with the one for which the shingle comes first.

    That one has the fewest shingles of its own: the text that others are edits of, if it is there.
    """
    first = lists.groupBy("h").agg(F.min(F.struct("at", "set_key", "label", "n")).alias("f"))
    rows = lists.join(first, "h").select(
        "set_key", "label", "n", F.col("f.set_key").alias("hub"), F.col("f.label").alias("hl"), F.col("f.n").alias("n_hub")
    )
    close, u, v = _ordered("set_key", "hub", least)
    return rows.filter((F.col("label") != F.col("hl")) & close).select(u, v).distinct()


def _prefix_pairs(lists: DataFrame, least: float) -> DataFrame:
    """Pairs of nodes of different groups that the prefix filter leaves."""
    found = lists.filter("short").select(
        "h", F.col("set_key").alias("v"), F.col("n").alias("m"), F.col("at").alias("bt"), F.col("label").alias("other")
    )
    sizes = (F.col("m") <= F.col("n")) & (F.col("m") >= F.lit(least) * F.col("n") - F.lit(1e-6))
    needed = F.lit(least / (1 + least)) * (F.col("n") + F.col("m")) - F.lit(1e-6)
    follow = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("bt")) >= needed
    met = lists.join(found, "h").filter((F.col("label") != F.col("other")) & sizes & follow)
    return met.select(F.least("set_key", "v").alias("u"), F.greatest("set_key", "v").alias("v")).distinct()


def groups(docs: DataFrame, k: int = WORDS_PER_SHINGLE, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_key, set_key)`` of every row, and ``(set_key, one, root)`` of every distinct set."""
    prints = durable(sketches(docs, k), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    nodes = prints.groupBy("set_key").agg(
        first.alias("one"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")
    )
    alike = durable(_fingerprint_pairs(nodes, least), "alike")
    spread = nodes.select("set_key", "n", F.explode("bands").alias("sig"))
    shared = F.count("*").over(Window.partitionBy("sig"))
    runs = durable(spread.withColumn("shared", shared).filter("shared > 1").drop("shared"), "bands")
    one = nodes.select("set_key", "one")
    met = runs.select("set_key").unionByName(alike.select(F.explode(F.array("u", "v")).alias("set_key"))).distinct()
    members = one.join(met, "set_key").select("set_key", "one.doc_id", "one.text_key")
    own = ids_and_texts(docs).select("doc_id", text_key().alias("text_key"), "text")
    same = own["doc_id"].eqNullSafe(members["doc_id"]) & (own["text_key"] == members["text_key"])
    texts = durable(own.join(members, same).select("set_key", "text").dropDuplicates(["set_key"]), "texts")
    release_shuffles(docs.sparkSession)

    links = tested = roots = lists = None
    for turn in range(-1, HUB_ROUNDS + 2):
        if turn < 0:
            pairs = alike
        elif turn < HUB_ROUNDS:
            pairs = _hub_pairs(_labelled(runs, roots), turn, least)
        elif turn == HUB_ROUNDS:
            left = durable(_open_nodes(_labelled(runs, roots)), "open")
            shingles = _shingles(texts.join(left, "set_key", "left_semi"), k)
            lists = durable(prefixes(shingles, least), "prefixes")
            pairs = _first_pairs(_open_lists(lists, roots), least)
        else:
            pairs = _prefix_pairs(_open_lists(lists, roots), least)
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = pairs if turn < 0 else durable(pairs, "pairs")
        found = durable(_verified(pairs, texts, k, least), "near")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            roots = components(links)
    if roots is None:
        return prints, one.withColumn("root", F.col("set_key"))
    named = one.join(roots.withColumnRenamed("u", "set_key"), "set_key", "left")
    return prints, named.withColumn("root", F.coalesce("root", "set_key"))


def keep_one(docs: DataFrame, k: int = WORDS_PER_SHINGLE, least: float = LEAST) -> DataFrame:
    """``docs`` with one row of each group: the smallest ``doc_id`` (then the smallest text hash)."""
    prints, named = groups(docs, k, least)
    chosen = named.groupBy("root").agg(F.min("one").alias("one")).select("one.doc_id", "one.text_key")
    chosen = durable(chosen, "kept")
    release_shuffles(docs.sparkSession)
    return listed_once(docs, prints, chosen)
