"""How document filters interact, with a counting-Bloom pass before the duplicate filter; DataFrame functions only.

Five filters, in any order: A few words, B few different words, C many capitals, D symbols, E a text that a smaller
``doc_id`` has too.  Only E looks across documents.  Its prepass hashes every text to ``SLOTS`` counters of one block
of a counting Bloom filter, which grows with the table (``COUNTERS_PER_DOC``); counters are summed within tasks
before they meet, so any number of copies is one row per task.  A text of which one counter says 1 is unique.
The others' blocks, as bitmaps of counters above 1, go back to the documents (broadcast up to ``BROADCAST_BYTES``,
joined by block beyond that), and only possible repeats are grouped by their full text for the smallest id.

The failed filters of a document are bits of a mask.  Everything asked for is a sum over documents per part and mask,
so one small table of at most 32 rows per part holds all orders' results.

Edge cases: a null text is an empty one; a null ``lang`` is the empty part; a document without an id is no smaller
document to any other, fails E under no circumstances, and has no labels; rows listed twice are counted twice, and as
equal ids are not smaller they do not fail E because of each other.  Labels listed twice count once.  No documents, no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import durable

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
BLOCK = 32768  # counters of a block: the bits of one bitmap
COUNTERS_PER_DOC = 16
SLOTS = 3
BROADCAST_BYTES = 32 << 20
SUMS = ["n", "good", "toxic"]


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def marks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, h, digest`` of every row: bits of A to D, a hash and a digest of the text; narrow."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE, -1), ""))
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    failed = {
        "A": words < LEAST_WORDS,
        "B": 100 * distinct < LEAST_DISTINCT_PERCENT * words,
        "C": 100 * capitals > MAX_CAPITALS_PERCENT * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }
    mask = sum((F.when(c, bit(x)).otherwise(0) for x, c in failed.items()), F.lit(0))
    return rows.select("doc_id", "part", mask.alias("mask"), F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("digest"))


def _block(blocks: int) -> Column:
    return F.pmod(F.col("h"), F.lit(blocks)).alias("block")


def _positions() -> list[Column]:
    """The counters of a text within its block, from 15 bits of a second hash each."""
    again = F.xxhash64("h", F.lit("slots"))
    return [F.shiftrightunsigned(again, 15 * i).bitwiseAND(BLOCK - 1).cast("int") for i in range(SLOTS)]


def repeated_slots(marked: DataFrame, blocks: int) -> DataFrame:
    """``block, bits``: the merged sketch, as bitmaps of the counters above 1; blocks without any are left out."""
    slots = marked.select(_block(blocks), F.explode(F.array_distinct(F.array(*_positions()))).alias("slot"))
    full = slots.groupBy("block", "slot").agg(F.count("*").alias("n")).filter("n > 1")
    return full.groupBy("block").agg(F.bitmap_construct_agg(F.col("slot").cast("long")).alias("bits"))


def possible_repeats(rows: DataFrame, sketch: DataFrame, blocks: int) -> Column:
    """``rows`` (with the hash ``h``) and whether the sketch leaves it open that another row has the same text."""
    byte = lambda p: F.conv(F.hex(F.substring("bits", F.shiftright(p, 3) + 1, F.lit(1))), 16, 10).cast("long")
    every = reduce(and_, [F.getbit(byte(p), p.bitwiseAND(7)) == 1 for p in _positions()])
    met = rows.withColumn("block", _block(blocks)).join(sketch, "block", "left")
    return met.withColumn("open", F.coalesce(every, F.lit(False))).drop("block", "bits")


def flagged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask`` of every row, with the bits of all five filters."""
    marked = durable(marks(docs), "marks")
    blocks = max(1, -(-marked.count() * COUNTERS_PER_DOC // BLOCK))
    sketch = durable(repeated_slots(marked, blocks), "sketch")
    if sketch.count() * BLOCK // 8 <= BROADCAST_BYTES:
        sketch = F.broadcast(sketch)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.filter("doc_id is not null").withColumn("h", F.xxhash64("text"))
    alike = possible_repeats(texts, sketch, blocks).filter("open").groupBy("text")
    first = alike.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    first = durable(first.select(F.sha2("text", 256).alias("digest"), "first"), "repeats")
    tested = possible_repeats(marked, sketch, blocks)
    later = tested.filter("open").join(first, "digest", "left")
    fails = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    later = later.withColumn("mask", F.when(fails, F.col("mask") + bit("E")).otherwise(F.col("mask")))
    columns = ["doc_id", "part", "mask"]
    return tested.filter("not open").select(*columns).unionAll(later.select(*columns))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of every combination of failed filters."""
    rows = durable(flagged(docs), "flagged")
    own = labels.select(
        "doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("g"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("t")
    )
    own = own.filter("g or t").groupBy("doc_id").agg(F.max("g").cast("long").alias("good"), F.max("t").cast("long").alias("toxic"))
    counted = rows.groupBy("part", "mask").agg(F.count("*").alias("n"))
    marked = rows.join(own, "doc_id").groupBy("part", "mask").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    every = counted.join(marked, ["part", "mask"], "left")
    return every.select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see the module's docstring for the counts."""
    cells = durable(mask_counts(docs, labels), "masks").groupBy("part").agg(F.collect_list(F.struct("mask", *SUMS)).alias("cells"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = cells.select("part", "cells", F.explode(orders).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    weight = F.create_map(*[x for f in FILTERS for x in (F.lit(f), F.lit(bit(f)))])
    earlier = F.transform(F.slice(F.split("filter_order", ""), F.lit(1), F.col("step") - 1), lambda f: F.element_at(weight, f))
    rows = rows.select(
        "*",
        F.element_at(weight, F.substring("filter_order", F.col("step"), F.lit(1))).alias("own"),
        F.aggregate(earlier, F.lit(0), lambda a, b: a + b).alias("earlier"),
    )

    def total(test, value=lambda cell: cell["n"]) -> Column:
        return F.aggregate(F.filter("cells", test), F.lit(0).cast("long"), lambda a, cell: a + value(cell))

    own, before = F.col("own"), F.col("earlier")
    fails = lambda cell: cell["mask"].bitwiseAND(own) > 0
    here = lambda cell: fails(cell) & (cell["mask"].bitwiseAND(before) == 0)
    orders_each = lambda cell: cell["n"] * (F.lit(120) / F.bit_count(cell["mask"])).cast("long")  # noqa: E731  those in which it comes first
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda cell: cell["mask"].bitwiseAND(own + before) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda cell: fails(cell) & (cell["mask"].bitwiseAND(before) > 0)).alias("redundant"),
        total(lambda cell: cell["mask"] == own).alias("unique_fails"),
        total(here, lambda cell: cell["good"]).alias("good_lost"),
        total(here, lambda cell: cell["toxic"]).alias("toxic_lost"),
        total(fails, orders_each).alias("shapley"),
    )
