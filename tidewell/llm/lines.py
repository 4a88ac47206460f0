"""Removal of repeated line runs; DataFrame functions only.

The corpus is one sequence of line ids: documents in order of ``(doc_id, text hash)``, lines in order, a
unique end mark after each document.  Blank lines take no part and stay.  Suffixes are ordered by distributed
prefix doubling: round k joins the table of suffix ranks with itself 2^k lines further on, sorts the distinct pairs of
ranks by range and numbers them in that order.  Suffixes of equal rank share their first 2^(k+1) lines: they are one
longest-common-prefix interval of the suffix array.  Intervals of one suffix are dropped, since no longer one can come of them,
so each round carries only suffixes that still repeat, and rounds end when none is left.

A suffix in an interval whose first position is earlier starts a later copy.  Its lines go if the copy has at least
``min_lines`` lines, or is one line of at least ``min_chars`` characters; overlapping copies merge into maximal runs.

Lines move as 128-bit hashes, texts only when they are put together again.  Hot lines are counted before they are
shuffled; the joins on line ids and ranks are ones adaptive execution can split.  Null and empty texts have no
lines.  A document listed twice is one document: neither row loses lines to the other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import packed, text_key
from tidewell.session import durable

MIN_LINES = 2
MIN_CHARS = 40


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def positions(docs: DataFrame) -> DataFrame:
    """``p, doc, seq, ln, h1, h2, chars``: every non-blank line and, with null ``ln``, an end mark per document.

    ``p`` grows with ``(doc_id, text hash, line)``; neighbours in a document differ by one.
    """
    numbered = F.transform(
        _lines(F.col("text")),
        lambda x, i: F.struct(
            i.alias("ln"),
            F.xxhash64(x).alias("h1"),
            F.xxhash64(F.lit("second"), x).alias("h2"),
            F.length(x).alias("chars"),
            F.length(F.btrim(x, F.lit(" \t\r"))).alias("solid"),
        ),
    )
    marked = F.filter(numbered, lambda x: x["solid"] > 0)
    end = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in [("ln", "int"), ("h1", "long"), ("h2", "long"), ("chars", "int"), ("solid", "int")]])
    rows = docs.select(F.struct("doc_id", text_key().alias("text_key")).alias("doc"), F.col("text")).select(
        "doc", F.posexplode(F.concat(marked, F.array(end))).alias("seq", "line")
    )
    rows = rows.select("doc", "seq", "line.ln", "line.h1", "line.h2", "line.chars")
    placed = rows.distinct().repartitionByRange("doc").sortWithinPartitions("doc", "seq")
    return durable(placed.select(F.monotonically_increasing_id().alias("p"), "*"), "lines")


def _ranked(keys: DataFrame, *names: str) -> DataFrame:
    """Distinct repeated keys with a rank that follows their order."""
    spread = keys.filter("n > 1").repartitionByRange(*names).sortWithinPartitions(*names)
    return durable(spread.select(F.monotonically_increasing_id().alias("r"), *names, "first"), "ranks")


def intervals(lines: DataFrame, most: int | None = None) -> DataFrame:
    """``p, size, first``: for each suffix and each power of two up to its longest repeat, the earliest equal block.

    ``size`` lines from ``p`` equal those from ``first``.  ``most`` ends the doubling at that size.
    """
    solid = lines.filter("ln is not null").select("p", "h1", "h2")
    repeated = solid.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("p").alias("first"))
    now = solid.join(_ranked(repeated, "h1", "h2"), ["h1", "h2"])
    now, size, found = durable(now.select("p", "r", "first"), "suffixes"), 1, []
    while not now.isEmpty():
        found.append(now.select("p", F.lit(size).alias("size"), "first"))
        if most is not None and size >= most:
            break
        ahead = now.select((F.col("p") - size).alias("p"), F.col("r").alias("r2"))
        pairs = durable(now.select("p", F.col("r").alias("r1")).join(ahead, "p"), "pairs")
        repeated = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.min("p").alias("first"))
        now = pairs.join(_ranked(repeated, "r1", "r2"), ["r1", "r2"]).select("p", "r", "first")
        now, size = durable(now, "suffixes"), size * 2
    if not found:
        return now.select("p", F.lit(1).alias("size"), "first")
    return reduce(DataFrame.unionAll, found)


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS, lengths: bool = True) -> DataFrame:
    """``doc, n_removed, n_runs, longest_run, longest_copy, removed`` of documents that lose lines.

    ``removed`` holds the line numbers in order; ``longest_copy`` is the largest power of two of lines copied from
    one earlier place.  ``min_lines`` is a power of two.  What goes is settled by blocks of one and of ``min_lines`` lines;
    without ``lengths`` the doubling ends there, and ``longest_copy`` with it.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    lines = positions(docs)
    copies = intervals(lines, None if lengths else min_lines).filter("first < p").select("p", "size")
    # longer copies lie within copies of min_lines lines
    deepest = copies.groupBy("p").agg(F.max("size").alias("deep"), F.array_contains(F.collect_set("size"), min_lines).alias("runs"))
    single = lines.filter(F.col("chars") >= min_chars).select("p")
    alone = deepest.join(single, "p", "left_semi").select("p", F.lit(1).alias("go"), "deep")
    many = deepest.filter("runs").select("p", F.lit(min_lines).alias("go"), "deep")
    gone = alone.unionAll(many).select(
        F.explode(F.sequence(F.col("p"), F.col("p") + F.col("go") - 1)).alias("p"), "deep"
    )
    gone = gone.groupBy("p").agg(F.max("deep").alias("deep")).join(lines.select("p", "doc", "seq", "ln"), "p")
    gone = gone.groupBy("doc", "seq").agg(F.max("deep").alias("deep"), F.first("ln").alias("ln"))
    order = Window.partitionBy("doc").orderBy("seq")
    runs = gone.withColumn("run", F.col("seq") - F.row_number().over(order)).groupBy("doc", "run")
    runs = runs.agg(F.count("*").alias("n"), F.max("deep").alias("deep"), F.collect_list("ln").alias("part"))
    return runs.groupBy("doc").agg(
        F.sum("n").alias("n_removed"),
        F.count("*").alias("n_runs"),
        F.max("n").alias("longest_run"),
        F.max("deep").alias("longest_copy"),
        F.array_sort(F.flatten(F.collect_list("part"))).alias("removed"),
    )


def _masked(removed: DataFrame) -> DataFrame:
    """``stay``: per line up to the last removed one, whether it stays; built in one pass over ``removed``."""
    gaps = F.transform(
        F.arrays_zip(F.col("removed").alias("at"), F.concat(F.array(F.lit(-1)), "removed").alias("last")),
        lambda x: F.concat(
            F.array_repeat(F.lit(True), F.greatest(x["at"] - x["last"] - 1, F.lit(0))), F.array(F.lit(False))
        ),
    )
    gaps = F.slice(gaps, 1, F.size("removed"))
    return removed.withColumn("stay", F.flatten(gaps)).drop("removed")


def _cut(docs: DataFrame, min_lines: int, min_chars: int, lengths: bool = True) -> DataFrame:
    """``row`` (the columns of ``docs``), ``left`` (the text that stays) and the counts of ``later_copies``."""
    gone = durable(_masked(later_copies(docs, min_lines, min_chars, lengths)), "removed")
    own = packed(docs)
    same = own["doc_id"].eqNullSafe(gone["doc.doc_id"]) & (own["text_key"] == gone["doc.text_key"])
    rows = own.join(gone, same, "left")
    text = F.col("row.text")
    staying = F.filter(_lines(text), lambda x, i: F.coalesce(F.get(F.col("stay"), i), F.lit(True)))
    left = F.when(F.col("stay").isNull(), text).otherwise(F.array_join(staying, "\n"))
    return rows.select("row", left.alias("left"), *[c for c in gone.columns if c not in ("doc", "stay")])


def _solid(text: Column) -> Column:
    return F.size(F.filter(_lines(text), lambda x: F.length(F.btrim(x, F.lit(" \t\r"))) > 0))


def report(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_runs, longest_run, longest_copy, kept_sha256`` for every document."""
    rows = _cut(docs.select("doc_id", "text"), min_lines, min_chars)
    names = ["n_removed", "n_runs", "longest_run", "longest_copy"]
    return rows.select(
        "row.doc_id",
        _solid(F.col("row.text")).cast("long").alias("n_lines"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names],
        F.sha2(F.coalesce("left", F.lit("")), 256).alias("kept_sha256"),
    )


def remove_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without later copies of line runs.

    A document that loses all its non-blank lines is dropped; one that had none before stays.
    """
    rows = _cut(docs, min_lines, min_chars, lengths=False)
    rows = rows.filter(F.col("n_removed").isNull() | (_solid(F.col("left")) > 0))
    return rows.select(*[F.col("left").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
