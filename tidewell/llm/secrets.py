"""Secret scan with corpus-wide ownership frequency; DataFrame functions only.

Candidates are the matches of the fixed patterns below, found in whole texts.  Positions come from splitting a
text by the same pattern: the pieces and matches before a match add up to its start.  The values of all candidates
are hashed and counted corpus-wide by distinct repositories and distinct owners.  A value that several owners carry, or
very many repositories of fewer owners, is widely copied: an example.  One that stays within few repositories of few owners and
looks random is a live-looking credential.  Each verdict adds
a span over the value (kind ``example`` or ``live``); the candidates' own spans always stay.

Counts collapse to one row per value, repository and owner before they meet, so a value held by a third of all
documents is no hot group; the join that brings verdicts back is one adaptive execution can split.
Null and empty texts have no spans.  Each row gives a row; a document listed twice counts once.  A null owner or
repository counts as one owner or repository of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import text_key
from tidewell.session import durable

# Kind, pattern, group that holds the value, least length of that group.
KINDS = [
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # a run is matched whole, so shorter runs may be left out here
]
VERDICTS = ["live", "example"]
ORDER = [kind for kind, *_ in KINDS] + VERDICTS
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 50
RANDOM_CHARACTERS = 8


def _matches(text: Column, number: int, pattern: str, group: int) -> Column:
    """Per match: kind, its number, characters before it since the last match, its length, the value."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"), value.alias("value"))
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("at"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["hit"]).alias("size"),
            x["value"].alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), rows)


def candidates(docs: DataFrame, owner_col: str, repo_col: str, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text_key, owner, repo, kind, start, end, value_start, value``; code points, end exclusive."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
    )
    none = F.array().cast("array<struct<kind:int,at:int,gap:int,size:int,value:string>>")
    found = F.concat(
        *[
            F.coalesce(_matches(F.col("text"), n, pattern, group), none)
            for n, (_, pattern, group, _) in enumerate(KINDS)
        ]
    )
    rows = rows.select("doc_id", text_key().alias("text_key"), "owner", "repo", F.explode(found).alias("m"))
    rows = rows.select("doc_id", "text_key", "owner", "repo", "m.*").distinct()
    before = Window.partitionBy("doc_id", "text_key", "owner", "repo", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    return (
        rows.withColumn("end", end)
        .filter(F.length("value") >= least)
        .select(
            "doc_id",
            "text_key",
            "owner",
            "repo",
            "kind",
            (F.col("end") - F.col("size")).alias("start"),
            "end",
            (F.col("end") - F.length("value")).alias("value_start"),
            "value",
        )
    )


def ownership(found: DataFrame) -> DataFrame:
    """``value, n_repos, n_owners`` over the whole corpus."""
    held = found.select("value", "owner", "repo").distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def looks_random(value: Column) -> Column:
    """Digits among at least ``RANDOM_CHARACTERS`` different characters."""
    return (F.size(F.array_distinct(F.split(value, ""))) >= RANDOM_CHARACTERS) & value.rlike("[0-9]")


def scan(docs: DataFrame, owner_col: str = "source", repo_col: str = "doc_id", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text_key, spans`` of documents with candidates.

    ``spans`` is an array of ``(start, kind, end)``, kinds numbered as in ``ORDER``, in that order and without repeats.
    """
    live = F.when(looks_random(F.col("value")), F.lit(ORDER.index("live")))
    hashed = candidates(docs, owner_col, repo_col, id_col).withColumn("random", live)
    found = durable(hashed.withColumn("value", F.sha2("value", 256)), "candidates")  # no secret is written out
    counts = ownership(found)
    copied = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repos") >= EXAMPLE_REPOS)
    judged = found.join(counts, "value").withColumn(
        "added", F.when(copied, F.lit(ORDER.index("example"))).otherwise(F.col("random"))
    )
    own = F.struct(F.col("start"), F.col("kind"), F.col("end"))
    extra = F.struct(F.col("value_start").alias("start"), F.col("added").alias("kind"), F.col("end"))
    spans = judged.select("doc_id", "text_key", F.explode(F.array(own, extra)).alias("s")).filter("s.kind is not null")
    return spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("s")).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ORDER])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every document."""
    found = scan(docs)
    none = F.array().cast(found.schema["spans"].dataType)
    every = docs.select("doc_id", text_key().alias("text_key"))
    key = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key"))
    rows = every.alias("d").join(found.alias("f"), key, "left").select(
        F.col("d.doc_id").alias("doc_id"), F.coalesce("spans", none).alias("s")
    )
    counts = [_count(F.col("s"), n).alias(f"n_{kind}") for n, (kind, *_) in enumerate(KINDS)]
    base = F.filter("s", lambda x: x["kind"] < len(KINDS))
    return rows.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans")
    )
