"""A training-corpus pipeline over ``documents``: each stage reads what its predecessor wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewell.llm import bpe, decontaminate, lines, neardup, quality
from tidewell.llm.common import table
from tidewell.session import scratch_path, ship_package

VOCABULARY = "byte_bpe_50k.tiktoken"


def _recounted(docs):
    """``n_chars`` follows a text that was cut."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")
    return quality.keep_good(docs, labels)


def line_dedup(spark, docs, sf_dir):
    """Documents without later copies of line runs; those left without a line go."""
    return _recounted(lines.remove_copies(docs))


def near_dedup(spark, docs, sf_dir):
    """One document of each group linked by a similarity of 0.8 or more of their five-word shingles.

    SimHash links come first and are verified; an exact similarity join completes their groups.
    """
    return neardup.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without benchmark passages; those that are mostly benchmark go."""
    return _recounted(decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark")))


def encoding(spark, docs, sf_dir):
    """Token ids of the texts that are left, and whether they decode to the same text."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.checked_ids(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: Hash functions, learned scores and token ids have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply ``STAGES`` in order to the whole ``documents`` table; stages hand over written tables."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
