"""Label expressions and encoders."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.cells import ref

BENIGN = "BENIGN"  # fixed value: the label of normal traffic


def binary_label(label: Column, benign: str = BENIGN) -> Column:
    """0 for the benign label, 1 for anything else including a missing label."""
    return F.coalesce((label != F.lit(benign)).cast("int"), F.lit(1))


def label_filter(df: DataFrame, label: str, pattern: str) -> DataFrame:
    """Rows whose label contains a match of the regular expression."""
    return df.filter(ref(label).rlike(pattern))


def fit_label_encoder(df: DataFrame, label: str, output: str = "label_id") -> StringIndexerModel:
    """Alphabetical class ids from 0; labels unseen at fit time get the next free id.

    The fitted model holds one string per class.
    """
    indexer = StringIndexer(
        inputCol=label, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return indexer.fit(df)


def encode_labels(df: DataFrame, label: str, output: str = "label_id") -> DataFrame:
    """Add the class id as an integer column."""
    encoded = fit_label_encoder(df, label, output).transform(df)
    return encoded.withColumn(output, F.col(output).cast("int"))
