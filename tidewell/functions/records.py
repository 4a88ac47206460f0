"""Keyed JSON records: partition keys, serialising, parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import ref

# Where a record's key may be found, in this order, and the key of a record without one.
KEY_FIELD = "Source_IP"
KEY_FALLBACKS = ("Source IP", "source_ip")
NO_KEY = "unknown"
KEY_PARTITIONS = 8
CORRUPT = "_corrupt_record"

# The flow record of the stream (integers and floats in their wide types).
FLOW_SCHEMA = T.StructType(
    [
        T.StructField("Source_IP", T.StringType()),
        T.StructField("Source_Port", T.LongType()),
        T.StructField("Destination_IP", T.StringType()),
        T.StructField("Destination_Port", T.LongType()),
        T.StructField("Protocol", T.LongType()),
        T.StructField("Flow_Duration", T.DoubleType()),
        T.StructField("Total_Fwd_Packets", T.LongType()),
        T.StructField("Total_Backward_Packets", T.LongType()),
        T.StructField("Flow_Bytes_per_s", T.DoubleType()),
        T.StructField("Flow_Packets_per_s", T.DoubleType()),
        T.StructField("Label", T.StringType()),
    ]
)
# The cleaned tables spell two of those fields with a slash.
FLOW_ALIASES = {"Flow_Bytes_per_s": "Flow_Bytes/s", "Flow_Packets_per_s": "Flow_Packets/s"}


def _truthy(df: DataFrame, name: str) -> Column:
    """The cell as text where it counts as a value: not NULL, not empty, not zero, not false."""
    dtype = df.schema[name].dataType
    cell = ref(name)
    if isinstance(dtype, T.StringType):
        kept = cell != ""
    elif isinstance(dtype, T.NumericType):
        kept = cell != 0
    elif isinstance(dtype, T.BooleanType):
        kept = cell
    else:
        kept = cell.isNotNull()
    return F.when(kept, cell.cast("string"))


def partition_key(
    df: DataFrame, field: str = KEY_FIELD, fallbacks: Sequence[str] = KEY_FALLBACKS, default: str = NO_KEY
) -> Column:
    """First usable value of the key field and its fallbacks, as text."""
    present = [c for c in dict.fromkeys([field, *fallbacks]) if c in df.columns]
    return F.coalesce(*[_truthy(df, c) for c in present], F.lit(default))


def key_slot(key: Column, partitions: int = KEY_PARTITIONS) -> Column:
    """Partition number of a key: equal keys share it."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def key_report(df: DataFrame, key: Column) -> DataFrame:
    """``n_keys, n_rows, top_share``: a share near 1 means the key does not spread the rows."""
    per_key = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy().agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.try_divide(F.max("n"), F.sum("n")).alias("top_share"),
    )


JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def record_value(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row as a JSON object; NULL fields are kept, times to the microsecond."""
    return F.to_json(F.struct(*[ref(c) for c in (columns or df.columns)]), JSON_OPTIONS)


def keyed_records(
    df: DataFrame, field: str = KEY_FIELD, fallbacks: Sequence[str] = KEY_FALLBACKS, default: str = NO_KEY
) -> DataFrame:
    """``key, value``: one keyed JSON record per row, a narrow projection."""
    return df.select(partition_key(df, field, fallbacks, default).alias("key"), record_value(df).alias("value"))


def parse_records(
    df: DataFrame,
    schema: T.StructType = FLOW_SCHEMA,
    value: str = "value",
    aliases: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse the JSON text and flatten it.

    Malformed text stays as a row of NULL fields with the text in ``_corrupt_record``.
    ``aliases`` maps a field to another spelling that is read when the field is absent.
    """
    aliases = aliases or {}
    extra = [T.StructField(other, schema[f].dataType) for f, other in aliases.items()]
    full = T.StructType([*schema.fields, *extra, T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(ref(value).cast("string"), full, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = df.select(*[ref(k) for k in keep], data.alias("data"))
    fields = []
    for f in schema.fields:
        cell = F.col("data").getField(f.name)
        if f.name in aliases:
            cell = F.coalesce(cell, F.col("data").getField(aliases[f.name]))
        fields.append(cell.alias(f.name))
    return parsed.select(*[ref(k) for k in keep], *fields, F.col("data").getField(CORRUPT).alias(CORRUPT))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(records, dead letters)`` of a parsed frame."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad).select(CORRUPT)
