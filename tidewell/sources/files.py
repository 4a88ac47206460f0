"""Reading and checking CSV and Parquet files."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.cells import ref
from tidewell.functions.names import normalized

SOURCE = "source_file"
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
MALFORMED = "_corrupt_record"
UNPARSED_CELLS, MALFORMED_RECORDS = "unparsed_cells", "malformed_records"  # columns that ``audit`` adds
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")

# Spellings of missing cells as written.
MISSING = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
NEGATIVE_NAN = "-nan"
_MISSING_NUMBER = sorted({m.lower() for m in MISSING} - {"nan", NEGATIVE_NAN})


def number(cell: Column) -> Column:
    """Text of a floating cell as a double; NULL for a missing spelling and for what is no number.

    The cast itself knows numbers, infinities and NaN in any case, with blanks around them.
    """
    return F.coalesce(cell.try_cast("double"), F.when(F.lower(F.trim(cell)) == NEGATIVE_NAN, F.lit(float("nan"))))


def _is_unparsed(cell: Column) -> Column:
    """A cell with text that is neither a number nor a missing spelling."""
    return cell.isNotNull() & number(cell).isNull() & ~F.lower(F.trim(cell)).isin(_MISSING_NUMBER)


def _floating(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.FloatType, T.DoubleType))


def _inferred(reader, paths, names: Sequence[str] | None) -> T.StructType:
    """Names and types from the data; a column of numbers may hold spellings that inference does not know."""
    frame = reader.option("inferSchema", "true").csv(paths)
    frame = frame.toDF(*names) if names else frame
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema])
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    if texts:
        odd = [F.count_if(_is_unparsed(ref(c))) for c in texts] + [F.count(number(ref(c))) for c in texts]
        counts = frame.agg(*[c.alias(f"c{i}") for i, c in enumerate(odd)]).first()
        for i, c in enumerate(texts):
            if counts[i] == 0 and counts[len(texts) + i] > 0:
                schema[c].dataType = T.DoubleType()
    return schema


def _rescued(schema: T.StructType, options: dict) -> Column:
    """A rejected record once more, its floating cells as text: fields ``c0``, ``c1``, ... and ``broken``."""
    kinds = ["string" if _floating(f) else f.dataType.simpleString() for f in schema]
    fields = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))
    options = {k: v for k, v in options.items() if k not in ("header", "encoding", "pathGlobFilter")}
    again = F.from_csv(F.col(MALFORMED), f"{fields}, broken string", {**options, "columnNameOfCorruptRecord": "broken"})
    return F.when(F.col(MALFORMED).isNotNull(), again)


def _scan(
    spark: SparkSession,
    paths,
    schema: T.StructType | None,
    options: dict,
    missing_text: bool,
    audit: bool,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Two tiers: the CSV reader parses numbers itself; only the records it rejects are read again, as text.

    Their floating cells go through ``number``, which understands every spelling of infinity and missing.  The second tier
    is a loop over one array of cells, so a wide table does not make the generated code longer by column.
    """
    options = {**CSV_OPTIONS, **options}
    reader = spark.read.options(**options)
    if schema is None:
        schema = _inferred(reader, paths, names)
    floating = [i for i, f in enumerate(schema) if _floating(f)]
    two_tiers = audit or bool(floating)
    marked = [T.StructField(MALFORMED, T.StringType())] if two_tiers else []
    typed = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], *marked])
    frame = reader.option("inferSchema", "false").schema(typed).option("columnNameOfCorruptRecord", MALFORMED).csv(paths)
    frame = frame.withColumn("__path", F.col("_metadata.file_path"))
    cells = [ref(f.name) for f in schema]
    marks = []
    if two_tiers:
        frame = frame.withColumn("__rescued", _rescued(schema, options))
        texts = F.array(*[F.col(f"__rescued.c{i}") for i in floating]).cast("array<string>")
        again = F.col("__rescued").isNotNull()
        frame = frame.withColumns(
            {
                "__numbers": F.when(again, F.transform(texts, number)),
                UNPARSED_CELLS: F.when(again, F.size(F.filter(texts, _is_unparsed))).otherwise(0),
                MALFORMED_RECORDS: F.col("__rescued.broken").isNotNull().cast("int"),
            }
        )
        for at, i in enumerate(floating):
            cells[i] = F.when(again, F.get("__numbers", F.lit(at)).cast(schema[i].dataType)).otherwise(cells[i])
        marks = [UNPARSED_CELLS, MALFORMED_RECORDS] if audit else []
    if missing_text:
        for i, f in enumerate(schema):
            if isinstance(f.dataType, T.StringType):
                cells[i] = F.when(~F.trim(cells[i]).isin(MISSING), cells[i])
    return frame.select(*[c.alias(f.name) for c, f in zip(cells, schema)], *marks, "__path")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    missing_text: bool = True,
    multi_line: bool = False,
    **options,
) -> DataFrame:
    """One CSV file or folder with a header.  Give a schema where you can: inference reads twice.

    Quotes inside quoted cells are doubled.  Quoted line breaks need ``multi_line``; such files are not split, so
    one file is one task.  With ``missing_text`` the missing spellings are NULL in text columns too.
    """
    options = {"multiLine": str(multi_line).lower(), **options}
    try:
        return _scan(spark, path, schema, options, missing_text, False).drop("__path")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Sorted paths in ``folder`` matching ``pattern``; a listing, nothing is read."""
    try:
        found = spark.read.option("pathGlobFilter", pattern).text(folder).inputFiles()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(folder) from error
        raise
    return sorted(found)


def locate(path: str):
    """``(file system, path in it)`` for a path as Spark lists it."""
    from urllib.parse import unquote

    from pyarrow import fs

    local = path.startswith("file:")
    return fs.FileSystem.from_uri(unquote(path) if local else path.replace("s3a://", "s3://", 1))


def _header_of(path: str) -> tuple[list[str] | None, str | None]:
    """``(first line, None)`` of one file, or ``(None, error)`` if it cannot be read to its end.

    A plain file is opened and its first line read; a compressed one is drained, as only that shows a cut.
    """
    line, first = b"", True
    try:
        store, place = locate(path)
        with store.open_input_stream(place) as stream:
            while piece := stream.read(1 << 20 if not first else 1 << 16):
                if first:
                    line += piece
                    first = b"\n" not in line
                if not first and not path.endswith(COMPRESSED):
                    break
        return _fields(line.split(b"\n", 1)[0].decode("utf-8-sig")), None
    except (OSError, pa.ArrowException, UnicodeDecodeError, EOFError) as error:
        return None, f"{type(error).__name__}: {error}"[:500]


def _fields(line: str) -> list[str]:
    return next(csv.reader([line.rstrip("\r")]), [])


def csv_headers(spark: SparkSession, folder: str, pattern: str = "*.csv", only: DataFrame | None = None) -> DataFrame:
    """``path, header: array<string>, error`` per file; ``error`` is NULL for a readable file.

    ``only`` names the wanted files in ``source_file``; no other is opened.

    Each task opens its files and reads one line of each, compressed ones to their end.  Where the storage is not one Arrow can
    open, the lines come from a text scan instead, which reads the files whole.
    """
    paths = list_files(spark, folder, pattern)
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    if only is not None:
        listed = listed.join(only, path_within(F.col("path"), folder) == only[SOURCE], "left_semi")
    slots = max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4))
    try:
        locate(paths[0]) if paths else None
    except (pa.ArrowException, OSError, ValueError):
        wanted = paths if only is None else [r["path"] for r in listed.collect()]
        lines = spark.read.option("pathGlobFilter", pattern).text(wanted).select(
            F.col("_metadata.file_path").alias("path"),
            F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("id")).alias("at"),
            "value",
        )
        listed = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
        return listed.mapInArrow(_split_lines, "path string, header array<string>, error string")

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(0).to_pylist()
            found = [_header_of(p) for p in files]
            yield pa.RecordBatch.from_pydict(
                {
                    "path": files,
                    "header": pa.array([h for h, _ in found], pa.list_(pa.string())),
                    "error": pa.array([e for _, e in found], pa.string()),
                }
            )

    return listed.repartition(slots).mapInArrow(headers, "path string, header array<string>, error string")


def _split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [_fields(line) for line in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(split, pa.list_(pa.string())), pa.nulls(len(split), pa.string())],
            names=["path", "header", "error"],
        )


def fingerprints(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``source_file, length, modified`` of the files of a folder, from its listing; no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    modified = F.unix_micros("modificationTime").alias("modified")
    return listed.select(path_within(F.col("path"), folder).alias(SOURCE), "length", modified)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _folder_pattern(folder: str) -> str:
    place = re.escape(re.sub(r"^\w+:/*", "/", folder.rstrip("/")))
    return f"^(?:\\w+:)?/*{place.lstrip('/')}/+"


def path_within(path: Column, folder: str) -> Column:
    """The path below ``folder``: the bare name in a flat folder, unique in a nested one."""
    inner = F.regexp_replace(path, _folder_pattern(folder), "")
    return F.when(inner == path, file_name(path)).otherwise(inner)


def _path_within_like(path: Column, folder: str, known: str | None) -> Column:
    """``path_within`` for a column of a row's path: where it begins like the path ``known``, that is cut off, as a pattern
    per row costs more."""
    start = re.match(_folder_pattern(folder), known or "")
    if not start:
        return path_within(path, folder)
    cut = F.substring(path, start.end() + 1, 1 << 30)
    return F.when(path.startswith(start.group()), cut).otherwise(path_within(path, folder))


def header_consistency(
    spark: SparkSession, folder: str, pattern: str = "*.csv", headers: DataFrame | None = None
) -> DataFrame:
    """``file, n_columns, missing_columns, extra_columns, consistent`` against the first file by path."""
    found = headers if headers is not None else csv_headers(spark, folder, pattern)
    found = found.filter("header is not null").withColumn("file", path_within(F.col("path"), folder))
    first = found.groupBy().agg(F.min_by("header", "path").alias("h")).first()
    expected = F.array(*[F.lit(c) for c in (first["h"] if first and first["h"] else [])]).cast("array<string>")
    compared = found.select(
        "file",
        F.size("header").alias("n_columns"),
        F.array_sort(F.array_except(expected, "header")).alias("missing_columns"),
        F.array_sort(F.array_except("header", expected)).alias("extra_columns"),
    )
    return compared.withColumn(
        "consistent", (F.size("missing_columns") == 0) & (F.size("extra_columns") == 0)
    )


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    pattern: str = "*.csv",
    skip_bad_files: bool = False,
    normalize: bool = False,
    headers: DataFrame | None = None,
    missing_text: bool = True,
    multi_line: bool = False,
    audit: bool = False,
    whole_folder: bool = True,
    **options,
) -> DataFrame:
    """All CSV files of a folder in one scan per header layout, with ``source_file``.

    Columns are matched by name: files are grouped by header (usually one group), each group
    is read with the types ``schema`` gives to its columns, and the groups are united by name
    with NULL for absent columns.  ``schema`` and the result use normalised names when
    ``normalize`` is set.  A file that cannot be read to its end is an error, or left out whole with
    ``skip_bad_files``; it is never read in part.  ``audit`` adds per row the number of cells that are no number
    and whether the record had the wrong number of fields.  ``whole_folder=False``: only the files of ``headers``.
    """
    found = headers if headers is not None else csv_headers(spark, folder, pattern)
    bad = found.filter("error is not null")
    some_bad = bad.orderBy("path").first()
    if some_bad and not skip_bad_files:
        raise OSError(f"{some_bad['path']}: {some_bad['error']}")
    good = found.filter("error is null")
    layouts = [tuple(r["header"]) for r in good.select("header").distinct().collect()]  # a row a layout
    if not layouts:
        raise FileNotFoundError(f"{folder}/{pattern}")
    files: dict[tuple[str, ...], list[str]] = defaultdict(list)
    if len(layouts) > 1 or some_bad or not whole_folder:
        for row in good.collect():
            files[tuple(row["header"])].append(row["path"])
    wanted = {f.name: f.dataType for f in schema} if schema is not None else None
    options = {"pathGlobFilter": pattern, "multiLine": str(multi_line).lower(), **options}
    known = good.agg(F.min("path")).first()[0]
    parts = []
    for header in sorted(layouts):
        names = normalized(header) if normalize else list(header)
        typed = None
        if wanted is not None:
            typed = T.StructType([T.StructField(n, wanted.get(n, T.StringType())) for n in names])
        part = _scan(spark, sorted(files[header]) or folder, typed, options, missing_text, audit, names)
        parts.append(part.withColumn(SOURCE, _path_within_like(F.col("__path"), folder, known)).drop("__path"))
    return union_files(parts)


def read_parquet_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Named Parquet files as one scan with ``source_file``; a missing one is an error."""
    try:
        frame = spark.read.parquet(*paths)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(str(list(paths))) from error
        raise
    chosen = [ref(c) for c in columns] if columns else ["*"]
    return frame.select(*chosen, F.col("_metadata.file_name").alias(SOURCE))


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-wise union by column name; absent columns are NULL."""
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united


def file_sizes(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``path, bytes`` of the files below ``folder``; contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return listed.select("path", F.col("length").alias("bytes"))


def _relative(listed: DataFrame, folder: str) -> Column:
    return path_within(F.col("path"), folder).alias("file")


def parquet_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``file, rows`` per Parquet file from the footers alone: quick, but pages may be broken.

    The stand-in schema keeps Spark from inferring one off a file that may be broken.
    """
    files = file_sizes(spark, folder, "*.parquet").select(F.regexp_replace("path", "^file:/*", "/").alias("path"))
    reader = spark.read.schema("unread int").option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    table = reader.option("pathGlobFilter", "*.parquet").parquet(folder)
    at = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/").alias("at")
    counts = table.groupBy(at).agg(F.count(F.lit(1)).alias("rows"))
    joined = files.join(counts, F.col("path") == F.col("at"), "left")
    return joined.select(_relative(joined, folder), F.coalesce("rows", F.lit(0)).alias("rows"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per row group; one with group -1 for a file whose footer cannot be read."""
    from pyarrow import parquet as pq

    for batch in batches:
        out: list[tuple[str, int]] = []
        for path in batch.column(0).to_pylist():
            try:
                store, place = locate(path)
                with store.open_input_file(place) as file:
                    groups = pq.ParquetFile(file).num_row_groups
                out += [(path, g) for g in range(groups)] or [(path, -1)]
            except (OSError, pa.ArrowException):
                out.append((path, -1))
        paths, groups = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(groups, pa.int32())], names=["path", "g"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a row group after decoding every page of every column; NULL if that fails."""
    from pyarrow import parquet as pq

    for batch in batches:
        counts: list[int | None] = []
        for path, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                store, place = locate(path)
                with store.open_input_file(place) as file:
                    table = pq.ParquetFile(file)
                    rows = sum(b.num_rows for b in table.iter_batches(row_groups=[group])) if group >= 0 else 0
                    counts.append(rows if group < 0 or rows == table.metadata.row_group(group).num_rows else None)
            except (OSError, pa.ArrowException):
                counts.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["path", "rows"])


def validate_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """``file, rows, valid`` per Parquet file, named by its path below ``folder``.

    Every page of every column is decoded, one row group at a time, row groups spread over the tasks.  A file that
    cannot be decoded, or has no row, is invalid; its ``rows`` are those of the row groups that could.
    """
    slots = spark.sparkContext.defaultParallelism * 4
    listed = file_sizes(spark, folder, "*.parquet").select("path")
    groups = listed.repartition(slots).mapInArrow(_footers, "path string, g int")
    counted = groups.repartition(slots, "path", "g").mapInArrow(_decoded, "path string, rows long")
    counted = counted.groupBy("path").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.every(F.col("rows").isNotNull()).alias("whole")
    )
    return counted.select(_relative(counted, folder), "rows", (F.col("whole") & (F.col("rows") > 0)).alias("valid"))


def all_valid(validation: DataFrame) -> bool:
    """True when there are files and every one is valid."""
    return bool(validation.agg(F.every("valid")).first()[0])
