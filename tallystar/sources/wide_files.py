"""Wide daily sales files."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tallystar.operators.unpivot import product_ids
from tallystar.schemas import DATE_COLUMN, REVENUE_PREFIX, UNITS_PREFIX

# Where a row comes from, for loads that take several files at once.
SOURCE_FILE = "source_file"
SOURCE_TIME = "source_time"
# Bytes read of a file at a time to find its header, and the longest header.
HEADER_BLOCK, HEADER_BYTES = 1 << 16, 1 << 24


def used_columns(schema: T.StructType) -> list[str]:
    names = schema.names
    if DATE_COLUMN not in names:
        raise ValueError(f"no column {DATE_COLUMN!r} in {names}")
    products = product_ids(names)
    return [DATE_COLUMN, *[f"{x}{p}" for p in products for x in (UNITS_PREFIX, REVENUE_PREFIX)]]


def _select(df: DataFrame, schema: T.StructType, with_source: bool) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in used_columns(schema)]
    if with_source:
        columns += [
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
        ]
    return df.select(*columns)


BINARY = "path string, modificationTime timestamp, length long, content binary"


def files_of(reader: DataStreamReader | DataFrameReader, path: str, glob: str | None) -> DataFrame:
    """`source_file, source_time, path` of files; their content is not read."""
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format("binaryFile").schema(BINARY).load(path).select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
        "path",
    )


def _first_line(path: str) -> bytes | None:
    """A file's first line without its end; None if it has none. Reads no more than it needs."""
    if path.startswith("file:"):
        source = fs.LocalFileSystem()
        name = "/" + path.removeprefix("file:").lstrip("/")
    else:
        source, name = fs.FileSystem.from_uri(quote(path, safe=":/@%"))
    start = b""
    with source.open_input_stream(name, compression="detect", buffer_size=0) as stream:
        while len(start) < HEADER_BYTES and (block := stream.read(HEADER_BLOCK)):
            start += block
            if end := re.search(rb"\r\n?|\n", start):
                return start[: end.start()]
    return start or None


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        header, opened = [], []
        for path in batch.column("path").to_pylist():
            try:
                line = _first_line(path)
                header.append(None if line is None else line.decode("utf-8", "replace"))
                opened.append(True)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError):
                header.append(None)  # a kind of store that only Spark can open
                opened.append(False)
        own = [batch.column(c) for c in (SOURCE_FILE, SOURCE_TIME, "path")]
        yield pa.record_batch(
            [*own, pa.array(header, pa.string()), pa.array(opened)],
            names=[SOURCE_FILE, SOURCE_TIME, "path", "header", "opened"],
        )


def file_headers(files: DataFrame) -> DataFrame:
    """One row per file: `source_file, source_time, path, header, opened`; `header` is its first line.

    Only the first bytes of each file are read, whatever its size; compressed files are unpacked as
    far. A file without a line has no row. A store that only Spark can read leaves `opened` false.
    """
    kind = f"{SOURCE_FILE} string, {SOURCE_TIME} timestamp, path string, header string, opened boolean"
    return files.mapInArrow(_headers, kind).where("header IS NOT NULL OR NOT opened")


def headers_by_reading(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The same as file_headers for stores that only Spark can read, by a pass over the lines.

    Lines of a block are read in order by one task, so the line with the smallest row number of
    a file's first block is its first.
    """
    lines = spark.read.text([_path(p) for p in paths]).select(
        "value",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return (
        lines.withColumn("row", F.monotonically_increasing_id())
        .where("block = 0")
        .groupBy(SOURCE_FILE, SOURCE_TIME)
        .agg(F.min_by("value", "row").alias("header"))
    )


def collected_headers(spark: SparkSession, files: DataFrame) -> list[Row]:
    """Rows with `source_file, source_time, header`: one per file."""
    rows = file_headers(files).select(SOURCE_FILE, SOURCE_TIME, "header", "opened").collect()
    closed = [r[SOURCE_FILE] for r in rows if not r["opened"]]
    if closed:
        rows = [r for r in rows if r["opened"]] + headers_by_reading(spark, closed).collect()
    return rows


def _path(uri: str) -> str:
    """The name under which a file of the metadata column can be read again."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def only_header(spark: SparkSession, files: DataFrame) -> str | None:
    """The header of all files, if they have the same. Distinct headers come to the driver."""
    found = file_headers(files).groupBy("header", "opened").agg(F.count(F.lit(1)).alias("n"))
    rows = found.orderBy(F.desc("n")).limit(2).collect()
    return rows[0]["header"] if len(rows) == 1 and rows[0]["opened"] else None


@dataclass(frozen=True)
class Rejected:
    """A file that is not loaded, and why."""

    filename: str
    reason: str


def _usable(header: str) -> tuple[tuple[str, ...], str | None]:
    """The column names of a header, and why files with it cannot be read, if so."""
    names = tuple(next(csv.reader([header]), ()))
    try:
        if len(set(names)) < len(names):
            raise ValueError(f"a column name occurs twice in {list(names)}")
        used_columns(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    except ValueError as e:
        return names, str(e)
    return names, None


def _rows_under(
    spark: SparkSession, names: Sequence[str], paths: str | Sequence[str], glob: str | None = None
) -> DataFrame:
    """The date and product columns of files with one header, as text, with their source."""
    # An unnamed column, as an index has, gets the name that the reader would give it.
    named = [n or f"_c{i}" for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in named])
    # enforceSchema=False: a file whose header differs by now fails the read, where
    # the default would assign its columns by position without a word.
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", "" in names)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _select(reader.csv(paths), schema, with_source=True)


def read_by_header(
    spark: SparkSession, headers: Sequence[Row], to_rows: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame | None, list[Rejected]]:
    """Rows of files with any headers, and the files that cannot be read.

    Files of one header are read together, by their own column names; `to_rows` makes rows of
    the same columns from each such group. `headers` are rows of file_headers, one per file.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    rejected = []
    for row in headers:
        names, reason = _usable(row["header"] or "")
        if reason:
            rejected.append(Rejected(row[SOURCE_FILE], reason))
        else:
            groups.setdefault(names, []).append(_path(row[SOURCE_FILE]))
    result = None
    for names, paths in sorted(groups.items()):
        rows = to_rows(_rows_under(spark, names, paths))
        result = rows if result is None else result.unionByName(rows)
    return result, rejected


def read_folder(
    spark: SparkSession, path: str, glob: str | None, to_rows: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame | None, list[Rejected]]:
    """Rows of the files below a path. No list of files passes through the driver, besides Spark's
    own, unless their headers differ."""
    files = files_of(spark.read, path, glob)
    header = only_header(spark, files)
    if header is not None:
        names, reason = _usable(header)
        if reason is None:
            return to_rows(_rows_under(spark, names, path, glob)), []
    return read_by_header(spark, collected_headers(spark, files), to_rows)


def stream_files(spark: SparkSession, path: str, max_files: int, glob: str | None = None) -> DataFrame:
    """New files of a folder, at most `max_files` per batch, oldest first; no content is read."""
    # By default a stream ignores a file that is a week older than the newest one
    # it has seen; a delivery that comes late must still be loaded.
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return files_of(reader.option("maxFileAge", "36500d"), path, glob)
