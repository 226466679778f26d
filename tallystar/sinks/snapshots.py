"""Snapshots of clean rows, and the manifest that describes them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions.dates import year_month
from tallystar.functions.fingerprint import table_fingerprint
from tallystar.schemas import (
    CLEAN,
    MANIFEST,
    PIPELINE_VERSION,
    SNAPSHOT_FOLDER,
    SNAPSHOT_MONTH,
    SNAPSHOT_PREFIX,
    SNAPSHOT_STAMP,
)

#: Clean rows per file of a snapshot whose months are known, about 64 MB of Parquet.
ROWS_PER_FILE = 1 << 22


def snapshot_name(fmt: str = "parquet", when: datetime | None = None, suffix: str = "") -> str:
    stamp = (when or datetime.now(timezone.utc)).strftime(SNAPSHOT_STAMP)
    extension = ".csv" if fmt == "csv" else ""
    return f"{SNAPSHOT_FOLDER}/{SNAPSHOT_PREFIX}{stamp}{suffix}{extension}"


def month_parts(
    months: Iterable[tuple[int, int]], per_file: int = ROWS_PER_FILE
) -> tuple[dict[int, tuple[int, int]], int]:
    """Partitions for months of known row counts: month to (first partition, number), and how many
    there are. Neighbouring small months share a partition, a large month has several of its own.
    """
    parts: dict[int, tuple[int, int]] = {}
    n, filled = 0, per_file
    for ym, rows in sorted(months):
        if filled + rows > per_file:  # it doesn't fit beside the months before it
            own = max(1, -(-rows // per_file))
            parts[ym] = (n, own)
            n += own
            filled = rows if own == 1 else per_file
        else:
            parts[ym] = (n - 1, 1)
            filled += rows
    return parts, n


def in_months(
    cleaned: DataFrame, months: Iterable[tuple[int, int]], per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Rows ranged by month, sorted by date and product within each partition.

    The row counts are known, so no pass over the rows samples them for bounds. A large month is
    spread over its partitions by date and product, so one date with a third of all rows is split
    too. A row of a month that is not listed goes to the first partition.
    """
    parts, n = month_parts(months, per_file)
    table = pa.table(
        {
            "__ym": pa.array(parts, pa.int32()),
            "__first": pa.array([first for first, _ in parts.values()], pa.int32()),
            "__of": pa.array([of for _, of in parts.values()], pa.int32()),
        }
    )
    # One row per calendar month.
    places = F.broadcast(cleaned.sparkSession.createDataFrame(table))
    spread = F.col("__first") + F.pmod(F.xxhash64("Date", "product_id"), F.col("__of")).cast("int")
    return (
        cleaned.join(places, year_month(F.col("Date")) == F.col("__ym"), "left")
        .repartitionById(max(n, 1), F.coalesce(spread, F.lit(0)))
        .sortWithinPartitions("Date", "product_id")
        .select(*cleaned.columns)
    )


def write_snapshot(
    cleaned: DataFrame, path: str, fmt: str = "parquet", months: Mapping[int, int] | None = None
) -> dict:
    """Writes clean rows; returns `record_count, min_date, max_date, content_hash` of them.

    The figures are observed by the job that writes, so the rows are not read
    again. An existing snapshot is never overwritten. With `months`, the rows of each month if they
    are known, files hold ranges of months, and who reads some months skips the others' files.
    """
    seen = Observation()
    rows = cleaned.select(*CLEAN.fieldNames())
    if months and fmt == "parquet":
        rows = in_months(rows, months.items())
    rows = rows.observe(
        seen,
        F.count(F.lit(1)).alias("record_count"),
        F.min("Date").alias("min_date"),
        F.max("Date").alias("max_date"),
        table_fingerprint(CLEAN.fieldNames()).alias("content_hash"),
    )
    writer = rows.write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return seen.get


def append_manifest(
    spark: SparkSession,
    lake: str,
    snapshot: str,
    written: dict,
    months: Sequence[tuple[int, Sequence[int], int]] | None = None,
) -> None:
    """`months`, if known, are (month, lane sums, bytes of keys); a load then need not count them."""
    parts = SNAPSHOT_MONTH.fieldNames()
    listed = json.dumps([dict(zip(parts, m, strict=True)) for m in months or ()])
    listed = F.from_json(F.lit(listed), T.ArrayType(SNAPSHOT_MONTH))
    row = spark.range(1).select(
        F.lit(snapshot).alias("snapshot"),
        F.localtimestamp().alias("processed_date"),
        F.lit(written["record_count"]).cast("bigint").alias("record_count"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        F.lit(written["content_hash"]).alias("content_hash"),
        F.lit(written["min_date"]).cast("date").alias("min_date"),
        F.lit(written["max_date"]).cast("date").alias("max_date"),
        (F.lit(None) if months is None else listed).cast(T.ArrayType(SNAPSHOT_MONTH)).alias("months"),
    )
    row.select(*MANIFEST.fieldNames()).coalesce(1).write.mode("append").parquet(
        f"{lake}/manifest"
    )
