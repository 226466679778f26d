"""Each new wide file once, through a file stream."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.fingerprint import N_LANES, fingerprint, lane_columns
from tallystar.operators.clean import clean, is_complete, typed
from tallystar.operators.membership import first_of_each_content, new_content, unprocessed
from tallystar.operators.unpivot import to_long
from tallystar.plans.load import load_rows
from tallystar.schemas import CLEAN
from tallystar.sinks.snapshots import append_manifest, snapshot_name, write_snapshot
from tallystar.sinks.star_tables import append_rejected, ensure_star
from tallystar.sources.snapshots import read_snapshot
from tallystar.sources.star_tables import read_ledger
from tallystar.sources.wide_files import (
    SOURCE_FILE,
    SOURCE_TIME,
    Rejected,
    collected_headers,
    read_by_header,
    stream_files,
)

SOURCE = (SOURCE_FILE, SOURCE_TIME)
RANK = "file_rank"


def file_profiles(long: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row per source file: the content hash of its clean rows, and whether a date and product
    stand in it twice.

    Rows are added up per file, date and product, and those groups per file, both map-side.

    `within` are columns that the name of a file determines. Rows that come dealt to tasks by them
    (many small files) are added up where they are, without a shuffle.
    """
    files = (*within, *SOURCE)
    rows = typed(long, files)
    kept = [F.when(is_complete(), F.col(c)).alias(f"key_{c}") for c in ("Date", "product_id")]
    lanes = lane_columns(CLEAN.fieldNames(), keep=is_complete())
    per_key = rows.groupBy(*files, *kept).agg(*[c.alias(f"lane{i}") for i, c in enumerate(lanes)])
    content = fingerprint(F.array(*[F.sum(f"lane{i}") for i in range(N_LANES)]))
    twice = F.bool_or((F.col("lane0") > 1) & F.col("key_Date").isNotNull())
    profiles = per_key.groupBy(*files).agg(content.alias("content_hash"), twice.alias("repeated"))
    return profiles.drop(*within)


def accepted_files(profiles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files with a new name and new content, one per content, the oldest."""
    named = profiles.withColumnRenamed(SOURCE_FILE, "filename")
    fresh = new_content(unprocessed(named, ledger), ledger)
    return first_of_each_content(fresh, SOURCE_TIME, "filename")


def newest_per_key(rows: DataFrame) -> DataFrame:
    """Per date and product the row of the file with the highest rank, as if loaded in turn.

    Rows are first counted per key and file, where a second row of the same file
    fails the job, then the newest file is picked. Both steps combine rows before
    they shuffle, so a key that a broken file repeats without end costs no more
    than any other.
    """
    keys = [c for c in CLEAN.fieldNames() if not c.startswith("Total_")]
    per_file = rows.groupBy(*keys, RANK).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("Total_Units_Sold").alias("Total_Units_Sold"),
        F.first("Total_Revenue").alias("Total_Revenue"),
    )
    key = F.concat_ws(" ", F.lit("not unique within a file:"), "Date", "product_id")
    repeated = F.raise_error(key)
    once = F.when(F.col("n") == 1, F.col("Total_Units_Sold")).otherwise(repeated.cast("int"))
    return (
        per_file.withColumn("Total_Units_Sold", once)
        .groupBy(*keys)
        .agg(
            F.max_by("Total_Units_Sold", RANK).alias("Total_Units_Sold"),
            F.max_by("Total_Revenue", RANK).alias("Total_Revenue"),
        )
    )


def _rows_of(spark: SparkSession, long: DataFrame, accepted: Sequence[Row]) -> DataFrame:
    """Clean rows of the accepted files, with the place of their file in the order of arrival.

    The list of files is a local table of known size, so Spark broadcasts it if
    it is small and otherwise joins by shuffle, splitting a file that is too large.
    """
    names = [r["filename"] for r in accepted]
    ranked = pa.table({SOURCE_FILE: names, RANK: pa.array(range(len(names)), pa.int32())})
    rows = clean(long, SOURCE).join(spark.createDataFrame(ranked), SOURCE_FILE)
    # The load of a snapshot checks the keys of a single file itself.
    return rows if len(accepted) == 1 else newest_per_key(rows)


def load_batch(
    files: DataFrame, batch_id: int, lake: str, mart: str, extra_formats: Sequence[str] = ()
) -> int:
    """Loads the files of one batch and returns how many had new content.

    Each file is read by its own header, of which only the first bytes are read here; then one pass
    over the batch profiles the files and one writes the rows. A file without the needed columns, or
    with a date and product twice, is listed in the mart's rejected files and left out; the others
    are loaded. Run twice, for a batch that is replayed after a failure, it finds the files
    in the ledger and does nothing.
    """
    spark = files.sparkSession
    ensure_star(spark, mart)
    headers = collected_headers(spark, files)
    long, rejected = read_by_header(
        spark, headers, lambda wide: to_long(wide, extra_formats, carry=SOURCE)
    )
    accepted = []
    if long is not None:
        # One row per file of the batch comes to the driver.
        profiles = file_profiles(long).collect()
        repeated = [r[SOURCE_FILE] for r in profiles if r["repeated"]]
        rejected += [Rejected(f, "not unique: a date and product twice") for f in repeated]
        sound = [tuple(r)[:3] for r in profiles if not r["repeated"]]
        if sound:
            table = spark.createDataFrame(
                sound, f"{SOURCE_FILE} string, {SOURCE_TIME} timestamp, content_hash string"
            )
            picked = accepted_files(table, read_ledger(spark, mart))
            accepted = sorted(picked.collect(), key=lambda r: (r[SOURCE_TIME], r["filename"]))
    append_rejected(spark, mart, rejected)
    if not accepted:
        return 0
    # The random end keeps a replay apart from the snapshot of its failed try.
    snapshot = snapshot_name(suffix=f"_{batch_id}_{uuid.uuid4().hex[:8]}")
    written = write_snapshot(_rows_of(spark, long, accepted), f"{lake}/{snapshot}")
    append_manifest(spark, lake, snapshot, written)
    files = [(r["filename"], r["content_hash"]) for r in accepted]
    files.append((snapshot, written["content_hash"]))
    load_rows(spark, read_snapshot(spark, f"{lake}/{snapshot}"), mart, files)
    return len(accepted)


def ingest_new_files(
    spark: SparkSession,
    in_folder: str,
    lake: str,
    mart: str,
    checkpoint: str | None = None,
    max_files: int = 1000,
    glob: str | None = None,
    extra_formats: Sequence[str] = (),
) -> None:
    """Loads all files that are new since the last call, then returns.

    `max_files` bounds a batch: what it keeps on the driver is one row per file,
    whatever the size of the files.
    """
    stream = stream_files(spark, in_folder, max_files, glob)
    query = (
        stream.writeStream.foreachBatch(
            lambda df, batch_id: load_batch(df, batch_id, lake, mart, extra_formats)
        )
        .option("checkpointLocation", checkpoint or f"{mart}/_checkpoints/ingest")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
