"""Wide files to snapshot to star."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.dates import year_month
from tallystar.functions.fingerprint import fingerprint_of, lane_sums
from tallystar.operators.clean import COUNTS, clean, is_complete, typed, validation_counts
from tallystar.operators.unpivot import to_long
from tallystar.plans.load import KEY_ROW_BYTES, load_star, month_rows
from tallystar.schemas import CLEAN
from tallystar.sinks.snapshots import append_manifest, snapshot_name, write_snapshot
from tallystar.sources.snapshots import latest_snapshot
from tallystar.sources.star_tables import read_manifest
from tallystar.sources.wide_files import Rejected, read_folder


@dataclass(frozen=True)
class EtlResult:
    status: str
    snapshot: str
    new_content: bool
    counts: dict[str, int]
    rejected: tuple[Rejected, ...] = ()


def profile(long: DataFrame) -> DataFrame:
    """Per month (null: no date) the validation counts, and lane sums and key size of the rows that
    will be kept. Months add up to the whole, see functions/fingerprint.py."""
    rows = typed(long)
    size = F.lit(KEY_ROW_BYTES) + F.octet_length("product_id")
    return rows.groupBy(year_month(F.col("Date")).alias("ym")).agg(
        *validation_counts(),
        lane_sums(CLEAN.fieldNames(), keep=is_complete()).alias("lanes"),
        F.coalesce(F.sum(F.when(is_complete(), size)), F.lit(0)).alias("key_bytes"),
    )


def _snapshot_with(spark: SparkSession, lake: str, content_hash: str) -> str | None:
    known = read_manifest(spark, lake).where(F.col("content_hash") == content_hash)
    return known.agg(F.min("snapshot")).first()[0]


def run_etl(
    spark: SparkSession,
    in_path: str,
    lake: str,
    mart: str,
    extra_formats: Sequence[str] = (),
    fmt: str = "parquet",
    glob: str | None = None,
) -> EtlResult:
    """One run over the wide file or folder at `in_path`, or over its files that match `glob`.

    The first bytes of each file tell its header, so products may come and go between files; files
    that cannot be read are returned as `rejected`, and the others are loaded. A pass over the input
    counts and hashes it by month. Content that has a
    snapshot already is not written again; if that snapshot is also in the
    ledger the run ends as `skipped`, if not (an earlier run died in between)
    it is loaded now. New content costs one more pass, which writes it.
    """
    long, rejected = read_folder(spark, in_path, glob, lambda wide: to_long(wide, extra_formats))
    if long is None:
        raise ValueError(f"no file of {in_path} can be read: {rejected}")
    rows = profile(long).collect()
    counts = {c: sum(r[c] for r in rows) for c in COUNTS}
    # Counts of no rows at all are zeros, as those of an aggregate without groups.
    months = [(r["ym"], r["lanes"], r["key_bytes"]) for r in rows if r["lanes"][0]]
    content_hash = fingerprint_of(lanes for _, lanes, _ in months)
    snapshot = _snapshot_with(spark, lake, content_hash)
    new_content = snapshot is None
    if new_content:
        # The random end keeps two runs of one second apart.
        snapshot = snapshot_name(fmt, suffix=f"_{uuid.uuid4().hex[:8]}")
        sizes = {ym: lanes[0] for ym, lanes, _ in months}
        written = write_snapshot(clean(long), f"{lake}/{snapshot}", fmt, sizes)
        if written["content_hash"] != content_hash:
            raise RuntimeError(f"{in_path} changed while it was read; {snapshot} is not used")
        append_manifest(spark, lake, snapshot, written, months)
    stored = "csv" if snapshot.endswith(".csv") else "parquet"
    status = load_star(
        spark, snapshot, lake, mart, content_hash, stored, month_rows(months)
    )
    return EtlResult(status, snapshot, new_content, counts, tuple(rejected))


def reload_latest(spark: SparkSession, lake: str, mart: str) -> str | None:
    """Loads the newest snapshot in the lake if the ledger does not list it yet."""
    snapshot = latest_snapshot(spark, lake)
    if snapshot is None:
        return None
    stored = "csv" if snapshot.endswith(".csv") else "parquet"
    return load_star(spark, snapshot, lake, mart, fmt=stored)
