"""Load of one clean snapshot into the star tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.dates import year_month
from tallystar.functions.fingerprint import N_LANES, fingerprint_of, lane_columns
from tallystar.functions.labels import product_label
from tallystar.operators import dimensions
from tallystar.operators.checks import DuplicateKeys
from tallystar.operators.merge import merge
from tallystar.schemas import CLEAN, FACT_KEYS
from tallystar.sinks import star_tables as sink
from tallystar.sinks.star_tables import ConcurrentLoad
from tallystar.sources import star_tables as star
from tallystar.sources.snapshots import read_snapshot, require_readable, snapshot_months

# A date, a text and their row header in a hash table, without the text itself.
KEY_ROW_BYTES = 96
# Folders of changes a dimension may have before a load folds them into one.
MOST_FOLDERS = 8

LOADED = "loaded"
SKIPPED = "skipped"

__all__ = ["ConcurrentLoad", "load_rows", "load_star", "month_rows", "only_months"]


@dataclass(frozen=True)
class MonthRows:
    """What a snapshot holds for a month: lane sums of its rows, and the size of their keys."""

    lanes: tuple[int, ...]
    key_bytes: int

    @property
    def source_hash(self) -> str:
        return fingerprint_of([self.lanes])


def key_bytes():
    """Aggregate over clean rows: the size of their keys in memory."""
    return F.sum(F.lit(KEY_ROW_BYTES) + F.octet_length("product_id"))


def month_rows(listed: Iterable[Sequence]) -> dict[int, MonthRows]:
    """(month, lane sums, bytes of keys), as the manifest lists them, by month."""
    return {ym: MonthRows(tuple(lanes), size) for ym, lanes, size in listed}


def only_months(cleaned: DataFrame, months: Iterable[int]) -> DataFrame:
    """The rows of some months. The plain date range reaches the scan, the rest filters."""
    ordered = sorted(months)
    if not ordered:
        return cleaned.where(F.lit(False))
    first, last = (F.lit(f"{m // 100:04d}-{m % 100:02d}-01") for m in (ordered[0], ordered[-1]))
    day = F.col("Date")
    in_range = (day >= first.cast("date")) & (day <= F.last_day(last.cast("date")))
    return cleaned.where(in_range & year_month(day).isin(ordered))


MONTH_KIND, DATE_KIND, PRODUCT_KIND = "month", "date", "product"


def source_profile(cleaned: DataFrame) -> DataFrame:
    """All that a load must know about its source, by one pass over the rows.

    They are counted per (date, product), combined map-side; those groups are then added up per
    month (lane sums, key sizes, repeated keys with an example), date (its parts) and product, each
    again map-side. A date that comes with several parts keeps the greatest.
    """
    lanes = [c.alias(f"lane{i}") for i, c in enumerate(lane_columns(CLEAN.fieldNames()))]
    per_key = cleaned.groupBy("Date", "product_id").agg(
        F.max(F.struct("Year", "Month", "Day")).alias("parts"), key_bytes().alias("key_bytes"), *lanes
    )
    repeated = F.col("lane0") > 1
    month = per_key.withColumn("ym", year_month(F.col("Date")))
    sets = month.groupingSets([["ym"], ["Date"], ["product_id"]], "ym", "Date", "product_id").agg(
        F.grouping_id().alias("gid"),
        F.max("parts").alias("parts"),
        F.count_if(repeated).alias("n_repeated"),
        F.max(F.when(repeated, F.struct("Date", "product_id", F.col("lane0").alias("n")))).alias("example"),
        F.sum("key_bytes").alias("key_bytes"),
        F.array(*[F.sum(f"lane{i}") for i in range(N_LANES)]).alias("lanes"),
    )
    # Bits of the columns that a set leaves out: ym 4, Date 2, product_id 1.
    kind = F.when(F.col("gid") == 3, MONTH_KIND).when(F.col("gid") == 5, DATE_KIND).otherwise(PRODUCT_KIND)
    return sets.withColumn("kind", kind).drop("gid")


def _news(
    rows: DataFrame, name: str, current: DataFrame, folders: Sequence[str]
) -> DataFrame:
    """Rows of a dimension that it does not have in just this form."""
    return rows if not folders else rows.join(current, rows.columns, "left_anti")


def _write_dimensions(
    spark: SparkSession, profile: DataFrame, changed: Iterable[int], mart: str, load: str, at: star.Current
) -> dict[str, list[str]]:
    """Writes what the source changes in the dimensions; the folders that are current then.

    A dimension without a change gets no folder. Past MOST_FOLDERS all are folded into one.
    """
    dates = profile.where(F.col("kind") == DATE_KIND)
    products = profile.where(F.col("kind") == PRODUCT_KIND)
    own = {
        star.DATES: dates.where(year_month(F.col("Date")).isin(sorted(changed))).select(
            F.col("Date").alias("date_key"), F.col("parts.Year").alias("year"),
            F.col("parts.Month").alias("month"), F.col("parts.Day").alias("day"),
        ),
        star.PRODUCTS: products.select(
            F.col("product_id").alias("product_key"),
            product_label(F.col("product_id")).alias("product_name"),
        ),
    }
    folders = {name: list(at.dims.get(name, [])) for name in own}
    read = {star.DATES: star.read_date_dim, star.PRODUCTS: star.read_product_dim}
    current = {name: read[name](spark, mart, at) for name in own}
    news = {name: _news(rows, name, current[name], folders[name]) for name, rows in own.items()}
    # One small job tells which dimensions change; the first load changes both.
    some = [
        rows.limit(1).select(F.lit(name).alias("name"))
        for name, rows in news.items()
        if folders[name]
    ]
    changing = {name for name in own if not folders[name]}
    if some:
        both = some[0] if len(some) == 1 else some[0].unionAll(some[1])
        changing |= {r["name"] for r in both.collect()}
    for name in sorted(changing):
        if len(folders[name]) < MOST_FOLDERS:
            sink.write_dim(news[name], mart, name, load)
            folders[name].append(load)
        else:
            keys = star.DIMENSIONS[name][1]
            sink.write_dim(merge(current[name], news[name], keys), mart, name, load)
            folders[name] = [load]
    return folders


def load_rows(
    spark: SparkSession,
    cleaned: DataFrame,
    mart: str,
    files: Iterable[tuple[str, str]],
    months: dict[int, MonthRows] | None = None,
    at: star.Current | None = None,
) -> None:
    """Merges clean rows into the star and commits them under the names in `files`.

    A month for which the source holds the very rows that its last load was
    given is left alone, since merging them again would change nothing, neither
    in the fact table nor in the dimensions. So a file that repeats all history
    and adds a day costs one month.

    `months` are the source's months if they are known. Then only those that changed are read: once
    for all figures about them and twice by the merge, for its keys and its rows. If they are not
    known, the first of these passes covers the whole source.

    Dimensions and fact are written before the ledger. Nothing is visible before the commit, so
    a load that fails anywhere can simply be run again. Of two loads from one state, only one commits.
    """
    at = at or star.current(spark, mart)
    known = {ym: month.source_hash for ym, month in at.months.items()}
    load = sink.new_load_id(at.number + 1)

    def differing(found: dict[int, MonthRows]) -> dict[int, MonthRows]:
        return {ym: m for ym, m in found.items() if known.get(ym) != m.source_hash}

    changed = None if months is None else differing(months)
    folders = at.dims
    if changed is None or changed:
        rows = cleaned if changed is None else only_months(cleaned, changed)
        profile = sink.write_profile(spark, source_profile(rows), mart, load)
        listed = profile.where(F.col("kind") == MONTH_KIND).collect()
        found = month_rows((r["ym"], r["lanes"], r["key_bytes"]) for r in listed)
        changed = differing(found)
        examples = [r["example"] for r in listed if r["ym"] in changed and r["n_repeated"]]
        if examples:
            shown = "; ".join(str(e.asDict()) for e in examples[:3])
            raise DuplicateKeys(f"keys {list(FACT_KEYS)} are not unique, for example {shown}")
    if changed:
        source = dimensions.sales_fact(only_months(cleaned, changed))
        target = star.read_fact(spark, mart, changed, at)
        size = sum(m.key_bytes for m in changed.values())
        # The small jobs of the dimensions run beside the large one of the fact.
        with ThreadPoolExecutor(1) as beside:
            dims = beside.submit(_write_dimensions, spark, profile, changed, mart, load, at)
            sink.write_fact(merge(target, source, FACT_KEYS, size), mart, load)
            folders = dims.result()
    written = {ym: m.source_hash for ym, m in changed.items()}
    sink.commit_load(spark, mart, at.number + 1, files, load, written, folders)


def load_star(
    spark: SparkSession,
    snapshot: str,
    lake: str,
    mart: str,
    content_hash: str | None = None,
    fmt: str = "parquet",
    months: dict[int, MonthRows] | None = None,
) -> str:
    """Loads the snapshot named `snapshot` unless the ledger already lists it.

    `months` are the snapshot's, if the caller has them; else the manifest may know them.
    """
    sink.ensure_star(spark, mart)
    at = star.current(spark, mart, snapshot)
    if at.listed:
        return SKIPPED
    path = f"{lake}/{snapshot}"
    if fmt == "csv":
        require_readable(spark, path)
        months = None  # a CSV file may lose digits or be put there by others
    elif months is None:
        listed = snapshot_months(spark, lake, snapshot)
        months = None if listed is None else month_rows(listed)
    rows = read_snapshot(spark, path, fmt)
    load_rows(spark, rows, mart, [(snapshot, content_hash)], months, at)
    return LOADED
