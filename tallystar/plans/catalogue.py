"""The registered queries: every operator over the supplied tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.dates import date_parts, parse_date
from tallystar.functions.fingerprint import (
    added_lanes,
    fingerprint,
    lane_sums,
    table_fingerprint,
    text_hash,
)
from tallystar.operators import checks, dimensions, membership, reports
from tallystar.operators.clean import clean, narrow_revenue, typed, validation_counts
from tallystar.operators.merge import BROADCAST_BYTES, merge
from tallystar.operators.unpivot import to_long
from tallystar.plans.analysis import kept_marts, marts, write_marts, year_report
from tallystar.plans.etl import run_etl
from tallystar.plans.load import KEY_ROW_BYTES
from tallystar.schemas import (
    CLEAN,
    DATE_COLUMN,
    DATE_KEYS,
    FACT_KEYS,
    PIPELINE_VERSION,
    PRODUCT_KEYS,
    UNITS_PREFIX,
)
from tallystar.session import scratch_folder
from tallystar.sinks.snapshots import append_manifest, snapshot_name, write_snapshot
from tallystar.sources import snapshots, supplied
from tallystar.sources import star_tables as star
from tallystar.sources.snapshots import stage_rows
from tallystar.sources.wide_files import SOURCE_FILE, SOURCE_TIME
from tallystar.streaming.ingest import accepted_files, file_profiles, ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

# The merge queries: the target holds the days before TARGET_END with older
# figures, the source holds the days from SOURCE_START on.
TARGET_END = "1999-01-01"
SOURCE_START = "1998-01-01"


def _clean_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(to_long(supplied.wide_daily(spark, sf_dir)))


def _daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.sales_fact(_clean_daily(spark, sf_dir))


def _is_target(column: str = "date_key"):
    return F.col(column) < F.lit(TARGET_END).cast("date")


def _is_source(column: str = "date_key"):
    return F.col(column) >= F.lit(SOURCE_START).cast("date")


# Reading, reshaping, cleaning


def unpivot_sales(spark, sf_dir):
    return to_long(supplied.wide_daily(spark, sf_dir))


def unpivot_brands(spark, sf_dir):
    return to_long(supplied.wide_brands(spark, sf_dir))


def unpivot_lines(spark, sf_dir):
    return to_long(supplied.wide_lines(spark, sf_dir))


def clean_sales(spark, sf_dir):
    return _clean_daily(spark, sf_dir)


def clean_lines(spark, sf_dir):
    return clean(to_long(supplied.wide_lines(spark, sf_dir)))


def narrow_revenue_sales(spark, sf_dir):
    return narrow_revenue(_clean_daily(spark, sf_dir))


def parse_dates(spark, sf_dir):
    """Order dates as text in two formats, the second one allowed as an extra."""
    day = F.col("o_orderdate").cast("date")
    texts = supplied.table(spark, sf_dir, "orders").select(
        "o_orderkey", supplied.date_text(day).alias("text")
    )
    parsed = texts.select(
        "o_orderkey",
        parse_date(F.col("text")).alias("strict_date"),
        parse_date(F.col("text"), ["yyyy-MM-dd"]).alias("date"),
    )
    return parsed.select("*", *date_parts(F.col("date")))


def staged_sales(spark, sf_dir):
    return stage_rows(supplied.staged_lines(spark, sf_dir))


# Counts, checks, content


def _counts(wide: DataFrame) -> DataFrame:
    return typed(to_long(wide)).agg(*validation_counts())


def validation_counts_daily(spark, sf_dir):
    return _counts(supplied.wide_daily(spark, sf_dir))


def validation_counts_lines(spark, sf_dir):
    return _counts(supplied.wide_lines(spark, sf_dir))


def csv_snapshot_rows(spark, sf_dir):
    """A CSV snapshot written by the sink and read back by position."""
    path = f"{scratch_folder(spark)}/{snapshot_name('csv')}"
    write_snapshot(_clean_daily(spark, sf_dir), path, "csv")
    return snapshots.read_snapshot(spark, path, "csv")


def csv_staging_rejects(spark, sf_dir):
    """Rows of a staged CSV file that the load would refuse."""
    path = f"{scratch_folder(spark)}/staged.csv"
    supplied.staged_lines(spark, sf_dir).write.option("header", True).csv(path)
    return snapshots.staging_rejects(snapshots.read_staging(spark, path))


def csv_refused_rows(spark, sf_dir):
    """The rows of a staged CSV file that the load would refuse, with the reason."""
    path = f"{scratch_folder(spark)}/staged.csv"
    supplied.staged_lines(spark, sf_dir).write.option("header", True).csv(path)
    return snapshots.refused_rows(snapshots.read_staging(spark, path))


def written_manifest(spark, sf_dir):
    """The manifest row of a written snapshot, without its name, time and hash."""
    lake, name = scratch_folder(spark), snapshot_name()
    append_manifest(
        spark, lake, name, write_snapshot(clean_lines(spark, sf_dir), f"{lake}/{name}")
    )
    return star.read_manifest(spark, lake).select(
        "record_count", "min_date", "max_date", "pipeline_version"
    )


def newest_snapshot_rows(spark, sf_dir):
    """Rows of the newest complete of two snapshots; the newer one lacks P4."""
    lake, cleaned = scratch_folder(spark), _clean_daily(spark, sf_dir)
    for suffix, rows in (("_a", cleaned), ("_b", cleaned.where(F.col("product_id") != "P4"))):
        name = snapshot_name(suffix=suffix)
        append_manifest(spark, lake, name, write_snapshot(rows, f"{lake}/{name}"))
    return snapshots.read_snapshot(spark, f"{lake}/{snapshots.latest_snapshot(spark, lake)}")


def globbed_sales(spark, sf_dir):
    """Rows that a run loads of the files that match a pattern, from a folder that holds others too."""
    home, wide = scratch_folder(spark), supplied.wide_daily(spark, sf_dir)
    wide.write.option("header", True).csv(f"{home}/data")
    old = wide.withColumn(f"{UNITS_PREFIX}P1", F.lit(0))
    old.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{home}/data")
    run = run_etl(spark, f"{home}/data", f"{home}/lake", f"{home}/mart", glob="*.csv")
    return snapshots.read_snapshot(spark, f"{home}/lake/{run.snapshot}")


def ledger_months(spark, sf_dir):
    """Months that the ledger lists after one run over the daily file."""
    home = scratch_folder(spark)
    _write_wide(supplied.wide_daily(spark, sf_dir), f"{home}/data")
    run_etl(spark, f"{home}/data", f"{home}/lake", f"{home}/mart")
    ledger = star.read_ledger(spark, f"{home}/mart")
    return ledger.select(F.explode("months.ym").alias("ym"))


def _in_one(found: dict[str, DataFrame]) -> DataFrame:
    """The four reports as one table."""
    columns = {
        "total_sales_by_product": (F.col("product_key"), F.col("total_sales")),
        "monthly_sales_trend": (F.col("month").cast("string"), F.col("total_sales")),
        "top_products": (F.col("product_key"), F.col("total_units").cast("double")),
        "avg_revenue": (F.lit(None).cast("string"), F.col("avg_revenue")),
    }
    parts = [
        found[name].select(F.lit(name).alias("report"), key.alias("key"), value.alias("value"))
        for name, (key, value) in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def written_marts(spark, sf_dir):
    """All reports as the report job writes them."""
    folder, fact = scratch_folder(spark), supplied.line_fact(spark, sf_dir)
    write_marts(fact, folder)
    return _in_one({name: spark.read.parquet(f"{folder}/{name}") for name in marts(fact)})


def kept_reports(spark, sf_dir):
    """Reports from kept sums: after an old delivery, and after a newer one replaced months of it."""
    home = scratch_folder(spark)
    for number, wide in enumerate(_old_and_new(spark, sf_dir)):
        _write_wide(wide, f"{home}/data/{number}")
        run_etl(spark, f"{home}/data/{number}", f"{home}/lake", f"{home}/mart")
        found = kept_marts(spark, f"{home}/mart")
    return _in_one(found)


def _fine_fact(spark, sf_dir):
    """Discounted revenue with four decimals."""
    lines = supplied.table(spark, sf_dir, "lineitem")
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    return lines.select(
        F.col("l_shipdate").cast("date").alias("date_key"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 25).cast("string")).alias("product_key"),
        F.col("l_quantity").cast("int").alias("total_units_sold"),
        net.alias("total_revenue"),
    )


def total_sales_fine(spark, sf_dir):
    return reports.total_sales_by_product(_fine_fact(spark, sf_dir))


def avg_revenue_fine(spark, sf_dir):
    return reports.avg_revenue(_fine_fact(spark, sf_dir))


def merge_fact_shuffled(spark, sf_dir):
    """merge_fact_many with keys counted as too large to broadcast."""
    return _merged_fact(supplied.keyed_fact(spark, sf_dir), BROADCAST_BYTES + 1)


def merge_fact_broadcast(spark, sf_dir):
    """merge_fact_many with the source's keys and days counted: what of them is small is broadcast."""
    fact = supplied.keyed_fact(spark, sf_dir)
    size = F.coalesce(F.sum(F.lit(KEY_ROW_BYTES) + F.octet_length("product_key")), F.lit(0))
    days = F.count_distinct("date_key") * KEY_ROW_BYTES
    # One row comes to the driver.
    return _merged_fact(fact, *fact.where(_is_source()).agg(size, days).first())


def staging_rejects(spark, sf_dir):
    return staged_sales(spark, sf_dir).agg(*validation_counts())


def _manifest(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("Date").alias("min_date"),
        F.max("Date").alias("max_date"),
        F.count_distinct("product_id").alias("n_products"),
    ).withColumn("pipeline_version", F.lit(PIPELINE_VERSION))


def snapshot_manifest(spark, sf_dir):
    return _manifest(_clean_daily(spark, sf_dir))


def snapshot_manifest_lines(spark, sf_dir):
    return _manifest(clean_lines(spark, sf_dir))


def content_copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups by the fingerprint of their whole clean rows: how many contents occur how often."""
    groups = rows.groupBy(*keys).agg(table_fingerprint(CLEAN.fieldNames()).alias("content_hash"))
    return (
        groups.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("copies").agg(F.count(F.lit(1)).alias("contents"))
    )


def _delivered(rows: DataFrame, number: str) -> DataFrame:
    """Every group of rows four times: as it is; with a cent more for one number in three; with a
    unit less for one in four; with every row twice for one in five. So contents occur one to four
    times, and a fingerprint that is blind to revenue, units or repetition counts them otherwise.
    """
    n = F.col(number)
    changed = rows.withColumn("delivery", F.explode(F.array(*map(F.lit, range(4)))))
    cent = F.when((F.col("delivery") == 1) & (n % 3 == 0), 0.01).otherwise(0.0)
    unit = F.when((F.col("delivery") == 2) & (n % 4 == 0), 1).otherwise(0)
    times = F.when((F.col("delivery") == 3) & (n % 5 == 0), 2).otherwise(1)
    return (
        changed.withColumn("Total_Revenue", F.round(F.col("Total_Revenue") + cent, 2))
        .withColumn("Total_Units_Sold", F.col("Total_Units_Sold") - unit)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
        .drop("copy")
    )


def content_fingerprint(spark, sf_dir):
    """All clean lines in all columns, as four deliveries of each order: contents by their copies."""
    wide = supplied.wide_lines(spark, sf_dir, "orderkey", together="orderkey")
    rows = clean(to_long(wide, carry=["orderkey"]), ["orderkey"])
    return content_copies(_delivered(rows, "orderkey"), ["orderkey", "delivery"])


def content_fingerprint_rows(spark, sf_dir):
    """All clean lines in all columns, as four deliveries of each date and product."""
    rows = clean_lines(spark, sf_dir).withColumn("number", F.datediff("Date", F.lit("1970-01-01")))
    return content_copies(_delivered(rows, "number"), ["Date", "product_id", "delivery"])


def combined_fingerprint(spark, sf_dir):
    """Products whose lines' fingerprint, added up from their months, is that of a whole pass."""
    rows, columns = clean_lines(spark, sf_dir), CLEAN.fieldNames()
    months = rows.groupBy("product_id", "Year", "Month").agg(lane_sums(columns).alias("lanes"))
    added = months.groupBy("product_id").agg(
        fingerprint(added_lanes(F.col("lanes"))).alias("added"), F.sum(F.col("lanes")[0]).alias("lines")
    )
    whole = rows.groupBy("product_id").agg(table_fingerprint(columns).alias("whole"))
    return added.join(whole, "product_id").select(
        "product_id", "lines", (F.col("added") == F.col("whole")).alias("same")
    )


def content_hash(spark, sf_dir):
    docs = supplied.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text_hash(F.col("text")).alias("content_hash"))


def page_hash(spark, sf_dir):
    pages = supplied.table(spark, sf_dir, "pages")
    return pages.select("page_id", text_hash(F.col("html")).alias("content_hash"))


def fact_duplicate_keys(spark, sf_dir):
    lines = supplied.table(spark, sf_dir, "lineitem")
    return checks.duplicate_keys(lines, ["l_orderkey", "l_partkey"])


def _dates_but_february(fact: DataFrame) -> DataFrame:
    return fact.select("date_key").where(F.month("date_key") != 2).distinct()


def fact_orphans(spark, sf_dir):
    fact = _daily_fact(spark, sf_dir)
    return checks.orphans(fact, _dates_but_february(fact), DATE_KEYS)


def _small_parts(spark, sf_dir):
    """A product dimension that lacks the parts of a size above 25."""
    parts = supplied.table(spark, sf_dir, "part").where(F.col("p_size") <= 25)
    return parts.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_key")
    )


def fact_orphans_lines(spark, sf_dir):
    fact = supplied.line_fact(spark, sf_dir)
    return checks.orphans(fact, _small_parts(spark, sf_dir), PRODUCT_KEYS)


def orphan_products(spark, sf_dir):
    fact = supplied.line_fact(spark, sf_dir)
    return checks.orphan_keys(fact, _small_parts(spark, sf_dir), PRODUCT_KEYS)


def star_integrity(spark, sf_dir):
    """All key checks over the lines, with both dimensions incomplete."""
    fact = supplied.line_fact(spark, sf_dir)
    return checks.integrity(fact, _dates_but_february(fact), _small_parts(spark, sf_dir))


# Files


def unprocessed_files(spark, sf_dir):
    files = supplied.event_files(spark, sf_dir)
    ledger = files.where(F.col("event_type") != "error")
    return membership.unprocessed(files.select("filename").distinct(), ledger)


def _as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows of the four deliveries of each order, each as a file of its own.

    An order's rows are dealt to one task before they are multiplied.
    """
    wide = supplied.wide_lines(spark, sf_dir, "orderkey", together="orderkey")
    rows = _delivered(typed(to_long(wide, carry=["orderkey"]), ["orderkey"]), "orderkey")
    name = F.concat_ws("/", F.lit("orders"), "orderkey", "delivery").alias(SOURCE_FILE)
    time = F.timestamp_seconds(F.col("delivery") * 86400 + F.col("orderkey")).alias(SOURCE_TIME)
    named = [F.col(c).alias(c.lower()) for c in CLEAN.fieldNames()]
    return rows.select("orderkey", "delivery", name, time, *named)


def accepted_deliveries(spark, sf_dir):
    """Files that the ingest job would load of four deliveries of each order, if it had loaded the
    first delivery of every seventh order before: by its own profile of files and its own choice.

    Files with a date and product twice are refused; of equal contents the oldest file is taken.
    """
    rows = _as_files(spark, sf_dir)
    before = (F.col("orderkey") % 7 == 0) & (F.col("delivery") == 0)
    sound, loaded = (
        file_profiles(r, ["orderkey"]).where(~F.col("repeated")).drop("repeated")
        for r in (rows, rows.where(before))
    )
    ledger = loaded.select(F.col(SOURCE_FILE).alias("filename"), "content_hash")
    return accepted_files(sound, ledger).select("filename", "copies_skipped")


def latest_snapshot(spark, sf_dir):
    files = supplied.event_files(spark, sf_dir).select("filename", "modified")
    return membership.latest(files, "modified", "filename")


def _incoming_and_ledger(spark, sf_dir):
    """The labelled documents are loaded already, the others come in."""
    hashes = content_hash(spark, sf_dir)
    labelled = supplied.table(spark, sf_dir, "labels").select("doc_id")
    incoming = hashes.join(labelled, "doc_id", "left_anti")
    return incoming, hashes.join(labelled, "doc_id", "left_semi")


def known_content(spark, sf_dir):
    return membership.known_content(*_incoming_and_ledger(spark, sf_dir))


def new_content(spark, sf_dir):
    return membership.new_content(*_incoming_and_ledger(spark, sf_dir))


def first_uploads(spark, sf_dir):
    return membership.first_of_each_content(content_hash(spark, sf_dir), "doc_id")


# Star tables


def date_dim(spark, sf_dir):
    return dimensions.date_dim(_clean_daily(spark, sf_dir))


def date_dim_lines(spark, sf_dir):
    return dimensions.date_dim(clean_lines(spark, sf_dir))


def product_dim(spark, sf_dir):
    return dimensions.product_dim(_clean_daily(spark, sf_dir))


def _part_keys(spark, sf_dir):
    return supplied.line_fact(spark, sf_dir).select(F.col("product_key").alias("product_id"))


def product_dim_many(spark, sf_dir):
    return dimensions.product_dim(_part_keys(spark, sf_dir))


def product_dim_one_digit(spark, sf_dir):
    return dimensions.product_dim(_part_keys(spark, sf_dir), label_width=1)


def merge_date_dim(spark, sf_dir):
    dates = date_dim(spark, sf_dir)
    stale = dates.where(_is_target()).withColumn("day", F.lit(0))
    return merge(stale, dates.where(_is_source()), DATE_KEYS)


def merge_product_dim(spark, sf_dir):
    products = product_dim(spark, sf_dir)
    target = products.where(F.col("product_key") != "P4").withColumn(
        "product_name", F.concat(F.lit("Old "), F.col("product_key"))
    )
    return merge(target, products.where(F.col("product_key") != "P1"), PRODUCT_KEYS)


def merge_product_dim_many(spark, sf_dir):
    """The target knows all parts by brand, the source renames those sold from SOURCE_START."""
    target = supplied.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_key"),
        F.col("p_brand").alias("product_name"),
    )
    sold = supplied.line_fact(spark, sf_dir).where(_is_source())
    source = dimensions.product_dim(sold.select(F.col("product_key").alias("product_id")))
    return merge(target, source, PRODUCT_KEYS)


def _merged_fact(
    fact: DataFrame, key_bytes: int | None = None, lead_bytes: int | None = None
) -> DataFrame:
    stale = fact.where(_is_target()).withColumn(
        "total_units_sold", F.col("total_units_sold") - 1
    )
    return merge(stale, fact.where(_is_source()), FACT_KEYS, key_bytes, lead_bytes)


def merge_fact(spark, sf_dir):
    return _merged_fact(_daily_fact(spark, sf_dir))


def merge_fact_many(spark, sf_dir):
    return _merged_fact(supplied.keyed_fact(spark, sf_dir))


# Reports


def total_sales_by_product(spark, sf_dir):
    return reports.total_sales_by_product(_daily_fact(spark, sf_dir))


def total_sales_by_brand(spark, sf_dir):
    cleaned = clean(to_long(supplied.wide_brands(spark, sf_dir)))
    return reports.total_sales_by_product(dimensions.sales_fact(cleaned))


def total_sales_by_product_many(spark, sf_dir):
    return reports.total_sales_by_product(supplied.line_fact(spark, sf_dir))


def monthly_sales_trend(spark, sf_dir):
    return reports.monthly_sales_trend(_daily_fact(spark, sf_dir))


def monthly_sales_trend_lines(spark, sf_dir):
    return reports.monthly_sales_trend(supplied.line_fact(spark, sf_dir))


def top_products(spark, sf_dir):
    return reports.top_products(_daily_fact(spark, sf_dir))


def top_products_many(spark, sf_dir):
    return reports.top_products(supplied.line_fact(spark, sf_dir))


def avg_revenue(spark, sf_dir):
    return reports.avg_revenue(_daily_fact(spark, sf_dir))


def avg_revenue_lines(spark, sf_dir):
    return reports.avg_revenue(supplied.line_fact(spark, sf_dir))


def fact_preview(spark, sf_dir):
    return reports.preview(_daily_fact(spark, sf_dir))


def star_monthly_by_product(spark, sf_dir):
    cleaned = _clean_daily(spark, sf_dir)
    return reports.monthly_by_product(
        dimensions.sales_fact(cleaned),
        dimensions.date_dim(cleaned),
        dimensions.product_dim(cleaned),
    )


def star_monthly_by_product_many(spark, sf_dir):
    fact = supplied.line_fact(spark, sf_dir)
    dates = fact.select("date_key").distinct()
    dates = dates.select("date_key", *date_parts(F.col("date_key")))
    products = supplied.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_key"),
        F.col("p_name").alias("product_name"),
    )
    return reports.monthly_by_product(fact, dates, products)


# Whole runs, through files in a new folder under spark.checkpoint.dir


def _write_wide(wide: DataFrame, folder: str) -> None:
    wide.write.mode("append").option("header", True).csv(folder)


def _old_and_new(spark, sf_dir):
    """Two deliveries of wide rows: older figures, then the days from SOURCE_START again."""
    wide = supplied.wide_daily(spark, sf_dir)
    day = F.coalesce(
        F.try_to_date(DATE_COLUMN, "dd-MM-yyyy"), F.try_to_date(DATE_COLUMN, "yyyy-MM-dd")
    )
    dated = wide.withColumn("d", day)
    old = dated.where(_is_target("d"))
    for number in supplied.PRODUCTS:
        units = f"{UNITS_PREFIX}P{number}"
        old = old.withColumn(units, F.col(f"`{units}`") - 1)
    return old.drop("d"), dated.where(_is_source("d")).drop("d")


def etl_sales_fact(spark, sf_dir):
    """Two ETL runs into one star; the fact table as readers see it after both."""
    home = scratch_folder(spark)
    for number, wide in enumerate(_old_and_new(spark, sf_dir)):
        _write_wide(wide, f"{home}/data/{number}")
        run_etl(spark, f"{home}/data/{number}", f"{home}/lake", f"{home}/mart")
    return star.read_fact(spark, f"{home}/mart")


def ingest_sales_fact(spark, sf_dir):
    """The same two deliveries as new files of one folder, picked up by the file stream."""
    home = scratch_folder(spark)
    for number, wide in enumerate(_old_and_new(spark, sf_dir)):
        if number == 0:  # the first delivery has another header: a column more, in another order
            wide = wide.withColumn("note", F.lit("x"))
            wide = wide.select(*[F.col(f"`{c}`") for c in reversed(wide.columns)])
        _write_wide(wide, f"{home}/data")
        ingest_new_files(spark, f"{home}/data", f"{home}/lake", f"{home}/mart")
    return star.read_fact(spark, f"{home}/mart")


def year_report_pruned(spark, sf_dir):
    """Sales of 1997 by month and product, from a star that a run has loaded."""
    home = scratch_folder(spark)
    _write_wide(supplied.wide_daily(spark, sf_dir), f"{home}/data")
    run_etl(spark, f"{home}/data", f"{home}/lake", f"{home}/mart")
    return year_report(spark, f"{home}/mart", 1997)


QUERIES: dict[str, Query] = {
    "unpivot_sales": unpivot_sales,
    "unpivot_brands": unpivot_brands,
    "unpivot_lines": unpivot_lines,
    "clean_sales": clean_sales,
    "clean_lines": clean_lines,
    "narrow_revenue": narrow_revenue_sales,
    "parse_dates": parse_dates,
    "staged_sales": staged_sales,
    "validation_counts": validation_counts_daily,
    "validation_counts_lines": validation_counts_lines,
    "staging_rejects": staging_rejects,
    "csv_snapshot_rows": csv_snapshot_rows,
    "csv_staging_rejects": csv_staging_rejects,
    "csv_refused_rows": csv_refused_rows,
    "accepted_deliveries": accepted_deliveries,
    "written_manifest": written_manifest,
    "newest_snapshot_rows": newest_snapshot_rows,
    "globbed_sales": globbed_sales,
    "ledger_months": ledger_months,
    "written_marts": written_marts,
    "kept_reports": kept_reports,
    "total_sales_fine": total_sales_fine,
    "avg_revenue_fine": avg_revenue_fine,
    "merge_fact_shuffled": merge_fact_shuffled,
    "merge_fact_broadcast": merge_fact_broadcast,
    "snapshot_manifest": snapshot_manifest,
    "snapshot_manifest_lines": snapshot_manifest_lines,
    "content_fingerprint": content_fingerprint,
    "content_fingerprint_rows": content_fingerprint_rows,
    "combined_fingerprint": combined_fingerprint,
    "content_hash": content_hash,
    "page_hash": page_hash,
    "fact_duplicate_keys": fact_duplicate_keys,
    "fact_orphans": fact_orphans,
    "fact_orphans_lines": fact_orphans_lines,
    "orphan_products": orphan_products,
    "star_integrity": star_integrity,
    "unprocessed_files": unprocessed_files,
    "latest_snapshot": latest_snapshot,
    "known_content": known_content,
    "new_content": new_content,
    "first_uploads": first_uploads,
    "date_dim": date_dim,
    "date_dim_lines": date_dim_lines,
    "product_dim": product_dim,
    "product_dim_many": product_dim_many,
    "product_dim_one_digit": product_dim_one_digit,
    "merge_date_dim": merge_date_dim,
    "merge_product_dim": merge_product_dim,
    "merge_product_dim_many": merge_product_dim_many,
    "merge_fact": merge_fact,
    "merge_fact_many": merge_fact_many,
    "total_sales_by_product": total_sales_by_product,
    "total_sales_by_brand": total_sales_by_brand,
    "total_sales_by_product_many": total_sales_by_product_many,
    "monthly_sales_trend": monthly_sales_trend,
    "monthly_sales_trend_lines": monthly_sales_trend_lines,
    "top_products": top_products,
    "top_products_many": top_products_many,
    "avg_revenue": avg_revenue,
    "avg_revenue_lines": avg_revenue_lines,
    "fact_preview": fact_preview,
    "star_monthly_by_product": star_monthly_by_product,
    "star_monthly_by_product_many": star_monthly_by_product_many,
    "etl_sales_fact": etl_sales_fact,
    "ingest_sales_fact": ingest_sales_fact,
    "year_report_pruned": year_report_pruned,
}
