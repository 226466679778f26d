"""The star tables as the last committed load left them.

Layout under the mart folder:

    processed_files/<number>.json       the ledger: a commit file per load, one line per loaded file
    date_dim/load=<id>/                 the rows that load added or changed, or the whole dimension
    product_dim/load=<id>/
    sales_fact/load=<id>/ym=<yyyyMM>/   only the months that load touched

A load becomes visible by its commit file alone, whose number only one load can take. A reader takes
each month from the newest load that lists it, and each dimension row from the newest of the folders
that the last load lists, so a load that died half way is never seen, and a
query that runs during a load keeps reading the files it started with.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.schemas import (
    DATE_DIM,
    DATE_KEYS,
    MANIFEST,
    PROCESSED_FILES,
    PRODUCT_DIM,
    PRODUCT_KEYS,
    SALES_FACT,
)

LEDGER = "processed_files"
REJECTED = "rejected_files"
DATES, PRODUCTS = "date_dim", "product_dim"
#: Schema and key of each dimension.
DIMENSIONS = {DATES: (DATE_DIM, DATE_KEYS), PRODUCTS: (PRODUCT_DIM, PRODUCT_KEYS)}
YM = T.StructField("ym", T.IntegerType())
# Times of the ledger, as written and as read.
LEDGER_TIME = "%Y-%m-%dT%H:%M:%S.%f"
LEDGER_TIME_READ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known as such to the optimizer, which drops a join with it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).where(F.lit(False)).select(*columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def read_ledger(spark: SparkSession, mart: str, with_number: bool = False) -> DataFrame:
    """One row per loaded file; `number` is that of its commit."""
    reader = spark.read.schema(PROCESSED_FILES).option("timestampNTZFormat", LEDGER_TIME_READ)
    name = F.substring_index(F.col("_metadata.file_name"), ".", 1).cast("int").alias("number")
    try:
        rows = reader.json(f"{mart}/{LEDGER}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows, name = empty(spark, PROCESSED_FILES), F.lit(0).alias("number")
    return rows.select("*", name) if with_number else rows


def read_rejected(spark: SparkSession, mart: str) -> DataFrame:
    """Files that the stream could not load, each once, with the reason."""
    schema = T.StructType.fromDDL("filename string, reason string, at timestamp_ntz")
    listed = read_or_empty(spark, f"{mart}/{REJECTED}", schema)
    return listed.groupBy("filename", "reason").agg(F.min("at").alias("at"))


def read_manifest(spark: SparkSession, lake: str) -> DataFrame:
    return read_or_empty(spark, f"{lake}/manifest", MANIFEST)


@dataclass(frozen=True)
class Month:
    """The load that wrote a month, and the fingerprint of the rows it was given for it."""

    load: str
    source_hash: str


@dataclass(frozen=True)
class Current:
    """What the ledger says is current: each month, the folders of each dimension, the last commit.

    `listed` tells whether the ledger has the file name that was asked for.
    """

    months: dict[int, Month]
    dims: dict[str, list[str]] = field(default_factory=dict)
    number: int = 0
    listed: bool = False


def current(spark: SparkSession, mart: str, filename: str | None = None) -> Current:
    """Reads it from the ledger: one row per calendar month with sales comes to the driver.

    Load ids sort by their commits, so the newest is the greatest.
    """
    ledger = read_ledger(spark, mart, with_number=True)
    listed = ledger.select(
        "load", "number", "dims", (F.col("filename") == F.lit(filename)).alias("hit"),
        F.explode_outer("months").alias("m"),
    )
    newest = F.max(F.struct("load", "m.source_hash")).alias("newest")
    # Folders stand in the first row of a commit only.
    dims = F.max_by("dims", F.when(F.size("dims") > 0, F.col("number"))).alias("dims")
    rows = listed.groupBy("m.ym").agg(
        newest, dims, F.max("number").alias("number"), F.bool_or("hit").alias("hit"),
        F.max(F.when(F.size("dims") > 0, F.col("number"))).alias("dims_at"),
    ).collect()
    months = {r["ym"]: Month(*r["newest"]) for r in rows if r["ym"] is not None}
    folders: dict[str, list[str]] = {}
    latest = max((r for r in rows if r["dims_at"] is not None), key=lambda r: r["dims_at"], default=None)
    for folder in latest["dims"] if latest else ():
        folders.setdefault(folder["name"], []).append(folder["load"])
    number = max((r["number"] for r in rows), default=0)
    return Current(months, folders, number, any(r["hit"] for r in rows))


def read_fact(
    spark: SparkSession,
    mart: str,
    months: Iterable[int] | None = None,
    at: Current | None = None,
    with_month: bool = False,
) -> DataFrame:
    """The fact table, or only some of its months; other months are not even listed.

    `with_month` adds `ym`, the month by which the table is partitioned, for joins that prune by it.
    """
    schema = T.StructType([*SALES_FACT.fields, *([YM] if with_month else [])])
    known = (at or current(spark, mart)).months
    wanted = known if months is None else {m: known[m] for m in months if m in known}
    if not wanted:
        return empty(spark, schema)
    base = f"{mart}/sales_fact"
    paths = [f"{base}/load={month.load}/ym={ym}" for ym, month in sorted(wanted.items())]
    reader = spark.read.schema(schema)
    if not with_month:
        return reader.parquet(*paths)
    return reader.option("basePath", base).parquet(*paths).select(*schema.fieldNames())


def _read_dim(spark: SparkSession, mart: str, name: str, at: Current | None) -> DataFrame:
    """Rows of the current folders; of a key that several have, the row of the newest."""
    schema, keys = DIMENSIONS[name]
    loads = (at or current(spark, mart)).dims.get(name, [])
    if not loads:
        return empty(spark, schema)
    base = f"{mart}/{name}"
    paths = [f"{base}/load={load}" for load in loads]
    if len(paths) == 1:
        return spark.read.schema(schema).parquet(*paths)
    with_load = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    rows = spark.read.schema(with_load).option("basePath", base).parquet(*paths)
    values = [c for c in schema.fieldNames() if c not in keys]
    newest = F.max_by(F.struct(*values), "load").alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "row.*").select(*schema.fieldNames())


def read_date_dim(spark: SparkSession, mart: str, at: Current | None = None) -> DataFrame:
    return _read_dim(spark, mart, DATES, at)


def read_product_dim(spark: SparkSession, mart: str, at: Current | None = None) -> DataFrame:
    return _read_dim(spark, mart, PRODUCTS, at)


def register_views(spark: SparkSession, mart: str) -> None:
    """The star under its table names, for spark.sql; call again to see a later load."""
    at = current(spark, mart)
    read_fact(spark, mart, at=at).createOrReplaceTempView("sales_fact")
    read_date_dim(spark, mart, at).createOrReplaceTempView("date_dim")
    read_product_dim(spark, mart, at).createOrReplaceTempView("product_dim")
    read_ledger(spark, mart).createOrReplaceTempView(LEDGER)
