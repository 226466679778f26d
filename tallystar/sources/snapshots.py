"""Clean snapshots in the lake, and the files that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions.dates import parse_staging_date
from tallystar.functions.numbers import parse_double, round_int
from tallystar.operators.clean import is_complete
from tallystar.operators.membership import latest
from tallystar.schemas import CLEAN, SNAPSHOT_FOLDER, SNAPSHOT_PREFIX, STAGING
from tallystar.sources.star_tables import read_manifest

CORRUPT = "_corrupt"


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """`path, modificationTime, length` of the files below a folder; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "modificationTime", "length")


def list_snapshots(spark: SparkSession, lake: str) -> DataFrame:
    """`snapshot, modified, bytes, is_file` per snapshot: a folder of part files, or one file."""
    name = F.regexp_extract(
        F.col("path"), f"({SNAPSHOT_FOLDER}/{SNAPSHOT_PREFIX}[^/]*)", 1
    ).alias("snapshot")
    files = list_files(spark, f"{lake}/{SNAPSHOT_FOLDER}")
    return (
        files.select(name, "path", "modificationTime", "length")
        .where(F.col("snapshot") != "")
        .groupBy("snapshot")
        .agg(
            F.max("modificationTime").alias("modified"),
            F.sum("length").alias("bytes"),
            F.bool_or(F.endswith("path", "snapshot")).alias("is_file"),
        )
    )


def latest_snapshot(spark: SparkSession, lake: str) -> str | None:
    """The newest complete snapshot: a single file, or a folder that the manifest lists.

    A folder without a manifest row is what a run left that died while writing.
    """
    listed = read_manifest(spark, lake).select("snapshot", F.lit(True).alias("complete"))
    found = list_snapshots(spark, lake).join(listed.distinct(), "snapshot", "left")
    complete = found.where(F.col("is_file") | F.col("complete"))
    row = latest(complete, "modified", "snapshot").first()
    return row["snapshot"] if row else None


def snapshot_months(
    spark: SparkSession, lake: str, snapshot: str
) -> list[tuple[int, list[int], int]] | None:
    """(month, lane sums, bytes of keys) of a snapshot if the manifest lists them."""
    row = read_manifest(spark, lake).where(F.col("snapshot") == snapshot).select("months").first()
    listed = row["months"] if row else None
    return None if listed is None else [tuple(m) for m in listed]


def stage_rows(staged: DataFrame, *carry: str) -> DataFrame:
    """Staging text to the types of a clean row; what cannot be read becomes null."""
    return staged.select(
        *carry,
        parse_staging_date(F.col("date_str")).alias("Date"),
        round_int(F.col("year")).alias("Year"),
        round_int(F.col("month")).alias("Month"),
        round_int(F.col("day")).alias("Day"),
        F.col("product_key").alias("product_id"),
        round_int(F.col("total_units_sold")).alias("Total_Units_Sold"),
        parse_double(F.col("total_revenue")).alias("Total_Revenue"),
    )


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """A CSV snapshot by position, as text; `_corrupt` holds rows of the wrong width."""
    schema = T.StructType([*STAGING.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def staging_rejects(staged: DataFrame) -> DataFrame:
    """One row: staged rows, rows of the wrong width, rows with an unreadable value."""
    corrupt = F.col(CORRUPT).isNotNull()
    rows = stage_rows(staged, CORRUPT)
    return rows.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(corrupt).alias("corrupt"),
        F.count_if(~corrupt & ~is_complete()).alias("unreadable"),
    )


def refused_rows(staged: DataFrame) -> DataFrame:
    """The staged rows that a load refuses, as their text, and why.

    `reason` is "wrong width", or "unreadable" with the names of the columns without a value.
    """
    text = F.struct(*STAGING.fieldNames()).alias("staged")
    rows = stage_rows(staged.select("*", text), "staged", CORRUPT)
    without = [
        F.when(F.col(c).isNull(), F.lit(name))
        for c, name in zip(CLEAN.fieldNames(), STAGING.fieldNames(), strict=True)
    ]
    nan = F.when(F.isnan("Total_Revenue"), F.lit(STAGING.fieldNames()[-1]))
    unreadable = F.concat(F.lit("unreadable: "), F.concat_ws(", ", *without, nan))
    reason = F.when(F.col(CORRUPT).isNotNull(), "wrong width").otherwise(unreadable)
    refused = F.col(CORRUPT).isNotNull() | ~is_complete()
    return rows.where(refused).select("staged.*", reason.alias("reason"))


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The clean rows of a snapshot."""
    if fmt == "parquet":
        return spark.read.schema(CLEAN).parquet(path)
    return stage_rows(read_staging(spark, path))


def require_readable(spark: SparkSession, path: str) -> None:
    """Fails if a CSV snapshot holds any row that cannot be loaded as it is."""
    staged = read_staging(spark, path)
    found = staging_rejects(staged).first()
    if found["corrupt"] or found["unreadable"]:
        shown = "; ".join(str(r.asDict()) for r in refused_rows(staged).limit(3).collect())
        raise ValueError(
            f"snapshot {path} has rows that cannot be read: {found.asDict()}, for example {shown}"
        )
