"""The supplied order tables, read as the sales data the operators work on.

Three shapes come out of `lineitem`, each over the whole table:

* `wide_daily`   one wide row per ship day, four products (the part key's
  remainder by four names the product, so every line belongs to one of them),
* `wide_brands`  the same with one product per brand,
* `wide_lines`   one wide row per line, so that it grows with the table.

`line_fact` and `keyed_fact` are fact tables with one product per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.numbers import exact_sum
from tallystar.schemas import (
    DATE_COLUMN,
    REVENUE_PREFIX,
    SNAPSHOT_FOLDER,
    SNAPSHOT_PREFIX,
    UNITS_PREFIX,
)

# The numbers of the four products, and of the 25 brands of the parts.
PRODUCTS = [1, 2, 3, 4]
BRANDS = list(range(1, 26))
# Lines that meet in one task where they are dealt by a column.
LINES_A_TASK = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _product_number() -> Column:
    """One of four for every part, so that no line is left out."""
    return F.col("partkey") % len(PRODUCTS) + 1


def date_text(date: Column) -> Column:
    """dd-MM-yyyy, but the 29th of a month comes as yyyy-MM-dd, which the parser must reject."""
    return F.when(F.dayofmonth(date) == 29, F.date_format(date, "yyyy-MM-dd")).otherwise(
        F.date_format(date, "dd-MM-yyyy")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_quantity").alias("units"),
        F.col("l_extendedprice").alias("revenue"),
    )


def _wide(sales: DataFrame, numbers: list[int]) -> DataFrame:
    """Added up per day and product first, so only those totals are pivoted."""
    daily = sales.groupBy("d", "number").agg(
        F.sum("units").cast("int").alias("units"), exact_sum(F.col("revenue")).alias("revenue")
    )
    pivoted = (
        daily.groupBy("d")
        .pivot("number", numbers)
        .agg(F.first("units").alias("units"), F.first("revenue").alias("revenue"))
    )
    return pivoted.select(
        date_text(F.col("d")).alias(DATE_COLUMN),
        *[F.col(f"{n}_units").alias(f"{UNITS_PREFIX}P{n}") for n in numbers],
        *[F.col(f"{n}_revenue").alias(f"{REVENUE_PREFIX}P{n}") for n in numbers],
    )


def wide_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(lines(spark, sf_dir).withColumn("number", _product_number()), PRODUCTS)


def wide_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring_index("p_brand", "#", -1).cast("int").alias("number")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), number)
    return _wide(lines(spark, sf_dir).join(parts, "partkey"), BRANDS)


def wide_lines(
    spark: SparkSession, sf_dir: str, *carry: str, together: str | None = None
) -> DataFrame:
    """One wide row per line; `carry` are other columns of `lines`.

    With `together`, lines of one value of that column are dealt to one task, as narrow rows, before
    anything is made of them: what is grouped within such values later needs no shuffle. Tasks grow
    in number with the lines (counted from the files' footers), not in size.
    """
    sales = lines(spark, sf_dir).withColumn("number", _product_number())
    if together is not None:
        tasks = max(spark.sparkContext.defaultParallelism, -(-sales.count() // LINES_A_TASK))
        sales = sales.repartition(tasks, together)
    here = {n: F.col("number") == n for n in PRODUCTS}
    return sales.select(
        *carry,
        date_text(F.col("d")).alias(DATE_COLUMN),
        *[F.when(here[n], F.col("units")).alias(f"{UNITS_PREFIX}P{n}") for n in PRODUCTS],
        *[F.when(here[n], F.col("revenue")).alias(f"{REVENUE_PREFIX}P{n}") for n in PRODUCTS],
    )


def _part_product() -> Column:
    return F.concat(F.lit("P"), F.col("partkey").cast("string")).alias("product_key")


def line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a sale of its part; a part may be sold more than once a day."""
    return lines(spark, sf_dir).select(
        F.col("d").alias("date_key"),
        _part_product(),
        F.col("units").cast("int").alias("total_units_sold"),
        F.col("revenue").alias("total_revenue"),
    )


def keyed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day and part."""
    return (
        line_fact(spark, sf_dir)
        .groupBy("date_key", "product_key")
        .agg(
            F.sum("total_units_sold").cast("int").alias("total_units_sold"),
            exact_sum(F.col("total_revenue")).alias("total_revenue"),
        )
    )


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as an upload at its time: `filename, modified, event_type`."""
    stamp = F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " -:", "_")
    return table(spark, sf_dir, "events").select(
        F.concat(
            F.lit(f"{SNAPSHOT_FOLDER}/{SNAPSHOT_PREFIX}"), stamp, F.lit(".csv")
        ).alias("filename"),
        F.col("ts").alias("modified"),
        "event_type",
    )


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as staging text; units carry a fraction and the 29th a date to reject."""
    d = F.col("d")
    date_str = F.when(F.dayofmonth(d) == 29, F.date_format(d, "dd-MM-yyyy")).otherwise(
        d.cast("string")
    )
    return lines(spark, sf_dir).select(
        date_str.alias("date_str"),
        F.year(d).cast("double").cast("string").alias("year"),
        F.month(d).cast("double").cast("string").alias("month"),
        F.dayofmonth(d).cast("double").cast("string").alias("day"),
        F.concat(F.lit("P"), F.col("partkey").cast("string")).alias("product_key"),
        (F.col("units") + 0.5).cast("string").alias("total_units_sold"),
        F.col("revenue").cast("string").alias("total_revenue"),
    )
