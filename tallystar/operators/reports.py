"""The sales reports over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.functions.dates import month_start
from tallystar.functions.numbers import exact_avg, exact_parts, exact_sum, exact_total


def total_sales_by_product(fact: DataFrame) -> DataFrame:
    totals = fact.groupBy("product_key").agg(
        exact_sum(F.col("total_revenue")).alias("total_sales")
    )
    return totals.orderBy(F.desc("total_sales"), "product_key")


def monthly_sales_trend(fact: DataFrame) -> DataFrame:
    totals = fact.groupBy(month_start(F.col("date_key")).alias("month")).agg(
        exact_sum(F.col("total_revenue")).alias("total_sales")
    )
    return totals.orderBy("month")


def top_products(fact: DataFrame, n: int = 5) -> DataFrame:
    totals = fact.groupBy("product_key").agg(F.sum("total_units_sold").alias("total_units"))
    return totals.orderBy(F.desc("total_units"), "product_key").limit(n)


def avg_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(exact_avg(F.col("total_revenue")).alias("avg_revenue"))


def preview(fact: DataFrame, n: int = 5) -> DataFrame:
    """The first rows by key, so that two runs show the same ones."""
    return fact.orderBy("date_key", "product_key").limit(n)


def monthly_by_product(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """The star join: sales per month and product, with the labels of both dimensions.

    Spark broadcasts the dates if their size allows. Nothing bounds the products, so
    the fact is first added up per month and product key, map-side, and only those
    totals meet the product dimension, by whichever join their size calls for.

    A fact with the month `ym` by which it is partitioned is joined by it, too: then a filter on the
    dates' year or month keeps Spark from reading the other months.
    """
    days, keys = dates.select("date_key", "year", "month"), ["date_key"]
    if "ym" in fact.columns:
        days, keys = days.withColumn("ym", F.col("year") * 100 + F.col("month")), ["date_key", "ym"]
    per_key = (
        fact.join(days, keys)
        .groupBy("year", "month", "product_key")
        .agg(
            F.sum("total_units_sold").alias("total_units"),
            exact_sum(F.col("total_revenue")).alias("total_sales"),
        )
    )
    return per_key.join(products, "product_key").select(
        "year", "month", "product_key", "product_name", "total_units", "total_sales"
    )


def month_parts(fact: DataFrame, *by: str) -> DataFrame:
    """What the reports need of a fact with `ym`, per month and product: exact sums that add up."""
    revenue = exact_parts(F.col("total_revenue"))
    return fact.groupBy(*by, "ym", "product_key").agg(
        F.sum("total_units_sold").alias("units"),
        F.count("total_revenue").alias("amounts"),
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(part).alias(name) for name, part in revenue.items()],
    )


# Names of the summed parts of the revenue.
PARTS = ("lane0", "lane1", "lane2", "fine", "large", "rest")


def reports_of_parts(parts: DataFrame) -> dict[str, DataFrame]:
    """The reports above, from month_parts instead of the fact."""
    sales = exact_total({name: F.sum(name) for name in PARTS})
    month = F.to_date(F.concat(F.col("ym").cast("string"), F.lit("01")), "yyyyMMdd").alias("month")
    units = parts.groupBy("product_key").agg(F.sum("units").alias("total_units"))
    return {
        "total_sales_by_product": parts.groupBy("product_key")
        .agg(sales.alias("total_sales")).orderBy(F.desc("total_sales"), "product_key"),
        "monthly_sales_trend": parts.groupBy(month).agg(sales.alias("total_sales")).orderBy("month"),
        "top_products": units.orderBy(F.desc("total_units"), "product_key").limit(5),
        "avg_revenue": parts.agg((sales / F.sum("amounts")).alias("avg_revenue")),
    }
