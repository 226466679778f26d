"""Star tables out of clean rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.functions.labels import product_label


def date_dim(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        F.col("Date").alias("date_key"),
        F.col("Year").alias("year"),
        F.col("Month").alias("month"),
        F.col("Day").alias("day"),
    ).distinct()


def product_dim(cleaned: DataFrame, label_width: int | None = None) -> DataFrame:
    """Distinct keys first, so that each label is built once."""
    keys = cleaned.select(F.col("product_id").alias("product_key")).distinct()
    return keys.withColumn("product_name", product_label(F.col("product_key"), label_width))


def sales_fact(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        F.col("Date").alias("date_key"),
        F.col("product_id").alias("product_key"),
        F.col("Total_Units_Sold").alias("total_units_sold"),
        F.col("Total_Revenue").alias("total_revenue"),
    )
