"""Primary-key and foreign-key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.schemas import DATE_KEYS, FACT_KEYS, PRODUCT_KEYS


class DuplicateKeys(ValueError):
    """A load that holds the same key more than once."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    examples = duplicate_keys(df, keys).limit(3).collect()
    if examples:
        shown = "; ".join(str(r.asDict()) for r in examples)
        raise DuplicateKeys(f"keys {list(keys)} are not unique, for example {shown}")


def orphans(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is missing from the dimension."""
    return df.join(dim.select(*keys), list(keys), "left_anti").select(*df.columns)


def orphan_keys(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys missing from the dimension, with their number of rows.

    The rows are counted per key before they meet the dimension, so a key that
    holds a third of them is one row per task by then.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dim.select(*keys), list(keys), "left_anti").select(*keys, "n")


def _violations(name: str, found: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("rows_affected")
    keys = F.count(F.lit(1)).alias("keys_affected")
    return found.agg(keys, total).select(
        F.lit(name).alias("check_name"), "keys_affected", "rows_affected"
    )


def integrity(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """One row per declared primary and foreign key of the star, with what breaks it.

    The fact is read and counted per (date, product) once for all of its three checks: each
    key's count, and one row per key side for the dimensions, carry the name of their check.
    """
    counted = fact.groupBy(*FACT_KEYS).agg(F.count(F.lit(1)).alias("n"))
    date, product = DATE_KEYS[0], PRODUCT_KEYS[0]
    kinds = F.array(
        F.struct(
            F.lit("sales_fact primary key").alias("check_name"),
            F.lit(None).cast(fact.schema[date].dataType).alias(date),
            F.lit(None).cast("string").alias(product),
            F.when(F.col("n") > 1, 1).otherwise(0).alias("keys"),
            F.when(F.col("n") > 1, F.col("n")).otherwise(0).alias("rows"),
        ),
        F.struct(
            F.lit("sales_fact date").alias("check_name"), F.col(date),
            F.lit(None).cast("string").alias(product), F.lit(1).alias("keys"),
            F.col("n").alias("rows"),
        ),
        F.struct(
            F.lit("sales_fact product").alias("check_name"),
            F.lit(None).cast(fact.schema[date].dataType).alias(date), F.col(product),
            F.lit(1).alias("keys"), F.col("n").alias("rows"),
        ),
    )
    sides = (
        counted.select("n", F.explode(kinds).alias("k"))
        .groupBy("k.check_name", f"k.{date}", f"k.{product}")
        .agg(F.sum("k.keys").alias("keys"), F.sum("k.rows").alias("n"))
    )
    known_dates = dates.select(F.col(date), F.lit(True).alias("in_dates")).distinct()
    known_products = products.select(F.col(product), F.lit(True).alias("in_products")).distinct()
    missing = (
        F.when(F.col("check_name") == "sales_fact primary key", F.col("keys"))
        .when(F.col("check_name") == "sales_fact date", F.col("in_dates").isNull().cast("int"))
        .otherwise(F.col("in_products").isNull().cast("int"))
    )
    found = (
        sides.join(known_dates, date, "left").join(known_products, product, "left")
        .withColumn("missing", missing.cast("bigint"))
        .groupBy("check_name")
        .agg(
            F.sum("missing").alias("keys_affected"),
            F.sum(F.when(F.col("missing") > 0, F.col("n")).otherwise(0)).alias("rows_affected"),
        )
    )
    names = ["sales_fact primary key", "sales_fact date", "sales_fact product"]
    spark = fact.sparkSession
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("check_name"))
    result = listed.join(found, "check_name", "left").select(
        "check_name",
        F.coalesce("keys_affected", F.lit(0)).cast("bigint").alias("keys_affected"),
        F.coalesce("rows_affected", F.lit(0)).cast("bigint").alias("rows_affected"),
    )
    for name, dim, keys in (
        ("date_dim primary key", dates, DATE_KEYS),
        ("product_dim primary key", products, PRODUCT_KEYS),
    ):
        result = result.unionByName(_violations(name, duplicate_keys(dim, keys)))
    return result
