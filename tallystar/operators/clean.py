"""Typing of long rows, removal of incomplete rows, and the counts of both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions.numbers import parse_double, parse_int
from tallystar.schemas import CLEAN


# Names of the validation counts, in their order.
COUNTS = ("rows_in", "bad_date", "bad_product", "bad_units", "bad_revenue", "rows_out")


def _int_column(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.IntegerType):
        return F.col(name)
    return parse_int(F.col(name))


def typed(long: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The columns of a clean row; a value that cannot be read becomes null."""
    return long.select(
        *carry,
        F.col("date").try_cast("date").alias("Date"),
        _int_column(long, "year").alias("Year"),
        _int_column(long, "month").alias("Month"),
        _int_column(long, "day").alias("Day"),
        F.col("product_id"),
        _int_column(long, "total_units_sold").alias("Total_Units_Sold"),
        parse_double(F.col("total_revenue")).alias("Total_Revenue"),
    )


def clean(long: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed rows without those that miss any value or whose revenue is NaN."""
    return typed(long, carry).dropna(subset=CLEAN.fieldNames())


def narrow_revenue(cleaned: DataFrame) -> DataFrame:
    """Revenue as a 32-bit float, for consumers that need the narrow type."""
    return cleaned.withColumn("Total_Revenue", F.col("Total_Revenue").cast("float"))


def is_complete() -> Column:
    """True for the typed rows that `clean` keeps."""
    present = [F.col(c).isNotNull() for c in CLEAN.fieldNames()]
    condition = ~F.isnan("Total_Revenue")
    for p in present:
        condition = condition & p
    return F.coalesce(condition, F.lit(False))


def validation_counts() -> list[Column]:
    """Aggregates over typed rows: rows in, what is wrong with them, rows out."""
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("Date").isNull()).alias("bad_date"),
        F.count_if(F.col("product_id").isNull()).alias("bad_product"),
        F.count_if(F.col("Total_Units_Sold").isNull()).alias("bad_units"),
        F.count_if(F.col("Total_Revenue").isNull() | F.isnan("Total_Revenue")).alias(
            "bad_revenue"
        ),
        F.count_if(is_complete()).alias("rows_out"),
    ]
