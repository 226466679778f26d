"""Table schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

# The column names and formats of the sales files and tables.
DATE_COLUMN = "Date"
UNITS_PREFIX = "Q-"
REVENUE_PREFIX = "S-"
DATE_FORMAT = "dd-MM-yyyy"
STAGING_DATE_FORMAT = "yyyy-MM-dd"
SNAPSHOT_FOLDER = "processed_data"
SNAPSHOT_PREFIX = "output_"
SNAPSHOT_STAMP = "%Y%m%d_%H%M%S"
PIPELINE_VERSION = "1.0"
PRODUCT_LABEL = "Product "

CLEAN = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Day", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("Total_Units_Sold", T.IntegerType()),
        T.StructField("Total_Revenue", T.DoubleType()),
    ]
)

# Read by position. Numbers arrive as text so that an unreadable value can be
# told from a missing one.
STAGING = T.StructType(
    [
        T.StructField("date_str", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("product_key", T.StringType()),
        T.StructField("total_units_sold", T.StringType()),
        T.StructField("total_revenue", T.StringType()),
    ]
)

DATE_DIM = T.StructType(
    [
        T.StructField("date_key", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)

PRODUCT_DIM = T.StructType(
    [
        T.StructField("product_key", T.StringType()),
        T.StructField("product_name", T.StringType()),
    ]
)

SALES_FACT = T.StructType(
    [
        T.StructField("date_key", T.DateType()),
        T.StructField("product_key", T.StringType()),
        T.StructField("total_units_sold", T.IntegerType()),
        T.StructField("total_revenue", T.DoubleType()),
    ]
)

# A month that a load wrote, with the fingerprint of the rows it was given for it.
MONTH = T.StructType(
    [T.StructField("ym", T.IntegerType()), T.StructField("source_hash", T.StringType())]
)

# A folder of dimension rows that is current after a load.
DIM_FOLDER = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("load", T.StringType())]
)

# One row per loaded file. `load`, `months` and `dims` are what make the ledger rows the
# commit of a load; see sources/star_tables.py.
PROCESSED_FILES = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField("months", T.ArrayType(MONTH)),
        T.StructField("dims", T.ArrayType(DIM_FOLDER)),
    ]
)

# What a snapshot holds of a month: lane sums of its rows, and the size of their keys in memory.
SNAPSHOT_MONTH = T.StructType(
    [
        T.StructField("ym", T.IntegerType()),
        T.StructField("lanes", T.ArrayType(T.LongType())),
        T.StructField("key_bytes", T.LongType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("processed_date", T.TimestampNTZType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("pipeline_version", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("min_date", T.DateType()),
        T.StructField("max_date", T.DateType()),
        T.StructField("months", T.ArrayType(SNAPSHOT_MONTH)),
    ]
)

FACT_KEYS = ("date_key", "product_key")
DATE_KEYS = ("date_key",)
PRODUCT_KEYS = ("product_key",)
