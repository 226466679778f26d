from datetime import date

import pytest
from pyspark.sql import functions as F

from tallystar.operators.clean import clean, narrow_revenue, typed, validation_counts
from tallystar.operators.unpivot import product_ids, to_long
from tallystar.sources.wide_files import read_folder

WIDE = "Date string, `Q-P1` string, `S-P1` string, `Q-P10` string, `S-P10` string"


def wide(spark, *rows):
    return spark.createDataFrame(list(rows), WIDE)


def test_products_come_from_the_header_pairs():
    assert product_ids(["Date", "Q-A", "S-B", "Q-B", "S-A", "x"]) == ["A", "B"]


@pytest.mark.parametrize("columns", [["Date", "Q-A"], ["Date", "Q-A", "S-B"], ["Date"]])
def test_unpaired_or_missing_products_are_an_error(columns):
    with pytest.raises(ValueError):
        product_ids(columns)


def test_long_has_one_row_per_day_and_product(spark):
    rows = to_long(wide(spark, ("13-06-2010", "1", "2.5", "3", "4.5"))).collect()
    assert [tuple(r) for r in rows] == [
        (date(2010, 6, 13), 2010, 6, 13, "P1", "1", "2.5"),
        (date(2010, 6, 13), 2010, 6, 13, "P10", "3", "4.5"),
    ]


@pytest.mark.parametrize("products", [1, 2, 5, 30])
def test_unpivot_keeps_rows_and_units(spark, products):
    cells = [F.lit("01-02-2010").alias("Date")]
    for p in range(products):
        cells += [(F.col("id") + p).alias(f"Q-{p}"), (F.col("id") * 0.5).alias(f"S-{p}")]
    long = to_long(spark.range(50).select(*cells))
    expected = sum(i + p for i in range(50) for p in range(products))
    found = long.agg(F.count("*"), F.sum("total_units_sold")).first()
    assert tuple(found) == (50 * products, expected)


def test_unpivot_is_one_scan(spark, home):
    path = f"{home}/wide.csv"
    wide(spark, ("13-06-2010", "1", "2.5", "3", "4.5")).write.option("header", True).csv(path)
    long, _ = read_folder(spark, path, None, to_long)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan


def test_mixed_cell_types_are_widened(spark):
    df = spark.range(1).select(
        F.lit("01-02-2010").alias("Date"),
        F.lit(1).alias("Q-A"),
        F.lit(2).cast("bigint").alias("Q-B"),
        F.lit(1).alias("S-A"),
        F.lit(2.5).alias("S-B"),
    )
    long = to_long(df)
    types = dict(long.dtypes)
    assert types["total_units_sold"] == "bigint" and types["total_revenue"] == "double"
    assert [r["total_revenue"] for r in long.collect()] == [1.0, 2.5]


@pytest.mark.parametrize("name", ["P'1", 'P"1', "P`1", "P\\1", "P.1", "P 1", "é"])
def test_any_product_name(spark, name):
    columns = ["Date", f"Q-{name}", f"S-{name}"]
    df = spark.createDataFrame([("13-06-2010", "1", "2.5")], columns)
    assert tuple(to_long(df).first())[4:] == (name, "1", "2.5")


def test_a_column_that_is_a_date_already_is_kept(spark):
    df = wide(spark, ("x", "1", "2", "3", "4")).withColumn("Date", F.lit(date(2011, 1, 2)))
    assert {r["date"] for r in to_long(df).collect()} == {date(2011, 1, 2)}


@pytest.mark.parametrize(
    "text", ["31-09-2010", "1-6-2010", "junk", None, "", "2010-06-13", "13-06-2010x"]
)
def test_dates_that_do_not_fit_are_null(spark, text):
    assert to_long(wide(spark, (text, "1", "2", "3", "4"))).first()["date"] is None


@pytest.mark.parametrize("text,fmt", [("1-6-2010", "d-M-yyyy"), ("2010-06-01", "yyyy-MM-dd")])
def test_an_extra_format_is_accepted(spark, text, fmt):
    long = to_long(wide(spark, (text, "1", "2", "3", "4")), [fmt])
    assert long.first()["date"] == date(2010, 6, 1)


@pytest.mark.parametrize(
    "units,expected",
    [
        ("12", 12),
        ("12.9", 12),
        ("-12.9", -12),
        ("20000001", 20000001),
        ("1e3", 1000),
        (" 7 ", 7),
        ("NaN", None),
        ("3e9", None),
        ("many", None),
        ("", None),
        (None, None),
    ],
)
def test_units(spark, units, expected):
    row = typed(to_long(wide(spark, ("13-06-2010", units, "1", "1", "1")))).first()
    assert row["Total_Units_Sold"] == expected


@pytest.mark.parametrize(
    "revenue,kept",
    [("1.5", True), ("Infinity", True), ("NaN", False), ("x", False), (None, False)],
)
def test_rows_with_unusable_revenue_are_dropped(spark, revenue, kept):
    rows = clean(to_long(wide(spark, ("13-06-2010", "1", revenue, "1", "1")))).collect()
    assert ("P1" in {r["product_id"] for r in rows}) == kept


def test_clean_has_the_fixed_columns(spark):
    cleaned = clean(to_long(wide(spark, ("13-06-2010", "1", "1", "1", "1"))))
    assert cleaned.dtypes == [
        ("Date", "date"),
        ("Year", "int"),
        ("Month", "int"),
        ("Day", "int"),
        ("product_id", "string"),
        ("Total_Units_Sold", "int"),
        ("Total_Revenue", "double"),
    ]
    assert dict(narrow_revenue(cleaned).dtypes)["Total_Revenue"] == "float"


def test_narrow_revenue_rounds_to_32_bits(spark):
    cleaned = clean(to_long(wide(spark, ("13-06-2010", "1", "1234567.89", "1", "1"))))
    assert narrow_revenue(cleaned).first()["Total_Revenue"] == 1234567.875


def test_counts_agree_with_what_clean_keeps(spark):
    long = to_long(
        wide(
            spark,
            ("13-06-2010", "1", "1", "2", "2"),
            ("31-09-2010", "1", "1", "2", "2"),
            ("14-06-2010", "x", "1", "2", "NaN"),
            ("15-06-2010", None, None, "2", "Infinity"),
        )
    )
    found = typed(long).agg(*validation_counts()).first().asDict()
    assert found == {
        "rows_in": 8,
        "bad_date": 2,
        "bad_product": 0,
        "bad_units": 2,
        "bad_revenue": 2,
        "rows_out": 3,
    }
    assert clean(long).count() == found["rows_out"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_values_do_not_fail_the_job_in_either_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        long = to_long(wide(spark, ("99-99-9999", "x", "y", "3e9", "z")))
        assert clean(long).count() == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
