import math
import struct
from datetime import date, timedelta
from decimal import Decimal

import hashlib
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystar.functions.dates import month_start, year_month
from tallystar.functions.fingerprint import table_fingerprint, text_hash
from tallystar.functions.labels import product_label
from tallystar.functions.numbers import exact_avg, exact_sum
from tallystar.plans.catalogue import content_copies
from tallystar.session import scratch_folder, shuffle_partitions

few = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def total(spark, values, scale=2):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_sum(F.col("v"), scale).alias("s")).first()["s"]


@few
@given(st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=60))
def test_exact_sum_is_the_decimal_sum(spark, cents):
    values = [c / 100 for c in cents]
    expected = sum(Decimal(c) for c in cents) / 100
    assert total(spark, values) == float(expected)


def test_exact_sum_does_not_depend_on_the_order(spark):
    values = [0.1, 1e9 + 0.01, -1e9, 0.2, 0.3] * 100
    assert total(spark, values) == total(spark, values[::-1]) == total(spark, sorted(values))


@pytest.mark.parametrize(
    "values,expected",
    [
        ([], None),
        ([None, None], None),
        ([None, 1.5], 1.5),
        ([-0.01, -0.02], -0.03),
        ([1.25, math.inf], math.inf),
        ([math.inf], math.inf),
        ([1e300, 0.5], 1e300),
        ([9e13, 9e13], 1.8e14),
    ],
)
def test_exact_sum_edges(spark, values, expected):
    assert total(spark, values) == expected


@pytest.mark.parametrize(
    "value, rows, expected",
    [(0.004, 1000, 4.0), (0.0001, 3, 0.0003), (12.3456, 1000, 12345.6), (9e13, 1000, 9e16)],
)
def test_exact_sum_keeps_finer_values(spark, value, rows, expected):
    df = spark.range(rows).select(F.lit(value).alias("v"))
    assert df.agg(exact_sum(F.col("v"))).first()[0] == expected


def test_exact_sum_of_mixed_scales(spark):
    df = spark.createDataFrame([(0.01,), (0.004,), (2.5e9 + 0.125,)], "v double")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 2.5e9 + 0.139


def test_exact_sum_has_room_for_many_large_values(spark):
    # A lane takes 2**17 at most from each value, so a long holds 2**44 of them.
    df = spark.range(1).select(F.lit(float(2**53 // 100 - 1)).alias("v"))
    lanes = df.select((F.rint(F.col("v") * 100.0).cast("bigint")).alias("m"))
    top = lanes.select(F.shiftright("m", 36)).first()[0]
    assert 0 < top < 2**17


def test_exact_sum_of_nan_is_nan(spark):
    assert math.isnan(total(spark, [1.0, math.nan]))


def test_exact_sum_of_more_than_a_long_of_cents(spark):
    df = spark.range(4000).select(F.lit(5e13).alias("v"))
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 2e17


def test_exact_sum_scale(spark):
    assert total(spark, [0.125] * 3, scale=3) == 0.375


def test_average_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.agg(exact_avg(F.col("v"))).first()[0] == 1.5


@pytest.mark.parametrize(
    "key,width,label",
    [("P1", None, "Product 1"), ("P10", None, "Product 10"), ("P10", 1, "Product 1")],
)
def test_labels(spark, key, width, label):
    df = spark.range(1).select(product_label(F.lit(key), width).alias("l"))
    assert df.first()["l"] == label


def test_months(spark):
    df = spark.createDataFrame([(date(2011, 12, 31),)], "d date")
    row = df.select(month_start(F.col("d")), year_month(F.col("d"))).first()
    assert tuple(row) == (date(2011, 12, 1), 201112)


def fingerprint(df):
    return df.agg(table_fingerprint(df.columns).alias("f")).first()["f"]


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("s"))
    shuffled = df.orderBy(F.desc("id")).repartition(7)
    assert fingerprint(df) == fingerprint(shuffled) == fingerprint(df.coalesce(1))


def test_fingerprint_sees_changes_and_copies(spark):
    df = spark.range(100).select("id", F.lit("a").alias("s"))
    others = [
        df.where("id <> 7"),
        df.union(df.where("id = 7")),
        df.union(df),
        df.withColumn("s", F.when(F.col("id") == 7, "b").otherwise(F.col("s"))),
        df.withColumn("id", F.col("id") + 1),
        df.limit(0),
    ]
    assert len({fingerprint(d) for d in [df, *others]}) == len(others) + 1


def test_content_copies_read_every_column_of_every_row(spark):
    day = date(2020, 1, 2)
    row = (day, 2020, 1, 2, "P1", 5, 1.5)
    other = (day + timedelta(1), 2021, 2, 3, "P2", 6, 1.25)
    groups = [[row] * 3, [row] * 3, [row] * 2]
    groups += [[row, row, row[:i] + other[i : i + 1] + row[i + 1 :]] for i in range(len(row))]
    rows = [(k, *r) for k, group in enumerate(groups) for r in group]
    schema = "k int, Date date, Year int, Month int, Day int, product_id string, Total_Units_Sold int, Total_Revenue double"
    copies = content_copies(spark.createDataFrame(rows, schema), ["k"])
    assert sorted(map(tuple, copies.collect())) == [(1, 8), (2, 1)]


def test_fingerprint_of_a_kept_part_is_that_of_the_part(spark):
    df = spark.range(100).select("id")
    kept = df.agg(table_fingerprint(["id"], keep=F.col("id") < 10)).first()[0]
    assert kept == fingerprint(df.where("id < 10"))


@few
@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.text(max_size=40)), max_size=30))
def test_fingerprint_by_brute_force(spark, rows):
    lanes = [0] * 6
    for number, text in rows:
        for seed in (0, 1):
            h = xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42)
            h = xxhash.xxh64_intdigest(struct.pack("<q", number), seed=h)
            h = xxhash.xxh64_intdigest(text.encode(), seed=h)
            for lane in range(3):
                lanes[seed * 3 + lane] += (h >> (21 * lane)) & (2**21 - 1)
    expected = hashlib.md5(",".join(map(str, [len(rows), *lanes])).encode()).hexdigest()
    df = spark.createDataFrame(rows, "n bigint, t string")
    assert fingerprint(df) == expected


@pytest.mark.parametrize("text", ["", "abc", "naïve ☃", "x" * 100_000])
def test_text_hash_is_md5_of_the_whole_text(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    expected = hashlib.md5(text.encode()).hexdigest()
    assert df.select(text_hash(F.col("t"))).first()[0] == expected


def test_shuffle_partitions_come_in_waves():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 << 40, 8000) % 8000 == 0
    assert (10 << 40) / shuffle_partitions(10 << 40, 8000) <= 128 << 20


def test_scratch_is_below_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second
    if base:
        assert first.startswith(base)
