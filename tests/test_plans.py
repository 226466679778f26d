"""What must not appear in a physical plan that has to hold at scale."""

import pytest
from pyspark.sql import functions as F

from tallystar.plans.catalogue import QUERIES
from tallystar.sources import supplied
from tallystar.streaming.ingest import file_profiles

SF_DIR = "/root/testdata/sf0.001"
THROUGH_FILES = {
    "etl_sales_fact",
    "ingest_sales_fact",
    "csv_refused_rows",
    "csv_snapshot_rows",
    "globbed_sales",
    "ledger_months",
    "newest_snapshot_rows",
    "written_manifest",
    "written_marts",
    "year_report_pruned",
    "kept_reports",
}
UNWANTED = [
    "CartesianProduct",
    "NestedLoopJoin",
    "EvalPython",
    "MapInPandas",
    "Window",
    "CollectLimit",
    "collect_list",
    "collect_set",
]
WITHOUT_SHUFFLE = {
    "unpivot_lines",
    "clean_lines",
    "parse_dates",
    "staged_sales",
    "content_hash",
    "page_hash",
    "latest_snapshot",
}


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - THROUGH_FILES))
def test_no_step_that_does_not_scale(spark, name):
    text = plan(spark, name)
    assert not [u for u in UNWANTED if u in text]
    assert ("Exchange" not in text) == (name in WITHOUT_SHUFFLE)


def test_all_rows_meet_in_one_partition_only_as_partial_results(spark):
    """A single partition is fed by partial aggregates or by a top-k, never by rows."""
    for name in sorted(set(QUERIES) - THROUGH_FILES):
        lines = plan(spark, name).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "partial_" in lines[i + 1] or "LocalLimit" in lines[i + 1], name


@pytest.mark.parametrize(
    "name,columns",
    [
        ("monthly_sales_trend_lines", {"l_extendedprice", "l_shipdate"}),
        ("top_products_many", {"l_partkey", "l_quantity"}),
        ("fact_duplicate_keys", {"l_orderkey", "l_partkey"}),
        ("latest_snapshot", {"ts"}),
        ("content_hash", {"doc_id", "text"}),
    ],
)
def test_only_used_columns_are_read(spark, name, columns):
    text = plan(spark, name)
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == columns


def test_filters_reach_the_scan(spark):
    text = plan(spark, "merge_fact_many")
    assert "LessThan(l_shipdate,1999-01-01" in text
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in text


@pytest.mark.parametrize("name", ["content_fingerprint", "accepted_deliveries"])
def test_orders_are_shuffled_as_lines_and_not_as_their_deliveries(spark, name):
    """What is made of an order's lines is added up in their task; contents alone are shuffled then."""
    shuffled = [x for x in plan(spark, name).splitlines() if "Exchange hashpartitioning" in x]
    assert any("(orderkey" in x for x in shuffled)
    assert not [x for x in shuffled if "delivery" in x or "source_time" in x or "key_product" in x]


def test_tasks_of_lines_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(supplied, "LINES_A_TASK", 500)
    lines = supplied.wide_lines(spark, SF_DIR, "orderkey", together="orderkey")
    parts = lines.select("orderkey", F.spark_partition_id().alias("part"))
    assert lines.rdd.getNumPartitions() == -(-lines.count() // 500)
    assert parts.distinct().groupBy("orderkey").count().where("count > 1").count() == 0


def test_profiles_of_dealt_rows_are_those_of_all(spark):
    from tallystar.plans.catalogue import _as_files

    rows = _as_files(spark, SF_DIR)
    dealt, plain = (
        sorted(map(tuple, file_profiles(r, within).collect()))
        for r, within in ((rows, ["orderkey"]), (rows.repartition(3), []))
    )
    assert dealt == plain
