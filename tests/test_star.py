from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sales_files import facts
from tallystar.operators.checks import (
    DuplicateKeys,
    duplicate_keys,
    integrity,
    orphan_keys,
    orphans,
    require_unique,
)
from tallystar.operators.dimensions import product_dim
from tallystar.operators.merge import BROADCAST_BYTES, merge
from tallystar.plans.analysis import marts, write_marts
from tallystar.plans.catalogue import QUERIES
from tallystar.plans.load import (
    LOADED,
    SKIPPED,
    ConcurrentLoad,
    load_rows,
    load_star,
    only_months,
)
from tallystar.schemas import CLEAN, FACT_KEYS, SALES_FACT
from tallystar.sinks import star_tables as sink
from tallystar.sinks.snapshots import write_snapshot
from tallystar.sources import star_tables as star

few = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ROWS = st.dictionaries(
    st.tuples(st.dates(date(2010, 1, 1), date(2010, 3, 31)), st.sampled_from(["P1", "P2"])),
    st.tuples(st.integers(0, 100), st.integers(0, 1000).map(float)),
    max_size=12,
)


def fact(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SALES_FACT)


def cleaned(spark, rows):
    return spark.createDataFrame(
        [(d, d.year, d.month, d.day, p, u, float(r)) for (d, p), (u, r) in rows.items()], CLEAN
    )


def as_dict(df):
    return {(r[0], r[1]): (r[2], r[3]) for r in df.collect()}


@pytest.fixture(params=[None, 0, BROADCAST_BYTES + 1])
def key_bytes(request):
    """Unknown, small and large sources take different plans."""
    return request.param


@few
@given(ROWS, ROWS)
def test_merge_is_a_dict_update_and_idempotent(spark, key_bytes, old, new):
    target, source = fact(spark, old), fact(spark, new)
    once = merge(target, source, FACT_KEYS, key_bytes)
    assert once.columns == target.columns
    assert as_dict(once) == {**old, **new}
    assert once.count() == len({**old, **new})
    assert as_dict(merge(once, source, FACT_KEYS, key_bytes)) == {**old, **new}


def test_merge_takes_null_values_from_the_source(spark, key_bytes):
    target = fact(spark, {(date(2010, 1, 1), "P1"): (1, 1.0)})
    source = fact(spark, {(date(2010, 1, 1), "P1"): (None, 2.0)})
    merged = merge(target, source, FACT_KEYS, key_bytes)
    assert as_dict(merged) == {(date(2010, 1, 1), "P1"): (None, 2.0)}


def test_a_key_that_the_target_repeats_is_one_row_afterwards(spark, key_bytes):
    day = date(2010, 1, 1)
    target = spark.createDataFrame(
        [(day, "P1", 1, 1.0), (day, "P1", 2, 2.0), (day, "P2", 3, 3.0)], SALES_FACT
    )
    merged = merge(target, fact(spark, {(day, "P1"): (9, 9.0)}), FACT_KEYS, key_bytes)
    assert sorted(tuple(r) for r in merged.collect()) == [(day, "P1", 9, 9.0), (day, "P2", 3, 3.0)]


def test_null_keys_match_nothing(spark, key_bytes):
    both = spark.createDataFrame([(None, "P1", 1, 1.0)], SALES_FACT)
    assert merge(both, both, FACT_KEYS, key_bytes).count() == 2


def test_only_keys_that_were_counted_small_are_broadcast(spark, home):
    """Highly compressible keys must not be broadcast for the size of their file."""
    rows = spark.range(300_000).select(
        F.lit(date(2010, 1, 1)).alias("date_key"),
        F.concat(F.lit("P"), F.col("id")).alias("product_key"),
        F.lit(1).alias("total_units_sold"),
        F.lit(1.0).alias("total_revenue"),
    )
    rows.write.parquet(f"{home}/rows")
    stored = spark.read.schema(SALES_FACT).parquet(f"{home}/rows")

    def plan(key_bytes):
        merged = merge(stored, stored, FACT_KEYS, key_bytes)
        return merged._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(1000)
    assert "Broadcast" not in plan(BROADCAST_BYTES + 1)
    assert "Broadcast" not in plan(None)


def test_of_large_keys_only_their_days_are_broadcast(spark, monkeypatch):
    old = fact(spark, {(date(2010, 1, d), f"P{p}"): (1, 1.0) for d in (1, 2) for p in range(9)})
    repeated_or_null = [(date(2010, 1, 2), "P1", 5, 5.0), (None, "P1", 6, 6.0)]
    target = old.unionByName(spark.createDataFrame(repeated_or_null, SALES_FACT))
    new = {(date(2010, 1, d), f"P{p}"): (2, 2.0) for d in (2, 3) for p in range(1, 5)}
    source = fact(spark, new).unionByName(spark.createDataFrame([(None, "P1", 7, 7.0)], SALES_FACT))
    parted = merge(target, source, FACT_KEYS, BROADCAST_BYTES + 1, 1)
    whole = merge(target, source, FACT_KEYS, BROADCAST_BYTES + 1)
    assert sorted(map(str, parted.collect())) == sorted(map(str, whole.collect()))

    # The query counts its keys: beyond the bound they meet by sorting, their days are broadcast.
    monkeypatch.setattr("tallystar.operators.merge.BROADCAST_BYTES", 200_000)
    merged = QUERIES["merge_fact_broadcast"](spark, "/root/testdata/sf0.001")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "BroadcastExchange" in line]
    assert sent and not [line for line in sent if "input[1" in line]
    assert "SortMergeJoin" in plan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "x int, y string")
    assert [tuple(r) for r in duplicate_keys(df, ["x", "y"]).collect()] == [(1, "a", 2)]
    with pytest.raises(DuplicateKeys, match="'x': 1"):
        require_unique(df, ["x", "y"])
    require_unique(df.distinct(), ["x", "y"])


def test_orphans(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "x int, y string")
    dim = spark.createDataFrame([(1, "one")], "x int, name string")
    assert {r["y"] for r in orphans(df, dim, ["x"]).collect()} == {"b", "c"}
    missing = orphan_keys(df.union(df), dim, ["x"])
    assert {tuple(r) for r in missing.collect()} == {(2, 2), (None, 2)}


def test_labels_of_long_product_keys(spark):
    df = spark.createDataFrame([("P10",), ("P1",), ("P10",)], "product_id string")
    found = {tuple(r) for r in product_dim(df).collect()}
    assert found == {("P1", "Product 1"), ("P10", "Product 10")}


def test_a_new_star_is_empty(spark, home):
    sink.ensure_star(spark, home)
    sink.ensure_star(spark, home)
    assert star.read_fact(spark, home).count() == 0
    assert star.read_date_dim(spark, home).count() == 0
    assert star.read_product_dim(spark, home).count() == 0
    assert star.read_ledger(spark, home).count() == 0


JAN, FEB, MAR = date(2010, 1, 31), date(2010, 2, 1), date(2010, 3, 5)


def load(spark, home, rows, name="f"):
    load_rows(spark, cleaned(spark, rows), home, [(name, "h")])


def loads(spark, home):
    return {ym: month.load for ym, month in star.current(spark, home).months.items()}


def test_months_outside_the_source_survive(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0), (FEB, "P1"): (2, 2.0), (MAR, "P1"): (3, 3.0)}, "a")
    load(spark, home, {(FEB, "P1"): (20, 20.0), (FEB, "P2"): (21, 21.0)}, "b")
    assert facts(star.read_fact(spark, home)) == {
        (str(JAN), "P1"): (1, 1.0),
        (str(FEB), "P1"): (20, 20.0),
        (str(FEB), "P2"): (21, 21.0),
        (str(MAR), "P1"): (3, 3.0),
    }
    assert loads(spark, home)[201001] == loads(spark, home)[201003] < loads(spark, home)[201002]


def test_rows_of_a_touched_month_that_are_not_in_the_source_survive(spark, home):
    later = date(2010, 1, 30)
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    load(spark, home, {(later, "P1"): (2, 2.0)}, "b")
    assert set(facts(star.read_fact(spark, home))) == {(str(JAN), "P1"), (str(later), "P1")}


def test_only_months_with_new_rows_are_rewritten(spark, home):
    history = {(JAN, "P1"): (1, 1.0), (FEB, "P1"): (2, 2.0), (MAR, "P1"): (3, 3.0)}
    load(spark, home, history, "a")
    before = loads(spark, home)
    added = {**history, (date(2010, 2, 2), "P1"): (4, 4.0)}
    load(spark, home, added, "b")
    after = loads(spark, home)
    assert {ym for ym in before if before[ym] != after[ym]} == {201002}
    expected = {(str(d), p): v for (d, p), v in added.items()}
    assert facts(star.read_fact(spark, home)) == expected
    load(spark, home, {**added, (JAN, "P2"): (5, 5.0), (MAR, "P2"): (6, 6.0)}, "c")
    assert {ym for ym in after if after[ym] != loads(spark, home)[ym]} == {201001, 201003}


def test_a_month_that_another_load_changed_is_merged_again(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    load(spark, home, {(JAN, "P1"): (9, 9.0), (JAN, "P2"): (2, 2.0)}, "b")
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "c")
    assert facts(star.read_fact(spark, home)) == {
        (str(JAN), "P1"): (1, 1.0),
        (str(JAN), "P2"): (2, 2.0),
    }


def test_a_load_without_news_is_listed_and_changes_nothing(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0), (FEB, "P1"): (2, 2.0)}, "a")
    before = loads(spark, home)
    load(spark, home, {(FEB, "P1"): (2, 2.0)}, "b")
    assert loads(spark, home) == before
    assert len(facts(star.read_fact(spark, home))) == 2
    assert star.read_product_dim(spark, home).count() == 1
    assert star.read_date_dim(spark, home).count() == 2
    assert star.read_ledger(spark, home).count() == 2


@few
@given(st.lists(ROWS, min_size=1, max_size=4))
def test_loads_in_turn_are_dict_updates(spark, tmp_path_factory, batches):
    home = str(tmp_path_factory.mktemp("mart"))
    expected = {}
    for i, rows in enumerate(batches):
        load(spark, home, rows, f"f{i}")
        expected.update({(str(d), p): v for (d, p), v in rows.items()})
    assert facts(star.read_fact(spark, home)) == expected


def test_the_date_range_of_the_months_reaches_the_scan(spark, home):
    cleaned(spark, {(JAN, "P1"): (1, 1.0), (MAR, "P1"): (3, 3.0)}).write.parquet(f"{home}/s")
    some = only_months(spark.read.parquet(f"{home}/s"), [201002, 201003])
    assert [r["Date"] for r in some.collect()] == [MAR]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2010-02-01)" in plan
    assert "LessThanOrEqual(Date,2010-03-31)" in plan


def test_only_wanted_months_are_read(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0), (FEB, "P1"): (2, 2.0)})
    only = star.read_fact(spark, home, [201002, 203001])
    assert facts(only) == {(str(FEB), "P1"): (2, 2.0)}
    assert all("ym=201002" in f for f in only.inputFiles())


def test_dimensions_keep_older_keys(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    load(spark, home, {(FEB, "P2"): (1, 1.0)}, "b")
    assert {tuple(r) for r in star.read_product_dim(spark, home).collect()} == {
        ("P1", "Product 1"),
        ("P2", "Product 2"),
    }
    assert {r["date_key"] for r in star.read_date_dim(spark, home).collect()} == {JAN, FEB}


def test_a_load_with_duplicate_keys_changes_nothing(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    rows = cleaned(spark, {(JAN, "P1"): (5, 5.0)})
    with pytest.raises(DuplicateKeys):
        load_rows(spark, rows.union(rows), home, [("b", "h")])
    assert facts(star.read_fact(spark, home)) == {(str(JAN), "P1"): (1, 1.0)}
    assert star.read_ledger(spark, home).count() == 1


@pytest.mark.parametrize("step", ["write_dim", "write_fact", "commit_load"])
def test_a_load_that_dies_is_invisible_and_can_be_repeated(spark, home, monkeypatch, step):
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    lake = f"{home}/lake"
    write_snapshot(cleaned(spark, {(JAN, "P1"): (7, 7.0), (FEB, "P2"): (8, 8.0)}), f"{lake}/s")
    real = getattr(sink, step)

    def dies(*args, **kwargs):
        if step != "commit_load":
            real(*args, **kwargs)
        raise OSError("lost")

    monkeypatch.setattr(sink, step, dies)
    with pytest.raises(OSError):
        load_star(spark, "s", lake, home)
    assert facts(star.read_fact(spark, home)) == {(str(JAN), "P1"): (1, 1.0)}
    assert star.read_product_dim(spark, home).count() == 1
    monkeypatch.undo()
    assert load_star(spark, "s", lake, home) == LOADED
    assert load_star(spark, "s", lake, home) == SKIPPED
    assert facts(star.read_fact(spark, home)) == {
        (str(JAN), "P1"): (7, 7.0),
        (str(FEB), "P2"): (8, 8.0),
    }


def test_a_load_that_another_one_overtook_is_refused(spark, home, monkeypatch):
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    real = sink.write_fact

    def overtaken(*args):
        monkeypatch.undo()
        load(spark, home, {(JAN, "P2"): (2, 2.0)}, "other")
        real(*args)

    monkeypatch.setattr(sink, "write_fact", overtaken)
    with pytest.raises(ConcurrentLoad):
        load(spark, home, {(JAN, "P3"): (3, 3.0)}, "b")
    assert {k[1] for k in facts(star.read_fact(spark, home))} == {"P1", "P2"}
    load(spark, home, {(JAN, "P3"): (3, 3.0)}, "b")
    assert {k[1] for k in facts(star.read_fact(spark, home))} == {"P1", "P2", "P3"}


def test_a_reader_keeps_its_version_during_a_load(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.0)}, "a")
    before = star.read_fact(spark, home)
    load(spark, home, {(JAN, "P1"): (2, 2.0)}, "b")
    assert facts(before) == {(str(JAN), "P1"): (1, 1.0)}


def test_a_hot_month_is_written_as_several_files(spark, home):
    """A third of all rows in one month must not pass through one task."""
    keys = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "400k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    before = {k: spark.conf.get(k) for k in keys}
    day = F.when(F.col("id") % 3 == 0, F.col("id") % 28).otherwise(31 + F.col("id") % 330)
    rows = spark.range(0, 200_000, 1, 8).select(
        F.date_add(F.lit(date(2010, 1, 1)), day.cast("int")).alias("date_key"),
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_key"),
        F.lit(1).alias("total_units_sold"),
        F.rand(1).alias("total_revenue"),
    )
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        sink.write_fact(rows, home, "x")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    written = spark.read.schema(SALES_FACT).parquet(f"{home}/sales_fact/load=x")
    assert written.count() == 200_000
    hot = [f for f in written.inputFiles() if "ym=201001" in f]
    cold = [f for f in written.inputFiles() if "ym=201005" in f]
    assert len(hot) > 2 and len(cold) == 1


def test_marts(spark, home):
    df = fact(
        spark,
        {
            (JAN, "P1"): (1, 1.5),
            (JAN, "P2"): (4, 1.0),
            (FEB, "P1"): (2, 2.0),
            (FEB, "P3"): (4, 1.0),
        },
    )
    found = {name: [tuple(r) for r in m.collect()] for name, m in marts(df).items()}
    assert found == {
        "total_sales_by_product": [("P1", 3.5), ("P2", 1.0), ("P3", 1.0)],
        "monthly_sales_trend": [(date(2010, 1, 1), 2.5), (date(2010, 2, 1), 3.0)],
        "top_products": [("P2", 4), ("P3", 4), ("P1", 3)],
        "avg_revenue": [(1.375,)],
    }
    write_marts(df, home)
    write_marts(df, home)
    stored = spark.read.parquet(f"{home}/total_sales_by_product")
    assert {tuple(r) for r in stored.collect()} == set(found["total_sales_by_product"])


def test_views_and_integrity(spark, home):
    load(spark, home, {(JAN, "P1"): (1, 1.5), (FEB, "P2"): (2, 2.5)})
    star.register_views(spark, home)
    joined = spark.sql(
        "SELECT month, product_name, total_units_sold FROM sales_fact "
        "JOIN date_dim USING (date_key) JOIN product_dim USING (product_key) ORDER BY month"
    )
    assert [tuple(r) for r in joined.collect()] == [(1, "Product 1", 1), (2, "Product 2", 2)]
    assert spark.table("processed_files").count() == 1
    tables = [spark.table(t) for t in ("sales_fact", "date_dim", "product_dim")]
    found = integrity(*tables).collect()
    assert len(found) == 5 and not any(r["rows_affected"] for r in found)
    broken = integrity(tables[0].union(tables[0]), tables[1].limit(0), tables[2])
    assert {r[0]: (r["keys_affected"], r["rows_affected"]) for r in broken.collect()} == {
        "sales_fact primary key": (2, 4),
        "date_dim primary key": (0, 0),
        "product_dim primary key": (0, 0),
        "sales_fact date": (2, 4),
        "sales_fact product": (0, 0),
    }
