import os
from datetime import datetime

import pytest

from sales_files import facts, write_file
from tallystar.plans import etl
from tallystar.plans.etl import reload_latest, run_etl
from tallystar.plans.load import LOADED, SKIPPED
from tallystar.sinks.snapshots import snapshot_name
from tallystar.sources import star_tables as star
from tallystar.sources.snapshots import (
    CORRUPT,
    latest_snapshot,
    list_files,
    list_snapshots,
    read_snapshot,
    read_staging,
    refused_rows,
    staging_rejects,
)
from tallystar.sources.wide_files import read_folder

ROWS = [
    ("13-06-2010", 5422, 17187.74, 3725, 23616.5),
    ("14-06-2010", "7.9", 10.25, 1, 2.5),
    ("31-09-2010", 1, 1.0, 1, 1.0),
    ("15-06-2010", "", 1.0, 4, "NaN"),
]
EXPECTED = {
    ("2010-06-13", "P1"): (5422, 17187.74),
    ("2010-06-13", "P2"): (3725, 23616.5),
    ("2010-06-14", "P1"): (7, 10.25),
    ("2010-06-14", "P2"): (1, 2.5),
}


@pytest.fixture(autouse=True)
def distinct_names(monkeypatch):
    """Names that sort in the order of the runs, also within one second."""
    numbers = iter(range(1000))
    monkeypatch.setattr(
        etl, "snapshot_name", lambda fmt, suffix: snapshot_name(fmt, suffix=f"_{next(numbers)}")
    )


def run(spark, home, name, **options):
    return run_etl(spark, f"{home}/data/{name}", f"{home}/lake", f"{home}/mart", **options)


def fact(spark, home):
    return facts(star.read_fact(spark, f"{home}/mart"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_one_run(spark, home, fmt):
    write_file(f"{home}/data", "a.csv", ROWS)
    result = run(spark, home, "a.csv", fmt=fmt)
    assert (result.status, result.new_content) == (LOADED, True)
    assert result.counts == {
        "rows_in": 8,
        "bad_date": 2,
        "bad_product": 0,
        "bad_units": 1,
        "bad_revenue": 1,
        "rows_out": 4,
    }
    assert fact(spark, home) == EXPECTED
    entry = star.read_manifest(spark, f"{home}/lake").first()
    assert entry["record_count"] == 4 and entry["pipeline_version"] == "1.0"
    assert (str(entry["min_date"]), str(entry["max_date"])) == ("2010-06-13", "2010-06-14")
    ledger = star.read_ledger(spark, f"{home}/mart").first()
    assert ledger["filename"] == result.snapshot == entry["snapshot"]
    assert ledger["content_hash"] == entry["content_hash"]
    assert isinstance(ledger["processed_at"], datetime)


def test_the_same_file_again_is_skipped(spark, home):
    write_file(f"{home}/data", "a.csv", ROWS)
    first = run(spark, home, "a.csv")
    again = run(spark, home, "a.csv")
    assert (again.status, again.new_content, again.snapshot) == (SKIPPED, False, first.snapshot)
    assert star.read_ledger(spark, f"{home}/mart").count() == 1
    assert list_snapshots(spark, f"{home}/lake").count() == 1


def test_the_same_content_under_another_name_is_skipped(spark, home):
    write_file(f"{home}/data", "a.csv", ROWS)
    write_file(f"{home}/data", "b.csv", ROWS[::-1])
    run(spark, home, "a.csv")
    assert run(spark, home, "b.csv").status == SKIPPED


def test_a_changed_file_replaces_figures_instead_of_adding(spark, home):
    write_file(f"{home}/data", "a.csv", ROWS)
    write_file(f"{home}/data", "b.csv", [("13-06-2010", 1, 1.5, 2, 2.5)])
    run(spark, home, "a.csv")
    assert run(spark, home, "b.csv").status == LOADED
    changed = {("2010-06-13", "P1"): (1, 1.5), ("2010-06-13", "P2"): (2, 2.5)}
    assert fact(spark, home) == {**EXPECTED, **changed}


def test_a_run_that_died_after_its_snapshot_is_resumed(spark, home, monkeypatch):
    write_file(f"{home}/data", "a.csv", ROWS)

    def dies(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(etl, "load_star", dies)
        with pytest.raises(OSError):
            run(spark, home, "a.csv")
    result = run(spark, home, "a.csv")
    assert (result.status, result.new_content) == (LOADED, False)
    assert fact(spark, home) == EXPECTED
    assert list_snapshots(spark, f"{home}/lake").count() == 1


def test_duplicate_keys_in_a_file_fail_the_run(spark, home):
    write_file(f"{home}/data", "a.csv", [ROWS[0], ROWS[0]])
    with pytest.raises(ValueError, match="not unique"):
        run(spark, home, "a.csv")
    assert fact(spark, home) == {}


def test_extra_date_formats(spark, home):
    write_file(f"{home}/data", "a.csv", [("1-6-2010", 1, 1.0, 2, 2.0)])
    result = run(spark, home, "a.csv", extra_formats=["d-M-yyyy"])
    assert result.counts["bad_date"] == 0
    assert set(fact(spark, home)) == {("2010-06-01", "P1"), ("2010-06-01", "P2")}


def test_a_folder_of_files_is_one_load(spark, home):
    write_file(f"{home}/data/in", "a.csv", ROWS[:1])
    write_file(f"{home}/data/in", "b.csv", ROWS[1:])
    run(spark, home, "in")
    assert fact(spark, home) == EXPECTED


def test_a_file_with_another_column_order_is_read_by_its_own(spark, home):
    write_file(f"{home}/data/in", "a.csv", ROWS[:1])
    swapped = [(d, r1, u1, u2, r2) for d, u1, r1, u2, r2 in ROWS[1:]]
    write_file(f"{home}/data/in", "b.csv", swapped, header=",Date,S-P1,Q-P1,Q-P2,S-P2\n")
    run(spark, home, "in")
    assert fact(spark, home) == EXPECTED


def test_other_columns_are_not_read(spark, home):
    path = write_file(f"{home}/data", "a.csv", ROWS)
    df, rejected = read_folder(spark, path, None, lambda wide: wide)
    assert df.columns[:5] == ["Date", "Q-P1", "S-P1", "Q-P2", "S-P2"] and not rejected
    assert "_c0" not in df._jdf.queryExecution().executedPlan().toString()


def test_reload_latest(spark, home):
    assert not os.path.exists(f"{home}/lake")
    write_file(f"{home}/data", "a.csv", ROWS)
    write_file(f"{home}/data", "b.csv", [("13-06-2011", 1, 1.5, 2, 2.5)])
    run(spark, home, "a.csv")
    newest = run(spark, home, "b.csv")
    assert latest_snapshot(spark, f"{home}/lake") == newest.snapshot
    assert reload_latest(spark, f"{home}/lake", f"{home}/mart") == SKIPPED
    other = f"{home}/other_mart"
    assert reload_latest(spark, f"{home}/lake", other) == LOADED
    assert set(facts(star.read_fact(spark, other))) == {
        ("2011-06-13", "P1"),
        ("2011-06-13", "P2"),
    }


def test_a_half_written_snapshot_is_not_the_latest(spark, home, monkeypatch):
    write_file(f"{home}/data", "a.csv", ROWS)
    write_file(f"{home}/data", "b.csv", [("13-06-2011", 1, 1.5, 2, 2.5)])
    first = run(spark, home, "a.csv")

    def dies(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(etl, "append_manifest", dies)
        with pytest.raises(OSError):
            run(spark, home, "b.csv")
    assert list_snapshots(spark, f"{home}/lake").count() == 2
    assert latest_snapshot(spark, f"{home}/lake") == first.snapshot


def test_a_single_file_put_into_the_lake_is_a_snapshot(spark, home):
    folder = f"{home}/lake/processed_data"
    os.makedirs(folder)
    with open(f"{folder}/output_20240101_000000.csv", "w") as out:
        out.write(STAGED + "2010-06-13,2010,6,13,P1,5,2.5\n")
    assert reload_latest(spark, f"{home}/lake", f"{home}/mart") == LOADED
    assert fact(spark, home) == {("2010-06-13", "P1"): (5, 2.5)}
    assert reload_latest(spark, f"{home}/lake", f"{home}/mart") == SKIPPED


def test_listing_reads_no_content(spark, home):
    write_file(f"{home}/data", "a.csv", ROWS)
    write_file(f"{home}/data/sub", "b.txt", ROWS)
    assert list_files(spark, f"{home}/data").count() == 2
    only = list_files(spark, f"{home}/data", "*.csv")
    assert [r["path"].rsplit("/", 1)[1] for r in only.collect()] == ["a.csv"]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]


STAGED = "date_str,year,month,day,product_key,total_units_sold,total_revenue\n"


def staged_file(home, *lines):
    os.makedirs(f"{home}/lake", exist_ok=True)
    with open(f"{home}/lake/s.csv", "w") as out:
        out.write(STAGED + "".join(f"{line}\n" for line in lines))
    return f"{home}/lake/s.csv"


def test_staging_is_read_by_position_with_quotes(spark, home):
    path = staged_file(home, '"2010-06-13",2010.0,6.0,13.0,"P1",5.9,2.5')
    assert [str(v) for v in read_snapshot(spark, path, "csv").first()] == [
        "2010-06-13", "2010", "6", "13", "P1", "6", "2.5",
    ]


def test_unreadable_staging_rows_are_counted_and_stop_the_load(spark, home):
    path = staged_file(
        home,
        "2010-06-13,2010,6,13,P1,5,2.5",
        "13-06-2010,2010,6,13,P1,5,2.5",
        "2010-06-14,2010,6,14,P1,many,2.5",
        "2010-06-15,2010",
    )
    staged = read_staging(spark, path)
    assert staging_rejects(staged).first().asDict() == {
        "rows_in": 4,
        "corrupt": 1,
        "unreadable": 2,
    }
    assert [r[CORRUPT] for r in staged.collect() if r[CORRUPT]] == ["2010-06-15,2010"]
    refused = {r["date_str"]: r["reason"] for r in refused_rows(staged).collect()}
    assert refused == {
        "13-06-2010": "unreadable: date_str",
        "2010-06-14": "unreadable: total_units_sold",
        "2010-06-15": "wrong width",
    }
    with pytest.raises(ValueError, match="cannot be read.*'reason': "):
        etl.load_star(spark, "s.csv", f"{home}/lake", f"{home}/mart", fmt="csv")
    assert star.read_ledger(spark, f"{home}/mart").count() == 0


@pytest.mark.parametrize("rows", [[], [("junk", 1, 1.0, 2, 2.0)]])
def test_a_file_without_usable_rows_is_loaded_as_empty(spark, home, rows):
    write_file(f"{home}/data", "a.csv", rows)
    result = run(spark, home, "a.csv")
    assert (result.status, result.counts["rows_out"]) == (LOADED, 0)
    assert fact(spark, home) == {}
    assert star.read_manifest(spark, f"{home}/lake").first()["min_date"] is None
    write_file(f"{home}/data", "b.csv", ROWS)
    run(spark, home, "b.csv")
    assert fact(spark, home) == EXPECTED


def test_a_short_row_is_counted_and_dropped(spark, home):
    write_file(f"{home}/data", "a.csv", [ROWS[0], ("14-06-2010", 4)])
    result = run(spark, home, "a.csv")
    assert (result.counts["rows_in"], result.counts["rows_out"]) == (4, 2)
    assert result.counts["bad_revenue"] == 2
