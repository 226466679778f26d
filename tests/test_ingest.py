from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql.types import IntegerType, StructField, StructType

from sales_files import facts, write_file
from tallystar.plans.etl import reload_latest, run_etl
from tallystar.plans.load import SKIPPED
from tallystar.schemas import CLEAN
from tallystar.sinks.snapshots import snapshot_name
from tallystar.sources import star_tables as star
from tallystar.streaming import ingest
from tallystar.streaming.ingest import ingest_new_files

A = [("13-06-2010", 1, 1.5, 2, 2.5), ("14-06-2010", 3, 3.5, 4, 4.5)]
B = [("14-06-2010", 30, 30.5, 40, 40.5), ("15-07-2010", 5, 5.5, 6, 6.5)]
AFTER_BOTH = {
    ("2010-06-13", "P1"): (1, 1.5),
    ("2010-06-13", "P2"): (2, 2.5),
    ("2010-06-14", "P1"): (30, 30.5),
    ("2010-06-14", "P2"): (40, 40.5),
    ("2010-07-15", "P1"): (5, 5.5),
    ("2010-07-15", "P2"): (6, 6.5),
}


def run(spark, home, **options):
    ingest_new_files(spark, f"{home}/data", f"{home}/lake", f"{home}/mart", **options)


def fact(spark, home):
    return facts(star.read_fact(spark, f"{home}/mart"))


def ledger(spark, home):
    """Names of the loaded source files; the snapshots made of them are listed as well."""
    rows = star.read_ledger(spark, f"{home}/mart").collect()
    names = [r["filename"].rsplit("/", 1)[1] for r in rows]
    return sorted(n for n in names if not n.startswith("output_"))


def test_three_calls(spark, home):
    write_file(f"{home}/data", "a.csv", A)
    run(spark, home)
    assert len(fact(spark, home)) == 4
    run(spark, home)
    assert ledger(spark, home) == ["a.csv"]
    write_file(f"{home}/data", "b.csv", B)
    write_file(f"{home}/data", "copy of a.csv", A)
    run(spark, home)
    assert fact(spark, home) == AFTER_BOTH
    assert ledger(spark, home) == ["a.csv", "b.csv"]


@pytest.mark.parametrize("max_files", [1, 10])
def test_the_newest_file_wins_however_files_are_batched(spark, home, max_files):
    write_file(f"{home}/data", "z_old.csv", A, modified=1_600_000_000)
    write_file(f"{home}/data", "a_new.csv", B, modified=1_600_000_100)
    run(spark, home, max_files=max_files)
    assert fact(spark, home) == AFTER_BOTH
    assert ledger(spark, home) == ["a_new.csv", "z_old.csv"]


def test_a_file_with_an_old_time_stamp_is_not_ignored(spark, home):
    write_file(f"{home}/data", "a.csv", A)
    run(spark, home)
    write_file(f"{home}/data", "late.csv", B[1:], modified=1_600_000_000)
    run(spark, home)
    assert ledger(spark, home) == ["a.csv", "late.csv"]


def test_copies_within_a_batch_are_loaded_once(spark, home):
    for i in range(5):
        write_file(f"{home}/data", f"{i}.csv", A, modified=1_600_000_000 + i)
    run(spark, home)
    assert ledger(spark, home) == ["0.csv"]
    assert len(fact(spark, home)) == 4


@pytest.mark.parametrize("others", [[], [B]])
def test_a_file_with_duplicate_keys_is_left_out(spark, home, others):
    write_file(f"{home}/data", "a.csv", [A[0], A[0]])
    for i, rows in enumerate(others):
        write_file(f"{home}/data", f"{i}.csv", rows)
    run(spark, home)
    assert ledger(spark, home) == [f"{i}.csv" for i in range(len(others))]
    assert star.read_rejected(spark, f"{home}/mart").first()["reason"].startswith("not unique")


@pytest.mark.parametrize("before_commit", [True, False])
def test_a_batch_that_dies_is_replayed_without_harm(spark, home, monkeypatch, before_commit):
    write_file(f"{home}/data", "a.csv", A)
    real = ingest.load_rows

    def dies(*args):
        if not before_commit:
            real(*args)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "load_rows", dies)
        with pytest.raises(Exception, match="lost"):
            run(spark, home)
    run(spark, home)
    assert ledger(spark, home) == ["a.csv"]
    assert len(fact(spark, home)) == 4


def test_the_snapshot_of_a_batch_counts_as_loaded(spark, home):
    write_file(f"{home}/data", "a.csv", A)
    run(spark, home)
    assert reload_latest(spark, f"{home}/lake", f"{home}/mart") == SKIPPED


def test_a_replay_within_the_same_second_does_not_clash(spark, home, monkeypatch):
    write_file(f"{home}/data", "a.csv", A)
    noon = datetime(2024, 1, 1, 12)
    monkeypatch.setattr(
        ingest, "snapshot_name", lambda suffix: snapshot_name("parquet", noon, suffix)
    )

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "load_rows", dies)
        with pytest.raises(Exception, match="lost"):
            run(spark, home)
    run(spark, home)
    assert ledger(spark, home) == ["a.csv"]


def test_content_that_the_batch_job_loaded_is_skipped(spark, home):
    path = write_file(f"{home}/data", "a.csv", A)
    run_etl(spark, path, f"{home}/lake", f"{home}/mart")
    before = star.read_ledger(spark, f"{home}/mart").count()
    run(spark, home)
    assert star.read_ledger(spark, f"{home}/mart").count() == before


def test_files_outside_the_glob_are_left_alone(spark, home):
    write_file(f"{home}/data", "a.csv", A)
    write_file(f"{home}/data", "notes.txt", B, header="free text\n")
    run(spark, home, glob="*.csv")
    assert ledger(spark, home) == ["a.csv"]


def test_an_empty_file_does_not_disturb_a_batch(spark, home):
    write_file(f"{home}/data", "a.csv", A, modified=1_600_000_000)
    write_file(f"{home}/data", "b.csv", [], modified=1_600_000_001)
    write_file(f"{home}/data", "c.csv", [("junk", 1, 1, 1, 1)], modified=1_600_000_002)
    run(spark, home)
    assert len(fact(spark, home)) == 4


def test_rows_are_combined_before_each_shuffle_to_the_newest(spark):
    rows = spark.createDataFrame(
        [(date(2010, 1, 1), 2010, 1, 1, "P1", u, float(u), u) for u in (3, 1, 2)],
        StructType([*CLEAN.fields, StructField(ingest.RANK, IntegerType())]),
    )
    newest = ingest.newest_per_key(rows)
    lines = newest._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hash" in line]
    assert len(below) == 2 and all("HashAggregate" in line for line in below)
    assert all("partial_" in line for line in below)
    assert [tuple(r)[-2:] for r in newest.collect()] == [(3, 3.0)]


GROWING = [
    ("1.csv", "Date,Q-P1,S-P1\n13-06-2010,1,1.5\n"),
    ("2 é.csv", "S-P2,Date,Q-P2,Q-P1,S-P1\n2.5,14-06-2010,2,3,3.5\n"),
    ("3.csv", "Date,Q-P1,S-P1\n15-06-2010,4,4.5\n"),
]
GROWN = {
    ("2010-06-13", "P1"): (1, 1.5),
    ("2010-06-14", "P1"): (3, 3.5),
    ("2010-06-14", "P2"): (2, 2.5),
    ("2010-06-15", "P1"): (4, 4.5),
}


def put(home, name, text):
    folder = Path(home) / "data"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


@pytest.mark.parametrize("at_once", [True, False])
def test_products_may_come_and_go_between_files(spark, home, at_once):
    for name, text in GROWING:
        put(home, name, text)
        if not at_once:
            run(spark, home)
    run(spark, home)
    assert fact(spark, home) == GROWN
    assert star.read_rejected(spark, f"{home}/mart").isEmpty()


def test_etl_reads_a_folder_of_different_headers(spark, home):
    for name, text in [*GROWING, ("4.csv", "no,such,columns\n1,2,3\n")]:
        put(home, name, text)
    result = run_etl(spark, f"{home}/data", f"{home}/lake", f"{home}/mart")
    assert fact(spark, home) == GROWN
    assert [r.filename.rsplit("/", 1)[1] for r in result.rejected] == ["4.csv"]


def test_broken_files_are_listed_and_the_others_load(spark, home):
    put(home, "bad.csv", "no,such,columns\n1,2,3\n")
    put(home, "twice.csv", "Date,Q-P1,S-P1\n01-01-2011,1,1.0\n01-01-2011,2,2.0\n")
    for name, text in GROWING:
        put(home, name, text)
    run(spark, home)
    assert fact(spark, home) == GROWN
    listed = star.read_rejected(spark, f"{home}/mart").collect()
    assert {r["filename"].rsplit("/", 1)[1] for r in listed} == {"bad.csv", "twice.csv"}
