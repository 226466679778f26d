"""Runs registered queries in Spark and their SQL in DuckDB and compares every value."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def oracle_rows(con, sql):
    cur = con.execute(sql)
    return _rows([d[0] for d in cur.description], cur.fetchall())


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def differences(spark, con, sf_dir, query, sql) -> str | None:
    names, got = spark_rows(query(spark, sf_dir))
    want_names, want = oracle_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    pairs = zip(got, want)
    wrong = [(g, w) for g, w in pairs if g != w or [*map(type, g)] != [*map(type, w)]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from tallystar.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", spark_sql_shuffle_partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        if name not in sqls:
            result = f"rows only: {query(spark, sf_dir).count()}"
        else:
            result = differences(spark, con, sf_dir, query, sqls[name])
            n = len(oracle_rows(con, sqls[name])[1])
            result = f"ok {n} rows" if result is None else f"DIFFERENT {result}"
        print(f"{name:32} {time.time() - start:6.2f}s {result}", flush=True)


if __name__ == "__main__":
    main()
