"""Times every registered query and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the runs per
query (the fastest counts). A query is timed from building its plan until all of
its rows have gone to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallystar.plans.catalogue import QUERIES
from tallystar.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark_sql_shuffle_partitions=CPUS,
        spark_driver_memory="8g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    times = {
        name: round(min(seconds(spark, query) for _ in range(RUNS)), 3)
        for name, query in QUERIES.items()
        if not only or name in only
    }
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
