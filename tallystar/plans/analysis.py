"""All reports over one fact table, or over sums kept for each of its months.

Kept sums lie below the mart, written by the first report after a load:

    report_parts/run=<id>/load=<load>/     sums per month and product of the months of a load
    report_parts/markers/<load>.json       which run holds the sums of a load

A month that a load wrote never changes, so neither do its sums. A report adds up those of the
current months, and reads of the fact only the months of loads that have none yet. A marker is
created once, so of two reports at a time one's sums are used, whole.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.operators import reports
from tallystar.sinks.commits import create_new
from tallystar.sources import star_tables as star


def marts(fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "total_sales_by_product": reports.total_sales_by_product(fact),
        "monthly_sales_trend": reports.monthly_sales_trend(fact),
        "top_products": reports.top_products(fact),
        "avg_revenue": reports.avg_revenue(fact),
    }


def write_marts(fact: DataFrame, folder: str) -> None:
    """Each report as a small table under `folder`; the first two feed the charts."""
    write_reports(marts(fact), folder)


def write_reports(found: dict[str, DataFrame], folder: str) -> None:
    for name, report in found.items():
        report.write.mode("overwrite").parquet(f"{folder}/{name}")


def year_report(spark: SparkSession, mart: str, year: int) -> DataFrame:
    """Sales of a year per month and product. The dates choose the months of the fact to read."""
    at = star.current(spark, mart)
    dates = star.read_date_dim(spark, mart, at).where(F.col("year") == year)
    fact = star.read_fact(spark, mart, at=at, with_month=True)
    return reports.monthly_by_product(fact, dates, star.read_product_dim(spark, mart, at))


def _kept(spark: SparkSession, mart: str) -> dict[str, str]:
    """The run that holds the sums of each load: at most a row per load that was reported on."""
    reader = spark.read.schema("load string, run string")
    try:
        rows = reader.json(f"{mart}/report_parts/markers").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    return {r["load"]: r["run"] for r in rows}


def kept_parts(spark: SparkSession, mart: str) -> DataFrame | None:
    """Sums per month and product of the whole star; those that are missing are written first."""
    at = star.current(spark, mart)
    if not at.months:
        return None
    loads: dict[str, list[int]] = defaultdict(list)
    for ym, month in at.months.items():
        loads[month.load].append(ym)
    runs = _kept(spark, mart)
    missing = [load for load in loads if load not in runs]
    if missing:
        run = uuid.uuid4().hex
        months = [ym for load in missing for ym in loads[load]]
        of = F.create_map(*[F.lit(x) for ym in months for x in (ym, at.months[ym].load)])
        fact = star.read_fact(spark, mart, months, at, with_month=True)
        parts = reports.month_parts(fact.withColumn("load", of[F.col("ym")]), "load")
        parts.write.partitionBy("load").parquet(f"{mart}/report_parts/run={run}")
        for load in missing:
            text = json.dumps({"load": load, "run": run})
            create_new(spark, f"{mart}/report_parts/markers/{load}.json", text)
        runs = _kept(spark, mart)
    paths = [f"{mart}/report_parts/run={runs[load]}/load={load}" for load in sorted(loads)]
    base = f"{mart}/report_parts"
    parts = spark.read.option("basePath", base).parquet(*paths)
    current = F.create_map(*[F.lit(x) for ym, month in at.months.items() for x in (ym, month.load)])
    return parts.where(current[F.col("ym")] == F.col("load").cast("string")).drop("run", "load")


def kept_marts(spark: SparkSession, mart: str) -> dict[str, DataFrame]:
    """The reports on the current star, from kept sums."""
    parts = kept_parts(spark, mart)
    return marts(star.read_fact(spark, mart)) if parts is None else reports.reports_of_parts(parts)


def first_rows(spark: SparkSession, mart: str, n: int = 5) -> DataFrame:
    """The first rows by key; reads only the months that hold them."""
    at, parts = star.current(spark, mart), kept_parts(spark, mart)
    wanted, rows = [], 0
    counted = [] if parts is None else parts.groupBy("ym").agg(F.sum("rows").alias("n")).collect()
    for r in sorted(counted):  # one row per month
        if rows < n:
            wanted.append(r["ym"])
            rows += r["n"]
    return reports.preview(star.read_fact(spark, mart, wanted, at), n)
