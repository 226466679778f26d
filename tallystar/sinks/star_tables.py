"""Writes of the star tables. The layout is described in sources/star_tables.py.

Two loads that run at once from one state would each miss the other's rows. Each takes the next
number of the ledger, which only one can get, so the other fails before anything of it is visible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.dates import year_month
from tallystar.sinks.commits import create_new
from tallystar.sources.star_tables import LEDGER, LEDGER_TIME, REJECTED


class ConcurrentLoad(RuntimeError):
    """Two loads ran at once; the later one has not seen the rows of the other."""


def new_load_id(number: int) -> str:
    """Sorts by the number of the commit; the random end keeps a load apart from its failed try."""
    return f"{number:010d}-{uuid.uuid4().hex[:8]}"


def _commit_file(mart: str, number: int) -> str:
    return f"{mart}/{LEDGER}/{number:010d}.json"


def ensure_star(spark: SparkSession, mart: str) -> None:
    """Creates the ledger if it is missing; with an empty ledger the other tables are empty."""
    create_new(spark, _commit_file(mart, 0), "")


def write_profile(spark: SparkSession, profile: DataFrame, mart: str, load: str) -> DataFrame:
    """What a load found in its source, written once and read by its steps."""
    path = f"{mart}/load_profiles/load={load}"
    profile.write.mode("errorifexists").parquet(path)
    return spark.read.schema(profile.schema).parquet(path)


def write_dim(dim: DataFrame, mart: str, name: str, load: str) -> None:
    dim.write.mode("errorifexists").parquet(f"{mart}/{name}/load={load}")


def write_fact(fact: DataFrame, mart: str, load: str) -> None:
    """The touched months, as evenly sized files sorted by date and product.

    The rebalance brings each month together and cuts a month that is too large
    for one task into several, so neither many tiny files nor one task with a
    third of the rows comes out. The sort is the one a write by month needs
    anyway; the keys after the month help compression and file skipping.
    """
    (
        fact.withColumn("ym", year_month(F.col("date_key")))
        .hint("rebalance", "ym")
        .sortWithinPartitions("ym", "date_key", "product_key")
        .write.mode("errorifexists")
        .partitionBy("ym")
        .parquet(f"{mart}/sales_fact/load={load}")
    )


def commit_load(
    spark: SparkSession,
    mart: str,
    number: int,
    files: Iterable[tuple[str, str]],
    load: str,
    months: dict[int, str],
    dims: dict[str, list[str]],
) -> None:
    """Writes the ledger rows of a load, all in the commit file of its number.

    `files` are (name, content hash); `months` maps each written month to the fingerprint of its
    source rows, `dims` each dimension to its current folders. Both are kept with the first file.
    """
    now = datetime.now(timezone.utc).strftime(LEDGER_TIME)
    first = {
        "months": [{"ym": ym, "source_hash": h} for ym, h in sorted(months.items())],
        "dims": [{"name": n, "load": x} for n, folders in sorted(dims.items()) for x in folders],
    }
    lines = []
    for name, content_hash in files:
        row = {"filename": name, "processed_at": now, "content_hash": content_hash, "load": load}
        lines.append(json.dumps(row | (first if not lines else {"months": [], "dims": []})))
    if not create_new(spark, _commit_file(mart, number), "\n".join(lines) + "\n"):
        raise ConcurrentLoad(f"another load of {mart} was committed meanwhile; run again")


def append_rejected(spark: SparkSession, mart: str, rejected: Iterable) -> None:
    """Lists files that were not loaded, with the reason; a replayed batch lists them again."""
    rows = [(r.filename, r.reason) for r in rejected]
    if rows:
        listed = spark.createDataFrame(rows, "filename string, reason string")
        listed.withColumn("at", F.localtimestamp()).coalesce(1).write.mode("append").parquet(
            f"{mart}/{REJECTED}"
        )
