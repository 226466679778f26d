"""Which files and which contents are new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose name is not in the ledger."""
    return files.join(ledger.select("filename").distinct(), "filename", "left_anti")


def known_content(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content hash was loaded before, under whatever name."""
    return files.join(ledger.select("content_hash").distinct(), "content_hash", "left_semi")


def new_content(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content hash was not loaded before."""
    return files.join(ledger.select("content_hash").distinct(), "content_hash", "left_anti")


def first_of_each_content(files: DataFrame, *order: str) -> DataFrame:
    """Per content the first file in `order`, and how many later copies are skipped.

    Kept as one aggregate: the copies of a content that fills a third of the
    input are combined before the shuffle and never meet in one task.
    """
    first = F.min(F.struct(*order)).alias("first")
    picked = files.groupBy("content_hash").agg(
        first, (F.count(F.lit(1)) - 1).alias("copies_skipped")
    )
    return picked.select("content_hash", "first.*", "copies_skipped")


def latest(files: DataFrame, time: str, name: str) -> DataFrame:
    """The newest file; of equally new ones the last by name."""
    return files.orderBy(F.desc(time), F.desc(name)).limit(1)
