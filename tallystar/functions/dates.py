"""Date parsing, date parts and month buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystar.schemas import DATE_FORMAT, STAGING_DATE_FORMAT


def parse_date(text: Column, extra_formats: Sequence[str] = ()) -> Column:
    """Text to DATE. Text that fits no format gives null instead of failing the job."""
    tries = [F.try_to_date(text, fmt) for fmt in (DATE_FORMAT, *extra_formats)]
    return F.coalesce(*tries) if extra_formats else tries[0]


def parse_staging_date(text: Column) -> Column:
    return F.try_to_date(text, STAGING_DATE_FORMAT)


def date_parts(date: Column) -> list[Column]:
    return [
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
    ]


def month_start(date: Column) -> Column:
    """First day of the month, still a DATE, so no session time zone is involved."""
    return F.trunc(date, "month")


def year_month(date: Column) -> Column:
    """The month as the int yyyyMM that partitions the fact table."""
    return (F.year(date) * 100 + F.month(date)).cast("int")
