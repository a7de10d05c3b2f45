"""Business dates, their keys and the run clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def business_day(c: Column) -> Column:
    """Strict year-month-day text to a date; NULL when it does not parse. One-digit months and days pass."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d"))


def anomesdia(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def partition_prefix(day: Column) -> Column:
    return F.date_format(day, "'year='yyyy'/month='MM'/day='dd")


def date_key(text: Column) -> Column:
    """Date text without its dashes, as the fact tables' day key."""
    return F.regexp_replace(text, "-", "")


def clock_text(ts: Column) -> Column:
    """UTC instant as ISO text with seconds and an explicit +00:00."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
