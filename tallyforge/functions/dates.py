"""Explicit date reading and calendar parts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"
US_SHAPE = r"^\d{2}/\d{2}/\d{4}\z"


def has_date_shape(text: Column) -> Column:
    return text.rlike(ISO_SHAPE) | text.rlike(US_SHAPE)


def explicit_date(text: Column) -> Column:
    """ISO year-month-day or US month/day/year; other layouts and impossible days give NULL."""
    return F.when(text.rlike(ISO_SHAPE), F.try_to_date(text, "yyyy-MM-dd")).when(
        text.rlike(US_SHAPE), F.try_to_date(text, "MM/dd/yyyy")
    )


def in_window(day: Column, start: date, before: date) -> Column:
    """Half-open range on the date itself, so that it can reach a Parquet scan."""
    return (day >= F.lit(start)) & (day < F.lit(before))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
