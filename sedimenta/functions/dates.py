"""Date keys and the calendar dimension columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH_DATE = "1900-01-01"


def date_key(col: Column | str) -> Column:
    """Integer ``YYYYMMDD``."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def order_date(col: str) -> Column:
    """Date of a timestamp; the sentinel date where there is none."""
    return F.coalesce(F.to_date(F.col(col)), F.lit(EPOCH_DATE).cast("date"))


def calendar(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day between two date columns of a one-row frame."""
    day = F.col("full_date")
    weekday = F.weekday(day)
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.when(weekday >= 5, 1).otherwise(0).alias("is_weekend"),
    )
