"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_date, date_key


def dim_date(
    spark: SparkSession,
    as_of: Column | dt.date | str | None = None,
    back_years: int = 25,
    forward_years: int = 25,
) -> DataFrame:
    """Every day from ``back_years`` before ``as_of`` to ``forward_years`` after it, inclusive."""
    today = as_date(as_of)
    first, last = F.add_months(today, -12 * back_years), F.add_months(today, 12 * forward_years)
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    day = F.col("date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.quarter(day).alias("quarter"),
    )
