"""Date spine (calendar generator).

``spark.range`` is a distributed generator: each task produces its own
slice of day offsets, so the spine never materialises as one array on one
task (unlike ``explode(sequence(...))``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import date_key

# Default calendar of the original models; fixtures use a wider one.
DEFAULT_START = "2020-01-01"
DEFAULT_DAYS = 3650


def date_spine(spark: SparkSession, start: str = DEFAULT_START, days: int = DEFAULT_DAYS) -> DataFrame:
    """``days`` consecutive dates from ``start`` as column ``date_day`` (DATE)."""
    dt.date.fromisoformat(start)  # validate early, on the driver
    return spark.range(0, days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))


def covering_spine(dates: list[DataFrame]) -> DataFrame:
    """The whole calendar years that cover every date of ``dates`` as ``date_day``, without a job of its own.

    Each frame has one date/timestamp column. A min/max aggregate over all of them is one
    row of the plan, and the days are generated from it; no dates, no days. For
    declared windows use ``date_spine``.
    """
    days = [df.select(F.to_date(df.columns[0]).alias("d")) for df in dates]
    union = days[0]
    for df in days[1:]:
        union = union.unionByName(df)
    first = F.make_date(F.year(F.min("d")), F.lit(1), F.lit(1))
    last = F.make_date(F.year(F.max("d")), F.lit(12), F.lit(31))
    return (union.agg(first.alias("first"), last.alias("last"))
            .select(F.explode(F.sequence("first", "last")).alias("date_day")))


def dim_date(spark: SparkSession, start: str = DEFAULT_START, days: int = DEFAULT_DAYS) -> DataFrame:
    return calendar_of(date_spine(spark, start, days))


def calendar_of(spine: DataFrame) -> DataFrame:
    """Calendar attributes of every ``date_day``."""
    d = F.col("date_day")
    return spine.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.dayname(d).alias("day_of_week"),
        F.quarter(d).alias("quarter"),
    )
