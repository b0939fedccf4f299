"""Scalar column helpers: surrogate keys, date keys, safe ratios.

All of them compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen and never cross into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(c) -> Column:
    """Hex MD5 of the natural key rendered as text; NULL stays NULL."""
    return F.md5(_col(c).cast("string"))


def date_key(ts) -> Column:
    """yyyyMMdd integer of the calendar day of ``ts`` (session time zone, pinned UTC).

    Integer arithmetic on the date parts instead of formatting a string per row.
    """
    d = F.to_date(_col(ts))
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI division by zero would raise)."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def days_between(start, end) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (2-argument datediff)."""
    return F.datediff(_col(end), _col(start))


def null_as(type_name: str) -> Column:
    """A typed NULL column, used to align both sides of a union."""
    return F.lit(None).cast(type_name)
