"""Date columns.

Every function exists as SQL text so that it can also be a stage of a saved
``pyspark.ml`` pipeline (``SQLTransformer``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = {
    "month": "month({d})",
    "day_of_month": "dayofmonth({d})",
    "day_of_week": "weekday({d})",
    "day_of_year": "dayofyear({d})",
}


def as_date_sql(column: str) -> str:
    """``column`` as DATE; text that is no date becomes null."""
    return f"try_to_date(cast({column} as string), 'yyyy-MM-dd')"


def date_part_sql(column: str, part: str) -> str:
    if part not in _PARTS:
        raise ValueError(f"unknown date part {part!r}, expected one of {sorted(_PARTS)}")
    return _PARTS[part].format(d=as_date_sql(column))


def date_part(column: str, part: str) -> Column:
    return F.expr(date_part_sql(column, part))


def date_difference_sql(date: str, other: str) -> str:
    """Whole days between two dates, never negative; 0 where either is missing."""
    d, o = as_date_sql(date), as_date_sql(other)
    return f"coalesce(abs(date_diff({o}, {d})), 0)"


def date_difference(date: str, other: str) -> Column:
    return F.expr(date_difference_sql(date, other))


def rounded_next_date(date: str, days: str) -> Column:
    """Training side: a half day rounds to the even day."""
    return F.date_add(F.col(date), F.bround(F.col(days), 0).cast("int"))


def truncated_next_date(date: str, days: str) -> Column:
    """Serving side: the fraction of a day is cut off."""
    return F.date_add(F.col(date), F.col(days).cast("int"))
