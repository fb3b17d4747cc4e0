"""Calendar flags on a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def weekend_flag(d: Column | str) -> Column:
    """1 on Saturday/Sunday (dayofweek 7/1), else 0 (NULL date -> 0)."""
    return F.when(F.dayofweek(_c(d)).isin(1, 7), 1).otherwise(0)


def back_to_school_flag(d: Column | str) -> Column:
    """1 from July 15 through August 31, else 0."""
    d = _c(d)
    return (F.when((F.month(d) == 7) & (F.dayofmonth(d) >= 15), 1)
            .when(F.month(d) == 8, 1).otherwise(0))
