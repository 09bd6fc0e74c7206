"""Date expressions: ages and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import ColumnLike, _col

# Fixed value: the average year length the age rule divides by.
DAYS_PER_YEAR = 365.25


def age_years(birth: ColumnLike, as_of: ColumnLike | None = None) -> Column:
    """Whole years as ``floor(datediff(as_of, birth) / 365.25)`` (BIGINT).

    Approximate on purpose (parity): an exact anniversary can still give the
    lower age, a future birth date gives a negative age, NULL gives NULL.
    ``as_of`` defaults to ``current_date()``; pass a fixed date for repeatable runs.
    """
    ref = F.current_date() if as_of is None else _col(as_of)
    return F.floor(F.datediff(ref, F.to_date(_col(birth))) / F.lit(DAYS_PER_YEAR))


def date_key(d: ColumnLike) -> Column:
    """yyyymmdd as INT, computed arithmetically (no string round trip)."""
    d = F.to_date(_col(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_parts(d: ColumnLike) -> list[Column]:
    """Calendar dimension columns for a date column."""
    d = F.to_date(_col(d))
    return [
        date_key(d).alias("date_sk"),
        d.alias("date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("weekday"),
    ]
