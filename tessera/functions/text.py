"""Text cleaning expressions used by the trusted layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c: ColumnLike) -> Column:
    """``upper(coalesce(trim(c), ''))``: never NULL.

    ``trim`` strips spaces only, so a leading tab survives; ``upper`` keeps
    accents (``viúvo`` -> ``VIÚVO``).
    """
    return F.upper(F.coalesce(F.trim(_col(c)), F.lit("")))


def split_name(c: ColumnLike) -> tuple[Column, Column]:
    """Split a normalised full name into (first token, rest).

    The rest is the remaining tokens joined by single spaces, NULL when there is
    only one token. Splitting is on single spaces, so inner runs of spaces leave
    empty tokens behind (``ANA   SILVA`` -> ``ANA`` / ``"  SILVA"``); NULL or ''
    gives ``""`` / NULL.
    """
    parts = F.split(normalize(c), " ")
    n = F.size(parts)
    first = parts.getItem(0)
    rest = F.when(n > 1, F.array_join(F.slice(parts, 2, n), " ")).otherwise(F.lit(None))
    return first, rest
