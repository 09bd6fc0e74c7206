"""Surrogate keys from a hash of the natural key and the load time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import ColumnLike, _col

# Fixed value: the modulus of the parity key form (ten decimal digits).
PARITY_MODULUS = 10_000_000_000


def surrogate_key(*cols: ColumnLike, modulus: int | None = None) -> Column:
    """Deterministic surrogate key from ``xxhash64(cols...)``.

    Default: the hash shifted right by one bit, a non-negative 63-bit value
    (about n^2 / 2^64 expected collisions, negligible). ``modulus`` gives the
    short form ``abs(hash) % modulus``; it is computed as ``abs(hash % modulus)``,
    which is the same number but cannot overflow on ``Long.MIN_VALUE`` under
    ANSI mode. With ``modulus=10**10`` expect ~n^2 / 2e10 collisions per load,
    so gate uniqueness when using it.
    Runs fully inside codegen, no shuffle, no driver round trip.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    h = F.xxhash64(*[_col(c) for c in cols])
    if modulus is None:
        return F.shiftrightunsigned(h, 1)
    return F.abs(h % F.lit(int(modulus)))
