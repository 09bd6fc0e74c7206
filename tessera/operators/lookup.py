"""Key lookups: join chains, natural -> surrogate key, point-in-validity, calendar.

Every lookup projects the dimension down to the columns it needs before the
join, so the shuffle (or broadcast) carries only key, validity and surrogate
key. No broadcast hints: Spark broadcasts a side only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time) and
falls back to a sort-merge join otherwise, so a dimension that grows with the
data never gets pushed into executor memory unchecked. Hot keys on the fact side
are split by AQE's skew-join handling (left outer / inner joins split the left
side), so one heavy card or holder does not land in a single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import SkewSpec, salted_join


@dataclass(frozen=True)
class ChainStep:
    """Inner join ``right`` where ``left_key`` (already in the frame) = ``right_key``.

    ``keep`` lists right-side columns to carry on (the next hop's key, attributes).
    """
    right: DataFrame
    left_key: str
    right_key: str
    keep: tuple[str, ...] = ()


def lookup_chain(base: DataFrame, steps: list[ChainStep],
                 skew: SkewSpec | None = None) -> DataFrame:
    """Walk a chain of natural keys with inner joins (movement -> card -> account -> holder).

    Rows whose key has no partner at any hop drop out (parity with the inner
    chain). The right key is carried on under its own name so later hops can use it.

    Hops whose key the chain itself brings in are resolved on the dimension side
    first, so ``base`` (the big side) joins once per key of its own, not once per
    hop. ``skew`` splits hot keys of those joins.
    """
    out = base
    steps = list(steps)
    while steps:
        first, later = steps[0], []
        right = _step_columns(first)
        for st in steps[1:]:
            if later or st.left_key in base.columns or st.left_key not in right.columns:
                later.append(st)
            else:
                right = _equi_join(right, _step_columns(st), st.left_key, st.right_key)
        out = _equi_join(out, right, first.left_key, first.right_key, skew)
        steps = later
    return out


def _step_columns(st: ChainStep) -> DataFrame:
    return st.right.select(st.right_key, *[c for c in st.keep if c != st.right_key])


def _equi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               skew: SkewSpec | None = None) -> DataFrame:
    if skew is not None:
        k = "__chain_key"
        out = salted_join(left, right.withColumnRenamed(right_key, k), left_key, k, skew, "inner")
        if left_key != right_key:
            return out.withColumnRenamed(k, right_key)
        return out.select(left_key, *[c for c in left.columns if c != left_key],
                          *[c for c in right.columns if c != right_key])
    if left_key == right_key:
        return left.join(right, on=left_key, how="inner")
    return left.join(right, left[left_key] == right[right_key], "inner")


def dim_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
               sk: str, out: str, how: str = "left",
               skew: SkewSpec | None = None, hot: dict | None = None) -> DataFrame:
    """Attach ``dim.sk`` as ``out`` by equality of the natural key.

    ``how='left'``: a miss keeps the fact row with a NULL key. Duplicate dimension
    keys fan out (parity); the quality gate is what catches that.
    """
    k = "__lk_key"
    right = dim.select(F.col(dim_key).alias(k), F.col(sk).alias(out))
    if skew is not None:
        return salted_join(fact, right, fact_key, k, skew, how, hot=hot).drop(k)
    return fact.join(right, fact[fact_key] == right[k], how).drop(k)


def validity_condition(ts: Column, valid_from: Column, valid_to: Column,
                       upper: str = "closed") -> Column:
    """``valid_from <= ts`` and (``ts <= valid_to`` | ``ts < valid_to``) or open end.

    ``closed`` (parity): a timestamp exactly on a boundary shared by two
    versions matches both. ``half_open``: it matches only the later one.
    """
    if upper == "closed":
        hi = ts <= valid_to
    elif upper == "half_open":
        hi = ts < valid_to
    else:
        raise ValueError(f"upper must be 'closed' or 'half_open', got {upper!r}")
    return (ts >= valid_from) & (hi | valid_to.isNull())


def validity_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                    ts: str, sk: str, out: str, valid_from: str = "valid_from",
                    valid_to: str = "valid_to", upper: str = "closed",
                    how: str = "left", skew: SkewSpec | None = None,
                    hot: dict | None = None) -> DataFrame:
    """Point-in-validity join: the version of ``fact_key`` valid at ``fact.ts``.

    An equi-join on the natural key with the range as a residual predicate, so
    Spark hash-partitions (or broadcasts) on the key and checks the few versions
    per key inside the join; no range binning is needed. A timestamp before the
    first version, or an unknown key, gives NULL under ``how='left'``.
    """
    k, f, t = "__vl_key", "__vl_from", "__vl_to"
    right = dim.select(F.col(dim_key).alias(k), F.col(valid_from).alias(f),
                       F.col(valid_to).alias(t), F.col(sk).alias(out))
    if skew is not None:
        rng = validity_condition(F.col(ts), F.col(f), F.col(t), upper)
        return salted_join(fact, right, fact_key, k, skew, how, rng, hot=hot).drop(k, f, t)
    cond = (fact[fact_key] == right[k]) & validity_condition(
        fact[ts], right[f], right[t], upper)
    return fact.join(right, cond, how).drop(k, f, t)


def calendar_lookup(fact: DataFrame, calendar: DataFrame, ts: str,
                    out: str = "date_sk", date_col: str = "date",
                    sk: str = "date_sk", how: str = "left",
                    skew: SkewSpec | None = None) -> DataFrame:
    """Attach the calendar key of ``CAST(ts AS DATE)``; dates outside the calendar give NULL.

    A calendar has one row per day, so Spark's size check normally broadcasts
    it and a busy day costs nothing extra; ``skew`` covers the case where it does not.
    """
    d = "__cal_date"
    right = calendar.select(F.col(date_col).alias(d), F.col(sk).alias(out))
    if skew is not None:
        fd = "__cal_fact_date"
        f2 = fact.withColumn(fd, F.to_date(F.col(ts)))
        return salted_join(f2, right, fd, d, skew, how).drop(d, fd)
    return fact.join(right, F.to_date(fact[ts]) == right[d], how).drop(d)
