"""Calendar and type-1 (overwrite) dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import calendar_parts
from tessera.functions.keys import surrogate_key
from tessera.operators.sequence import consecutive_keys, largest


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return F.to_date(d)
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.isoformat()[:10]
    return F.to_date(F.lit(str(d)))


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in ``[start, end]`` with key yyyymmdd, parts and English weekday.

    Size is bounded by the span in days (36,525 rows per century), never by data
    volume, so it is always a broadcast-sized side.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(_date_lit(start), _date_lit(end))).alias("d"))
    return days.select(*calendar_parts("d"))


#: The days a calendar made from data may span; a wrong date outside makes no days.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2100, 12, 31)


def calendar_for(df: DataFrame, ts: str, first=FIRST_DAY, last=LAST_DAY) -> DataFrame:
    """Calendar spanning the dates of ``df[ts]`` (min..max) within ``[first, last]``.

    The min/max is a partial aggregate per task, so only one row per task
    reaches the final stage; the span bounds the rows made from it. Dates outside
    get no calendar day: ``outside_days`` counts them, and a fact's undated rows
    fail its gate.
    """
    day = F.to_date(ts)
    inside = df.where(day.between(_date_lit(first), _date_lit(last)))
    bounds = inside.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_parts("d"))


def outside_days(df: DataFrame, ts: str, first=FIRST_DAY, last=LAST_DAY) -> DataFrame:
    """One row: ``rows`` dated, ``outside`` the span a calendar may have, ``passed``."""
    day = F.to_date(ts)
    return df.agg(F.count(day).alias("rows"), F.count(F.when(
        ~day.between(_date_lit(first), _date_lit(last)), 1)).alias("outside")
    ).withColumn("passed", F.col("outside") == 0)


def type1_upsert(trusted: DataFrame, dim: DataFrame, key: str, sk: str = "sk",
                 now: Column | None = None, modulus: int | None = None,
                 new_flag: str | None = None, consecutive: bool = False) -> DataFrame:
    """Overwrite-in-place dimension: attributes follow the source, keys stay.

    Ids in both keep their old surrogate key with fresh attributes; new ids get
    ``surrogate_key(id, now)``; ids gone from the source stay as they were.
    ``new_flag`` names an optional boolean column marking newly keyed rows.
    One full outer join on the natural key (each side shuffled once); a
    duplicated dimension key fans out exactly as a left join would.
    ``consecutive`` numbers new ids after the largest key in use instead of hashing
    them (``modulus`` is then the numbers' limit).
    """
    ts = F.current_timestamp() if now is None else now
    cols = [c for c in dim.columns if c != sk]
    if extra := sorted(set(trusted.columns) - set(cols) - {sk}):
        raise ValueError(f"columns not in the dimension: {extra}; select them away or add them")
    t = trusted.select(F.lit(True).alias("__t1_in_src"), *[F.col(c) for c in cols])
    d = dim.select(F.col(key).alias("__t1_dkey"), F.col(sk).alias("__t1_old_sk"),
                   *[F.col(c).alias(f"__t1_d_{c}") for c in cols if c != key])
    j = t.join(d, t[key] == d["__t1_dkey"], "full_outer")
    in_src = F.col("__t1_in_src").isNotNull()
    fresh = surrogate_key(F.col(key), ts, modulus=modulus)
    if consecutive:
        new = consecutive_keys(t.join(d, t[key] == d["__t1_dkey"], "left_anti").select(
            F.col(key).alias("__t1_nkey")).distinct(), ["__t1_nkey"], "__t1_new_sk",
            largest(dim, sk), modulus)
        j = j.join(new, F.col(key) == F.col("__t1_nkey"), "left")
        fresh = F.col("__t1_new_sk")
    out = [F.when(in_src, F.coalesce(F.col("__t1_old_sk"), fresh))
            .otherwise(F.col("__t1_old_sk")).alias(sk)]
    for c in cols:
        dc = "__t1_dkey" if c == key else f"__t1_d_{c}"
        out.append(F.when(in_src, F.col(c)).otherwise(F.col(dc)).alias(c))
    if new_flag:
        out.append((in_src & F.col("__t1_old_sk").isNull()).alias(new_flag))
    return j.select(*out)
