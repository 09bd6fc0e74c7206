"""Hot-key splitting for equi-joins whose left (fact) side may be heavily skewed.

A single card, holder or date can carry a third of all movements. A plain
shuffle join sends all of them to one task. Here the left side is first counted
per key (a map-side partial aggregate: one row per key per task). A key with
more than ``share`` of all rows is "hot" and is spread over
``ceil(its rows / (share * all rows))`` salt buckets: left rows of the key pick a
bucket from a hash of ``salt_on`` (all their columns by default, or a unique id;
deterministic, so a retried task reproduces the same assignment), and the right
rows of the key are replicated once per bucket. The join then runs on
``(key, salt)``. Every left row still meets every matching right row exactly
once, so results are exact. NULL keys match nothing: they are counted like a
key and spread the same way, without replicating anything.

Both numbers follow from ``share`` whatever the data: fewer than ``1 / share`` keys
can be hot, and their buckets add up to less than ``2 / share``. That bound is what
allows the list to be collected and written into the plan as literals, so
neither side is joined with it. Without a hot key the join is the plain one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewSpec:
    share: float = 0.01                 # of all rows; a key above it is split
    salt_on: tuple[str, ...] = ()       # left columns whose hash picks the bucket

    def __post_init__(self):
        if not 0.0005 <= self.share <= 1:
            raise ValueError("share must lie between 0.0005 and 1")


SALT = "__salt"


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """``(__hk, __n)``: rows per key, a partial (map-side) aggregate then a merge."""
    return df.groupBy(F.col(key).alias("__hk")).agg(F.count(F.lit(1)).alias("__n"))


def key_counts_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(__at, __hk, __n)``: rows per key of several columns of one type, in one pass."""
    return (df.select(F.posexplode(F.array(*[F.col(k) for k in keys])).alias("__at", "__hk"))
            .groupBy("__at", "__hk").agg(F.count(F.lit(1)).alias("__n")))


def rollup_counts(counts: DataFrame, mapping: DataFrame, from_key: str,
                  to_key: str) -> DataFrame:
    """Re-key counts through a (dimension-sized) mapping ``from_key -> to_key``.

    Rows per holder = sum over its cards of rows per card: the big side is
    counted once, per card, and only the small per-card counts travel.
    """
    m = mapping.select(F.col(from_key).alias("__from"), F.col(to_key).alias("__to"))
    return (counts.join(m, counts["__hk"] == m["__from"], "inner")
            .groupBy(F.col("__to").alias("__hk")).agg(F.sum("__n").alias("__n")))


def hot_from_counts(counts: DataFrame, spec: SkewSpec) -> DataFrame:
    """``(__hk, __buckets)`` for the keys (NULL among them) above the share of all rows."""
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("t")).scalar()
    limit = total * F.lit(spec.share)
    return counts.where(F.col("__n") > limit).select(
        "__hk", F.ceil(F.col("__n") / limit).cast("int").alias("__buckets"))


def hot_keys(df: DataFrame, key: str, spec: SkewSpec) -> DataFrame:
    """``(__hk, __buckets)`` for keys of ``df`` with more than ``spec.share`` of its rows."""
    return hot_from_counts(key_counts(df, key), spec)


def collect_hot(hot: DataFrame) -> dict:
    """Hot keys and their buckets; fewer than ``1 / share`` rows, see above."""
    return {r["__hk"]: r["__buckets"] for r in hot.collect()}


def _buckets(key: Column, hot: dict) -> Column:
    """Buckets of a key: NULL for one that is not hot."""
    known = [k for k in hot if k is not None]
    out = F.lit(None).cast("int")
    if known:
        table = F.create_map(*[F.lit(x) for k in known for x in (k, hot[k])])
        out = F.when(key.isin(known), F.element_at(table, key))
    if None in hot:
        out = F.when(key.isNull(), F.lit(hot[None])).otherwise(out)
    return out


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                spec: SkewSpec, how: str = "left",
                residual: Column | None = None, hot: dict | None = None) -> DataFrame:
    """``left JOIN right ON left[left_key] = right[right_key] [AND residual]`` with hot keys split.

    ``residual`` may reference columns of both sides by their (distinct) names.
    ``hot`` passes known hot keys (e.g. from counts taken on the base table before
    earlier joins); otherwise ``left`` is counted first. Helper columns are dropped
    from the result.
    """
    hot = collect_hot(hot_keys(left, left_key, spec)) if hot is None else hot
    if not hot:
        cond = left[left_key] == right[right_key]
        return left.join(right, cond if residual is None else cond & residual, how)
    salt_on = [c for c in spec.salt_on if c in left.columns] or left.columns
    buckets = _buckets(left[left_key], hot)
    l2 = left.select("*", F.when(buckets.isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[left[c] for c in salt_on]), buckets)).cast("int").alias(SALT))
    copies = F.coalesce(_buckets(right[right_key], {k: n for k, n in hot.items() if k is not None}),
                        F.lit(1))
    r2 = right.select("*", F.explode(F.sequence(F.lit(0), copies - 1)).alias("__rsalt"))
    cond = (l2[left_key] == r2[right_key]) & (l2[SALT] == r2["__rsalt"])
    if residual is not None:
        cond = cond & residual
    return l2.join(r2, cond, how).drop(SALT, "__rsalt")
