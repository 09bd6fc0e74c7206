"""Looking backward and forward along a key's rows, when one key may hold a third of all rows.

A window over a key is one task's work for each key. Here a key with more than
``share`` of all rows is cut into ranges of its order column (at approximate
quantiles, so that each range holds about that share), the window runs over
(key, range), and what a range needs from its neighbours travels in one row a
hot range: fewer than ``2 / share`` rows. Rows with equal order values stay in
one range. Results are those of the window over the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.skew import SkewSpec, collect_hot, hot_keys

RANGE = "__range"


def split_points(df: DataFrame, key: str, order: str, skew: SkewSpec | None) -> dict:
    """Hot keys and the ascending order values their ranges start after."""
    hot = collect_hot(hot_keys(df, key, skew)) if skew is not None else {}
    if not hot:
        return {}
    most = max(hot.values())
    cuts = [F.lit((k + 1) / most) for k in range(most - 1)] or [F.lit(0.5)]
    wanted = F.col(key).isin([k for k in hot if k is not None])
    if None in hot:
        wanted = wanted | F.col(key).isNull()
    found = df.where(wanted).groupBy(F.col(key).alias("k")).agg(
        F.percentile_approx(order, F.array(*cuts), 1000).alias("at")).collect()
    return {r["k"]: sorted(set(x for x in r["at"] or [] if x is not None)) for r in found}


def range_of(key: Column, order: Column, points: dict) -> Column:
    """The range a row belongs to: how many of its key's points lie below it (0 for a NULL value)."""
    known = {k: at for k, at in points.items() if k is not None and at}
    out = F.lit(0)
    if known:
        table = F.create_map(*[x for k, at in known.items() for x in (F.lit(k), F.array(*map(F.lit, at)))])
        at = F.when(key.isin(list(known)), F.element_at(table, key))
        out = F.coalesce(F.size(F.filter(at, lambda x: x < order)), F.lit(0))
    if points.get(None):
        below = F.size(F.filter(F.array(*map(F.lit, points[None])), lambda x: x < order))
        out = F.when(key.isNull(), below).otherwise(out)
    return out.cast("int")


def along(df: DataFrame, key: str, order: list[str], columns: dict[str, tuple[str, str]],
          skew: SkewSpec | None = None, points: dict | None = None) -> DataFrame:
    """``df`` with new columns ``{name: (kind, column)}`` that look along each key's rows.

    Rows of a key are taken by ``order``, which should tell them apart (its first
    column, which must not be NULL, cuts hot keys). ``kind``: ``last``, the last value that is not NULL up to
    the row itself; ``top``, the largest value up to the row itself; ``before`` and
    ``after``, the value in the row before and after (NULL if there is none). ``points`` are
    known ``split_points``, so that ``df`` is not counted again.
    """
    points = split_points(df, key, order[0], skew) if points is None else points
    cut = df.withColumn(RANGE, range_of(F.col(key), F.col(order[0]), points) if points else F.lit(0))
    w = Window.partitionBy(key, RANGE).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {"last": lambda c: F.last(c, ignorenulls=True).over(so_far), "top": lambda c: F.max(c).over(so_far),
             "before": lambda c: F.lag(F.struct(c)).over(w), "after": lambda c: F.lead(F.struct(c)).over(w)}
    out = cut.select("*", *[local[kind](F.col(c)).alias(f"__{n}") for n, (kind, c) in columns.items()])
    plain = {n: (F.col(f"__{n}") if kind in ("last", "top") else F.col(f"__{n}.{c}"))
             for n, (kind, c) in columns.items()}
    if not points:
        return out.select(*df.columns, *[c.alias(n) for n, c in plain.items()])

    # one row for each range of a hot key, then one pass over those rows
    hot = cut.where(F.col(key).isin([k for k in points if k is not None])
                    | (F.col(key).isNull() & F.lit(None in points)))
    rank, need = F.struct(*order), []
    for n, (kind, c) in columns.items():
        value = F.struct(F.col(c).alias(c))
        need.append({"last": F.max_by(value, F.when(F.col(c).isNotNull(), rank)),
                     "top": F.max(F.col(c)), "before": F.max_by(value, rank),
                     "after": F.min_by(value, rank)}[kind].alias(f"__e_{n}"))
    edges = hot.groupBy(F.col(key).alias("__k"), F.col(RANGE).alias("__r")).agg(*need)
    by_range = Window.partitionBy("__k").orderBy("__r")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    look = {"last": lambda e: F.last(e, ignorenulls=True).over(earlier), "top": lambda e: F.max(e).over(earlier),
            "before": lambda e: F.lag(e).over(by_range), "after": lambda e: F.lead(e).over(by_range)}
    carried = edges.select("__k", "__r", *[look[kind](F.col(f"__e_{n}")).alias(f"__c_{n}")
                                          for n, (kind, _) in columns.items()])
    met = out.join(F.broadcast(carried),  # fewer than 2 / share rows
                   F.col(key).eqNullSafe(F.col("__k")) & (F.col(RANGE) == F.col("__r")), "left")
    full = []
    for n, (kind, c) in columns.items():
        mine, far = F.col(f"__{n}"), F.col(f"__c_{n}")
        if kind == "top":
            full.append(F.greatest(mine, far).alias(n))
        elif kind == "last":
            full.append(F.coalesce(mine, far[c]).alias(n))
        else:  # a struct that is NULL has no neighbour in the range; its value may be NULL
            full.append(F.coalesce(mine, far)[c].alias(n))
    return met.select(*df.columns, *full)
