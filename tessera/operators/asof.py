"""Point-in-validity lookup by sorting: versions and movements in one order, each movement
takes the versions of the last start before it.

The join in ``lookup.validity_lookup`` compares every movement of a key with every
version of it; where keys have many versions that is rows times versions. Here
both sides are unioned, ordered once by key and time, and the last start is
carried forward (``ordered.along``, which also cuts hot keys), so the work is
linear in rows plus versions.

Versions of a key must not overlap but at shared ends (``overlap_report`` counts
those that do); several may start at one time, as versions of no length do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordered import along
from tessera.operators.skew import SkewSpec


def validity_lookup_sorted(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                           ts: str, sk: str, out: str, valid_from: str = "valid_from",
                           valid_to: str = "valid_to", upper: str = "closed",
                           skew: SkewSpec | None = None) -> DataFrame:
    """``validity_lookup(..., how="left")`` for versions that tile time.

    ``closed``: a movement at the time one version ends and the next starts gets both, in a row each.
    """
    if upper not in ("closed", "half_open"):
        raise ValueError(f"upper must be 'closed' or 'half_open', got {upper!r}")
    # a date compares with a timestamp as its midnight
    kind = dim.schema[valid_from].dataType
    if isinstance(kind, T.DateType):
        kind = fact.schema[ts].dataType
    v = dim.select(F.col(dim_key).alias("k"), F.col(valid_from).cast(kind).alias("f"),
                   F.col(valid_to).cast(kind).alias("t"), F.col(sk).alias("sk"))
    starts = v.where(F.col("k").isNotNull() & F.col("f").isNotNull()).groupBy("k", "f").agg(
        F.collect_list(F.struct("sk", "t")).alias("here"))
    ids = f"array<{dim.schema[sk].dataType.simpleString()}>"
    if upper == "closed":  # versions that end exactly where one starts
        ends = v.where(F.col("t") > F.col("f")).groupBy("k", F.col("t").alias("f")).agg(
            F.collect_list("sk").alias("ending"))
        starts = starts.join(ends, ["k", "f"], "left")
    else:
        starts = starts.withColumn("ending", F.lit(None).cast(ids))
    node = starts.select("k", F.col("f").alias("at"), F.lit(0).alias("side"),
                         F.struct(F.col("f"), F.col("here"), F.col("ending")).alias("node"))
    moved = fact.select(F.col(fact_key).cast(dim.schema[dim_key].dataType).alias("k"),
                        F.col(ts).cast(kind).alias("at"), F.lit(1).alias("side"),
                        F.struct(*[F.col(c) for c in fact.columns]).alias("row"))
    both = node.unionByName(moved, allowMissingColumns=True)
    seen = along(both, "k", ["at", "side"], {"last": ("last", "node")}, skew).where("side = 1")
    within = (lambda e: e >= F.col("at")) if upper == "closed" else (lambda e: e > F.col("at"))
    mine = F.transform(F.filter(F.col("last.here"), lambda e: e["t"].isNull() | within(e["t"])),
                       lambda e: e["sk"])
    met = F.when(F.col("last.f") == F.col("at"), F.concat(mine, F.coalesce(
        F.col("last.ending"), F.array().cast(ids)))).otherwise(mine)
    return seen.select(F.col("row"), F.explode_outer(met).alias("met")).select(
        *[F.col("row")[c].alias(c) for c in fact.columns if c != out], F.col("met").alias(out))


def overlap_report(dim: DataFrame, key: str, valid_from: str = "valid_from",
                   valid_to: str = "valid_to", skew: SkewSpec | None = None) -> DataFrame:
    """One row: ``versions``, ``overlaps`` (versions that last beyond the next start), ``passed``."""
    known = dim.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        key, F.col(valid_from).alias("f"), F.col(valid_to).alias("t"),
        F.coalesce(valid_to, F.lit("9999-12-31").cast(dim.schema[valid_to].dataType)).alias("e"))
    seen = along(known, key, ["f", "e"], {"next": ("after", "f")}, skew)
    over = F.col("next").isNotNull() & (F.col("e") > F.col("next"))
    return seen.agg(F.count(F.lit(1)).alias("versions"), F.count(F.when(over, 1)).alias("overlaps")
                    ).withColumn("passed", F.col("overlaps") == 0)
