"""Slowly changing dimension, type 2: detect new/changed rows, expire, merge.

The merge is one DataFrame: the old snapshot with changed current versions
closed, plus the new versions. Both sets come from the same input snapshot and
share one ``now``, so an expiry time always equals the start of its successor.
Writing the result as a new snapshot (see ``sources.store``) replaces the
original pipeline's in-place UPDATE + append and cuts the lineage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.keys import surrogate_key
from tessera.operators.sequence import consecutive_keys, largest
from tessera.session import keep_shuffles_over_unions


@dataclass(frozen=True)
class Scd2Spec:
    """Column roles of a type-2 dimension.

    ``match='any'`` (parity) compares the source row with every version of its
    id, so a return to a former state (A -> B -> A) is no change; ``'current'``
    compares with the current version only. ``null_safe=False`` (parity) makes a
    NULL tracked value never match, so such a row gets a new version each run;
    ``True`` compares with ``<=>``.
    """
    key: str
    tracked: tuple[str, ...]
    sk: str = "sk"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    current: str = "is_current"
    match: str = "any"
    null_safe: bool = False
    key_modulus: int | None = None
    # hash of id and load time, or numbers after the largest in use (then key_modulus is their limit)
    consecutive: bool = False
    validity_type: T.DataType = field(default_factory=T.TimestampType)

    def __post_init__(self):
        if self.match not in ("any", "current"):
            raise ValueError("match must be 'any' or 'current'")


def _now(now: Column | None, dtype: T.DataType | None) -> Column:
    c = F.current_timestamp() if now is None else now
    return c.cast(dtype) if dtype is not None else c


def empty_dimension(spark: SparkSession, src_schema: T.StructType,
                    spec: Scd2Spec) -> DataFrame:
    """Typed empty target for a first load (the caller checks existence first)."""
    fields = [T.StructField(spec.sk, T.LongType(), False)]
    fields += [f for f in src_schema.fields if f.name != spec.sk]
    fields += [T.StructField(spec.valid_from, spec.validity_type, True),
               T.StructField(spec.valid_to, spec.validity_type, True),
               T.StructField(spec.current, T.BooleanType(), False)]
    return spark.createDataFrame([], T.StructType(fields))


def _match_condition(s: str, d: str, spec: Scd2Spec) -> Column:
    cond = F.col(f"{s}.{spec.key}") == F.col(f"{d}.{spec.key}")
    for t in spec.tracked:
        a, b = F.col(f"{s}.{t}"), F.col(f"{d}.{t}")
        cond = cond & (a.eqNullSafe(b) if spec.null_safe else a == b)
    return cond


def changed_rows(src: DataFrame, dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Source rows with no matching version (new ids and changed ids): a left anti join."""
    cand = dim.where(F.col(spec.current)) if spec.match == "current" else dim
    cand = cand.select(spec.key, *spec.tracked)
    return src.alias("s").join(cand.alias("d"), _match_condition("s", "d", spec), "left_anti")


def new_versions(src: DataFrame, dim: DataFrame, spec: Scd2Spec,
                 now: Column | None = None, changed: DataFrame | None = None,
                 last_key: int | None = None) -> DataFrame:
    """Dimension-shaped rows to insert: new surrogate key, valid from ``now``, open, current.

    ``changed`` may pass in a precomputed ``changed_rows(src, dim, spec)``, ``last_key`` the
    largest key in use where ``dim`` is only a part of the dimension.
    """
    vt = (dim.schema[spec.valid_from].dataType if spec.valid_from in dim.columns
          else spec.validity_type)
    ts = _now(now, vt)
    ch = changed_rows(src, dim, spec) if changed is None else changed
    cols = [c for c in src.columns if c != spec.sk]
    if spec.consecutive:
        after = largest(dim, spec.sk) if last_key is None else last_key
        ch = consecutive_keys(ch.select(*cols), [spec.key], spec.sk, after, spec.key_modulus)
        sk = F.col(spec.sk)
    else:
        sk = surrogate_key(F.col(spec.key), ts, modulus=spec.key_modulus).alias(spec.sk)
    return ch.select(
        sk,
        *cols,
        ts.alias(spec.valid_from),
        F.lit(None).cast(vt).alias(spec.valid_to),
        F.lit(True).alias(spec.current),
    )


def expired_keys(src: DataFrame, dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Surrogate keys of current versions whose id has a changed source row.

    A semi join, so each version appears once even if the source repeats an id.
    """
    ch = changed_rows(src, dim, spec).select(spec.key)
    return dim.where(F.col(spec.current)).join(ch, spec.key, "left_semi").select(spec.sk)


def _same(versions: Column, spec: Scd2Spec) -> Column:
    """Whether one of ``versions`` (an array of tracked values) equals the row's own."""
    def equal(v: Column) -> Column:
        out = F.lit(True)
        for t in spec.tracked:
            out = out & (F.col(t).eqNullSafe(v[t]) if spec.null_safe else F.col(t) == v[t])
        return out
    return F.coalesce(F.exists(versions, equal), F.lit(False))


def merge(src: DataFrame, dim: DataFrame, spec: Scd2Spec,
          now: Column | None = None, changed: DataFrame | None = None,
          last_key: int | None = None) -> DataFrame:
    """Next snapshot: old versions (changed current ones closed at ``now``) + new versions.

    Ids missing from the source are left open; duplicate source ids are not
    deduplicated (parity). Both sides are partitioned once, on the natural key:
    the versions of an id are gathered there, compared with its source row, and
    the ids found changed meet their versions again without another shuffle.
    ``changed`` may pass in a precomputed ``changed_rows(src, dim, spec)``; its
    ids are then joined to the snapshot, which a small delta does by broadcast.
    A snapshot that is a union is shuffled like any other: the session's planning
    rule that would take the union as partitioned already is turned off.
    """
    if extra := sorted(set(src.columns) - set(dim.columns) - {spec.sk}):
        raise ValueError(f"columns not in the dimension: {extra}; select them away or add them")
    keep_shuffles_over_unions(dim.sparkSession)
    vt = dim.schema[spec.valid_from].dataType
    ts = _now(now, vt)
    flag = "__scd2_changed"
    if changed is None:
        dim = dim.repartition(spec.key)
        taken = F.col(spec.current) if spec.match == "current" else F.lit(True)
        versions = dim.groupBy(F.col(spec.key).alias("__scd2_key")).agg(
            F.collect_set(F.when(taken, F.struct(*spec.tracked))).alias("__scd2_versions"))
        changed = (src.join(versions, F.col(spec.key) == F.col("__scd2_key"), "left")
                   .where(~_same(F.coalesce("__scd2_versions", F.array()), spec))
                   .select(*src.columns))
    changed_ids = changed.groupBy(spec.key).agg(F.lit(True).alias(flag))
    closing = F.col(spec.current) & F.col(flag).isNotNull()
    kept = (dim.join(changed_ids, spec.key, "left")
            .select(*[
                (F.when(closing, ts).otherwise(F.col(c)).alias(c) if c == spec.valid_to
                 else F.when(closing, F.lit(False)).otherwise(F.col(c)).alias(c)
                 if c == spec.current else F.col(c))
                for c in dim.columns]))
    inserts = new_versions(src, dim, spec, ts, changed=changed, last_key=last_key).select(*dim.columns)
    return kept.unionByName(inserts)


def first_load(spark: SparkSession, src: DataFrame, spec: Scd2Spec,
               now: Column | None = None) -> DataFrame:
    """Merge into an empty target: every source row becomes a current version."""
    return merge(src, empty_dimension(spark, src.schema, spec), spec, now)
