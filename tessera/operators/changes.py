"""A feed of changes into a type-2 dimension: several changes of one id, and deletes, in one load.

A change has the id, a sequence number, a code (I, U or D), a time and the id's
new attributes. The dimension's rows and the changes are put in one order, by id,
and each row looks at its neighbours: a change that leaves the tracked attributes
as they were makes no version, any other closes the version before it and, unless
it deletes the id, opens one that lasts until the next. So one pass makes all
versions between two loads, however many changes an id has.

Defined results:

* Versions of an id tile time from its first insert, but for gaps after deletes;
  at most one is current. A change stamped earlier than the id's last one (or than its
  current version) takes effect at that later time.
* Two changes of an id at one time: the later by sequence number counts, the other
  leaves no version.
* A delete of an unknown or deleted id does nothing; I and U mean the same.
* Repeated changes do nothing. Differing changes with one sequence number are
  taken by time, then by a hash of their content.
* Stored versions are never removed: one that is replaced at its very start ends there.
* Tracked attributes are compared with ``<=>``, so NULL equals NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import surrogate_key
from tessera.operators.ordered import along, split_points
from tessera.operators.scd2 import Scd2Spec
from tessera.operators.skew import SkewSpec

STORED, CURRENT, CHANGE = 0, 1, 2


def apply_changes(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, seq: str, op: str, at: str,
                  delete: str = "D", skew: SkewSpec | None = None) -> DataFrame:
    """The next snapshot of ``dim`` after ``changes``. ``changes`` has the dimension's columns but
    for key and validity, and ``seq``, ``op``, ``at``; ``skew`` cuts ids with very many rows."""
    kind = dim.schema[spec.valid_from].dataType
    own = {spec.sk, spec.valid_from, spec.valid_to, spec.current}
    attributes = [c for c in dim.columns if c not in own]
    if missing := sorted(set(attributes) - set(changes.columns)):
        raise ValueError(f"the changes lack the columns {missing}")
    state = F.struct(*[F.col(c) for c in spec.tracked])
    no_state = F.lit(None).cast(dim.select(state.alias("s")).schema["s"].dataType)
    row = F.struct(*[F.col(c) for c in attributes]).alias("row")
    stored = dim.select(
        F.col(spec.key).alias("key"), row,
        F.when(F.col(spec.current), CURRENT).otherwise(STORED).alias("rank"),
        F.lit(0).cast("long").alias("seq"),
        F.when(F.col(spec.current), F.col(spec.valid_from)).otherwise(
            F.coalesce(spec.valid_to, spec.valid_from)).alias("at"),
        F.when(F.col(spec.current), state).otherwise(no_state).alias("state"),
        F.struct(spec.sk, spec.valid_from, spec.valid_to, spec.current).alias("old"),
        F.xxhash64(spec.sk).alias("tie"))
    gone = F.coalesce(F.col(op) == delete, F.lit(False))
    coming = changes.select(
        F.col(spec.key).alias("key"), row, F.lit(CHANGE).alias("rank"),
        F.col(seq).cast("long").alias("seq"), F.col(at).cast(kind).alias("at"),
        F.when(gone, no_state).otherwise(state).alias("state"),
        F.lit(None).cast(stored.schema["old"].dataType).alias("old"),
        F.xxhash64(at, op, *attributes).alias("tie"))
    # the order's first column cuts hot ids: what is stored comes before any change
    place = F.when(F.col("rank") == CHANGE, F.col("seq").cast("double")).otherwise(F.lit(-1e30))
    rows = stored.unionByName(coming).withColumn("place", place)
    order = ["place", "rank", "seq", "at", "tie"]
    points = split_points(rows, "key", "place", skew)
    seen = along(rows, "key", order, {"known": ("before", "state"), "since": ("top", "at")}, points=points)
    different = ~F.col("state").eqNullSafe(F.col("known"))
    kept = seen.where((F.col("rank") != CHANGE) | different)
    ends = along(kept, "key", order, {"until": ("after", "since"), "next": ("after", "rank")},
                 points=points)
    # a stored row that is not current, and a delete, are nobody's end but the row's before
    opened = F.col("rank") == CHANGE
    ended = F.col("next") == CHANGE
    sk = surrogate_key(F.col("key"), F.col("since"), F.col("seq"), modulus=spec.key_modulus)
    made = ends.where(~opened | (F.col("state").isNotNull() & ~F.coalesce(
        ended & (F.col("until") == F.col("since")), F.lit(False))))
    closed = F.when((F.col("rank") != STORED) & ended, F.col("until")).cast(kind)
    out = {spec.sk: F.when(opened, sk).otherwise(F.col(f"old.{spec.sk}")),
           spec.valid_from: F.when(opened, F.col("since")).otherwise(F.col(f"old.{spec.valid_from}")).cast(kind),
           spec.valid_to: F.coalesce(closed, F.col(f"old.{spec.valid_to}")),
           spec.current: F.when(F.col("rank") == STORED, F.lit(False)).otherwise(
               ~F.coalesce(ended, F.lit(False)))}
    return made.select(*[out[c].alias(c) if c in out else F.col(f"row.{c}").alias(c) for c in dim.columns])
