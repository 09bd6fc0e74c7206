"""Facts that point to versions which changed after the fact was loaded.

A version may arrive late, with a start in the past, or a holder after its
movements. Only facts whose holder and time lie in a changed span can point
elsewhere then, facts without a version among them. ``touched_parts`` finds the
parts of the stored fact that hold such a row from the change of the dimension,
``stale_parts`` from the fact and the dimension as they are. ``rekey`` looks those
up again and replaces them in one commit; the other folders stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.lookup import validity_condition
from tessera.operators.skew import SkewSpec, salted_join
from tessera.sources.store import NULL_PART, TableStore


#: The commit marker's entry for the last version that replaced rows of earlier ones.
REWRITTEN = "rewritten"


def changed_spans(before: DataFrame, after: DataFrame, key: str, sk: str = "sk",
                  valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """(id, since, until) of the time in which an id's versions differ; ``until`` is NULL for no end.

    Versions are compared by surrogate key, start and end: one that was only closed
    counts from its start, as its facts after the new end change.
    """
    def side(df, name):
        return df.select(F.col(key).alias("k"), F.col(sk).alias("s"), F.col(valid_from).alias("f"),
                         F.col(valid_to).alias("t"), F.lit(name).alias("side"))
    both = side(before, 0).unionByName(side(after, 1)).groupBy("k", "s", "f", "t").agg(
        F.count_distinct("side").alias("n"))
    endless = F.max(F.col("t").isNull())
    return (both.where(F.col("n") == 1).groupBy(F.col("k").alias("id"))
            .agg(F.min("f").alias("since"), F.when(~endless, F.max("t")).alias("until")))


def touched_parts(fact: DataFrame, spans: DataFrame, key: str, ts: str, part: Column,
                  skew: SkewSpec | None = None) -> set[str]:
    """The parts of ``fact`` that hold a row in a changed span (at most one value a folder)."""
    left = fact.select(F.col(key).alias("__fk"), F.col(ts).alias("__ts"), part.cast("long").alias("__part"))
    right = spans.select(F.col("id").alias("__sk"), "since", "until")
    within = (F.col("__ts") >= F.col("since")) & (F.col("until").isNull() | (F.col("__ts") <= F.col("until")))
    if skew is not None:
        met = salted_join(left, right, "__fk", "__sk", skew, "inner", within)
    else:
        met = left.join(right, (F.col("__fk") == F.col("__sk")) & within)
    return {NULL_PART if r[0] is None else str(r[0]) for r in met.select("__part").distinct().collect()}


def stale_parts(fact: DataFrame, versions: DataFrame, key: str, sk: str, ts: str, part: Column,
                dim_key: str, dim_sk: str = "sk", valid_from: str = "valid_from",
                valid_to: str = "valid_to", upper: str = "closed",
                skew: SkewSpec | None = None) -> set[str]:
    """The parts of ``fact`` with a row whose version ``sk`` is not valid at its time any more, or
    that has none though one is valid now. Needs no earlier state of the versions."""
    rows = fact.select(F.col(key).alias("__fk"), F.col(sk).alias("__fsk"), F.col(ts).alias("__ts"),
                       part.cast("long").alias("__part"))
    v = versions.select(F.col(dim_key).alias("__k"), F.col(dim_sk).alias("__v"),
                        F.col(valid_from).alias("__f"), F.col(valid_to).alias("__t"))
    valid = validity_condition(F.col("__ts"), F.col("__f"), F.col("__t"), upper)
    keyed, without = rows.where(F.col("__fsk").isNotNull()), rows.where(F.col("__fsk").isNull())
    if skew is not None:
        met = salted_join(keyed, v, "__fsk", "__v", skew, "left")
        found = salted_join(without, v, "__fk", "__k", skew, "inner", valid)
    else:
        met = keyed.join(v, F.col("__fsk") == F.col("__v"), "left")
        found = without.join(v, (F.col("__fk") == F.col("__k")) & valid)
    stale = met.where(~F.coalesce(valid, F.lit(False))).select("__part")
    parts = stale.unionByName(found.select("__part")).distinct().collect()
    return {NULL_PART if r[0] is None else str(r[0]) for r in parts}


def rekey(store: TableStore, table: str, touched: set[str], part: Column,
          lookup: Callable[[DataFrame], DataFrame],
          check: Callable[[DataFrame], None] = lambda staged: None) -> None:
    """Look up again the parts ``touched`` of ``table`` and replace them in one commit.

    ``lookup`` gives the stored rows their keys anew (all columns, one row a fact);
    ``check`` sees the staged rows and may raise, which leaves the table as it was.
    """
    if not touched:
        return
    if lost := touched - store.parts(table):
        raise ValueError(f"{table} is not stored in parts, or has none for {sorted(lost)[:5]}")
    rows = store.read(table, touched)
    staged = store.stage(lookup(rows).select(*rows.columns), table, parts=part)
    check(store.read_staged(staged))
    store.commit(staged, "replace", epoch=(REWRITTEN, staged.version), replaced=touched)
