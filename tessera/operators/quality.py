"""Data-quality reports and the fail-fast gate.

Each report is a one-row (or small) DataFrame computed by Spark; only that row
reaches the driver. Counting is a map-side partial aggregate, so a hot key
costs one combined row per task, not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(Exception):
    """Raised by ``gate`` before anything is written; carries the failed reports."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        super().__init__("; ".join(f"{f['check']}: {f}" for f in failures))


def row_count_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source_count``, ``target_count``, ``passed`` in one pass over both inputs.

    Catches orphans (fewer rows) and fan-out (more rows), but not both at once
    when they cancel out; pair it with ``key_uniqueness_report``.
    """
    side = "__side"
    both = source.select(F.lit(0).alias(side)).unionByName(target.select(F.lit(1).alias(side)))
    return both.agg(
        F.count(F.when(F.col(side) == 0, 1)).alias("source_count"),
        F.count(F.when(F.col(side) == 1, 1)).alias("target_count"),
    ).withColumn("passed", F.col("source_count") == F.col("target_count"))


def _key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    # groupBy keeps NULL as its own group: a NULL key counts as one value,
    # like select(key).distinct().count().
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def key_uniqueness_report(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """``total_rows``, ``distinct_keys``, ``duplicate_rows`` (= total - distinct), ``passed``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).select(
        "total_rows", "distinct_keys",
        (F.col("total_rows") - F.col("distinct_keys")).alias("duplicate_rows"),
        (F.col("total_rows") == F.col("distinct_keys")).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """The offending keys with their row counts (``n > 1``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _key_counts(df, keys).where(F.col("n") > 1)


def null_key_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """``rows`` and, per column, ``null_<col>``: rows an inner star join would drop."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in cols])


def orphan_report(base: DataFrame, hops: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """One row: ``rows`` of ``base`` and, per hop, ``orphans_<n>``, the rows whose chain of
    keys breaks there.

    ``hops``: (table, key it is reached by, its own key), each reached from the one
    before (the first from ``base``). Rows are first counted per first key (a partial
    aggregate), so the big side is read once and only per-key counts are joined.
    """
    _, first_key, _ = hops[0]
    out = base.groupBy(F.col(first_key).alias("__k0")).agg(F.count(F.lit(1)).alias("__n"))
    for i, (table, _, own) in enumerate(hops):
        cols = [F.col(own).alias(f"__own{i}")]
        if i + 1 < len(hops):
            cols.append(F.col(hops[i + 1][1]).alias(f"__k{i + 1}"))
        hop = table.select(*cols).dropDuplicates([f"__own{i}"])
        out = out.join(hop, F.col(f"__k{i}") == F.col(f"__own{i}"), "left")
    reached, sums = F.lit(True), []
    for i in range(len(hops)):
        found = F.col(f"__own{i}").isNotNull()
        sums.append(F.coalesce(F.sum(F.when(reached & ~found, F.col("__n"))), F.lit(0))
                    .cast("long").alias(f"orphans_{i + 1}"))
        reached = reached & found
    return out.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"), *sums)


def evaluate(**reports: DataFrame) -> list[dict]:
    """The rows of one-row reports as dicts named by ``check``; all reports run as one job, side by side."""
    if not reports:
        return []
    named = [rep.limit(1).withColumn("__check", F.lit(name)) for name, rep in reports.items()]
    together = named[0]
    for rep in named[1:]:
        together = together.unionByName(rep, allowMissingColumns=True)
    found = {r["__check"]: r.asDict() for r in together.collect()}
    return [{"check": name, **({c: found[name][c] for c in rep.columns} if name in found
                               else {"passed": False})} for name, rep in reports.items()]


def require(rows: list[dict]) -> list[dict]:
    """``rows`` if all ``passed``; raises with those that did not."""
    if failures := [d for d in rows if not d.get("passed")]:
        raise QualityError(failures)
    return rows


def gate(**reports: DataFrame) -> list[dict]:
    """Evaluate reports (each a one-row frame with ``passed``); raise if any failed.

    Returns the report rows as dicts when all pass.
    """
    return require(evaluate(**reports))
