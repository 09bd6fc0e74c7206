"""Stored keys that join and group without a shuffle: bucketed Parquet folders.

A folder is written in ``buckets`` hash buckets of a key, one task a bucket. Spark
plans a scan of such a folder as already partitioned by the key, so an anti
join or a count by key shuffles the other side only. The folder is known to the
session as an external table (its definition, not its rows, lives in the
session's catalog), so any session that reads it registers it again under a
name made from its path. Folders are compared one after another (``lacking``,
``held_keys_report``), each under the batch's one shuffle.

They are not unioned: Spark 4.1 takes a union of equally bucketed scans as
bucketed as well, but its columnar form puts their partitions side by side, so a
count by key over it misses keys that lie in two folders. ``read_bucketed``
therefore turns that planning rule off in the session.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import keep_shuffles_over_unions


def _table(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` to the new folder ``path`` in ``buckets`` buckets of ``key``, sorted by it."""
    table = _table(path)
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: its files stay
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("errorifexists").saveAsTable(table))


def read_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """The folder, planned as hash partitioned by ``key``. ``schema`` is a DDL list of columns."""
    keep_shuffles_over_unions(spark)  # see above
    table = _table(path)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def lacking(batch: DataFrame, stored: list[DataFrame], key: str) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is in none of the stored frames: one anti join each, all
    under the batch's one shuffle."""
    for held in stored:
        batch = batch.join(held.select(key).hint("shuffle_merge"), key, "left_anti")
    return batch


def held_keys_report(staged: DataFrame, stored: list[DataFrame], key: str, buckets: int) -> DataFrame:
    """One row for ``gate``: ``rows`` of ``staged``, ``held`` of them whose key a stored frame has
    too, ``duplicate_rows`` among themselves, ``passed`` if both are none.

    With stored folders that passed it one by one, this is the uniqueness of the whole
    table's key, without a shuffle of what is stored: the staged rows are dealt into the
    stored folders' ``buckets`` and counted there.
    """
    counts = staged.select(key).repartition(buckets, key).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    for i, held in enumerate(stored):
        keys = held.select(F.col(key).alias(f"__k{i}"))
        counts = counts.join(keys.hint("shuffle_merge"), F.col(key) == F.col(f"__k{i}"), "left")
    found = sum((F.when(F.col(f"__k{i}").isNotNull(), 1).otherwise(0) for i in range(len(stored))), F.lit(0))
    return counts.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(found > 0, F.col("__n"))), F.lit(0)).alias("held"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
    ).withColumn("passed", (F.col("held") == 0) & (F.col("duplicate_rows") == 0))
