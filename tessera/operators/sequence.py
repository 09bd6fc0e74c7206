"""Surrogate keys without collisions: consecutive numbers after the largest one in use.

Rows are ordered by their natural key, written, and numbered by file and place
in the file, so a row's number is its rank: no task holds more than its range, a
retried task gives the same numbers, and so does a rerun from the same snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_dir


class KeySpaceError(Exception):
    """The keys of a load would pass the given limit."""


def largest(dim: DataFrame, sk: str) -> int:
    """The largest key in use, 0 for an empty dimension."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long")).first()[0]


def consecutive_keys(rows: DataFrame, order: list[str], out: str, after: int = 0,
                     limit: int | None = None) -> DataFrame:
    """``rows`` with ``out``: ``after`` + 1, + 2, ... in the order of the columns ``order``.

    ``order`` should tell rows apart (a natural key); otherwise equal rows share their numbers
    in any order. Numbers of ``limit`` or more raise ``KeySpaceError`` before anything is used.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "keys")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    placed = spark.read.schema(rows.schema).parquet(path).select(
        *rows.columns, F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("__file"),
        F.regexp_extract("_metadata.file_name", r"-c(\d+)", 1).alias("__piece"),
        F.col("_metadata.row_index").alias("__row"))
    sizes = placed.groupBy("__file", "__piece").agg(F.count(F.lit(1)).alias("__n"))
    # one row a file
    before = Window.orderBy("__file", "__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("__file").alias("__f"), F.col("__piece").alias("__p"), "__n",
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    if limit is not None:
        n = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        if after + n >= limit:
            raise KeySpaceError(f"{n} new keys after {after} pass the limit {limit}")
    met = placed.join(starts, (F.col("__file") == F.col("__f")) & (F.col("__piece") == F.col("__p")))
    return met.select((F.lit(after) + F.col("__before") + F.col("__row") + 1).cast("long").alias(out),
                      *[c for c in rows.columns if c != out])
