"""Helpers shared by the text operators: words, scratch tables, batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

#: ASCII white space, the only characters that separate words.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def strip(col: Column) -> Column:
    """``col`` without white space at both ends."""
    return F.btrim(col, F.lit(WHITE))


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(col, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of characters other than white space; null has none."""
    t = strip(F.coalesce(text, F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(t, r"[\x20\x09-\x0D]+"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row.

    An expression named inside another higher-order function's lambda would
    otherwise be evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BOX = "__box"


def boxed(df: DataFrame, carry: list[str], **needed: Column) -> DataFrame:
    """The columns ``carry`` of ``df`` as one struct beside what an operator needs, so that the
    operator's own names cannot meet the caller's."""
    held = [df[f"`{c}`"] for c in carry] or [F.lit(0).alias("none")]
    return df.select(F.struct(*held).alias(BOX), *[c.alias(n) for n, c in needed.items()])


def unboxed(df: DataFrame, carry: list[str], **found: Column) -> DataFrame:
    """The carried columns as they were, and the operator's results; a result takes the place of a
    column of its name."""
    return df.select(*[F.col(BOX).getField(c).alias(c) for c in carry if c not in found],
                     *[c.alias(n) for n, c in found.items()])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Bound what one Arrow batch sent to a Python worker holds (rows and bytes)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
