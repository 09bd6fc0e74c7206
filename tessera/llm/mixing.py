"""Mixing sources to target weights.

Word counts are aggregated per source, a target is set for every source, and
each document is emitted ``floor(rate)`` times plus one more copy with
probability ``rate - floor(rate)``, where ``rate`` is its source's target over
its source's size. The extra copy is a Bernoulli draw seeded by a hash of the
document's id and text, so a rerun or a retried task takes the same copies.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ...
and share the corpus size by weight. A target stops at ``cap`` times its
source's size; the excess is shared among the others by weight until none is
above its cap. Only one-row sums reach the driver: the per-source table stays
distributed, whatever the number of sources.

Defined results: a null or blank text has size 0; a null source is a source of
its own; a source without any word has target 0 and its documents are emitted
once; rows without an id, or with one that others have too, draw by their text, and
rows of equal id and text draw alike; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BOX, boxed, materialize, n_words, unboxed

SIZE, SOURCE_SIZE, TARGET, COPIES = "__mix_size", "__mix_source_size", "__mix_target", "__mix_copies"


def _ranked(per: DataFrame, source: str) -> DataFrame:
    """``per`` with ``__rank``, its place in code point order, without one global task.

    A range-partitioned, sorted copy is written; a row's place is its place in
    its partition plus the rows of the partitions before (one count a partition).
    """
    order = F.col(source).asc_nulls_last()
    placed = materialize(
        per.repartitionByRange(order).sortWithinPartitions(order)
        .withColumn("__at", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("__at", 33)
    before, offsets = 0, []
    for pid, n in sorted(placed.groupBy(part.alias("p")).count().collect()):
        offsets += [F.lit(pid), F.lit(before)]
        before += n
    if not offsets:
        return placed.withColumn("__rank", F.lit(0).cast("long")).drop("__at")
    return placed.withColumn(
        "__rank", F.create_map(*offsets)[part] + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("__at")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0,
                   source: str = "source") -> DataFrame:
    """``(source, __mix_source_size, __mix_target)`` for rows with a ``__mix_size``."""
    per = sized.groupBy(source).agg(F.sum(SIZE).alias(SOURCE_SIZE))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("__rank"), F.lit(len(weights))) + 1).cast("int"))
    per = materialize(_ranked(per, source).select(
        source, SOURCE_SIZE, w.alias("__w"), (F.col(SOURCE_SIZE) * cap).alias("__cap")),
        "mix-sources")
    total = per.agg(F.sum(SOURCE_SIZE)).first()[0] or 0
    level, filled = 0.0, -1
    while total:  # a round caps one more source at least, in practice a few rounds do
        full = F.col("__cap") <= F.lit(level) * F.col("__w")
        n, capped, free = per.agg(
            F.sum(full.cast("long")), F.sum(F.when(full, F.col("__cap")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("__w")))).first()
        if n == filled or not free:
            break
        filled, level = n, (total - capped) / free
    return per.select(source, SOURCE_SIZE,
                      F.least("__cap", F.lit(float(level)) * F.col("__w")).alias(TARGET))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A uniform number in [0, 1) from a hash of the id and the text."""
    key = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def assign_copies(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0,
                  seed: str = "mix:", doc_id: str = "doc_id", text: str = "text",
                  source: str = "source", salts: int = 32,
                  carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) plus size, source size, target and copies.

    The per-source table is joined on (source, salt), each row repeated once a
    salt, so a source with a third of all rows still spreads over ``salts``
    tasks; Spark broadcasts the table instead where its size allows.
    """
    carry = docs.columns if carry is None else carry
    left = boxed(docs, carry, src=docs[source], size=n_words(docs[text]),
                 salt=F.pmod(F.xxhash64(docs[doc_id], docs[text]), F.lit(salts)).cast("int"),
                 draw=draw(docs[doc_id], docs[text], seed))
    targets = source_targets(left.select("src", F.col("size").alias(SIZE)), weights, cap, "src")
    right = targets.withColumnRenamed("src", "of").withColumn(
        "rsalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rate = F.when(F.col(SOURCE_SIZE) > 0, F.col(TARGET) / F.col(SOURCE_SIZE)).otherwise(1.0)
    out = left.join(right, F.col("src").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("rsalt")))
    copies = F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")
    return unboxed(out, carry, **{SIZE: F.col("size"), SOURCE_SIZE: F.col(SOURCE_SIZE),
                                  TARGET: F.col(TARGET), COPIES: copies.cast("long")})


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its source's rate asks for, with all of
    its columns as they were."""
    own = boxed(docs, docs.columns, doc_id=docs[doc_id], text=docs[text], source=docs[source])
    counted = assign_copies(own, carry=[BOX], **options)
    copies = F.array_repeat(F.lit(1), F.col(COPIES).cast("int"))
    return unboxed(counted.select(BOX, F.explode(copies)), docs.columns)
