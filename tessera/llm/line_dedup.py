"""Line dedup over levelled sorted runs of line hashes.

Documents arrive in batches, those with the largest ids first. A batch's lines
are reduced to one row per key and document; the batch is anti-joined with the
runs written so far, which tells the keys never seen before: the batch's
largest id holding such a key is the key's keeper for good, since later batches
hold smaller ids only. The batch then adds its own run: hash, documents, and
the keeper where the key is new. Runs are hash-partitioned and sorted; as soon
as a level holds ``fanout`` runs they are merged into one run of the next level,
so ``b`` batches leave a logarithmic number of runs and each row is rewritten a
logarithmic number of times. Keys that the runs count in ``min_docs`` documents
or more lose all their lines except in the keeper.

A key is the line, white space stripped at both ends and A-Z lower-cased;
shorter ones than ``min_chars`` code points never count. Keys travel as two
independent 64-bit hashes.

Defined results: a null text is one empty line; documents are told apart by
doc_id, so rows that repeat an id count once and share its decisions; a null
doc_id is one document, before all others; equal lines of one document stay or
go together; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, boxed, let, materialize, strip, unboxed

KEY = ["__h1", "__h2"]
#: A key in more than ``1 / HEAVY`` of all line occurrences is joined by broadcast.
HEAVY = 1000


def line_keys(text: Column, min_chars: int) -> Column:
    """For every line of the text a struct of two hashes, null where it is too short."""
    def key(line: Column) -> Column:
        return let(strip(line), lambda s: F.when(
            F.length(s) >= min_chars,
            F.struct(F.xxhash64(s).alias("__h1"), F.xxhash64(F.lit(1), s).alias("__h2"))))

    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n"), key)


class LineRuns:
    """The levelled runs: ``(__h1, __h2, __n, __keeper)``, sorted by hash within a partition."""

    def __init__(self, fanout: int = 4):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        out = runs[0] if runs else None
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    @staticmethod
    def _sorted(df: DataFrame, name: str) -> DataFrame:
        return materialize(df.repartition(*KEY).sortWithinPartitions(*KEY), name)

    def add(self, batch: DataFrame) -> None:
        """``batch``: ``(__h1, __h2, __n, __last)``, one row a key."""
        runs = self.all()
        new = batch.withColumn("__keeper", F.struct(F.col("__last").alias("id")))
        if runs is not None:
            seen = runs.where(F.col("__keeper").isNotNull()).select(*KEY).withColumn(
                "__seen", F.lit(True))
            new = new.join(seen, KEY, "left").withColumn(
                "__keeper", F.when(F.col("__seen").isNull(), F.col("__keeper")))
        run = self._sorted(new.select(*KEY, "__n", "__keeper"), "line-run")
        level = 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            union, self.levels[level] = self.levels[level], []
            merged = union[0]
            for r in union[1:]:
                merged = merged.unionByName(r)
            run = self._sorted(self._summed(merged), "line-run")
            level += 1

    @staticmethod
    def _summed(runs: DataFrame) -> DataFrame:
        return runs.groupBy(*KEY).agg(F.sum("__n").alias("__n"),
                                      F.max("__keeper").alias("__keeper"))

    def frequent(self, min_docs: int) -> DataFrame | None:
        """``(__h1, __h2, __n, __keeper)`` of the keys found in ``min_docs`` documents or more."""
        runs = self.all()
        return None if runs is None else self._summed(runs).where(F.col("__n") >= min_docs)


def _batch_bounds(ids: DataFrame, doc_id: str, batches: int) -> list:
    """Ids that cut the documents into about equal batches (none if there are no rows)."""
    cut = ids.agg(F.percentile_approx(doc_id, [k / batches for k in range(1, batches)], 1000)
                  ).first()[0] if batches > 1 else None
    return sorted(set(cut or []))


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4,
                  fanout: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(__id, __row, __drop)``: for documents that lose lines, the places of those lines.

    ``__row``, a hash of the text, tells rows with one id and different texts apart.
    """
    occurrences = materialize(
        docs.select(docs[doc_id].alias("__id"), F.xxhash64(docs[text]).alias("__row"),
                    F.posexplode(line_keys(docs[text], min_chars)).alias("__at", "__key"))
        .where(F.col("__key").isNotNull()).select("__id", "__row", "__at", "__key.*"),
        "line-keys")
    bounds = _batch_bounds(docs.select(doc_id), doc_id, batches)
    runs = LineRuns(fanout)
    edges = [None, *bounds, None]
    for low, high in reversed(list(zip(edges[:-1], edges[1:], strict=True))):
        part = occurrences
        if low is not None:
            part = part.where(F.col("__id") > F.lit(low))
        if high is not None:  # the batch of the smallest ids holds the null id as well
            at_most = F.col("__id") <= F.lit(high)
            part = part.where(at_most | F.col("__id").isNull() if low is None else at_most)
        # one row a key and document first: a line that is everywhere spreads over its documents
        per_doc = part.groupBy(*KEY, "__id").agg(F.lit(1).alias("__one"))
        runs.add(per_doc.groupBy(*KEY).agg(F.count(F.lit(1)).alias("__n"),
                                           F.max("__id").alias("__last")))
    # fewer than HEAVY keys can have such a share of the occurrences, so their list can be
    # broadcast, and no line, however common, meets in one task
    frequent = materialize(runs.frequent(min_docs), "line-frequent")
    is_heavy = F.col("__n") * HEAVY > F.lit(occurrences.count())
    heavy = F.broadcast(frequent.where(is_heavy).drop("__n"))
    others = occurrences.join(heavy.select(*KEY), KEY, "left_anti").join(
        frequent.where(~is_heavy).drop("__n"), KEY)
    hit = occurrences.join(heavy, KEY).unionByName(others).where(
        ~F.col("__id").eqNullSafe(F.col("__keeper.id")))
    return hit.groupBy("__id", "__row").agg(F.collect_set("__at").alias("__drop"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4,
                fanout: int = 4, doc_id: str = "doc_id", text: str = "text",
                carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``__lines``, ``__dropped`` and ``__kept``, the
    text without the dropped lines."""
    carry = docs.columns if carry is None else carry
    drop = dropped_lines(docs, min_chars, min_docs, batches, fanout, doc_id, text)
    left = boxed(docs, carry, own=docs[doc_id], own_row=F.xxhash64(docs[text]),
                 body=F.coalesce(docs[text], F.lit("")))
    out = left.join(drop, F.col("own").eqNullSafe(F.col("__id"))
                    & (F.col("own_row") == F.col("__row")), "left")
    kept = let(F.split("body", "\n"), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__drop")),
        lambda i: F.get(x, i)), "\n"))
    n = F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1
    return unboxed(out, carry, __lines=n.cast("long"),
                   __dropped=F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
                   __kept=F.when(F.col("__drop").isNull(), F.col("body")).otherwise(kept))
