"""SimHash near-dedup with pivot distance tables.

Fingerprints: words of the A-Z lower-cased text, ``shingle`` words at a time,
repeats included; XXH64 (seed 42) of each shingle; a bit is set if it is set in
over half of the hashes. Equal fingerprints are reduced to one row at once.

Pairs at most ``max_bits`` apart: the 64 bits are cut into ``2 * max_bits``
blocks. Two such fingerprints differ in at most ``max_bits`` blocks, so they
agree on at least ``max_bits`` whole blocks, and one of the choices of that
many blocks puts them into one bucket. Within a bucket every fingerprint gets its row of the pivot
table, its Hamming distances to ``PIVOTS`` reference fingerprints. The distance
of two fingerprints is at least the difference of their distances to any
reference, so pairs whose largest coordinate difference exceeds ``max_bits``
are discarded without looking at them; survivors are verified on all 64 bits.
A bucket emits only as many links as join its members (a star for each group
found), never all its pairs. A bucket with more than ``tile`` members is cut into
tiles and each pair of tiles is a task's work of its own, so no member is left
out and no task holds more than two tiles of a bucket.

Defined results: a null or blank text has fingerprint zero and links like any
other; a text with fewer words than ``shingle`` is one shingle; a null doc_id
is never smaller than another id (a group of such rows only has a null
component id); rows that repeat an id keep their own rows; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import BOX, boxed, materialize, python_batches, unboxed
from tessera.llm.components import components, merge_labels

SEED = 42
#: Reference fingerprints of the pivot table.
PIVOTS = np.random.default_rng(64).integers(0, 1 << 64, 16, dtype=np.uint64)
HASHES_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str | None, shingle: int) -> int:
    w = text.encode().lower().split() if text else []
    if not w:
        return 0
    if len(w) < shingle:
        shingles = iter([b" ".join(w)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*[w[k:] for k in range(shingle)], strict=False))
        n = len(w) - shingle + 1
    ones = np.zeros(64, np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    for at in range(0, n, HASHES_AT_ONCE):
        some = hashes[at:at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text",
                 carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the fingerprint as a signed long ``__fp``."""
    carry = docs.columns if carry is None else carry
    python_batches(docs.sparkSession)
    source = docs.select(*carry, docs[text].alias("__text"))
    schema = T.StructType([*docs.select(*carry).schema.fields, T.StructField("__fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(len(carry))),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(got.view(np.int64))],
                names=[*batch.schema.names[:-1], "__fp"])

    return source.mapInArrow(run, schema)


def block_masks(max_bits: int) -> list[int]:
    """For every choice of ``max_bits`` out of ``2 * max_bits`` blocks the bits that it keeps.

    Without any allowed difference the only bucket key is the whole fingerprint.
    """
    if not max_bits:
        return [(1 << 64) - 1]
    n = 2 * max_bits
    edges = [64 * k // n for k in range(n + 1)]
    block = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(n)]
    return [sum(block[k] for k in kept) for kept in combinations(range(n), n - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _verified(fp: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int):
    """Of the pairs (a, b) those within ``max_bits``."""
    near = (np.abs(table[a] - table[b]).max(axis=1) <= max_bits)
    a, b = a[near], b[near]
    near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
    return a[near], b[near]


def bucket_links(bucket: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For members sorted by bucket: each linked member with the first one of its group.

    Pairs are formed by the distance of their places (1, 2, ...), so work is
    proportional to the pairs within buckets and memory to the members.
    """
    n = len(fp)
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    label = np.arange(n)
    places, step = np.arange(n), 1
    found_a, found_b, held = [], [], 0
    while len(places):
        places = places[places + step < n]
        places = places[bucket[places] == bucket[places + step]]
        if not len(places):
            break
        a, b = _verified(fp, table, places, places + step, max_bits)
        found_a.append(a)
        found_b.append(b)
        held += len(a)
        if held >= PAIRS_AT_ONCE:
            merge_labels(label, np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, held = [], [], 0
        step += 1
    if held:
        merge_labels(label, np.concatenate(found_a), np.concatenate(found_b))
    linked = np.flatnonzero(label != np.arange(n))
    return fp[linked], fp[label[linked]]


def links(reps: DataFrame, max_bits: int = 3, tile: int = 4096) -> DataFrame:
    """``(a, b)``: enough links between the distinct ``__fp`` of ``reps`` to join every pair
    within ``max_bits`` bits, each of them such a pair or a chain of such pairs."""
    spark = reps.sparkSession
    masks = block_masks(max_bits)
    keyed = reps.select("__fp", F.posexplode(F.array(
        *[F.col("__fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("__t", "__k"))
    sizes = keyed.groupBy("__t", "__k").count()
    large = materialize(sizes.where(F.col("count") > tile).select(
        F.col("__t").alias("__lt"), F.col("__k").alias("__lk"),
        F.ceil(F.col("count") / tile).cast("int").alias("__tiles")), "simhash-buckets")
    tiles = F.coalesce("__tiles", F.lit(1))
    own = F.pmod(F.xxhash64("__fp"), tiles).cast("int")
    tiled = keyed.join(large, (F.col("__t") == F.col("__lt")) & (F.col("__k") == F.col("__lk")),
                       "left").select("__fp", "__t", "__k", own.alias("__own"), F.explode(
                           F.sequence(F.lit(0), tiles - 1)).alias("__other"))
    spread = tiled.select("__fp", F.xxhash64(
        "__t", "__k", F.least("__own", "__other"), F.greatest("__own", "__other"))
        .alias("__bucket"))
    python_batches(spark, rows=100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_b, rest_f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(bucket, fp):
            a, b = bucket_links(bucket, fp, max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            bucket = np.concatenate([rest_b, batch.column(1).to_numpy()])
            fp = np.concatenate([rest_f, batch.column(0).to_numpy().view(np.uint64)])
            if not len(bucket):
                continue
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            yield out(bucket[:cut], fp[:cut])
            rest_b, rest_f = bucket[cut:], fp[cut:]
        if len(rest_b):
            yield out(rest_b, rest_f)

    return (spread.repartition("__bucket").sortWithinPartitions("__bucket", "__fp")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id",
                    text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``__fp``, ``__component``, the smallest doc_id
    reachable over links of at most ``max_bits`` differing bits (null if none has one), and
    ``__root``, a fingerprint that tells groups apart whatever their ids."""
    carry = docs.columns if carry is None else carry
    own = materialize(fingerprints(
        boxed(docs, carry, __id=docs[doc_id], __body=docs[text]), shingle, "__body", [BOX, "__id"]), "simhash")
    reps = own.groupBy("__fp").agg(F.min("__id").alias("__first"))
    roots = components(links(reps, max_bits), "a", "b")
    grouped = materialize(
        reps.join(roots, F.col("__fp") == F.col("node"), "left")
        .select("__fp", "__first", F.coalesce("root", "__fp").alias("__root")), "simhash-roots")
    firsts = grouped.groupBy("__root").agg(F.min("__first").alias("__component"))
    member = grouped.join(firsts, "__root").select(F.col("__fp").alias("__member"), "__component", "__root")
    return unboxed(own.join(member, F.col("__fp") == F.col("__member")), carry, __fp=F.col("__fp"),
                   __component=F.col("__component"), __root=F.col("__root"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Of each group of near copies the row of the smallest doc_id (one of them where it is
    repeated), with all columns as they were.

    The group's row is chosen by a partial aggregate over ids, so large groups
    cost one row a task; repeated rows are told apart by their place.
    """
    placed = materialize(boxed(docs, docs.columns, place=F.monotonically_increasing_id()), "placed")
    own = placed.select("place", *[F.col(BOX).getField(c).alias(n) for n, c in (("doc_id", doc_id), ("text", text))])
    found = materialize(near_duplicates(own, shingle, max_bits, carry=["doc_id", "place"]), "near")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("place")))
    keep = found.groupBy("__root").agg(first.alias("first")).select(F.col("first.place").alias("kept"))
    return unboxed(placed.join(keep, F.col("place") == F.col("kept")), docs.columns)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
