"""Embedding near-dedup by int8 tile products with error bounds.

Vectors are compared within a label only (the caller's partition column).
Exact copies are reduced to one row with a count. The rows of a label are cut
into tiles of about ``tile`` vectors and every pair of tiles is one group, so a
label of any size spreads over many tasks and none holds more than two tiles.

In a group every vector is scaled to length one and quantised to int8 with its
own step; the length of what quantisation loses is kept with it. The product of
two quantised vectors, exact in integers, differs from the true cosine by at
most ``|s q_a| |e_b| + |e_a|`` (e: what is lost), so pairs below the threshold by
more than that are done with; only the others are computed again from the
original components in double precision.

A group returns, for each linked vector, how many rows it links to and the
first vector of its local component, never the pairs themselves.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, or has a null label, links with nothing and is its own
component; vectors of different lengths never link; rows repeating a vec_id
are vectors of their own for counts; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.components import components, merge_labels

#: Longest run of components whose int8 products sum exactly in single precision.
EXACT = (1 << 24) // (127 * 127)
#: Covers the rounding of the bounds themselves.
SLACK = 1e-5
PAIRS_AT_ONCE = 1 << 15
ROWS_AT_ONCE = 512


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, steps, lengths of the codes' vectors, and lengths of the losses."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    step = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / step[:, None]).astype(np.int8)
    back = codes * step[:, None]
    return codes, step, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT):
        out += a[:, k:k + EXACT].astype(np.float32) @ b[:, k:k + EXACT].astype(np.float32).T
    return out


def cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    norm = np.linalg.norm(x, axis=1)
    for k in range(0, len(a), PAIRS_AT_ONCE):
        i, j = a[k:k + PAIRS_AT_ONCE], b[k:k + PAIRS_AT_ONCE]
        out[k:k + PAIRS_AT_ONCE] = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j])
    return out


def linked_pairs(x: np.ndarray, first: np.ndarray, second: np.ndarray, threshold: float):
    """Batches of pairs (i, j), i in ``first`` and j in ``second``, with cosine at or above the
    threshold; each unordered pair once when both are the same."""
    codes, step, length, loss = quantise(x)
    same = first is second
    for k in range(0, len(first), ROWS_AT_ONCE):
        i = first[k:k + ROWS_AT_ONCE]
        bound = integer_products(codes[i], codes[second])
        bound *= step[i][:, None] * step[second][None, :]
        bound += length[i][:, None] * loss[second][None, :] + loss[i][:, None]
        r, c = np.nonzero(bound >= threshold - SLACK)
        a, b = i[r], second[c]
        if same:
            a, b = a[a < b], b[a < b]
        near = cosines(x, a, b) >= threshold
        yield a[near], b[near]


def tile_links(node: np.ndarray, own: np.ndarray, n: np.ndarray, x: np.ndarray,
               threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with links, the rows each links to, and the first node of its local component."""
    low = own.min()
    first = np.flatnonzero(own == low)
    second = np.flatnonzero(own != low)
    label, count = np.arange(len(node)), np.zeros(len(node), np.int64)
    for a, b in linked_pairs(x, first, second if len(second) else first, threshold):
        np.add.at(count, a, n[b])
        np.add.at(count, b, n[a])
        merge_labels(label, a, b)
    hit = np.flatnonzero(count)
    return node[hit], count[hit], node[label[hit]]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile: int = 2048,
                    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    carry: list[str] | None = None) -> DataFrame:
    """``vectors`` (or its columns ``carry``) with ``__links`` and ``__component``."""
    carry = vectors.columns if carry is None else carry
    e = F.col(embedding).cast("array<double>")
    finite = F.forall(e, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    usable = F.coalesce(F.col(label).isNotNull() & finite & F.exists(e, lambda v: v != 0),
                        F.lit(False))
    own = vectors.select(*carry, F.col(vec_id).alias("__id"), F.when(usable, e).alias("__e"),
                         F.col(label).alias("__label")).withColumns(
        {"__h1": F.when(F.col("__e").isNotNull(), F.xxhash64("__label", "__e")),
         "__h2": F.when(F.col("__e").isNotNull(), F.xxhash64(F.lit(1), "__label", "__e"))})
    reps = materialize(
        own.where(F.col("__e").isNotNull()).groupBy("__h1", "__h2").agg(
            F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"),
            F.any_value("__label").alias("__label"), F.any_value("__e").alias("__e"))
        .withColumns({"__node": F.monotonically_increasing_id(), "__dim": F.size("__e")}),
        "vectors")
    sizes = materialize(reps.groupBy(F.col("__label").alias("__l"), F.col("__dim").alias("__d"))
                        .agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("__tiles")),
                        "labels")
    mine = F.pmod(F.xxhash64("__node"), F.col("__tiles")).cast("int")
    tiled = reps.join(sizes, (F.col("__label") == F.col("__l")) & (F.col("__dim") == F.col("__d"))
                      ).select("__label", "__dim", "__node", "__n", "__e", mine.alias("__own"),
                               F.explode(F.sequence(F.lit(0), F.col("__tiles") - 1)).alias("__other"))
    tiled = tiled.withColumns({"__low": F.least("__own", "__other"),
                               "__high": F.greatest("__own", "__other")}).drop("__other")

    def run(table: pa.Table) -> pa.Table:
        flat = table["__e"].combine_chunks().flatten().to_numpy()
        x = flat.reshape(table.num_rows, -1)
        node, links, root = tile_links(table["__node"].to_numpy(), table["__own"].to_numpy(),
                                       table["__n"].to_numpy(), x, threshold)
        return pa.table({"node": node, "links": links, "root": root})

    found = materialize(tiled.groupBy("__label", "__dim", "__low", "__high").applyInArrow(
        run, "node long, links long, root long"), "vector-links")
    counts = found.groupBy(F.col("node").alias("__c")).agg(F.sum("links").alias("__sum"))
    roots = components(found, "node", "root")
    grouped = materialize(
        reps.join(roots, F.col("__node") == F.col("node"), "left")
        .join(counts, F.col("__node") == F.col("__c"), "left")
        .select(F.col("__h1").alias("__k1"), F.col("__h2").alias("__k2"), "__first",
                (F.coalesce("__sum", F.lit(0)) + F.col("__n") - 1).alias("__links"),
                F.coalesce("root", "__node").alias("__root")), "vector-groups")
    firsts = grouped.groupBy("__root").agg(F.min("__first").alias("__component"))
    member = grouped.join(firsts, "__root").drop("__root", "__first")
    return own.join(member, (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2")),
                    "left").select(
        *carry, F.coalesce("__links", F.lit(0)).cast("long").alias("__links"),
        F.coalesce("__component", "__id").alias("__component"))
