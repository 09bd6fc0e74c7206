"""Suffix-array dedup: remove every byte of a long string that also starts elsewhere.

A string of ``length`` bytes is found by its anchor, the leftmost of the least
hashed ``K``-byte pieces in it: equal strings have it at the same place, and
one byte in about ``length / 2`` is an anchor. A document is thus a row of
anchors, each with a context: the bytes that the strings around it span. Equal
strings have equal pieces, so contexts are dealt to shards by the piece.

A shard drops contexts that share neither the half string to the right nor the
one to the left of their anchor with another one (either half must be equal in
equal strings), and keeps the others in a logarithmic family of suffix arrays:
a new batch is sorted by the bytes from the anchor on, and by the bytes before
it read backwards; it is merge-scanned with every level, and levels no larger
than it are merged into it, so sizes grow geometrically. A scan walks the two
merged orders with their longest common prefixes. For every offset of the
anchor in the string, contexts that share enough bytes on both sides lie in
one interval of either order, so a pair of intervals with two members is a
string found twice, exactly and without forming pairs.

Equal contexts are one entry with a count, so a passage with any number of
copies is sorted once, and neighbouring anchors of one context (a run of one
byte, a short period) are one record. Only a document's merged spans leave a
shard. Contexts carry the number of
their batch and of the document in it; each batch sends the hashes of its
documents' ids and texts once, and spans are joined to the texts by these.

Defined results: a null text has no bytes; a text shorter than ``length`` keeps
all of them; repeated rows are copies of each other, so both lose what they
share; strings never cross documents; a null doc_id is like any other; an empty
table gives no row. Kept bytes may cut characters and are therefore binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, python_batches, shuffle_partitions

#: Bytes of the piece that is hashed to choose anchors.
K = 16
AT_ONCE = 1 << 18
UNIT_DOCS, UNIT_MB = 4000, 8
LEVEL = 6  # of compression
#: Text bytes whose contexts a shard holds.
SHARD_BYTES = 8 << 20
PLACE_BITS = np.uint64(28)


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``K`` bytes that start at each place."""
    n = len(data) - 7
    eight = np.ndarray((n,), "<u8", data.tobytes(), strides=(1,))
    x = eight[:-8] * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += eight[8:]
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """Anchors of the documents ``data[starts:ends]``: place, first and last string start, hash."""
    h = piece_hashes(data)
    span = length - K + 1  # pieces in a string
    key = (h >> PLACE_BITS << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    low, done = key, 1
    while done < span:
        step = min(done, span - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    first = np.concatenate([np.arange(s, max(s, e - length + 1)) for s, e in zip(
        starts.tolist(), ends.tolist(), strict=True)]) if len(starts) else np.empty(0, np.int64)
    place = (low[first] & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    new = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(new[1:], len(first)) - 1
    at = place[new]
    return at, first[new], first[last[:len(new)]], h[at]


def document_contexts(texts: list[bytes], length: int):
    """Runs of anchors of one context, the distinct contexts and their hashes.

    A run has its document, the place of its first anchor's first string, the distance
    to the last anchor, how many anchors it holds, and the number of its context. A
    context is its bytes and how many of them lie before the anchor. Texts are taken
    in parts of ``AT_ONCE`` string starts; in low-entropy text, where every byte can be
    an anchor, neighbours have the same context and become one run.
    """
    number: dict[tuple[bytes, int], int] = {}
    found, hashes = [], []
    group: list[tuple[int, int, bytes]] = []  # document, place of the part in it, the part
    size = 0

    def flush():
        nonlocal group, size
        if not group:
            return
        data = b"".join(t for _, _, t in group)
        ends = np.cumsum([len(t) for _, _, t in group])
        starts = ends - [len(t) for _, _, t in group]
        at, first, last, h = anchors(np.frombuffer(data, np.uint8), starts, ends, length)
        part = np.searchsorted(starts, first, side="right") - 1
        doc = np.array([k for k, _, _ in group])[part]
        begin = first - starts[part] + np.array([p for _, p, _ in group])[part]
        place = begin + at - first
        known = len(number)
        of = np.fromiter((number.setdefault((data[a:b], n), len(number)) for a, b, n in zip(
            first.tolist(), (last + length).tolist(), (at - first).tolist(), strict=True)), np.int64, len(at))
        new, where = np.unique(of, return_index=True)
        hashes.append(h[where[new >= known]])
        apart = np.diff(place)
        head = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(of) != 0)
                                              | (apart > length)]))[:len(at)]
        tail = np.append(head[1:], len(at)) - 1
        found.append((doc[head], begin[head], place[tail] - place[head], tail - head + 1, of[head]))
        group, size = [], 0

    for k, t in enumerate(texts):
        for p in range(0, len(t) - length + 1, AT_ONCE):
            group.append((k, p, t[p:p + AT_ONCE + length - 1]))
            size += len(group[-1][2])
            if size >= AT_ONCE:
                flush()
    flush()
    runs_of = [np.concatenate(x) for x in zip(*found, strict=True)] or [np.empty(0, np.int64)] * 5
    return *runs_of, list(number), np.concatenate([np.empty(0, np.uint64), *hashes])


class SuffixLevels:
    """A logarithmic family of suffix arrays over anchor contexts."""

    def __init__(self, length: int):
        self.length = length
        self.right: list[bytes] = []   # bytes from the anchor on
        self.left: list[bytes] = []    # bytes before it, backwards
        self.levels: list[tuple[list[int], list[int]]] = []
        self.found = np.zeros((0, length - K + 1), bool)  # by context and offset of the anchor

    def add(self, contexts: list[tuple[bytes, int]]) -> None:
        """A batch of distinct contexts, each with the number of its bytes before the anchor."""
        new = range(len(self.right), len(self.right) + len(contexts))
        self.right += [c[b:] for c, b in contexts]
        self.left += [c[:b][::-1] for c, b in contexts]
        self.found = np.concatenate([self.found, np.zeros((len(contexts), self.length - K + 1), bool)])
        level = (sorted(new, key=self.right.__getitem__), sorted(new, key=self.left.__getitem__))
        self._scan(*level)
        kept = []
        for old in reversed(self.levels):
            both = self._merged(old, level)
            self._scan(*both)
            if len(old[0]) <= len(level[0]):
                level = both
            else:
                kept.append(old)
        self.levels = [*reversed(kept), level]

    def _merged(self, a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]):
        # sorting two sorted runs one after the other is a merge
        return (sorted(a[0] + b[0], key=self.right.__getitem__),
                sorted(a[1] + b[1], key=self.left.__getitem__))

    @staticmethod
    def _common(order: list[int], strings: list[bytes], width: int) -> np.ndarray:
        """Longest common prefix of each string with the one before it in the order."""
        out = np.full(len(order), -1)
        for k in range(1, len(order), 1 << 14):
            some = [strings[i] for i in order[k - 1:k + (1 << 14)]]
            m = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in some), np.uint8
                              ).reshape(len(some), width)
            size = np.array([len(s) for s in some])
            differ = m[1:] != m[:-1]
            common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            out[k:k + len(common)] = np.minimum(common, np.minimum(size[1:], size[:-1]))
        return out

    def _scan(self, forward: list[int], backward: list[int]) -> None:
        """Mark strings found twice among the contexts of two merged orders."""
        if len(forward) < 2:
            return
        n, width = len(forward), self.length - K
        members = np.array(sorted(forward))
        common_right = self._common(forward, self.right, self.length)
        common_left = self._common(backward, self.left, max(width, 1))
        in_forward, in_backward = np.empty(n, np.int64), np.empty(n, np.int64)
        in_forward[np.searchsorted(members, forward)] = np.arange(n)
        in_backward[np.searchsorted(members, backward)] = np.arange(n)
        least = self.length - np.array([len(self.right[i]) for i in members])
        most = np.array([len(self.left[i]) for i in members])
        for d in range(int(least.min()), int(most.max()) + 1):
            here = np.flatnonzero((least <= d) & (d <= most))
            if len(here) < 2 or self.found[members[here], d].all():
                continue
            right = np.cumsum(common_right < self.length - d)[in_forward[here]]
            left = np.cumsum(common_left < d)[in_backward[here]]
            _, of, times = np.unique(right * (n + 1) + left, return_inverse=True, return_counts=True)
            self.found[members[here[times[of] > 1]], d] = True


def _twice(keys: list[bytes]) -> np.ndarray:
    """Whether each key is there more than once."""
    seen: dict[bytes, int] = {}
    of = np.fromiter((seen.setdefault(k, len(seen)) for k in keys), np.int64, len(keys))
    return np.bincount(of, minlength=1)[of] > 1


def shard_found(contexts: list[tuple[bytes, int]], times: np.ndarray, length: int,
                batches: int) -> np.ndarray:
    """For distinct contexts found ``times`` times: by offset, whether the string is found twice."""
    found = np.zeros((len(contexts), length - K + 1), bool)
    half = length // 2
    related = (_twice([c[b:b + half] if len(c) - b >= half else b"\0" + str(k).encode()
                       for k, (c, b) in enumerate(contexts)])
               | _twice([c[b - half:b] if b >= half else b"\0" + str(k).encode()
                         for k, (c, b) in enumerate(contexts)]))
    some = np.flatnonzero(related)
    if len(some):
        family = SuffixLevels(length)
        for part in np.array_split(some, min(batches, len(some))):
            family.add([contexts[k] for k in part])
        found[some] = family.found
    for k in np.flatnonzero(times > 1):
        c, b = contexts[k]
        found[k, length - (len(c) - b):b + 1] = True
    return found


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def merged_spans(unit: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The spans of each document, those that touch as one."""
    if not len(doc):
        return unit, doc, start, end
    order = np.lexsort((start, doc, unit))
    unit, doc, start, end = (x[order] for x in (unit, doc, start, end))
    other = np.concatenate([[True], (np.diff(unit) != 0) | (np.diff(doc) != 0)])
    shift = np.cumsum(other) * (int(end.max()) + 1)
    upto = np.maximum.accumulate(end + shift)
    head = np.flatnonzero(other | np.concatenate([[True], (start + shift)[1:] > upto[:-1]]))
    tail = np.append(head[1:], len(doc)) - 1
    return unit[head], doc[head], start[head], (upto - shift)[tail]


def _pack(*arrays: np.ndarray, blob: bytes) -> bytes:
    head = np.array([len(arrays), *[len(a) for a in arrays]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(
        head + b"".join(a.astype(np.int64).tobytes() for a in arrays) + blob)


def _unpack(data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    out, at = [], 8 * (n + 1)
    for k in np.frombuffer(raw, np.int64, n, 8):
        out.append(np.frombuffer(raw, np.int64, int(k), at))
        at += 8 * int(k)
    return out, raw[at:]


def repeated_spans(rows: DataFrame, length: int, batches: int) -> DataFrame:
    """``(r1, r2, spans)`` from ``(r1, r2, body)``: byte spans of the rows to remove."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-size // SHARD_BYTES))
    python_batches(spark, UNIT_DOCS, UNIT_MB)

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            r1, r2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = [x or b"" for x in batch.column(2).to_pylist()]
            doc, begin, reach, times, of, contexts, piece = document_contexts(texts, length)
            shard = ((piece >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)[of]
            order = np.argsort(shard, kind="stable")
            cut = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
            # equal batches have equal numbers, and equal documents under them
            unit = xxhash.xxh64_intdigest(r1.tobytes() + r2.tobytes()) >> 1
            own = np.unique(doc)
            names = [shards + unit % shards]
            packed = [_pack(np.array([unit]), own, r1[own], r2[own], blob=b"")]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                mine = order[a:b]
                here, own_of = np.unique(of[mine], return_inverse=True)
                held = [contexts[k] for k in here.tolist()]
                names.append(int(shard[mine[0]]))
                packed.append(_pack(
                    np.array([unit]), doc[mine], begin[mine], reach[mine], times[mine], own_of,
                    np.array([n for _, n in held]), np.array([len(c) for c, _ in held]),
                    blob=b"".join(c for c, _ in held)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["shard", "packed"])

    def keys(table: pa.Table) -> pa.Table:
        parts = [_unpack(value.as_py())[0] for value in table["packed"]]
        unit = np.concatenate([np.repeat(u, len(doc)) for u, doc, _, _ in parts])
        doc, r1, r2 = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        none = pa.nulls(len(doc), pa.int64())
        return pa.table([unit, doc, r1, r2, none, none], names=columns)

    def search(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() >= shards:
            return keys(table)
        number: dict[tuple[bytes, int], int] = {}
        rows_of = []
        for value in table["packed"]:
            (unit, doc, begin, reach, many, of, before, sizes), blob = _unpack(value.as_py())
            ends = np.cumsum(sizes)
            own = np.array([number.setdefault((blob[a:b], n), len(number)) for a, b, n in zip(
                (ends - sizes).tolist(), ends.tolist(), before.tolist(), strict=True)])
            rows_of.append((np.repeat(unit, len(doc)), doc, begin, reach, many, own[of]))
        unit, doc, begin, reach, many, of = (np.concatenate(x) for x in zip(*rows_of, strict=True))
        contexts = list(number)
        times = np.zeros(len(contexts), np.int64)
        np.add.at(times, of, many)
        found = shard_found(contexts, times, length, batches)
        spans = [(k, contexts[k][1] - b, contexts[k][1] - a + length)
                 for k in np.flatnonzero(found.any(axis=1)).tolist() for a, b in runs(found[k])]
        context, start, end = np.array(spans, np.int64).reshape(-1, 3).T
        # every run with every span of its context; a run's anchors are at most a string apart
        low, high = np.searchsorted(context, of), np.searchsorted(context, of, side="right")
        row = np.repeat(np.arange(len(of)), high - low)
        span = np.arange(len(row)) + np.repeat(low - np.cumsum(high - low) + high - low, high - low)
        unit, doc, start, end = merged_spans(
            unit[row], doc[row], begin[row] + start[span], begin[row] + reach[row] + end[span])
        none = pa.nulls(len(doc), pa.int64())
        return pa.table([unit, doc, none, none, start, end], names=columns)

    columns = ["unit", "doc", "r1", "r2", "start", "end"]
    found = rows.mapInArrow(deal, "shard long, packed binary").groupBy("shard").applyInArrow(
        search, ", ".join(f"{c} long" for c in columns))
    spans = found.groupBy("unit", "doc").agg(
        F.max("r1").alias("r1"), F.max("r2").alias("r2"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "end"))).alias("spans")
    ).where(F.size("spans") > 0)
    # repeated rows have the same spans
    return spans.groupBy("r1", "r2").agg(F.any_value("spans").alias("spans"))


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without the spans, and the maximal spans."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    kept, at = [], 0
    for a, b in merged:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), merged


def dedup(docs: DataFrame, length: int = 200, batches: int = 4, doc_id: str = "doc_id",
          text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``__bytes`` (of the text), ``__spans`` (maximal removed
    spans) and ``__kept`` (the remaining bytes)."""
    if length < 2 * K:
        raise ValueError(f"length must be at least {2 * K}")
    carry = docs.columns if carry is None else carry
    key = [F.xxhash64(docs[doc_id].cast("string"), docs[text]).alias("r1"),
           F.xxhash64(F.lit(1), docs[doc_id].cast("string"), docs[text]).alias("r2")]
    body = F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8").alias("body")
    spans = materialize(repeated_spans(docs.select(*key, body), length, batches), "repeats")
    joined = docs.select(*carry, *[k.alias(f"__{n}") for k, n in zip(key, ("r1", "r2"), strict=True)],
                         body.alias("__body")).join(
        spans.toDF("__s1", "__s2", "__found"),
        (F.col("__r1") == F.col("__s1")) & (F.col("__r2") == F.col("__s2")), "left").select(
        *carry, "__body", "__found")
    python_batches(docs.sparkSession)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.select(*carry).schema.fields, T.StructField("__bytes", T.LongType()),
                           T.StructField("__spans", span), T.StructField("__kept", T.BinaryType())])

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = batch.column(len(carry)).to_pylist()
            done = [without(t, [(x["start"], x["end"]) for x in s or ()])
                    for t, s in zip(texts, batch.column(len(carry) + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(carry)], pa.array([len(t) for t in texts], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in m] for _, m in done],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([k for k, _ in done], pa.binary())], names=schema.names)

    return joined.mapInArrow(remove, schema)
