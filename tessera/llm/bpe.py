"""Byte-level BPE encoding and decoding with a given vocabulary.

A text is cut into pieces by the vocabulary's pattern and each piece is merged
on its own. A segment tree over the piece's byte positions holds, for every
live position, the rank of the pair it forms with its next live neighbour; the
root is the leftmost pair of least rank. A merge updates three leaves (the
merged position, the swallowed one, the neighbour before), so a piece of n
bytes takes O(n log n) steps however long it is. The trees of many short pieces
are kept as rows of one array and merged side by side (``merge_many``). Pieces
repeat, so each task keeps the ids of pieces seen lately in a bounded table.

The vocabulary file is read once by the driver and sent as bytes (its size is
fixed and checked); ids travel packed as little-endian unsigned 32-bit integers.

Defined results: a null text encodes like an empty one, to no ids; an id
outside the vocabulary is an error when decoding, null ids decode to no bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import python_batches

#: A vocabulary file above this size is refused, as every worker holds it.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pieces whose ids a task remembers, twice this number and a batch's pieces at most.
REMEMBERED = 150_000
#: Longer pieces are not remembered.
KEPT = 64
FREE = 1 << 62


def load_vocabulary(path: str) -> bytes:
    """The bytes of a file with one base64 token and its rank a line."""
    data = Path(path).read_bytes()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary of {len(data)} bytes; at most {MAX_VOCABULARY_BYTES}")
    return data


def parse_vocabulary(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    shift = n.bit_length()
    here = (1 << shift) - 1
    half = 1 << (n - 1).bit_length()
    tree = [FREE] * (2 * half)  # leaf: rank and position in one number, so least means leftmost
    end = list(range(1, n + 1))  # where the symbol that starts here ends
    before = list(range(-1, n - 1))  # where the symbol before starts
    rank = ranks.get
    for i in range(n - 1):
        if (r := rank(piece[i:i + 2])) is not None:
            tree[half + i] = r << shift | i
    for k in range(half - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while tree[1] != FREE:
        i = tree[1] & here
        j = end[i]
        stop = end[i] = end[j]
        r = None
        if stop < n:
            before[stop] = i
            r = rank(piece[i:end[stop]])
        tree[half + i] = FREE if r is None else r << shift | i
        tree[half + j] = FREE
        p = before[i]
        if p >= 0:
            r = rank(piece[p:stop])
            tree[half + p] = FREE if r is None else r << shift | p
        else:
            p = i
        # the ancestors of the three leaves, level by level; close leaves soon share theirs
        x, y, z = (half + p) >> 1, (half + i) >> 1, (half + j) >> 1
        while x:
            a, b = tree[2 * x], tree[2 * x + 1]
            tree[x] = a if a < b else b
            if y != x:
                a, b = tree[2 * y], tree[2 * y + 1]
                tree[y] = a if a < b else b
            if z != y:
                a, b = tree[2 * z], tree[2 * z + 1]
                tree[z] = a if a < b else b
            x, y, z = x >> 1, y >> 1, z >> 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """Ranks by token, and the same as arrays: which two symbols merge into which, and the
    tokens' bytes one after another."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.has_all_bytes = bool((self.bytes >= 0).all())
        size = max(ranks.values(), default=0) + 1
        self.width = size.bit_length()
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << self.width | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in keys.tolist()] + [0], np.int64)
        self.pairs = np.append(keys, FREE)
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.text = np.frombuffer(b"".join(tokens), np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that two symbols merge into, -1 where they do not."""
        key = left << self.width | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.merged[at], -1)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of texts that have ``sizes`` ids each."""
        if len(ids) and (int(ids.max()) >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        n = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        plain = self.text[np.repeat(self.starts[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        at = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [plain[a:b] for a, b in zip(at, at[1:])]


#: Pieces of up to this many bytes are merged side by side, longer ones each on its own.
SIDE_BY_SIDE = 64


def merge_many(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The packed ids of pieces, as ``merge`` finds them."""
    out: list[bytes] = [b""] * len(pieces)
    classes: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        whole = vocabulary.ranks.get(piece)
        if whole is not None:
            out[k] = struct.pack("<I", whole)
        elif 1 < len(piece) <= SIDE_BY_SIDE and vocabulary.has_all_bytes:
            classes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(k)
        else:
            ids = merge(piece, vocabulary.ranks)
            out[k] = struct.pack(f"<{len(ids)}I", *ids)
    for half, chosen in classes.items():
        for first in range(0, len(chosen), 1 << 14):
            some = chosen[first:first + (1 << 14)]
            for k, ids in zip(some, _merge_class([pieces[k] for k in some], half, vocabulary)):
                out[k] = ids
    return out


def _merge_class(pieces: list[bytes], half: int, vocabulary: Vocabulary) -> list[bytes]:
    """``merge`` for pieces of up to ``half`` bytes, a power of two: a row of each array is a piece."""
    count, shift, here = len(pieces), half.bit_length() - 1, half - 1
    n = np.array([len(p) for p in pieces], np.int64)
    padded = np.frombuffer(b"".join(p.ljust(half, b"\0") for p in pieces), np.uint8).reshape(count, half)
    symbol = vocabulary.bytes[padded]
    place = np.arange(half)
    live = place < n[:, None]
    tree = np.full((count, 2 * half), FREE, np.int64)
    rank = vocabulary.rank_of(symbol[:, :-1], symbol[:, 1:])
    pair = (rank >= 0) & live[:, 1:]
    tree[:, half:2 * half - 1][pair] = (rank << shift | place[:-1])[pair]
    level = half
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    after = np.broadcast_to(np.arange(1, half + 1), (count, half)).copy()  # the next live place
    before = np.broadcast_to(np.arange(-1, half), (count, half + 1)).copy()
    rows = np.flatnonzero(tree[:, 1] != FREE)
    while len(rows):
        least = tree[rows, 1]
        i = least & here
        symbol[rows, i] = least >> shift
        j = after[rows, i]
        stop = np.where(j < half, after[rows, np.minimum(j, here)], half)
        after[rows, i] = stop
        before[rows, stop] = i
        live[rows, j] = False
        inside = stop < n[rows]
        rank = vocabulary.rank_of(symbol[rows, i], symbol[rows, np.minimum(stop, here)])
        tree[rows, half + i] = np.where(inside & (rank >= 0), rank << shift | i, FREE)
        tree[rows, half + j] = FREE
        p = before[rows, i]
        first = p < 0
        p = np.where(first, i, p)
        rank = vocabulary.rank_of(symbol[rows, p], symbol[rows, i])
        tree[rows, half + p] = np.where(first, tree[rows, half + i],
                                        np.where(rank >= 0, rank << shift | p, FREE))
        x, y, z = (half + p) >> 1, (half + i) >> 1, (half + j) >> 1
        for _ in range(shift):
            for node in (x, y, z):
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            x, y, z = x >> 1, y >> 1, z >> 1
        rows = rows[tree[rows, 1] != FREE]
    packed = symbol[live].astype("<u4").tobytes()
    at = (np.concatenate([[0], np.cumsum(live.sum(axis=1))]) * 4).tolist()
    return [packed[a:b] for a, b in zip(at, at[1:])]


class Pieces(dict):
    """Packed ids by piece, in two generations: when the young one holds ``room`` pieces it becomes
    the old one, and the old one goes; a piece met again moves to the young one, so
    frequent pieces stay. A batch of texts adds its distinct pieces at once.
    """

    def __init__(self, vocabulary: Vocabulary | dict[bytes, int], room: int = REMEMBERED):
        self.vocabulary = vocabulary if isinstance(vocabulary, Vocabulary) else Vocabulary(vocabulary)
        self.room, self.old = room, {}

    def __missing__(self, piece: str) -> bytes:
        return self.encode([[piece]])[0]

    def encode(self, split: list[list[str]]) -> list[bytes]:
        """The packed ids of texts that are given as their pieces; a piece that is not known is
        merged once, and only short ones are kept."""
        distinct = set().union(*split)
        missing = distinct.difference(self)
        if len(self) >= self.room and any(len(p) <= KEPT for p in missing):
            self.old, missing = dict(self), distinct
            self.clear()
        new = []
        for piece in missing:
            packed = self.old.get(piece)
            if packed is None:
                new.append(piece)
            else:
                self[piece] = packed
        self.update(zip(new, merge_many([p.encode() for p in new], self.vocabulary)))
        get = self.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in split]
        for piece in new:
            if len(piece) > KEPT:
                del self[piece]
        return out


@lru_cache(maxsize=2)
def _vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary(parse_vocabulary(data))


def encode(df: DataFrame, vocabulary: bytes, pattern: str, text: str = "text",
           ids: str = "ids", carry: list[str] | None = None, decoded: str | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) with the packed ids of ``text`` as binary ``ids``, and, if
    named, ``decoded``, the bytes that ``decode`` makes of those ids, in the same pass. Both take the
    place of a column of their name."""
    new = [ids] if decoded is None else [ids, decoded]
    carry = [c for c in (df.columns if carry is None else carry) if c not in new]
    spark = df.sparkSession
    python_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)
    source = df.select(*carry, df[text].alias("__bpe_text"))
    schema = T.StructType([*df.select(*carry).schema.fields, *[T.StructField(c, T.BinaryType()) for c in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of this task only: an idle worker keeps none
        own = _vocabulary(sent.value)
        pieces, find = Pieces(own), regex.compile(pattern).findall
        for batch in batches:
            packed = pieces.encode([find(x) if x else [] for x in batch.column(len(carry)).to_pylist()])
            found = [packed]
            if decoded is not None:
                found.append(_decoded(packed, own))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(x, pa.binary()) for x in found]],
                names=[*batch.schema.names[:-1], *new])

    return source.mapInArrow(run, schema)


def _decoded(packed: list[bytes | None], vocabulary: Vocabulary) -> list[bytes]:
    known = [p or b"" for p in packed]
    return vocabulary.decode(np.frombuffer(b"".join(known), "<u4"),
                             np.array([len(p) >> 2 for p in known], np.int64))


def decode(df: DataFrame, vocabulary: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the packed ids stand for as binary ``out``, which takes the
    place of a column of that name."""
    spark = df.sparkSession
    df = df.drop(out) if out in df.columns else df
    python_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _vocabulary(sent.value)
        for batch in batches:
            plain = _decoded(batch.column(at).to_pylist(), own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(plain, pa.binary())],
                                             names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)
