"""Runs: stretches of words that repeat with a period, and texts with the repeats taken out.

A run is a maximal stretch of consecutive words with smallest period q (words q
apart are the same) that holds at least ``exponent`` periods and ``least`` words.

Every run holds a Lyndon root: a Lyndon word of length q that, under the order of
the words or its reverse, is the longest Lyndon word starting at its place. So
for both orders the longest Lyndon word at each place is found by the first
phase of a grouping suffix sorter (``lyndon_lengths``): suffixes lie in groups by
the prefix known so far, groups are taken in descending order, and each suffix of
the group joins its prefix to that of the nearest suffix to its left that is in
a lower group; a group's prefix is final, and a Lyndon word, when it is taken.
Each Lyndon root is extended to both sides by the longest common extension of its
two ends; what is long enough is a run.

Before that, stretches that cannot hold a run are left out: each three
consecutive words inside a run occur at least ``exponent - 1`` times in it, so
only stretches of words that lie in such triples are looked at. Triples are
counted by hash, which can only leave a stretch in that holds nothing.

Nothing is shuffled: a text's runs need that text only. A task holds one Arrow
batch of texts, whose bytes are bounded, or one longer text.

Defined results: null and empty texts have no words, no runs and an empty
collapsed text; rows are independent, so repeated rows and ids do no harm; a
column named like an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import python_batches

RUN = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False),
                                T.StructField("length", T.LongType(), False),
                                T.StructField("period", T.LongType(), False)]), False)


def lyndon_lengths(w: list[int]) -> list[int]:
    """For each place of ``w`` the length of the longest Lyndon word that starts there."""
    n = len(w)
    first: dict[int, list[int]] = {}
    for i, c in enumerate(w):
        first.setdefault(c, []).append(i)
    members = [first[c] for c in sorted(first)]  # by group, ascending places; some may have left
    lower = list(range(-1, len(members) - 1))
    upper = list(range(1, len(members) + 1))
    group = [0] * n
    for g, places in enumerate(members):
        for i in places:
            group[i] = g
    length = [1] * n
    # left[i + 1] leads to the nearest place at or before i whose group is not taken yet
    # (+ 1; 0: none)
    left = list(range(n + 1))
    g = len(members) - 1
    while g >= 0:
        places = [i for i in members[g] if group[i] == g]
        for i in places:
            left[i + 1] = i
        joined: dict[int, int] = {}
        for i in places:
            x = i
            while (y := left[x]) != x:
                left[x] = x = left[y]
            if x:
                joined[x - 1] = joined.get(x - 1, 0) + 1
                length[x - 1] = i + length[i] - x + 1
        # places joined by more members of this group are greater than those joined by fewer
        moved: dict[int, dict[int, list[int]]] = {}
        for j, count in joined.items():
            moved.setdefault(group[j], {}).setdefault(count, []).append(j)
        for old, by_count in moved.items():
            for count in sorted(by_count, reverse=True):
                new = len(members)
                members.append(by_count[count])
                above = upper[old]
                lower.append(old)
                upper.append(above)
                upper[old] = lower[above] = new
                for j in by_count[count]:
                    group[j] = new
        g = lower[g]
    return length


def common_right(raw: bytes, x: int, y: int, n: int) -> int:
    """How many 4-byte values from ``x`` on equal those from ``y`` > ``x`` on."""
    k, step = 0, 8
    while y + k < n:
        m = min(step, n - y - k)
        if raw[4 * (x + k):4 * (x + k + m)] == raw[4 * (y + k):4 * (y + k + m)]:
            k += m
            step *= 2
            continue
        while m > 1:
            half = m // 2
            if raw[4 * (x + k):4 * (x + k + half)] == raw[4 * (y + k):4 * (y + k + half)]:
                k += half
                m -= half
            else:
                m = half
        break
    return k


def common_left(raw: bytes, x: int, y: int) -> int:
    """How many 4-byte values before ``x`` equal those before ``y`` > ``x``."""
    k, step = 0, 8
    while x - k > 0:
        m = min(step, x - k)
        if raw[4 * (x - k - m):4 * (x - k)] == raw[4 * (y - k - m):4 * (y - k)]:
            k += m
            step *= 2
            continue
        while m > 1:
            half = m // 2
            if raw[4 * (x - k - half):4 * (x - k)] == raw[4 * (y - k - half):4 * (y - k)]:
                k += half
                m -= half
            else:
                m = half
        break
    return k


def runs_of(codes: np.ndarray, least: int, exponent: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``codes`` (32-bit)."""
    n, raw, w = len(codes), codes.astype("<i4").tobytes(), codes.tolist()
    found = set()
    for signs in (w, [-c for c in w]):
        ends: dict[int, int] = {}  # by period: where the last stretch found ends
        for i, p in enumerate(lyndon_lengths(signs)):
            # a run's first root has exponent - 1 periods of it to its right at least
            if i + (exponent - 1) * p > n or i + p <= ends.get(p, 0):
                continue
            if exponent > 2 and (w[i] != w[i + p] or w[i + p - 1] != w[i + 2 * p - 1]):
                continue
            right = i + p + common_right(raw, i, i + p, n)
            start = i - common_left(raw, i, i + p)
            ends[p] = right
            if right - start >= max(least, exponent * p):
                found.add((start, right - start, p))
    return found


def _stretches(inside: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the maximal stretches of true values with one owner."""
    cut = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[cut] |= inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cut - 1] |= inside[cut - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends)


def candidate_stretches(codes: np.ndarray, doc: np.ndarray, least: int,
                        exponent: int) -> list[tuple[int, int]]:
    """Bounds of stretches of ``codes`` that hold every run of every document.

    Twice: triples seen often enough in their document, then in their stretch.
    """
    n = len(codes)
    need = min(exponent - 1, max(least, exponent) - 2)
    shortest = max(least, exponent)
    if n < shortest:
        return []
    if need < 2:  # triples say nothing
        first, last = _stretches(np.ones(n, bool), doc)
        return list(zip(first.tolist(), (last + 1).tolist()))
    triple = np.zeros(n, np.uint64)
    c = codes.astype(np.uint64)
    for k, mul in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        triple[:n - 2] += (c[k:n - 2 + k] + np.uint64(1)) * np.uint64(mul)
    inside = np.zeros(n, bool)
    inside[:n - 2] = doc[2:] == doc[:-2]
    owner = doc.astype(np.uint64)
    bits = max(10, int(4 * n).bit_length())
    for _ in range(2):
        at = np.flatnonzero(inside)
        h = (triple[at] ^ (owner[at] * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xFF51AFD7ED558CCD)
        slot = (h >> np.uint64(64 - bits)).astype(np.int64)
        inside[at] = np.bincount(slot, minlength=1)[slot] >= need
        # triples that follow each other in one document are one stretch
        first, last = _stretches(inside, doc)
        long = last + 3 - first >= shortest
        first, last = first[long], last[long]
        inside[:] = False
        owner = np.zeros(n, np.uint64)
        mark = np.zeros(n + 1, np.int64)
        np.add.at(mark, first, 1)
        np.add.at(mark, last + 1, -1)
        inside = np.cumsum(mark[:n]) > 0
        step = np.zeros(n, np.int64)
        step[first] = 1
        owner = np.cumsum(step).astype(np.uint64)
    return list(zip(first.tolist(), (last + 3).tolist()))


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _batch(texts: list[bytes], least: int, exponent: int):
    """For each text its words (bytes) and its runs in order."""
    words = [t.split() for t in texts]  # of bytes: at ASCII white space only
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    code = _Codes().__getitem__
    flat = np.fromiter((code(x) for ws in words for x in ws), np.int32, int(sizes.sum()))
    doc = np.repeat(np.arange(len(words)), sizes)
    base = np.cumsum(sizes) - sizes
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for a, b in candidate_stretches(flat, doc, least, exponent):
        d = int(doc[a])
        shift = a - int(base[d])
        runs[d] += [(s + shift, n, p) for s, n, p in runs_of(flat[a:b], least, exponent)]
    return words, [sorted(set(r), key=lambda r: (r[0], r[2])) for r in runs]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by a blank."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


def find_runs(df: DataFrame, text: str = "text", least: int = 6, exponent: int = 4,
              runs: str = "runs", collapsed: str = "collapsed",
              carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) with the runs of ``text`` by start and period, and the
    text without repeats.

    ``exponent`` is a whole number of at least 2.
    """
    if exponent < 2 or least < 1:
        raise ValueError("exponent must be 2 or more, least 1 or more")
    carry = [c for c in (df.columns if carry is None else carry) if c not in (runs, collapsed)]
    python_batches(df.sparkSession)
    packed = df.select(F.struct(*[df[f"`{c}`"] for c in carry], F.lit(0).alias("__none")).alias("c"),
                       df[text].alias("t"))
    schema = T.StructType([packed.schema["c"], T.StructField("r", RUN, False),
                           T.StructField("k", T.StringType(), False)])
    kind = pa.struct([pa.field(f, pa.int64(), False) for f in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
            words, found = _batch(texts, least, exponent)
            flat = np.array([r for rs in found for r in rs], np.int64).reshape(-1, 3)
            items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)],
                                               fields=list(kind))
            offsets = np.concatenate([[0], np.cumsum([len(rs) for rs in found])]).astype(np.int32)
            short = pa.array([collapse(w, r) for w, r in zip(words, found)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), items),
                 short.cast(pa.string())], names=schema.names)

    return packed.mapInArrow(run, schema).select(
        *[F.col("c")[c].alias(c) for c in carry], F.col("r").alias(runs), F.col("k").alias(collapsed))
