"""Language-model scoring with an n-gram trie of Elias-Fano levels.

Tokens are the words of the A-Z lower-cased text and one end token. The model
interpolates bigrams with unigrams: ``P(w | v) = (n(v w) + mu P(w)) / (n(v) + mu)``,
``P(w) = (n(w) + 0.1) / (N + 0.1 (V + 1))``; the first token of a text has ``P(w)``.

The corpus is never shuffled as text. Each batch of documents becomes a *unit*:
its distinct words, and its texts as numbers of these words, packed. A unit
asks for each of its distinct words and word pairs, with its training counts;
questions are dealt to shards by the hash of the first word. A shard sums the
counts of all units, builds its part of the trie, and answers the questions
from the trie, one number each in the order asked; a unit scores its texts from
the answers. A word with more than ``1 / HOT`` of all tokens (fewer than ``HOT`` such
words can exist) has its pairs dealt over shards in proportion to its share, so no
shard grows with one word. Words are 64-bit hashes throughout.

The trie of a shard lies in anonymous memory maps, which end with the task (a
mapped file would need a folder, and those of executors are not shared): first words (64-bit hashes) and their exact counts as sums; a monotone pointer
from each first word to its successors; successors as places in the shard's
word list, relative to their context (the context's number times the list's
length is added, so the whole level is monotone), found by successor search
between the context's pointers; and one byte a successor, the pair's count on a
logarithmic scale, rounded down. No probability is stored: smoothing is applied
when a text is scored. Anonymous maps are plain process memory, not a file.

Defined results: a null text is one end token; with nothing to learn from every
token has probability one; a null id counts as empty text for the fold; rows
that repeat an id are scored alike and learned as often as they come; an empty
table gives no row.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, python_batches, shuffle_partitions
from tessera.llm.elias_fano import EliasFano

#: A token that no text holds, as words never have white space.
END = b"\n"
MU = 32.0
HOT = 2000
#: A frequent word's pairs go to about this many shards for each ``1 / HOT`` of all tokens it has.
SPREAD = 8
#: Logarithmic step of the stored probabilities: 255 codes reach from 1 to 2 ** 40 occurrences.
STEP = 40 * np.log(2) / 254
SHARD_BYTES = 16 << 20
UNIT_DOCS, UNIT_MB = 4000, 8


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, with their types and lengths, compressed."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(
        b"\0".join([head, b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)]))


def unpack(data: bytes) -> list[np.ndarray]:
    head, _, body = zstandard.ZstdDecompressor().decompress(data).partition(b"\0")
    out, at = [], 0
    for part in head.decode().split(";"):
        kind, n = part.split(",")
        a = np.frombuffer(body, kind, int(n), at)
        at += a.nbytes
        out.append(a)
    return out


def encode_unit(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, all tokens as numbers of these, tokens a text."""
    number: dict[bytes, int] = {}
    lengths = np.empty(len(texts), np.int64)
    parts = []
    for k, text in enumerate(texts):
        w = text.encode().lower().split() if text else []
        w.append(END)
        lengths[k] = len(w)
        parts.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int32, len(w)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
    tokens = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return hashes, tokens, lengths


class Questions:
    """What a unit asks, in an order that depends on the unit and the shards only."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray,
                 train: np.ndarray, hot: tuple[np.ndarray, np.ndarray], shards: int):
        n = len(hashes)
        self.learn = np.repeat(train, lengths)
        last = np.zeros(len(tokens), bool)
        last[np.cumsum(lengths) - 1] = True
        self.first = np.zeros(len(tokens), bool)
        self.first[np.cumsum(lengths) - lengths] = True
        self.count = np.bincount(tokens[self.learn], minlength=n)
        at = np.flatnonzero(~last)
        codes, self.pair_of = np.unique(tokens[at].astype(np.int64) * n + tokens[at + 1],
                                        return_inverse=True)
        self.pair_count = np.bincount(self.pair_of[self.learn[at]], minlength=len(codes))
        self.v, w = codes // max(n, 1), codes % max(n, 1)
        self.child = hashes[w]
        self.hashes = hashes
        self.word_shard = (hashes % np.uint64(shards)).astype(np.int64)
        over = np.ones(n, np.uint64)  # shards a word's pairs are dealt over, by their second word
        over[np.isin(hashes, hot[0])] = hot[1][np.searchsorted(hot[0], hashes[np.isin(hashes, hot[0])])]
        spread = (self.child >> np.uint64(20)) % over[self.v]
        mixed = hashes[self.v] + spread * np.uint64(0x9E3779B97F4A7C15)
        self.pair_shard = (mixed % np.uint64(shards)).astype(np.int64)

    def by_shard(self, shards: int):
        """For every shard the words and the pairs it is asked for."""
        words = np.argsort(self.word_shard, kind="stable")
        pairs = np.argsort(self.pair_shard, kind="stable")
        w_at = np.searchsorted(self.word_shard[words], np.arange(shards + 1))
        p_at = np.searchsorted(self.pair_shard[pairs], np.arange(shards + 1))
        for s in range(shards):
            yield s, words[w_at[s]:w_at[s + 1]], pairs[p_at[s]:p_at[s + 1]]

    def payload(self, words: np.ndarray, pairs: np.ndarray) -> bytes:
        context, run = np.unique(self.v[pairs], return_counts=True)
        return pack(self.hashes[words], self.count[words].astype(np.uint32),
                    self.hashes[context], run.astype(np.uint32),
                    self.child[pairs], self.pair_count[pairs].astype(np.uint32))


class Trie:
    """One shard's n-grams in memory-mapped levels."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, context: np.ndarray,
                 child: np.ndarray, pair_counts: np.ndarray):
        """``words``, ``counts``: training counts, repeats are added; so for the pairs."""
        roots, at = np.unique(np.concatenate([words, context]), return_inverse=True)
        count = np.bincount(at[:len(words)], counts, len(roots)).astype(np.uint64)
        self.total, self.distinct = int(count.sum()), int((count > 0).sum())
        names, name_of = np.unique(child, return_inverse=True)
        level = at[len(words):].astype(np.uint64) * np.uint64(max(len(names), 1)) + name_of.astype(np.uint64)
        level, of = np.unique(level, return_inverse=True)
        seen = np.bincount(of, pair_counts, len(level))
        level, seen = level[seen > 0], seen[seen > 0]
        pointers = np.searchsorted(level, np.arange(len(roots) + 1, dtype=np.uint64)
                                   * np.uint64(max(len(names), 1)))
        self.width = max(len(names), 1)
        self.roots = EliasFano(roots, self.mapped)
        self.sums = EliasFano(np.concatenate([[0], np.cumsum(count)]), self.mapped)
        self.names = EliasFano(names, self.mapped)
        self.pointers = EliasFano(pointers, self.mapped)
        self.children = EliasFano(level, self.mapped)
        self.codes = self.mapped(code(seen))

    @staticmethod
    def mapped(a: np.ndarray) -> np.ndarray:
        """``a`` in a memory map of its own."""
        if not len(a):
            return a
        level = mmap.mmap(-1, a.nbytes)
        level.write(np.ascontiguousarray(a).tobytes())
        return np.frombuffer(level, a.dtype)

    def word_counts(self, words: np.ndarray) -> np.ndarray:
        at = self.roots.find(words)
        safe = np.maximum(at, 0)
        return np.where(at < 0, 0, (self.sums[safe + 1] - self.sums[safe]).astype(np.int64))

    def pair_codes(self, context: np.ndarray, run: np.ndarray, child: np.ndarray) -> np.ndarray:
        root = self.roots.find(context)
        safe = np.maximum(root, 0)
        low, high = self.pointers[safe].astype(np.int64), self.pointers[safe + 1].astype(np.int64)
        names, name_of = np.unique(child, return_inverse=True)
        name = self.names.find(names)[name_of]
        known = (np.repeat(root, run) >= 0) & (name >= 0)
        out = np.zeros(len(child), np.uint8)
        i = np.flatnonzero(known)
        at = self.children.find(
            np.repeat(safe, run)[i].astype(np.uint64) * np.uint64(self.width) + name[i].astype(np.uint64),
            np.repeat(low, run)[i], np.repeat(high, run)[i])
        out[i[at >= 0]] = self.codes[at[at >= 0]]
        return out


def code(count: np.ndarray) -> np.ndarray:
    """A probability, as occurrences among the training tokens, on the logarithmic scale."""
    return np.minimum(255, 1 + np.floor(np.log(np.maximum(count, 1)) / STEP + 1e-9)).astype(np.uint8)


def decode(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, np.exp((codes.astype(float) - 1) * STEP), 0.0)


def _units(docs: DataFrame, train: Column, text: str, carry: list[str]) -> DataFrame:
    """``(unit, docs, payload, frequent)``: the packed batches of documents."""
    source = docs.select(*carry, F.coalesce(train, F.lit(False)).alias("__train"),
                         docs[text].alias("__text"))
    row = docs.select(*carry).schema
    schema = T.StructType([
        T.StructField("docs", T.ArrayType(T.StructType(row.fields))),
        T.StructField("payload", T.BinaryType()),
        T.StructField("frequent", T.ArrayType(T.StructType([
            T.StructField("h", T.LongType()), T.StructField("n", T.LongType())]))),
        T.StructField("tokens", T.LongType())])
    python_batches(docs.sparkSession, UNIT_DOCS, UNIT_MB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pa.StructArray.from_arrays(batch.columns[:len(carry)], names=row.names)
            hashes, tokens, lengths = encode_unit(batch.column(len(carry) + 1).to_pylist())
            train = batch.column(len(carry)).to_numpy(zero_copy_only=False).astype(bool)
            n = np.bincount(tokens)
            often = np.flatnonzero(n * (2 * HOT) >= len(tokens))
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays([0, batch.num_rows], own),
                pa.array([pack(hashes, tokens, lengths, train)]),
                pa.array([[{"h": int(h), "n": int(k)} for h, k in zip(
                    hashes[often].view(np.int64), n[often], strict=True)]],
                    pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))),
                pa.array([len(tokens)])], names=schema.names)

    return materialize(source.mapInArrow(run, schema).withColumn(
        "unit", F.monotonically_increasing_id()), "lm-units")


def _hot(units: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words with over ``1 / HOT`` of all tokens, fewer than ``HOT`` whatever the corpus, and over
    how many shards each one's pairs are dealt: in proportion to its share.

    Such a word has over half that share in a unit that counts, so the units' own
    lists of frequent words hold nearly all of it; the rest only decides dealing.
    """
    total = units.agg(F.sum("tokens")).first()[0] or 0
    word = units.select(F.explode("frequent").alias("f")).groupBy("f.h").agg(
        F.sum("f.n").alias("n")).where(F.col("n") * HOT > total)
    found = {r["h"] % (1 << 64): -(-SPREAD * HOT * r["n"] // total) for r in word.collect()}
    hashes = np.array(sorted(found), np.uint64)
    return hashes, np.array([found[int(h)] for h in hashes], np.uint64)


def score(docs: DataFrame, train: Column, text: str = "text", mu: float = MU,
          carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``__n_tokens``, ``__n_known``, ``__train_tokens``,
    ``__base`` and ``__score``; rows where ``train`` holds are learned."""
    carry = docs.columns if carry is None else carry
    spark = docs.sparkSession
    units = _units(docs, train, text, carry)
    hot = _hot(units)
    size = units.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-4 * size // SHARD_BYTES))

    def questions(payload: bytes) -> tuple[Questions, np.ndarray, np.ndarray]:
        hashes, tokens, lengths, learn = unpack(payload)
        return Questions(hashes, tokens, lengths, learn, hot, shards), tokens, lengths

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                q, _, _ = questions(payload.as_py())
                asked = [(s, q.payload(w, p)) for s, w, p in q.by_shard(shards) if len(w) or len(p)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in asked], pa.int64()), pa.array([unit] * len(asked), pa.int64()),
                    pa.array([p for _, p in asked], pa.binary())], names=["shard", "unit", "asked"])

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        asked = [unpack(x.as_py()) for x in table["asked"]]
        context = np.concatenate([np.repeat(a[2], a[3]) for a in asked])
        trie = Trie(*[np.concatenate([a[k] for a in asked]) for k in (0, 1)], context,
                    *[np.concatenate([a[k] for a in asked]) for k in (4, 5)])
        answers = [pack(trie.word_counts(a[0]), trie.pair_codes(a[2], a[3], a[4])) for a in asked]
        n = table.num_rows
        return pa.table({"shard": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
                         "unit": pa.array([*table["unit"].to_pylist(), None], pa.int64()),
                         "answer": pa.array([*answers, None], pa.binary()),
                         "total": pa.array([*[None] * n, trie.total], pa.int64()),
                         "distinct": pa.array([*[None] * n, trie.distinct], pa.int64())})

    python_batches(spark, UNIT_DOCS, 2)  # about one unit at a time
    payloads = units.select("unit", "payload").mapInArrow(
        ask, "shard long, unit long, asked binary")
    # as many partitions as shards: a task's share does not grow with the corpus
    answers = materialize(payloads.repartition(shards, "shard").groupBy("shard").applyInArrow(
        answer, "shard long, unit long, answer binary, total long, distinct long"), "lm-answers")
    total, distinct = (x or 0 for x in answers.agg(F.sum("total"), F.sum("distinct")).first())
    row = T.StructType([T.StructField(c, T.LongType()) for c in ("__n_tokens", "__n_known")]
                       + [T.StructField(c, T.DoubleType()) for c in ("__base", "__score")])
    schema = T.StructType([T.StructField("docs", units.schema["docs"].dataType),
                           T.StructField("scores", T.ArrayType(row))])

    def rate(key: tuple, unit: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for payload in unit["payload"]:
            q, tokens, lengths = questions(payload.as_py())
            count, codes = np.zeros(len(q.hashes), np.int64), np.zeros(len(q.v), np.uint8)
            got = dict(zip(replies["shard"].to_pylist(), replies["answer"], strict=True))
            for s, words, pairs in q.by_shard(shards):
                if len(words) or len(pairs):
                    count[words], codes[pairs] = unpack(got[s].as_py())
            prob = (count + 0.1) / (total + 0.1 * (distinct + 1))
            p = prob[tokens]
            at = np.flatnonzero(~q.first)
            before = count[tokens[at - 1]]
            model = p.copy()
            model[at] = (decode(codes)[q.pair_of] + mu * p[at]) / (before + mu)
            starts = np.cumsum(lengths) - lengths
            columns = [pa.array(lengths), pa.array(np.add.reduceat((count[tokens] > 0).astype(np.int64), starts)),
                       pa.array(np.add.reduceat(np.log10(p), starts)),
                       pa.array(np.add.reduceat(np.log10(model), starts))]
            out.append(pa.ListArray.from_arrays(
                [0, len(lengths)], pa.StructArray.from_arrays(columns, names=row.names)))
        return pa.table({"docs": unit["docs"], "scores": pa.chunked_array(out)})

    scored = units.select("unit", "docs", "payload").groupBy("unit").cogroup(
        answers.where(F.col("unit").isNotNull()).select("unit", "shard", "answer").groupBy("unit")
    ).applyInArrow(rate, schema)
    return scored.select(F.explode(F.arrays_zip("docs", "scores")).alias("x")).select(
        "x.docs.*", "x.scores.*", F.lit(total).cast("long").alias("__train_tokens"))
