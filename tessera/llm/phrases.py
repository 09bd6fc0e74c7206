"""Phrase collocations of each language, found best first.

A text is cut into pieces at ``. , ; : ! ?`` and line ends and a piece into words.
A phrase of 2 to 4 words that occurs a = ``least`` times or more scores
2000000 * a / (l + r), rounded down, at the cut where that is lowest; l and r
are the counts of the two parts. A phrase goes if a longer one that holds it has
``share`` percent of its count. Each language keeps its ``top`` best phrases.

Growth is branch and bound. Any phrase that begins with q has at most f(q)
occurrences, and cut after its first word it scores at most
2000000 * f(q) / (f(first word) + f(q)): the bound of all that grows from q. Words
and the pairs of words that are frequent enough are counted first. Then rounds
take every pair whose bound reaches a floor, count the triples that grow from
those, and from the triples whose bound reaches it those of four words. All
phrases at or above the floor are then known, with all that could displace them
(one word more on either side suffices, as counts only fall when a phrase grows).
A language with ``top`` survivors at its floor is settled, ties included, and so is one
whose floor is zero; the others get a lower floor in the next round.

Counting passes read the documents and add up inside a task before the shuffle.
What a pass counts is chosen by membership in hashed sets of a fixed number of
bits (``BITS``), which is all that is broadcast: a phrase of the set is always
counted, others sometimes, and then completely, so results do not depend on the
bits. The sets grow full on very large vocabularies; passes then count more.
Counts are joined by (language, part), single words spread over salts, since
a frequent word is part of very many phrases; the best rows are picked by salt
first and then by language. Tables of phrases and their parts meet in sort-merge
joins by request: the planner sizes them by their Parquet files and does not see
that rows are exploded, so it would broadcast through the driver what is many
times its threshold. Products are computed as decimals.

Defined results: a null text has no words, a null language is ``und``; languages
without any phrase have no row; equal rows count as often as they are there;
other columns of the documents are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, python_batches

LEAST, TOP, SHARE = 30, 2000, 80
LONGEST = 4
SCALE = 2_000_000
#: Bits of a broadcast set: 4 MB.
BITS = 1 << 25
#: Frequent words are spread over this many keys where phrases look up their parts.
SALTS = 16
#: Floor of the first round: the score of this many times ``top`` pairs; then so many times more.
FIRST, GROWTH = 2, 16
TURN = 17  # a word's hash is rotated by this times its place in the phrase

#: A-Z lower-cased; what ends a piece becomes a byte that no UTF-8 text holds.
_TABLE = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b
               for b in range(256))
_END = b"\xff"
_COUNTS = "lang string, phrase string, n long"


# -- hashed sets ---------------------------------------------------------------------------------

def _turned(h, by: int):
    """64-bit rotation of a numpy array."""
    return h if by == 0 else (h << np.uint64(by)) | (h >> np.uint64(64 - by))


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\0" + word, seed=42)


def phrase_hash(words: Column, size: int, first: int = 0) -> Column:
    """The hash of ``size`` words from number ``first`` on, as ``Reader`` computes it."""
    out = F.lit(0).cast("long")
    for k in range(size):
        h = F.xxhash64(F.concat(F.col("lang"), F.lit("\0"), F.get(words, F.lit(first + k))))
        by = TURN * k
        if by:
            h = F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by))
        out = out.bitwiseXOR(h)
    return out


def hashed_set(phrases: DataFrame, size: int, first: int = 0) -> bytes:
    """The set of the phrases' (or their words' from ``first`` on) hashes, as ``BITS`` bits."""
    bit = phrase_hash(F.split("phrase", " "), size, first).bitwiseAND(F.lit(BITS - 1))
    slots = (phrases.select(bit.alias("bit"))
             .select(F.shiftrightunsigned("bit", 6).alias("slot"),
                     F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("v"))
             .groupBy("slot").agg(F.bit_or("v").alias("v")))  # BITS / 64 rows at most
    table = slots.toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[table["slot"].to_numpy()] = table["v"].to_numpy()
    return out.tobytes()


class Members:
    def __init__(self, bits: bytes):
        self.words = np.frombuffer(bits, "<u8")
        self.mask = np.uint64(len(self.words) * 64 - 1)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        bit = h & self.mask
        return (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


# -- counting ------------------------------------------------------------------------------------

class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


class Reader:
    """The words of some texts of one language, as codes; 0 ends a piece."""

    def __init__(self, lang: bytes, texts: list[bytes]):
        raw = _END.join(texts).translate(_TABLE)
        codes = _Codes({_END: 0})
        words = raw.replace(_END, b" \xff ").split()  # of bytes: at ASCII white space only
        self.codes = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        self.words = list(codes)
        self.lang = lang

    def hashes(self) -> np.ndarray:
        lang, words = self.lang, self.words
        return np.fromiter((word_hash(lang, w) for w in words), np.uint64, len(words))

    def count(self, keys: np.ndarray) -> tuple[np.ndarray, list[int]]:
        found, n = np.unique(keys, return_counts=True)
        return found, n.tolist()


def _words(r: Reader) -> tuple[list[bytes], list[int]]:
    n = np.bincount(r.codes, minlength=len(r.words)).tolist()
    # the empty phrase stands for all words
    return [b"", *r.words[1:]], [sum(n[1:]), *n[1:]]


class _Grams:
    """Places of pairs of ``r`` that are in the set ``pairs``, and their hashes."""

    def __init__(self, r: Reader, words: Members, pairs: Members | None):
        h = r.hashes()
        known = words(h)
        known[0] = False
        self.r, self.h = r, h[r.codes]
        ok = known[r.codes]
        n = max(len(ok) - 1, 0)
        self.pair_hash = self.h[:n] ^ _turned(self.h[1:], TURN)
        here = ok[:-1] & ok[1:]
        if pairs is not None:
            here &= pairs(self.pair_hash)
        at = np.flatnonzero(here)
        self.size = len(r.words)
        self.keys, inverse = np.unique(r.codes[at] * self.size + r.codes[at + 1], return_inverse=True)
        self.at, self.inverse = at, inverse
        self.pair = np.full(n, -1, np.int64)
        self.pair[at] = inverse

    def pair_words(self, k: int) -> bytes:
        key = int(self.keys[k])
        return self.r.words[key // self.size] + b" " + self.r.words[key % self.size]

    def pairs(self) -> tuple[list[bytes], list[int]]:
        n = np.bincount(self.inverse, minlength=len(self.keys)).tolist()
        return [self.pair_words(k) for k in range(len(self.keys))], n

    def triples(self, grow: Members, suffix: Members | None) -> tuple[list[bytes], list[int]]:
        """Triples whose first pair is in ``grow`` or whose last one is in ``suffix``."""
        p = self.pair
        here = (p[:-1] >= 0) & (p[1:] >= 0)
        wanted = grow(self.pair_hash[:-1])
        if suffix is not None:
            wanted |= suffix(self.pair_hash[1:])
        at = np.flatnonzero(here & wanted)
        found, n = self.r.count(p[at] * self.size + self.r.codes[at + 2])
        return [self.pair_words(k // self.size) + b" " + self.r.words[k % self.size]
                for k in found.tolist()], n

    def fours(self, grow: Members, suffix: Members) -> tuple[list[bytes], list[int]]:
        """Phrases of four whose first three are in ``grow`` or whose last three in ``suffix``."""
        p, size = self.pair, len(self.keys)
        here = (p[:-2] >= 0) & (p[1:-1] >= 0) & (p[2:] >= 0)
        three = self.pair_hash[:-1] ^ _turned(self.h[2:], 2 * TURN)
        at = np.flatnonzero(here & (grow(three[:-1]) | suffix(three[1:])))
        found, n = self.r.count(p[at] * size + p[at + 2])
        return [self.pair_words(k // size) + b" " + self.pair_words(k % size)
                for k in found.tolist()], n


def _count(docs: DataFrame, sets: dict[str, bytes], rows, least: int, name: str) -> DataFrame:
    """(lang, phrase, n) of what ``rows(reader, members by name)`` yields, from ``least`` on, stored."""
    spark = docs.sparkSession
    python_batches(spark, rows=4000, mb=8)
    sent = spark.sparkContext.broadcast(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = {k: Members(v) for k, v in sent.value.items()}
        for batch in batches:
            by_lang = defaultdict(list)
            for lang, text in zip(batch.column(0).cast(pa.binary()).to_pylist(),
                                  batch.column(1).cast(pa.binary()).to_pylist()):
                by_lang[lang].append(text)
            for lang, texts in by_lang.items():
                r = Reader(lang, texts)
                if len(r.codes) < 1:
                    continue
                for phrases, n in rows(r, members):
                    if phrases:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(n), pa.binary()).cast(pa.string()),
                             pa.array(phrases, pa.binary()).cast(pa.string()),
                             pa.array(n, pa.int64())], names=["lang", "phrase", "n"])

    counted = docs.mapInArrow(run, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    out = materialize(counted.where((F.col("n") >= least) | (F.col("phrase") == "")), name)
    sent.unpersist()
    return out


# -- scores --------------------------------------------------------------------------------------

def _ratio(a: Column, whole: Column) -> Column:
    """floor(SCALE * a / whole), exactly."""
    top = a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(8,0)")
    return F.call_function("div", top, whole.cast("decimal(21,0)")).cast("long")


def scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrases`` (lang, phrase, n) of which ``counts`` (lang, part, salt, f) has all parts, with
    l, r and the score of the lowest cut, and ``bound`` of what grows from them."""
    w = F.split("phrase", " ")
    size = F.size(w)
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(0).alias("side"), F.array_join(F.slice(w, F.lit(1), k), " ").alias("part")),
        F.struct(k.alias("k"), F.lit(1).alias("side"), F.array_join(F.slice(w, k + 1, size - k), " ").alias("part"))))
    parts = phrases.select("lang", "phrase", "n", F.explode(F.flatten(cuts)).alias("c")).select(
        "lang", "phrase", "n", "c.*")
    one = ~F.col("part").contains(" ")
    salt = F.when(one, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    met = parts.withColumn("salt", salt).join(counts.hint("shuffle_merge"), ["lang", "part", "salt"])
    by_phrase = met.groupBy("lang", "phrase").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("found"),
        *[F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"f{k}{s}")
          for k in range(1, LONGEST) for s in (0, 1)])
    each = [F.when(F.col(f"f{k}0").isNotNull(), F.struct(
        _ratio(F.col("n"), F.col(f"f{k}0") + F.col(f"f{k}1")).alias("score"), F.lit(k).alias("k"),
        F.col(f"f{k}0").alias("l"), F.col(f"f{k}1").alias("r"))) for k in range(1, LONGEST)]
    whole = by_phrase.where(F.col("found") == 2 * (size - 1))
    return whole.select("lang", "phrase", "n", F.array_min(F.array(*each)).alias("b"),
                        _ratio(F.col("n"), F.col("f10") + F.col("n")).alias("bound")).select(
        "lang", "phrase", "n", "b.score", "b.l", "b.r", "bound")


def _parts(counts: DataFrame, salted: bool = False) -> DataFrame:
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))) if salted else F.lit(0)
    return counts.select("lang", F.col("phrase").alias("part"), salt.cast("int").alias("salt")
                         if not salted else salt.alias("salt"), F.col("n").alias("f"))


def undisplaced(found: DataFrame, longer: DataFrame, share: int) -> DataFrame:
    """``found`` without phrases that one of ``longer`` (one word more) holds and nearly always comes with."""
    w = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(w, F.lit(1), F.size(w) - 1), " "),
                              F.array_join(F.slice(w, F.lit(2), F.size(w) - 1), " ")))
    most = longer.select("lang", inner.alias("phrase"), "n").groupBy("lang", "phrase").agg(
        F.max("n").alias("most"))
    joined = found.join(most.hint("shuffle_merge"), ["lang", "phrase"], "left")
    held = (F.lit(100).cast("decimal(3,0)") * F.col("most").cast("decimal(20,0)")
            >= F.lit(share).cast("decimal(3,0)") * F.col("n").cast("decimal(20,0)"))
    return joined.where(~F.coalesce(held, F.lit(False))).drop("most")


def floors(pairs: DataFrame, rank: int) -> DataFrame:
    """(lang, floor): at or above it lie the best ``rank`` pairs or a few more, or all (floor 0)."""
    step = SCALE // 2000
    h = pairs.groupBy("lang", F.floor(F.col("score") / step).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    above = h.withColumn("above", F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("b"))))
    floor = F.coalesce(F.max(F.when(F.col("above") >= rank, F.col("b") * step)), F.lit(0))
    return above.groupBy("lang").agg(floor.cast("long").alias("floor"))


def best(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank."""
    order = [F.desc("score"), F.desc("n"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = found.withColumn("salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = few.where(F.col("rank") <= top)  # SALTS * top rows a language at most
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top)


# -- rounds --------------------------------------------------------------------------------------

def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 top: int = TOP, share: int = SHARE, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``first`` only sets the floor of the first round, not the result.
    """
    docs = df.select(F.coalesce(df[lang], F.lit("und")).alias("lang"),
                     F.coalesce(df[text], F.lit("")).alias("text"))
    words = _count(docs, {}, lambda r, m: [_words(r)], least, "words")
    frequent = words.where((F.col("phrase") != "") & (F.col("n") >= least))
    word_set = hashed_set(frequent, 1)
    counted = _count(docs, {"words": word_set},
                     lambda r, m: [_Grams(r, m["words"], None).pairs()], least, "pairs")
    word_parts = _parts(frequent, salted=True)
    pairs = materialize(scored(counted, word_parts), "scored-pairs")
    sets = {"words": word_set, "pairs": hashed_set(pairs, 2)}

    done, rank = None, first * top
    while True:
        cut = materialize(floors(pairs, rank), "floors")
        found = _round(docs, sets, pairs, word_parts, cut, least, share)
        settled = materialize(
            cut.join(found.groupBy("lang").agg(F.count(F.lit(1)).alias("known")), "lang", "left").select(
                "lang", ((F.col("floor") == 0) | (F.coalesce("known", F.lit(0)) >= top)).alias("settled")),
            "settled")
        ready = found.join(settled.where("settled").select("lang"), "lang", "left_semi")
        done = ready if done is None else done.unionByName(ready)
        open_langs = settled.where(~F.col("settled")).select("lang")
        if open_langs.isEmpty():
            break
        rank *= GROWTH
        pairs = pairs.join(open_langs, "lang", "left_semi")
        docs = docs.join(open_langs, "lang", "left_semi").select("lang", "text")
    totals = words.where(F.col("phrase") == "").select("lang", F.col("n").alias("total"))
    return best(done, top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r",
        F.col("total").alias("n"), "score")


def _round(docs: DataFrame, sets: dict[str, bytes], pairs: DataFrame, word_parts: DataFrame,
           cut: DataFrame, least: int, share: int) -> DataFrame:
    """All surviving phrases that score their language's floor or more, stored."""
    at = pairs.join(cut, "lang")
    grow, good = at.where(F.col("bound") >= F.col("floor")), at.where(F.col("score") >= F.col("floor"))
    chosen = {**sets, "grow": hashed_set(grow, 2), "good": hashed_set(good, 2)}
    counted = _count(docs, chosen, lambda r, m: [
        _Grams(r, m["words"], m["pairs"]).triples(m["grow"], m["good"])], least, "triples")
    pair_parts = word_parts.unionByName(_parts(pairs))
    triples = materialize(scored(counted, pair_parts), "scored-triples")
    at = triples.join(cut, "lang")
    grow3, good3 = at.where(F.col("bound") >= F.col("floor")), at.where(F.col("score") >= F.col("floor"))
    columns = ["lang", "phrase", "n", "score", "l", "r"]
    found = undisplaced(good.select(columns), triples, share)
    if not grow3.isEmpty():
        # the last three words of a phrase of four are one of its parts
        chosen = {**sets, "grow": hashed_set(grow3, 3), "good": hashed_set(good3, 3),
                  "last": hashed_set(grow3, 2, first=1)}

        def rows(r: Reader, m: dict[str, Members]):
            grams = _Grams(r, m["words"], m["pairs"])
            return [grams.fours(m["grow"], m["good"]), grams.triples(m["last"], None)]

        both = _count(docs, chosen, rows, least, "fours")
        four = F.size(F.split("phrase", " ")) == 4
        threes = _parts(both.where(~four)).unionByName(_parts(triples)).groupBy(
            "lang", "part", "salt").agg(F.max("f").alias("f"))
        fours = materialize(scored(both.where(four), pair_parts.unionByName(threes)), "scored-fours")
        found = found.unionByName(undisplaced(good3.select(columns), both.where(four), share))
        found = found.unionByName(fours.join(cut, "lang").where(
            F.col("score") >= F.col("floor")).select(columns))
    return materialize(found, "found")
