"""Phrase collocations against a count of every phrase."""

import random
import re
from collections import Counter

import pytest

from tessera.llm import phrases
from tests.llm.helpers import SCHEMA, lower, rows


def every_phrase(docs, least, top, share):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, *w[i:i + m]) for i in range(len(w) - m + 1))
    found = []
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        cuts = [(2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.append((lang, w, a, f[lang, *w[:k]], f[lang, *w[k:]], score))
    gone = set()
    for lang, w, a, *_ in found:
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= share * f[lang, *w[i:i + m]]:
                    gone.add((lang, *w[i:i + m]))
    out = []
    for lang in sorted(n):
        left = sorted((-s, -a, " ".join(w).encode(), l, r) for g, w, a, l, r, s in found
                      if g == lang and (g, *w) not in gone)
        out += [(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(left[:top])]
    return out


def texts(seed, size):
    """Few words, so that phrases share counts, scores tie and longer phrases displace shorter ones."""
    rng, out = random.Random(seed), []
    common = ["a", "B", "the", "ça", "x.y", "-", "日", "a\xa0b"]
    fixed = ["new york city hall", "new york", "of the", "once upon a time", "a a a a a"]
    for _ in range(size):
        ws = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(common) for _ in range(rng.randrange(30))]
        sep = rng.choice([" ", "  ", " \t", ", ", ".", "\n"])
        out.append((rng.choice(["en", "fr", None, "und"]), sep.join(ws) if rng.random() < 0.97 else None))
    return out


@pytest.mark.parametrize("least,top,share,first", [(3, 40, 80, 2), (2, 7, 80, 1), (5, 2000, 50, 2), (3, 300, 100, 1)])
def test_all_phrases(spark, least, top, share, first):
    docs = texts(least * top, 400)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = phrases.collocations(df, least=least, top=top, share=share, first=first).collect()
    want = every_phrase(docs, least, top, share)
    assert sorted(map(tuple, got)) == want and want


def test_several_rounds_lower_the_floor(spark, monkeypatch):
    """Pairs that score best are displaced, so the first floor leaves too few."""
    floors, seen = phrases.floors, []

    def watched(pairs, rank):
        seen.append(rank)
        return floors(pairs, rank)

    monkeypatch.setattr(phrases, "floors", watched)
    monkeypatch.setattr(phrases, "GROWTH", 4)
    docs = [("en", " ".join(f"p{k} q{k} r{k} s{k}." for k in range(40))) for _ in range(4)]
    docs += [("en", f"z{k % 9} y{k % 7} the z{k % 5}") for k in range(200)]
    df = spark.createDataFrame(docs, "lang string, text string")
    got = phrases.collocations(df, least=3, top=50, first=1).collect()
    assert sorted(map(tuple, got)) == every_phrase(docs, 3, 50, 80)
    assert len(seen) > 1


def test_sets_that_are_full_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 64)
    docs = texts(9, 200)
    got = phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), least=3, top=30).collect()
    assert sorted(map(tuple, got)) == every_phrase(docs, 3, 30, 80)


def test_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).withColumnsRenamed({"size": "phrase", "a b": "n"})
    pairs = [(r["lang"], r["text"]) for r in docs.collect()]
    got = phrases.collocations(docs, least=3).collect()
    assert sorted(map(tuple, got)) == every_phrase(pairs, 3, 2000, 80)
    empty = phrases.collocations(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_products_beyond_64_bits(spark):
    big = 9 * 10 ** 17
    df = spark.createDataFrame([(big, 2 * big), (3, 7)], "a long, w long")
    got = [r[0] for r in df.select(phrases._ratio(df["a"], df["w"])).collect()]
    assert got == [2_000_000 * big // (2 * big), 2_000_000 * 3 // 7]


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_phrases_are_not_broadcast(spark, aqe):
    """The planner takes both sides for small; exploded and unpacked they overflow the driver."""
    def stored(*rows):
        return phrases.materialize(spark.createDataFrame(rows, "lang string, phrase string, n long"), "counts")

    words = stored(*[("en", w, 9) for w in "abc"])
    pairs, threes = stored(("en", "a b", 6), ("en", "b c", 5)), stored(("en", "a b c", 5))
    conf = {"spark.sql.adaptive.enabled": aqe, "spark.sql.autoBroadcastJoinThreshold": "10m"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        scored = phrases.scored(pairs, phrases._parts(words, salted=True))
        left = phrases.undisplaced(pairs, threes, 90)
        got = [sorted(map(tuple, df.collect())) for df in (scored, left)]
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (scored, left)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == [[("en", "a b", 6, 2_000_000 * 6 // 18, 9, 9, 2_000_000 * 6 // 15),
                    ("en", "b c", 5, 2_000_000 * 5 // 18, 9, 9, 2_000_000 * 5 // 14)],
                   [("en", "a b", 6)]]
    assert all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
