"""Runs against a search of every period, Lyndon words against their definition."""

import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm import periodic_runs, queries
from tests.llm.helpers import SCHEMA, rows, sha, words

SF = "/root/testdata/sf0.001"


def every_run(ws, least=6, exponent=4):
    """(start, length, period) by trying all periods; a multiple of a smaller period is none."""
    n, out = len(ws), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and ws[i] == ws[i + q]:
                i += 1
            length = i + q - start
            if (i > start and length >= max(least, exponent * q)
                    and not any(q % p == 0 and s <= start and start + length <= s + m for s, m, p in out)):
                out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(ws, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(ws) if k not in gone)


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(3000):
        w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(1, 16))]
        want = []
        for i in range(len(w)):
            j = i + 1
            while j < len(w) and w[j:] > w[i:]:
                j += 1
            want.append(j - i)
        assert periodic_runs.lyndon_lengths(w) == want


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (5, 3), (1, 5), (1, 2)])
def test_runs_of_many_texts(least, exponent):
    rng, texts = random.Random(least * 10 + exponent), []
    for _ in range(800):
        ws = []
        for _ in range(rng.randint(0, 6)):
            ws += rng.choices("abc", k=rng.randint(1, 6)) * rng.randint(1, 7)
        texts.append(ws)
    _, found = periodic_runs._batch([" ".join(ws).encode() for ws in texts], least, exponent)
    assert found == [every_run(ws, least, exponent) for ws in texts]


def test_long_texts():
    one = ["a"] * 200_000  # one run; galloping comparisons keep it linear
    two = (["x"] + ["y"] * 999) * 40  # a run of period 1000 holding forty of period 1
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 20_000:
        fib = fib[1], fib[1] + fib[0]
    _, found = periodic_runs._batch([" ".join(ws).encode() for ws in (one, two, fib[1])], 6, 4)
    assert found[0] == [(0, 200_000, 1)]
    assert found[1] == sorted([(0, 40_000, 1000)] + [(1000 * k + 1, 999, 1) for k in range(40)],
                              key=lambda r: (r[0], r[2]))
    assert found[2] == []  # Fibonacci words hold no fourth power


def want_row(doc_id, text):
    ws = words(text)
    n, h = len(ws), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = every_run(ws)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapsed(ws, runs)))


def test_query_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    want = {want_row(r["doc_id"], r["text"]) for r in docs}
    assert got == want and sum(w[1] > 0 for w in want) > len(want) // 20


def test_nulls_copies_and_clashing_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).withColumn("runs", F.lit("x")).withColumn("c", F.lit(1))
    out = periodic_runs.find_runs(docs)
    assert out.columns == [c for c in docs.columns if c != "runs"] + ["runs", "collapsed"]
    keep = [c for c in docs.columns if c != "runs"]
    assert sorted(map(str, out.select(keep).collect())) == sorted(map(str, docs.select(keep).collect()))
    for r in out.collect():
        runs = every_run(words(r["text"])) if len(words(r["text"])) < 1000 else None
        if runs is not None:
            assert [tuple(x) for x in r["runs"]] == runs
            assert r["collapsed"] == collapsed(words(r["text"]), runs)
    assert periodic_runs.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, exponent=1)
