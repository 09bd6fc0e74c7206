"""Word, line, shingle and token operators against plain Python."""

import base64
import collections
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, mixing, quality, queries, simhash
from tests.llm.helpers import SCHEMA, lower, rows, sha, words

SF = "/root/testdata/sf0.001"


def sets(spark):
    yield spark.createDataFrame(rows(), SCHEMA)
    yield spark.read.parquet(f"{SF}/documents.parquet")
    yield spark.createDataFrame([], SCHEMA)


# -- mixing --------------------------------------------------------------------------------------

def mix_targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        target = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target | {s: cap * sizes[s] for s in full}
        full |= over


def test_mix_targets_and_copies(spark):
    for docs in sets(spark):
        got = mixing.assign_copies(docs).collect()
        assert len(got) == docs.count()
        sizes = collections.Counter()
        for r in got:
            assert r[mixing.SIZE] == len(words(r["text"]))
            sizes[r["source"]] += r[mixing.SIZE]
        if not got:
            continue
        want = mix_targets(dict(sizes))
        for r in got:
            assert r[mixing.SOURCE_SIZE] == sizes[r["source"]]
            assert r[mixing.TARGET] == pytest.approx(want[r["source"]], rel=1e-9)
            rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 1
            assert rate - 1 < r[mixing.COPIES] < rate + 1 and r[mixing.COPIES] <= 3
        assert sorted(map(str, mixing.assign_copies(docs).collect())) == sorted(map(str, got))


def test_mix_of_rows_without_ids_or_with_one_id(spark):
    """Sources of null and of repeated ids come near their targets, and reruns agree."""
    rows = [(None, f"text {k} of a source without any ids at all", "a") for k in range(2000)]
    rows += [(7, f"text {k} of a source where all ids are the same", "b") for k in range(2000)]
    rows += [(k, "each of these has an id of its own, one text", "c") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.assign_copies(docs)
    taken = {r["source"]: r for r in out.groupBy("source").agg(
        F.sum(F.col(mixing.SIZE) * F.col(mixing.COPIES)).alias("taken"), F.first(mixing.TARGET).alias("target"),
    ).collect()}
    for r in taken.values():
        assert r["taken"] == pytest.approx(r["target"], rel=0.06)
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.assign_copies(docs.repartition(3)).collect()))


def test_mix_emits_copies(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    want = collections.Counter()
    for r in mixing.assign_copies(docs).collect():
        want[str(r["doc_id"]), r["text"]] += r[mixing.COPIES]
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert collections.Counter((str(r["doc_id"]), r["text"]) for r in out.collect()) == +want


def test_mix_takes_near_target(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    out = mixing.assign_copies(docs).groupBy("source").agg(
        F.sum(F.col(mixing.COPIES) * F.col(mixing.SIZE)).alias("t"), F.first(mixing.TARGET).alias("w"))
    for r in out.collect():
        assert abs(r["t"] - r["w"]) < 0.1 * r["w"]


# -- byte-pair encoding --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(
        bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(spark, tiktoken_encoding):
    data, pattern = queries.vocabulary()
    for docs in sets(spark):
        out = bpe.decode(bpe.encode(docs, data, pattern), data)
        assert out.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
        got = out.collect()
        assert len(got) == docs.count()
        for r in got:
            text = r["text"] or ""
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == tiktoken_encoding.encode_ordinary(text)
            assert bytes(r["decoded"]) == text.encode()


def test_bpe_pieces(tiktoken_encoding):
    ranks = bpe.parse_vocabulary(queries.vocabulary()[0])
    rng = random.Random(5)
    for n in (1, 2, 3, 7, 64, 65, 300, 5000):
        for alphabet in (b"ab", b"the anerinonti", bytes(range(256))):
            piece = bytes(rng.choice(alphabet) for _ in range(n))
            assert bpe.merge(piece, ranks) == tiktoken_encoding._encode_single_piece(piece)


def test_bpe_table_stays_bounded():
    pieces = bpe.Pieces(bpe.parse_vocabulary(queries.vocabulary()[0]), room=10)
    for k in range(100):
        pieces[f"piece{k}"]
        assert pieces["often"] == pieces["often"]
    pieces["x" * 100]
    assert len(pieces) <= 10 and len(pieces.old) <= 10 and "often" in pieces


# -- line dedup ----------------------------------------------------------------------------------

def line_dedup_plain(docs, min_chars=40, min_docs=5):
    ws = " \t\n\x0b\x0c\r"
    holders = collections.defaultdict(set)
    order = lambda d: -1 if d is None else d
    for d, text in docs:
        for x in (text or "").split("\n"):
            k = lower(x.strip(ws))
            if len(k) >= min_chars:
                holders[k].add(d)
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(lower(x.strip(ws)), ())) < min_docs
                or order(d) == max(map(order, h))]
        yield d, len(lines), len(lines) - len(kept), sha("\n".join(kept))


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (6, 2)])
def test_line_dedup(spark, batches, fanout):
    for docs in sets(spark):
        plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout)
        got = [(r["doc_id"], r["__lines"], r["__dropped"], sha(r["__kept"])) for r in out.collect()]
        assert sorted(map(str, got)) == sorted(map(str, line_dedup_plain(plain)))


def test_line_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(k, 0, 2, 10 - k), (99, 0, 1, 10 - k)],
                                       "__h1 long, __h2 long, __n long, __last long"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert [(r["__h1"], r["__keeper"]["id"]) for r in runs.frequent(5).collect()] == [(99, 10)]


# -- SimHash -------------------------------------------------------------------------------------

def fingerprint_plain(text, k=3):
    w = [lower(x) for x in words(text)]
    s = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_plain(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(spark):
    for docs in sets(spark):
        got = simhash.near_duplicates(docs).collect()
        assert len(got) == docs.count()
        fps = {}
        for r in got:
            fp = r["__fp"] % (1 << 64)
            assert fp == fingerprint_plain(r["text"])
            fps.setdefault(fp, []).append(r["doc_id"])
        roots = components_plain(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
        first = {}
        for fp, ids in fps.items():
            first.setdefault(roots[fp], []).extend(i for i in ids if i is not None)
        for r in got:
            assert r["__component"] == min(first[roots[r["__fp"] % (1 << 64)]], default=None)


@pytest.mark.parametrize("tile", [4096, 8])
def test_simhash_links(spark, tile):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(150)}
    centre = rng.getrandbits(64)  # a dense group, and a chain
    fps |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    x = rng.getrandbits(64)
    for k in range(0, 60, 3):
        fps.add(x := x ^ (7 << k))
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "__fp long")
    from tessera.llm.components import components
    got = components(simhash.links(reps, 3, tile), "a", "b").collect()
    want = components_plain(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    groups = collections.defaultdict(set)
    for r in got:
        groups[r["root"]].add(r["node"] % (1 << 64))
    wanted = collections.defaultdict(set)
    for f, r in want.items():
        wanted[r].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in wanted.values() if len(g) > 1)


# -- quality rules -------------------------------------------------------------------------------

def quality_plain(text):
    text = text or ""
    w = words(text)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def test_quality_counts(spark):
    for docs in sets(spark):
        scored, _ = quality.score(docs)
        got = scored.withColumn("failed", quality.base_failed()).collect()
        assert len(got) == docs.count()
        for r in got:
            q = r["__q"]
            want = quality_plain(r["text"])
            assert (q["w"]["n_words"], q["word_chars"], q["n_symbols"], q["l"]["n_dup_lines"],
                    q["w"]["n_repeat_words"]) == want
            assert r["failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
            assert 0 <= r["__q_posterior"] <= 1
        kept = quality.keep(docs)
        assert kept.columns == docs.columns


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op7_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = {(x["quality"], x["kept"]): x["count"] for x in out.groupBy("quality", "kept").count().collect()}
    good, bad = r.get((1, True), 0), r.get((0, False), 0)
    assert good >= 0.97 * (good + r.get((1, False), 0))
    assert bad >= 0.9 * (bad + r.get((0, True), 0))


def test_label_model():
    rng = random.Random(1)
    tally = collections.Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        tally[tuple(None if rng.random() < 0.2 else int(good == (rng.random() < 0.85)) for _ in range(5))] += 1
    model = quality.fit(sorted(tally.items(), key=str), 5, good=0.9, bad=0.2, strength=0.01)
    assert abs(model.prior - 0.7) < 0.05 and all(abs(g - 0.85) < 0.06 for g in model.on_good)
    assert all(abs(b - 0.15) < 0.06 for b in model.on_bad)
    assert quality.fit([], 5).prior == pytest.approx(0.8)


def invented(chances, size=50_000, good=0.8, silent=0.2):
    """A histogram of votes of rules with the given chances to vote good on good and on bad documents."""
    rng, tally = random.Random(7), collections.Counter()
    for _ in range(size):
        kind = rng.random() < good
        tally[tuple(None if rng.random() < silent else int(rng.random() < (g if kind else b)) for g, b in chances)] += 1
    return sorted(tally.items(), key=str)


@pytest.mark.parametrize("chances", [
    [(0.8, 0.4)] * 6, [(0.99, 0.3)] * 5 + [(0.6, 0.3)], [(0.99, 0.3)] * 5 + [(0.3, 0.9)]])
def test_label_model_estimates_with_the_query_parameters(chances):
    """Rules that are often wrong, a noisy one and a reversed one, as the query would fit them."""
    model = quality.fit(invented(chances), len(chances))
    assert abs(model.prior - 0.8) < 0.05
    for (g, b), x, y in zip(chances, model.on_good, model.on_bad, strict=True):
        assert abs(g - x) < 0.05 and abs(b - y) < 0.05


def test_label_model_leaves_clean_documents_whole():
    """Where hardly any rule is tripped and nothing hangs together, no document is bad."""
    rng, tally = random.Random(2), collections.Counter()
    for _ in range(5000):
        tally[tuple(int(rng.random() < 0.995) for _ in range(7))] += 1
    model = quality.fit(sorted(tally.items()), 7)
    assert sum(n for v, n in tally.items() if model.log_odds(v) >= 0) >= 0.95 * 5000


def votes_plain(text):
    n, chars, symbols, dup_lines, repeats = quality_plain(text)
    text = text or ""
    w = words(text)
    lines = len([x for x in text.split("\n") if words(x)])
    function = sum(x in set(quality.FUNCTION_WORDS) for x in w)
    stutter = sum(a == b for a, b in zip(w, w[1:]))
    capitals = sum(c in quality.CAPITALS for c in text)
    pairs = [(100 * symbols <= n, 10 * symbols > n), (repeats == 0 and n >= 16, 4 * repeats > n),
             (10 * stutter <= n and n >= 16, 4 * stutter > n),
             (dup_lines == 0 and lines > 1, 2 * dup_lines > lines and lines > 3),
             (2.5 * n <= chars <= 9 * n, chars < 2 * n or chars > 13 * n),
             (100 * capitals <= 15 * chars, 10 * capitals > 4 * chars)]
    other = any(bad for _, bad in pairs)
    pairs.append((100 * function >= 4 * n, 200 * function < n and n >= 30 and other))
    return tuple(0 if bad else 1 if good else None for good, bad in pairs)


def estimate_plain(tally, m, good=0.99, bad=0.7, strength=10):
    """The label model's estimation once more, row by row: (log likelihood, prior, on good, on bad)."""
    out = []
    for g, b, prior in quality.starts(m):
        for _ in range(500):
            total, tops, sums = 0.0, [[[strength * good, strength], [strength * bad, strength]] for _ in range(m)], 0.0
            for votes, n in tally.items():
                x, y = math.log(prior), math.log(1 - prior)
                for j, v in enumerate(votes):
                    if v is not None:
                        x += math.log(g[j] if v else 1 - g[j])
                        y += math.log(b[j] if v else 1 - b[j])
                p = 1 / (1 + math.exp(min(700, y - x)))
                total += n * (max(x, y) + math.log1p(math.exp(-abs(x - y))))
                sums += n * p
                for j, v in enumerate(votes):
                    if v is not None:
                        for side, part in ((0, p), (1, 1 - p)):
                            tops[j][side][0] += n * part * v
                            tops[j][side][1] += n * part
            old = [*g, *b, prior]
            g, b = [t[0][0] / t[0][1] for t in tops], [t[1][0] / t[1][1] for t in tops]
            prior = (sums + 0.8) / (sum(tally.values()) + 1)
            if max(abs(x - y) for x, y in zip(old, [*g, *b, prior])) < 1e-9:
                break
        total += strength * sum(good * math.log(x) + (1 - good) * math.log(1 - x) + bad * math.log(y)
                                + (1 - bad) * math.log(1 - y) for x, y in zip(g, b))
        out.append((total, prior, g, b))
    return max(out, key=lambda r: r[0])


def test_quality_verdict_of_every_document(spark):
    """Votes, estimation and posterior of the registered query against plain Python."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    votes = {k: votes_plain(t) for k, t in docs.items()}
    _, prior, g, b = estimate_plain(collections.Counter(votes.values()), 7)
    assert 2 * sum(x > y for x, y in zip(g, b)) >= 7
    kept = 0
    for r in queries.op7_quality_rules(spark, SF).collect():
        odds = math.log(prior / (1 - prior))
        for v, x, y in zip(votes[r["doc_id"]], g, b):
            if v is not None:
                odds += math.log(x / y) if v else math.log((1 - x) / (1 - y))
        assert r["posterior"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-4)
        n, *_, rep = quality_plain(docs[r["doc_id"]])
        assert r["base_failed"] == (n < 20 or 100 * rep > 30 * n)
        assert r["kept"] == (not r["base_failed"] and odds >= 0)
        kept += r["kept"]
    assert 0 < kept < len(docs)


@pytest.mark.parametrize("share", [0.005, 0.02])
def test_quality_keeps_clean_texts_in_other_languages(spark, share):
    rng = random.Random(3)
    other = ["утром мы пошли вдоль реки чтобы посмотреть как строят новый мост через старый город".split(),
             "dün sabah çocuklar okula giderken yolda küçük bir kedi buldular ve eve götürdüler".split()]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [" ".join(rng.choice(other[k % 2]) + ("" if j % 9 else f"{k}х{j}") for j in range(60 + 40 * (k % 9)))
             for k in range(max(2, int(share * docs.count())))]
    texts += ["Слово The " + " ".join(f"{w}{j}" for j in range(25) for w in other[0])]
    mine = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(texts)], docs.schema)
    kept = {r["doc_id"] for r in quality.keep(docs.union(mine)).collect()}
    assert all(-1 - k in kept for k in range(len(texts)))
    junk = docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 0"), "doc_id")
    assert len(kept & {r["doc_id"] for r in junk.collect()}) <= 0.05 * junk.count()


def test_bpe_side_by_side_equals_one_by_one():
    """Trees merged as rows of one array give what one tree at a time gives."""
    ranks = bpe.parse_vocabulary(queries.vocabulary()[0])
    rng = random.Random(11)
    pieces = [bytes(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(800)
              for alphabet in (b"ab", b"the anerinonti", b" aeszAB\xc3\xa9.,1\x00", bytes(range(256)))]
    got = bpe.merge_many(pieces, bpe.Vocabulary(ranks))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [bpe.merge(p, ranks) for p in pieces]
    # a vocabulary that lacks single bytes has no ids for them, but those it has are found
    few = {b"a": 0, b"b": 1, b"ab": 2, b"aba": 3}
    assert bpe.merge_many([b"abab", b"aba", b"a"], bpe.Vocabulary(few)) == [
        np.array(x, "<u4").tobytes() for x in ([2, 2], [3], [0])]


def test_bpe_decodes_in_the_same_pass(spark):
    data, pattern = queries.vocabulary()
    for docs in sets(spark):
        one = bpe.encode(docs, data, pattern, decoded="decoded")
        two = bpe.decode(bpe.encode(docs, data, pattern), data)
        assert one.columns == two.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    bad = spark.createDataFrame([(bytearray(b"\xff\xff\xff\x7f"),)], "ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, data).collect()
