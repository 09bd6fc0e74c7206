"""Licence scans, embeddings, language ID, suffix arrays and the language model against plain Python."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import embed_dedup, langid, licenses, lm, queries, suffix_dedup
from tessera.llm.components import components
from tessera.llm.elias_fano import EliasFano
from tests.llm.helpers import SCHEMA, lower, rows, words
from tests.llm.test_text_ops import components_plain, sets

SF = "/root/testdata/sf0.001"


# -- licences ------------------------------------------------------------------------------------

def test_license_rules(spark):
    full = "\n".join(s for _, s in licenses.SENTENCES[3:5])
    docs = spark.createDataFrame([
        (1, "Intro text. Licensed under the Apache License, Version 2.0.\nMore. Released under the MIT License."),
        (2, None), (3, ""), (4, "licensed under CC BY-NC 4.0"), (5, full.upper()),
        (6, "I like the MIT License."), (7, "All rights reserved.\nALL RIGHTS RESERVED!"),
        (8, "Redistributions of source code must retain the above copyright notice, this list of conditions "
            "and the following disclaimer."), (8, ""),
    ], "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in licenses.scan(docs).collect():
        got[r["doc_id"]].append((r["__matches"], r["__licenses"]))
    assert got[1] == [(["d", "a"], ["Apache-2.0", "MIT"])]
    assert got[2] == got[3] == got[6] == [([], [])]
    assert got[4] == [(["l"], ["CC-BY-NC-4.0"])]
    assert got[5] == [(["bc"], ["MIT"])]
    assert got[7] == [(["t", "t"], ["all-rights-reserved"])]
    assert len(got[8]) == 2 and got[8][0] == ([], [])
    for docs in sets(spark):
        assert licenses.scan(docs).count() == docs.count()


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0"""


@pytest.mark.parametrize("width", [30, 72, 80, 1000])
@pytest.mark.parametrize("mark,end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n"), (";; ", "\n")])
def test_license_wrapped(spark, width, mark, end):
    import textwrap

    def wrapped(text):
        parts = ["Copyright (c) 2020 A. Name", *text.split("\n\n"), "THE SOFTWARE IS PROVIDED AS IS"]
        lines = [x for p in parts for x in [*textwrap.wrap(p.replace("\n", " "), width), ""]]
        return end.join((mark + x).rstrip() for x in lines) + end + "int main() { return 0; }"
    texts = [MIT, BSD, BSD3, APACHE, BSD3.replace("1. ", "(1) ").replace("2. ", "(2) ").replace("3. ", "(3) "),
             BSD3.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "),
             "This work is licensed under the GNU General Public License version 3. More."]
    out = licenses.scan(spark.createDataFrame(
        [(k, wrapped(t)) for k, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert [(r["__matches"], r["__licenses"]) for r in sorted(out, key=lambda r: r["doc_id"])] == [
        (["bc"], ["MIT"]), (["pqr"], ["BSD-2-Clause"]), (["pqrs"], ["BSD-3-Clause"]), (["defg"], ["Apache-2.0"]),
        (["pqrs"], ["BSD-3-Clause"]), (["pqrs"], ["BSD-3-Clause"]), (["h"], ["GPL-3.0"])]


WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public
License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later
version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} Public License for more details."""
NOTICES = [
    (MIT + "\n\n" + WARRANTY, ["MIT"], 1), (MIT.split(", subject to")[0] + ".\n\n" + WARRANTY, ["MIT-0"], 1),
    (GNU.format("General", 3, "General"), ["GPL-3.0"], 1), (GNU.format("General", 2, "General"), ["GPL-2.0"], 1),
    (GNU.format("Affero General", 3, "Affero General"), ["AGPL-3.0"], 1),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
     "your option) any later version.", ["LGPL-2.1"], 1),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.", ["ISC"], 1),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted.", ["0BSD"], 1),
    (APACHE.replace("http:", "https:") + "\n\nUnless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied. See the License for the specific language governing permissions and limitations under "
     "the License.", ["Apache-2.0"], 1),
    ("This is free and unencumbered software released into the public domain.", ["Unlicense"], 1),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", ["MPL-2.0"], 2),
    ("SPDX-License-Identifier: MPL-2.0\n\nSPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0", "MPL-2.0"], 2),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"], 1),
    ("Released under the ISC License.", ["ISC"], 1), ("This software is about licences of software.", [], 0),
]


@pytest.mark.parametrize("width,mark", [(40, " * "), (79, "# "), (1000, "")])
def test_license_notices(spark, width, mark):
    import textwrap

    def wrapped(text):
        lines = [x for p in text.split("\n\n") for x in [*textwrap.wrap(p.replace("\n", " "), width), ""]]
        return "\n".join((mark + x).rstrip() for x in lines)
    out = licenses.scan(spark.createDataFrame(
        [(k, wrapped(t)) for k, (t, _, _) in enumerate(NOTICES)], "doc_id long, text string")).collect()
    got = [(r["__licenses"], len(r["__matches"])) for r in sorted(out, key=lambda r: r["doc_id"])]
    assert got == [(names, n) for _, names, n in NOTICES]


def test_license_tables():
    """Every known sentence is normal, has one identifier and a marker word; rules use known identifiers."""
    import re

    texts = [s for _, s in licenses.SENTENCES]
    assert len(texts) == len(set(texts)) > 100 and all(re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s) for s in texts)
    marks = licenses.markers(licenses.SENTENCES)
    assert all(any(m in s.split() for m in marks) for s in texts) and len(marks) < 12
    known = {i for i, _ in licenses.SENTENCES}
    assert all(len(i) == 1 for i in known) and all(set(r) <= known for r, _ in licenses.RULES)
    assert len(dict(licenses.RULES)) == len(licenses.RULES)


def test_license_lines_are_not_joined_over_a_sentence_end(spark):
    docs = spark.createDataFrame([
        (1, "All rights. Reserved"), (2, "Released under the MIT License\nsome code\nAll rights reserved"),
        (3, "I am not released under\nthe MIT License"), (4, "\n" * 200000 + "All rights\n\nreserved S")],
        "doc_id long, text string")
    got = {r["doc_id"]: r["__matches"] for r in licenses.scan(docs).collect()}
    assert got == {1: [], 2: ["a", "t"], 3: [], 4: []}


def test_license_longest_rule_wins():
    import re
    p = re.compile(licenses.pattern())
    assert p.findall("defg de pqrs pqr abc") == ["defg", "de", "pqrs", "pqr", "abc"]


# -- embeddings ----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, __n string"


def vectors_plain(data, threshold):
    def usable(e, label):
        return label is not None and e is not None and len(e) and all(
            v is not None and math.isfinite(v) for v in e) and any(e)
    n = len(data)
    linked = []
    for i in range(n):
        for j in range(i):
            (_, a, la, *_), (_, b, lb, *_) = data[i], data[j]
            if la == lb and usable(a, la) and usable(b, lb) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    linked.append((i, j))
    count = collections.Counter(k for p in linked for k in p)
    root = components_plain(range(n), linked)
    first = {}
    for i in range(n):
        first[root[i]] = min(first.get(root[i], data[i][0]), data[i][0])
    return sorted((data[i][0], count[i], first[root[i]]) for i in range(n))


@pytest.mark.parametrize("tile", [2048, 16])
def test_embeddings(spark, tile):
    rng = np.random.default_rng(1)
    data, base = [], rng.normal(size=(12, 24))
    for k in range(150):
        v = base[k % 12] + rng.normal(0, 0.24, 24)
        data.append((k, [float(np.float32(x)) for x in v], int(k % 12 < 8), None))
    data += [(200 + k, data[5][1], 1, "x") for k in range(4)] + [data[5]]
    data += [(300, None, 1, None), (301, [0.0] * 24, 1, None), (302, [], 0, None), (303, [None, 1.0], 0, None),
             (304, [float("nan"), 1.0], 0, None), (305, [float("inf")] * 24, 1, None), (306, data[0][1], None, None),
             (307, [2 * x for x in data[0][1]], 1, None), (308, [1.0, 2.0], 1, None)]
    out = embed_dedup.near_duplicates(spark.createDataFrame(data, VECTORS), 0.93, tile)
    got = sorted((r["vec_id"], r["__links"], r["__component"]) for r in out.collect())
    assert got == vectors_plain(data, 0.93)
    assert embed_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(2)
    for d in (3, 64, 2500):
        x = rng.normal(size=(60, d)) * 10.0 ** rng.integers(-3, 4, (60, 1))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        codes, step, length, loss = embed_dedup.quantise(x)
        approx = embed_dedup.integer_products(codes, codes) * step[:, None] * step[None, :]
        bound = length[:, None] * loss[None, :] + loss[:, None]
        assert (np.abs(unit @ unit.T - approx) <= bound + 1e-9).all()


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    edges += [(500, k) for k in range(501, 540)] + [(7, 7), (None, 3), (3, None)]
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = components_plain({x for e in real for x in e}, real)
    assert got == want


# -- language ID ---------------------------------------------------------------------------------

def test_language_id(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op8_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert sum(held) >= 0.95 * len(held)


def test_language_id_edges(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = langid.identify(docs)
    assert out.columns == [*docs.columns, "__lang", "__score"]
    for r in out.collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["__lang"], r["__score"]) == ("und", 0.0)
        else:
            assert r["__lang"] in {"en", "fr", "de"}
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["__lang"] for r in nothing} == {"und"}
    assert langid.identify(docs.limit(0)).collect() == []


def test_folded_tables_equal_the_network():
    net = langid.train([("a", b"abc abd" * 20), ("b", b"xyz xyw " * 20)] * 20, epochs=1)
    x = langid.windows(bytes(range(256)) * 3)
    features, _ = langid._forward(net, x)
    assert np.allclose(langid.Predictor(net)(x), langid.softmax(features @ net.out + net.out_bias), atol=1e-5)


def whole_text_plain(net, data):
    """Probabilities of a whole text, window by window, filter by filter, as the network is defined."""
    total = np.zeros(len(net.langs))
    for at in range(0, len(data), langid.WINDOW):
        part = data[at:at + langid.WINDOW]
        e = net.embed[np.frombuffer(part.ljust(langid.WINDOW + max(langid.WIDTHS), b"\0"), np.uint8)].astype(float)
        seen = [np.array([sum(e[p + k] @ f[k] for k in range(len(f))) for p in range(langid.WINDOW)]).max(axis=0)
                for f in net.filters]
        z = np.maximum(np.concatenate(seen) + net.bias, 0) @ net.out + net.out_bias
        p = np.exp(z - z.max())
        total += len(part) * p / p.sum()
    return total / total.sum()


def test_language_of_whole_texts(spark):
    """The prediction of every document once more: windows weighted by their bytes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).union(spark.createDataFrame(
        [(900, "é" * 200 + " the of and", None, "s", 1), (901, "123 456", None, "s", 1), (902, None, None, "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long"))
    net = langid.train(langid.sample_windows(docs, "lang", "text", "doc_id"), epochs=1)
    rows = langid.predict(docs, net).collect()
    assert len(rows) == 63
    for r in rows:
        if r["doc_id"] in (901, 902):
            assert (r["__lang"], r["__score"]) == ("und", 0)
            continue
        p = whole_text_plain(net, r["text"].encode())
        assert r["__lang"] == net.langs[p.argmax()] and r["__score"] == pytest.approx(p.max(), abs=1e-4)


def test_gradients():
    net = langid.train([("a", b"abcabd"), ("b", b"xyzw")] * 4, epochs=1, seed=3)
    for k, p in enumerate(net.parameters()):
        p[...] = p.astype(np.float64)
    x, y = langid.windows(b"abcd xyz" * 64), np.array([0, 1])
    w = np.ones(2)

    def loss():
        f, _ = langid._forward(net, x)
        return -np.log(langid.softmax(f @ net.out + net.out_bias)[np.arange(2), y]).mean()
    grads = langid._gradients(net, x, y, w)
    for p, g in zip(net.parameters(), grads, strict=True):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[i]
        p[i] = old + 1e-2
        up = loss()
        p[i] = old - 1e-2
        down = loss()
        p[i] = old
        assert (up - down) / 2e-2 == pytest.approx(g[i], rel=0.1, abs=1e-3)


# -- suffix arrays -------------------------------------------------------------------------------

def repeats_plain(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        f = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                f[i:i + length] = b"\1" * length
        spans = suffix_dedup.runs(np.frombuffer(bytes(f), np.uint8)) if t else []
        yield bytes(b for b, x in zip(t, f, strict=True) if not x), [(a, b + 1) for a, b in spans]


@pytest.mark.parametrize("length,batches", [(200, 4), (200, 1), (40, 6)])
def test_suffix_dedup(spark, length, batches):
    for docs in sets(spark):
        if docs.columns[0] == "doc_id" and docs.count() > 100 and length == 40:
            continue
        got = suffix_dedup.dedup(docs, length, batches).collect()
        want = repeats_plain([(r["text"] or "").encode() for r in got], length)
        assert len(got) == docs.count()
        for r, (kept, spans) in zip(got, want, strict=True):
            assert bytes(r["__kept"]) == kept
            assert [(x["start"], x["end"]) for x in r["__spans"]] == spans
            assert r["__bytes"] == len((r["text"] or "").encode())


def test_suffix_dedup_many_overlaps(spark):
    rng = random.Random(9)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(30, 90))) for _ in range(12)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    texts += ["xy" * 200, "xy" * 90 + "z", "q" * 39, "é" * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.dedup(docs, 40, 5).collect()
    for r, (kept, _) in zip(got, repeats_plain([r["text"].encode() for r in got], 40), strict=True):
        assert bytes(r["__kept"]) == kept


def test_suffix_dedup_long_low_entropy_texts(spark):
    rng = random.Random(6)
    noise = rng.randbytes(60000).hex()
    texts = ["-" * 700000 + "end", "-" * 300 + noise + noise[100:900], "ab" * 150000, "abc" * 90000 + "-" * 150,
             noise[:262144 // 4], "=" * 199, " " * 200, noise.upper() * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.dedup(docs).orderBy("doc_id").collect()
    for r, (kept, spans) in zip(got, repeats_plain([t.encode() for t in texts], 200), strict=True):
        assert bytes(r["__kept"]) == kept and [(x["start"], x["end"]) for x in r["__spans"]] == spans


@pytest.mark.parametrize("text", [b"-", b"ab", b"0123456"])
def test_suffix_contexts_of_low_entropy_text_are_small(text):
    import tracemalloc

    texts = [text * ((4 << 20) // len(text))]
    tracemalloc.start()
    out = suffix_dedup.document_contexts(texts, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and len(out[0]) < 200


def test_suffix_levels_merge_geometrically():
    family = suffix_dedup.SuffixLevels(40)
    rng = random.Random(2)
    for _ in range(7):
        family.add([(bytes(rng.choice(b"ab") for _ in range(60)), 20) for _ in range(4)])
    assert [len(x[0]) for x in family.levels] == [16, 8, 4]


# -- language model ------------------------------------------------------------------------------

def model_plain(docs, folds=10, mu=lm.MU):
    def tokens(t):
        return [lower(w) for w in words(t)] + ["\n"]
    learn = [zlib.crc32((str(d) if d is not None else "").encode()) % folds != 0 for d, _ in docs]
    one, two = collections.Counter(), collections.Counter()
    for (_, t), use in zip(docs, learn, strict=True):
        if use:
            one.update(tokens(t))
            two.update(zip(tokens(t), tokens(t)[1:], strict=False))
    total, kinds = sum(one.values()), len(one)
    for _, t in docs:
        w = tokens(t)
        p = [(one[x] + 0.1) / (total + 0.1 * (kinds + 1)) for x in w]
        score = math.log10(p[0])
        for v, x, q in zip(w, w[1:], p[1:], strict=False):
            c = two[v, x]
            c = float(lm.decode(lm.code(np.array([c])))[0]) if c else 0
            score += math.log10((c + mu * q) / (one[v] + mu))
        yield len(w), sum(one[x] > 0 for x in w), total, sum(map(math.log10, p)), score


def test_lm_scores(spark):
    for docs in sets(spark):
        got = lm.score(docs, ~langid.held_out(F.col("doc_id"), 10)).collect()
        assert len(got) == docs.count()
        want = model_plain([(r["doc_id"], r["text"]) for r in got])
        for r, w in zip(got, want, strict=True):
            assert (r["__n_tokens"], r["__n_known"], r["__train_tokens"]) == w[:3]
            assert r["__base"] == pytest.approx(w[3], rel=1e-9)
            assert r["__score"] == pytest.approx(w[4], rel=1e-6)


def test_lm_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for r in lm.score(docs, F.lit(False)).collect():
        assert (r["__base"], r["__n_known"], r["__train_tokens"]) == (0.0, 0, 0)


def test_lm_improves_on_the_base(spark):
    out = queries.op10_lm_score(spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_lm_scores_are_probabilities():
    counts = np.arange(1, 100000)
    assert (lm.decode(lm.code(counts)) <= counts * (1 + 1e-6)).all()
    assert (lm.decode(lm.code(counts)) >= counts * 0.89).all()


@pytest.mark.parametrize("values", [
    [], [0], [5, 5, 5], [0, 1, 2, 3], [2**64 - 1], [0, 2**63, 2**64 - 1],
    sorted(random.Random(1).getrandbits(64) for _ in range(3000)),
    sorted(random.Random(2).randrange(5000) for _ in range(3000)),
    [k * 1000 for k in range(2000)] + [10**15],
])
def test_elias_fano(values):
    ef = EliasFano(np.array(values, np.uint64))
    n = len(values)
    if n:
        assert ef[np.arange(n)].tolist() == values
    ask = np.array(sorted({x for v in values for x in (v, max(v, 1) - 1, min(v + 1, 2**64 - 1))} | {0, 17}), np.uint64)
    a = np.array(values, np.uint64)
    if n:
        assert ef.successor(ask).tolist() == np.searchsorted(a, ask).tolist()
    assert [x >= 0 for x in ef.find(ask)] == [int(x) in set(values) for x in ask]
