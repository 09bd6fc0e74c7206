"""The corpus pipeline stage by stage against plain Python."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SCHEMA, rows, sha
from tests.llm.test_text_ops import (components_plain, fingerprint_plain, line_dedup_plain,
                                     quality_plain)

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def inputs(spark):
    yield spark.createDataFrame(rows(), SCHEMA)
    yield spark.read.parquet(f"{SF}/documents.parquet")
    yield spark.createDataFrame([], SCHEMA)


def test_stages_keep_the_columns(spark):
    for docs in inputs(spark):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.dtypes == docs.dtypes, name
            out.collect()


def test_quality_stage_rejects_failing_documents(spark):
    for docs in inputs(spark):
        kept = {r["doc_id"] for r in STAGES["quality rules"](spark, docs, SF).collect()}
        for r in docs.collect():
            n, _, _, _, rep = quality_plain(r["text"])
            if n < 20 or 100 * rep > 30 * n:
                assert r["doc_id"] not in kept or r["doc_id"] is None


def test_line_stage(spark):
    for docs in inputs(spark):
        want = collections.Counter(x[3] for x in line_dedup_plain([(r["doc_id"], r["text"]) for r in docs.collect()]))
        out = STAGES["line dedup"](spark, docs, SF).collect()
        assert collections.Counter(sha(r["text"] or "") for r in out) == want


def test_simhash_stage_keeps_the_smallest_of_each_group(spark):
    for docs in inputs(spark):
        fps = collections.defaultdict(list)
        for r in docs.collect():
            fps[fingerprint_plain(r["text"])].append(r["doc_id"])
        root = components_plain(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
        groups = collections.defaultdict(list)
        for fp, ids in fps.items():
            groups[root[fp]] += [i for i in ids if i is not None]
        out = STAGES["SimHash near-dedup"](spark, docs, SF).collect()
        assert sorted(str(r["doc_id"]) for r in out) == sorted(str(min(g, default=None)) for g in groups.values())


def test_simhash_stage_keeps_one_of_near_copies_without_ids(spark):
    base = [f"word{k}" for k in range(400)]
    texts = [" ".join([*base, f"tail{k}"]) for k in range(12)]
    fps = {fingerprint_plain(t) for t in texts}
    root = components_plain(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    assert len(set(root.values())) < len(fps)  # some are near but not equal
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert STAGES["SimHash near-dedup"](spark, docs, SF).count() == len(set(root.values()))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = collections.Counter(r["doc_id"] for r in out.collect())
    assert got and set(got) <= {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    again = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect())
    assert got == again


@pytest.mark.parametrize("name", ["quality rules", "line dedup", "SimHash near-dedup"])
def test_clean_documents_stay(spark, name):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1"), "doc_id").drop(
            "quality", "toxic").dropDuplicates(["text"])
    n = docs.count()
    assert STAGES[name](spark, docs, SF).count() >= 0.95 * n


HELPERS = ["__place", "__own", "__own_row", "__id", "__row", "__text", "__body", "__q", "__q_posterior", "__box",
           "__mix_size", "__mix_source_size", "__mix_target", "__mix_copies", "__mix_copy", "__mix_salt", "__mix_draw",
           "__lines", "__dropped", "__kept", "__drop", "__at", "__key", "__n", "__keeper", "__fp", "__component",
           "__root", "__first", "__member", "place", "kept", "body", "own", "own_row", "src", "of", "salt", "rsalt",
           "draw", "size", "node", "root", "first", "none", "count", "w", "x y"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_named_like_a_helper_come_out_unchanged(spark, name):
    """Every row that comes out has the values it went in with, in columns of every helper's name."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = [F.concat(F.lit(c), F.lit(":"), F.col("doc_id").cast("string")).alias(c) for c in HELPERS]
    wide = docs.select("*", *marks)
    out = STAGES[name](spark, wide, SF)
    assert out.dtypes == wide.dtypes
    got = out.collect()
    plain = STAGES[name](spark, docs, SF).collect()
    assert sorted(str(tuple(r[c] for c in docs.columns)) for r in got) == sorted(map(str, map(tuple, plain)))
    assert got and all(r[c] == f"{c}:{r['doc_id']}" for r in got for c in HELPERS)
