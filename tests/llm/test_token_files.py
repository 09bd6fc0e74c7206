"""Token files against the tokenizers library, and what their pages allow."""

import glob
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import queries, token_files
from tests.llm.helpers import SCHEMA, rows

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return token_files.load_tokenizer(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def want_rows(library, docs):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) pairs in file order."""
    out, start = [], 0
    for k, text in docs:
        ids = ids_of(library, text)
        out.append((k, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_words_give_the_ids_of_whole_texts(library, tokenizer):
    rng = random.Random(5)
    signs = [*"aZ'sré \t\n\x0b\x0c\r\x85\xa0 　\x1c\x1f̸́=<ΣσςİI日1२😀|\x00", "<|endoftext|>",
             "<|startoftext|>", "\r\n", "'LL", "'ll", " ́", "word", "WORD ",
             "w,", "W.", "é!", "?!", "<|ENDOFTEXT|>", "İ", "K"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(50))) for _ in range(3000)]
    texts += ["", " ", "a" * 20000, "word " * 5000]
    encode = token_files.Encoder(tokenizer, room=500)
    assert encode.by_word
    for at in range(0, len(texts), 300):
        part = texts[at:at + 300]
        ids, sizes = encode(pa.array(part))
        for text, got in zip(part, np.split(ids, np.cumsum(sizes)[:-1])):
            assert got.tolist() == ids_of(library, text)[:-1], repr(text)
    assert len(encode.young) <= 500 + 300 * 50


def test_tokenizers_that_keep_white_space_get_whole_texts(library):
    data = token_files.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    encode = token_files.Encoder(data)
    assert not encode.by_word
    text = "two  words and\n a line"
    ids, sizes = encode(pa.array([text, ""]))
    assert sizes.tolist() == [len(ids), 0] and ids.tolist() == Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text).ids


#: A worker's peak MB over 32 MB of texts in batches of so many bytes, beyond an encoder's own.
PEAK = """
import resource, sys
import pyarrow as pa
from tessera.llm import token_files

letters = str.maketrans("0123456789", "abcdefghij")
encode = token_files.Encoder(token_files.load_tokenizer(sys.argv[1]))
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
rows, before = int(sys.argv[2]) // 4000, peak()
for k in range(0, 8000, rows):
    encode(pa.array([" ".join([str(n).translate(letters) for n in range(10**6 + i * 100, 10**6 + i * 100 + 100)] * 5)
                     for i in range(k, min(k + rows, 8000))]))
print(peak() - before)
"""


def test_a_worker_stays_small(spark, tokenizer, tmp_path):
    token_files.write_tokens(spark.createDataFrame(rows(), SCHEMA), f"{tmp_path}/t", tokenizer, 1)
    batch = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    got = subprocess.run([sys.executable, "-c", PEAK, PATH, batch], capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)})
    assert int(got.stdout) < 240


def test_query_on_the_test_table(spark, library):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = queries.op12_token_files(spark, SF).collect()
    assert sorted(map(tuple, got)) == want_rows(library, docs)


def test_nulls_ties_and_copies(spark, library, tokenizer, tmp_path):
    docs = spark.createDataFrame(rows(), SCHEMA)
    token_files.write_tokens(docs, f"{tmp_path}/t", tokenizer, 1, carry=["size", "a b", "root"])
    read = token_files.read_tokens(spark, f"{tmp_path}/t")
    assert read.columns == ["doc_id", "size", "a b", "root", "n_tokens", "ids", "start"]
    got = sorted((r["start"], r["doc_id"], tuple(r["ids"]), r["n_tokens"]) for r in read.collect())
    assert [g[1] is None for g in got] == sorted([g[1] is None for g in got], reverse=True)
    assert [g[1] for g in got if g[1] is not None] == sorted(g[1] for g in got if g[1] is not None)
    place = 0
    for start, _, ids, n in got:
        assert start == place and n == len(ids) and ids[-1] == 1
        place += n
    assert sorted((str(g[1]), g[2]) for g in got) == sorted(
        (str(r["doc_id"]), tuple(ids_of(library, r["text"]))) for r in docs.collect())
    with pytest.raises(ValueError, match="names"):
        token_files.write_tokens(docs.withColumn("ids", F.lit(1)), f"{tmp_path}/u", tokenizer, 1, carry=["ids"])


def test_one_order_value_spreads_over_ranges(spark, tokenizer, tmp_path):
    docs = spark.range(0, 400, 1, 4).select(F.lit(7).alias("doc_id"), F.lit("the same text").alias("text"))
    token_files.write_tokens(docs, f"{tmp_path}/t", tokenizer, 1, parts=8)
    read = spark.read.parquet(f"{tmp_path}/t/ids")
    counts = [r["count"] for r in read.groupBy("part").count().collect()]
    assert sum(counts) == 400 and len(counts) >= 6 and max(counts) <= 120
    starts = sorted(r["start"] for r in token_files.read_tokens(spark, f"{tmp_path}/t", ["doc_id"]).collect())
    assert starts == list(range(0, 400 * 4, 4))


def test_empty_table(spark, tokenizer, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    token_files.write_tokens(docs, f"{tmp_path}/t", tokenizer, 1)
    out = token_files.ids_crc32(token_files.read_tokens(spark, f"{tmp_path}/t"))
    assert out.collect() == [] and out.columns == ["doc_id", "n_tokens", "start", "ids_crc32"]


def test_files_allow_selective_reads(spark, tokenizer, tmp_path):
    docs = spark.range(0, 6000, 1, 4).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("text number"), "id").alias("text"))
    token_files.write_tokens(docs, f"{tmp_path}/t", tokenizer, 1, parts=2, row_group_bytes=1 << 14, page_rows=100)
    files = sorted(glob.glob(f"{tmp_path}/t/ids/*.parquet"))
    assert len(files) == 2
    for f in files:
        meta = pq.ParquetFile(f).metadata
        assert meta.num_row_groups > 1
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i)
                   for i in range(meta.num_columns)}
        ids = next(c for n, c in columns.items() if n.startswith("ids"))
        assert "RLE_DICTIONARY" in ids.encodings and ids.has_dictionary_page
        for name in ("doc_id", "offset"):
            assert "DELTA_BINARY_PACKED" in columns[name].encodings
        assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    lengths = token_files.read_tokens(spark, f"{tmp_path}/t", ["doc_id", "n_tokens"])
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan
    some = token_files.read_tokens(spark, f"{tmp_path}/t", where=F.col("doc_id").between(3000, 3009))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,3000)" in \
        some._jdf.queryExecution().executedPlan().toString()
    all_rows = {r["doc_id"]: r for r in token_files.read_tokens(spark, f"{tmp_path}/t").collect()}
    got = some.collect()
    assert len(got) == 10 and all(r == all_rows[r["doc_id"]] for r in got)
