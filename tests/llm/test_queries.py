"""The registered queries: against DuckDB where SQL can express them, and their contracts."""

import hashlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import rows_of

SF = Path("/root/testdata/sf0.001")
COLUMNS = {
    "op1_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double",
                        "taken": "bigint"},
    "op2_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op4_license_scan": {"doc_id": "bigint", "licenses": "string"},
    "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                          "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
                          "kept": "boolean"},
    "op8_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op9_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint",
                         "kept_sha256": "string"},
    "op10_lm_score": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                      "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op13_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint",
                           "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string",
                           "collapsed_sha256": "string"},
    "op11_phrases": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint",
                     "r": "bigint", "n": "bigint", "score": "bigint"},
    "op12_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


def test_all_operators_are_registered():
    assert set(COLUMNS) | {"pipeline"} == set(E.LLM_QUERIES)
    assert set(E.LLM_ORACLE) <= set(E.LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(E.LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF / t}.parquet')")
    df = E.queries()[name](spark, str(SF))
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, rows) == rows_of(cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns_and_rows(spark, name):
    df = E.queries()[name](spark, str(SF))
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name == "op11_phrases":  # a row a phrase, not a document
        return
    table, key = ("embeddings", "vec_id") if "vec_id" in kinds else ("documents", "doc_id")
    want = Counter(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
    rows = df.collect()
    assert Counter(r[key] for r in rows) == want
    if name == "op2_byte_bpe":
        texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
        for r in rows:
            assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_entry_works_without_the_subpackage():
    import subprocess
    import sys

    code = ("import sys; sys.modules['tessera.llm'] = None; import __spark_entry__ as E; "
            "assert not E.LLM_QUERIES and 'fact_build' in E.queries()")
    root = Path(__file__).resolve().parents[2]
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0
