"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, embed_dedup, langid, licenses, line_dedup, lm, mixing,
                         periodic_runs, phrases, quality, simhash, suffix_dedup, token_files)
from tessera.llm.common import let, read_table, words
from tessera.session import scratch_dir


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.assign_copies(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", F.col(mixing.SIZE).alias("size"),
                      F.col(mixing.SOURCE_SIZE).alias("source_size"),
                      F.col(mixing.TARGET).alias("target"),
                      (F.col(mixing.COPIES) * F.col(mixing.SIZE)).alias("taken"))


def vocabulary() -> tuple[bytes, str]:
    """The bytes and the pattern of the byte-level vocabulary."""
    import public_tokenizers

    return (bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")),
            public_tokenizers.PATTERN)


def digests(docs: DataFrame) -> DataFrame:
    data, pattern = vocabulary()
    ids = bpe.encode(docs, data, pattern, carry=["doc_id"], decoded="decoded")
    return ids.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", F.col("__lines").alias("n_lines"),
                      F.col("__dropped").alias("n_dropped"),
                      F.sha2("__kept", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", F.length(F.replace("__ids", F.lit(" "), F.lit(""))).cast("long")
                      .alias("n_sentences"), F.size("__matches").cast("long").alias("n_matches"),
                      F.array_join("__licenses", ",").alias("licenses"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", simhash.hex16(F.col("__fp")).alias("fingerprint"),
                      F.col("__component").alias("component_id"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), carry=["vec_id"])
    return out.select("vec_id", F.col("__links").alias("n_links"),
                      F.col("__component").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.col("__component"), F.lit(True)).alias("kept"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = quality.score(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    failed = quality.base_failed()
    return scored.select(
        "doc_id", F.col("__q.w.n_words").alias("n_words"), F.col("__q.word_chars").alias("word_chars"),
        F.col("__q.n_symbols").alias("n_symbols"), F.col("__q.l.n_dup_lines").alias("n_dup_lines"),
        F.col("__q.w.n_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (F.col("__q_posterior") >= 0.5)).alias("kept"),
        F.round("__q_posterior", 6).alias("posterior"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", langid.held_out(F.col("doc_id"), 5).alias("held_out"),
                      F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", F.col("__bytes").alias("n_bytes"),
                      (F.col("__bytes") - F.octet_length("__kept")).cast("long").alias("n_removed"),
                      F.size("__spans").cast("long").alias("n_spans"),
                      F.sha2("__kept", 256).alias("kept_sha256"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = langid.held_out(F.col("doc_id"), 10)
    out = lm.score(read_table(spark, sf_dir, "documents"), ~held, carry=["doc_id"])
    return out.select("doc_id", held.alias("held_out"), F.col("__n_tokens").alias("n_tokens"),
                      F.col("__n_known").alias("n_known"),
                      F.col("__train_tokens").alias("train_tokens"),
                      F.col("__base").alias("base_score"), F.col("__score").alias("score"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, "token-files")
    tokenizer = token_files.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer, end_id=1)
    read = token_files.read_tokens(spark, path, ["doc_id", "ids"])
    out = read.withColumn("n_tokens", F.size("ids").cast("long"))
    return token_files.ids_crc32(out).select("doc_id", "start", "n_tokens", "ids_crc32")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` where one document in ten, by its id's CRC-32 h (h % 10 = 0), repeats a stretch of
    its words: with g = h / 10 and n words, word i >= a is word a + (i - a) % p, where a = g % n
    and p = 1 + (n - a) / (3 + g % 8), all in whole numbers. A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w):
        a = g % F.size(w)
        p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
        return let(F.struct(w.alias("w"), a.alias("a"), p.alias("p")), lambda v: F.array_join(
            F.transform(v["w"], lambda x, i: F.when(i < v["a"], x).otherwise(
                F.get(v["w"], (v["a"] + (i - v["a"]) % v["p"]).cast("int")))), " "))

    new = F.when(F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").rlike(r"[^\x20\x09-\x0D]"),
                 let(words(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.withColumn("text", new)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_repeats(read_table(spark, sf_dir, "documents"))
    found = periodic_runs.find_runs(docs, runs="r", collapsed="k", carry=["doc_id"])
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate("r", F.lit(None).cast(kind), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("r", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select("doc_id", F.size("r").cast("long").alias("n_runs"), best.alias("b"),
                        F.sha2(text, 256).alias("runs_sha256"),
                        F.sha2("k", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"),
        F.col("b.period").alias("period"),
        F.floor(1000 * F.col("b.length") / F.col("b.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_byte_bpe, op3_line_dedup, op4_license_scan, op5_simhash,
    op6_embedding_dedup, op7_quality_rules, op8_language_id,
    op9_suffix_dedup, op10_lm_score, op11_phrases, op12_token_files,
    op13_periodic_runs)}
