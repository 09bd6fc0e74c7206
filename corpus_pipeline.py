"""A corpus pipeline of five stages, each one of the operators of ``tessera.llm``.

Every stage is written as Parquet in the shared scratch folder and read again
as the next one's documents. All but the last return the columns of documents:

1. quality rules: documents that the rules reject go;
2. line dedup: lines found in many documents stay only in the largest doc_id;
3. SimHash near-dedup: of each group of near copies the smallest doc_id stays;
4. mixing: documents are repeated or dropped by their source's target;
5. byte-level BPE: every row becomes ids and is decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, quality, simhash
from tessera.llm.common import BOX, boxed, materialize, read_table
from tessera.llm.queries import digests


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept lines become the text; a text without dropped lines (null as well) is unchanged."""
    out = line_dedup.dedup_lines(boxed(docs, docs.columns, doc_id=docs["doc_id"], text=docs["text"]), carry=[BOX])
    old = {c: F.col(BOX).getField(c) for c in docs.columns}
    new = {"text": F.col("__kept"), "n_chars": F.length("__kept")}
    return out.select(*[(F.when(F.col("__dropped") > 0, new[c]).otherwise(old[c]) if c in new else old[c]).alias(c)
                        for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the smallest doc_id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", byte_bpe),
]

#: Expectation-maximisation, XXH64 fingerprints and BPE are beyond SQL: tests compare the
#: stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
