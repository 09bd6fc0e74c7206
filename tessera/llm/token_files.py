"""Token ids of documents as Parquet files that can be read selectively.

``write_tokens`` cuts the documents by range of their order column, encodes
each range in one task and writes one row a document, in order: the order
column, ``part`` (the range), ``offset`` (ids before it in its range),
``n_tokens`` and the id list. The ids use dictionary encoding (a vocabulary's ids
take two bytes at most), the sorted numbers delta encoding; row groups and
pages have set sizes and the writer adds a page index, so a reader that wants
lengths never touches the ids, and one that wants a range of documents reads
only its pages. A small table beside them holds the ids before each range, of
which there are as many as partitions; ``read_tokens`` adds it to the offsets.

Ranges are cut by the order column, then by the text's hash and the row's place,
so a value that many rows share does not land in one task.

The tokenizer is a file of the ``tokenizers`` library, read once by the driver
(its size is checked) and sent as bytes. A text is encoded by its words (between
ASCII white space): for tokenizers that drop white space before they merge
this gives the ids of the whole text, and ``splits_at_white_space`` says whether
that holds; other tokenizers get the whole text. Ids of words seen lately are
remembered in a bounded table.

Defined results: a null text has the ids of an empty one (the end id only); rows
with a null order value come first; rows of equal order value are ordered by the
text's hash; extra columns are not stored unless named in ``carry``.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import python_batches, shuffle_partitions

#: A tokenizer file above this size is refused, as every worker holds it.
MAX_TOKENIZER_BYTES = 64 << 20
#: MB of text that a worker encodes at once; its arrays take some ten times that.
BATCH_MB = 4
#: Words whose ids a worker remembers: twice this number and a batch's words at most.
REMEMBERED = 300_000
#: Texts or lines of 100 words that the library encodes at once: it holds some 100 bytes a token meanwhile.
GROUP = 200
#: Longer words are not remembered.
LONGEST = 64
SIGNS = (b".", b",", b";", b":", b"!", b"?")
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 512


def load_tokenizer(path: str) -> bytes:
    data = Path(path).read_bytes()
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"tokenizer of {len(data)} bytes; at most {MAX_TOKENIZER_BYTES}")
    return data


def splits_at_white_space(tokenizer: bytes) -> bool:
    """Whether a text's ids are those of its words one after another.

    True for the one layout known to be so: runs of white space become a space,
    a pattern that keeps no white space cuts the words, nothing is added in
    front, and no added token takes white space around it.
    """
    spec = json.loads(tokenizer)
    norm = spec.get("normalizer") or {}
    kinds = [x["type"] for x in norm.get("normalizers", [norm]) if x]
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    return (set(kinds) <= {"NFC", "Replace", "Lowercase"} and kinds[:1] == ["NFC"]
            and first.get("type") == "Split" and first.get("behavior") == "Removed"
            and bool(first.get("invert"))
            and r"[^\s\p{L}\p{N}]+" in first["pattern"].get("Regex", "")
            and all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps[1:])
            and not spec.get("post_processor")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                        for t in spec["added_tokens"]))


class Encoder:
    """Ids of whole texts: (all ids one after another, how many each text has)."""

    def __init__(self, tokenizer: bytes, room: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer)
        self.by_word = splits_at_white_space(tokenizer)
        self.marks = [t["content"].lower() for t in json.loads(tokenizer)["added_tokens"]]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.room = room
        if self.by_word:
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
            self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
            self.signs = dict(zip(SIGNS, self._encode(list(SIGNS))))

    def _ids(self, texts: list[bytes]) -> Iterator[list[int]]:
        for k in range(0, len(texts), GROUP):
            some = [t.decode() for t in texts[k:k + GROUP]]
            for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                yield e.ids

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        return [np.asarray(ids, "<u4").tobytes() for ids in self._ids(texts)]

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words. Those of letters only are one piece each, so many are encoded as one
        text and cut where a piece ends."""
        plain, rest = [], []
        for w in words:
            letters = w.isalpha() if w.isascii() else w.decode().lower().isalpha()
            (plain if letters else rest).append(w)
        out = dict(zip(rest, self._encode(rest)))
        lines = [b" ".join(plain[k:k + 100]) for k in range(0, len(plain), 100)]
        flat = np.fromiter(chain.from_iterable(self._ids(lines)), "<u4")
        ends = (np.flatnonzero(self.last[flat]) + 1) * 4
        if len(ends) != len(plain):  # a letter that the pieces are cut at
            return out | dict(zip(plain, self._encode(plain)))
        packed, at = flat.tobytes(), [0, *ends.tolist()]
        out.update((w, packed[a:b]) for w, a, b in zip(plain, at, at[1:]))
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            packed = self._encode([x or b"" for x in texts.cast(pa.binary()).to_pylist()])
            return (np.frombuffer(b"".join(packed), "<u4"),
                    np.fromiter((len(x) >> 2 for x in packed), np.int64, len(packed)))
        # A-Z lower-cased as the tokenizer does; an added token is looked for before that, so a
        # text that may hold one in other letters stays as it is
        low = pc.ascii_lower(texts)
        for mark in self.marks:
            low = pc.if_else(pc.match_substring(low, mark), texts, low)
        split = pc.ascii_split_whitespace(low)
        words = split.flatten().dictionary_encode()
        # by way of NumPy, as to_pylist takes several times as long
        distinct = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = self._look_up(distinct)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        starts = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(known), "<u4")
        at = words.indices.to_numpy()
        n = sizes[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(starts[at] - ends + n, n) + np.arange(total)]
        ends = np.concatenate([[0], ends])
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids, np.diff(ends[bounds])

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of distinct words."""
        young, old, fresh = self.young, self.old, []
        young[b""] = b""  # before and after white space at a text's ends
        out = list(map(young.get, words))
        missing = [k for k, ids in enumerate(out) if ids is None]
        for k in missing:
            w = words[k]
            ids = old.get(w)
            if ids is None:
                fresh.append(w)
            else:
                young[w] = ids
        # a sign after a letter or digit is a piece of its own
        stems = {w: w[:-1] for w in fresh if w[-1:] in SIGNS and w[-2:-1].isalnum()}
        young.update(self._encode_words(list({stems.get(w, w) for w in fresh}.difference(young))))
        for w, stem in stems.items():
            young[w] = young[stem] + self.signs[w[-1:]]
        for k in missing:
            out[k] = young[words[k]]
        for w in fresh:
            if len(w) > LONGEST:
                young.pop(w, None)
                young.pop(w[:-1], None)
        if len(young) >= self.room:
            self.old, self.young = young, {}
        return out


@lru_cache(maxsize=1)
def _encoder(tokenizer: bytes) -> Encoder:
    """One for each worker process, so that its tasks share what they remember."""
    return Encoder(tokenizer)


def write_tokens(docs: DataFrame, path: str, tokenizer: bytes, end_id: int, order: str = "doc_id",
                 text: str = "text", carry: list[str] | None = None, parts: int | None = None,
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
                 page_rows: int = PAGE_ROWS) -> None:
    """Write the ids of ``docs`` to the folder ``path``, ``end_id`` after each document.

    The files hold ``order`` and the columns ``carry`` under their own names, and
    ``part``, ``offset``, ``n_tokens`` and ``ids``: none of those may be a name in ``carry``.
    """
    own = {"part", "offset", "n_tokens", "ids", order}
    carry = list(carry or [])
    if clash := own & set(carry):
        raise ValueError(f"columns {sorted(clash)} have names that the files use themselves")
    spark = docs.sparkSession
    python_batches(spark, rows=10_000, mb=BATCH_MB)
    sent = spark.sparkContext.broadcast(tokenizer)
    t = F.coalesce(docs[text], F.lit(""))
    placed = docs.select(docs[order].alias("k"), t.alias("t"), F.xxhash64(t).alias("h"),
                         F.monotonically_increasing_id().alias("p"),
                         F.struct(*[docs[c] for c in carry]).alias("c") if carry
                         else F.lit(None).cast("int").alias("c"))
    ranges = placed.repartitionByRange(parts or shuffle_partitions(spark), "k", "h", "p")
    sorted_rows = ranges.sortWithinPartitions("k", "h", "p").select("k", "c", "t")
    schema = T.StructType([*sorted_rows.select("k", "c").schema.fields,
                           T.StructField("part", T.IntegerType(), False),
                           T.StructField("offset", T.LongType(), False),
                           T.StructField("n_tokens", T.IntegerType(), False),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        encode = _encoder(sent.value)
        for batch in batches:
            ids, sizes = encode(batch.column(2))
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            flat = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int32)
            inner = np.ones(len(flat), bool)
            inner[ends - 1] = False
            flat[inner] = ids
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.full(len(sizes), part, np.int32)),
                 pa.array(before + ends - sizes), pa.array(sizes.astype(np.int32)), lists],
                names=schema.names)
            before += int(ends[-1]) if len(ends) else 0

    rows = sorted_rows.mapInArrow(run, schema).select(
        F.col("k").alias(order), *[F.col("c")[c].alias(c) for c in carry],
        "part", "offset", "n_tokens", "ids")
    w = rows.write
    for k, v in {"parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
                 "parquet.page.row.count.limit": page_rows, "parquet.writer.version": "PARQUET_2_0",
                 "parquet.enable.dictionary": "true", f"parquet.enable.dictionary#{order}": "false",
                 "parquet.enable.dictionary#offset": "false",
                 "parquet.enable.dictionary#n_tokens": "false", "compression": "zstd"}.items():
        w = w.option(k, str(v))
    w.parquet(f"{path}/ids")
    _part_starts(spark.read.parquet(f"{path}/ids")).write.parquet(f"{path}/starts")


def _part_starts(files: DataFrame) -> DataFrame:
    """(part, base): ids in all ranges before. One row a range reaches the running sum."""
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None,
                where: Column | None = None) -> DataFrame:
    """The documents of a folder that ``write_tokens`` wrote, with ``start``: ids of all
    documents before.

    ``columns`` picks stored columns (the ids are read only if named, or if it is
    None), ``where`` is a condition on stored columns that prunes files, row groups
    and pages.
    """
    files = spark.read.parquet(f"{path}/ids")
    names = [c for c in files.columns if c not in ("part", "offset")]
    bases = spark.read.parquet(f"{path}/starts").withColumnRenamed("part", "__part")
    kept = files if where is None else files.where(where)
    start = (F.col("base") + F.col("offset")).alias("start")
    return kept.join(bases, F.col("part") == F.col("__part")).select(
        *(names if columns is None else columns), start)


def ids_crc32(df: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """``df`` with the unsigned CRC-32 of the little-endian ids in place of the id column."""
    rest = [c for c in df.columns if c != ids]
    source = df.select(*rest, ids)
    schema = T.StructType([*df.select(*rest).schema.fields, T.StructField(out, T.LongType())])
    python_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(rest))
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())],
                                             names=schema.names)

    return source.mapInArrow(run, schema)
