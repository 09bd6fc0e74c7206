"""Language identification with a byte convolutional network.

The network embeds bytes, slides filters of several widths over a window of
``WINDOW`` bytes, keeps each filter's maximum, and ends in a softmax over the
languages seen in training. It is trained in numpy on the driver, on a sample
of labelled rows bounded by two parameters (documents, and windows a document);
rows are sampled by a hash of their id, so a rerun trains the same network.

Prediction covers whole texts: each text is cut into consecutive windows,
windows of many texts are run as one batch, and a text's probabilities are the
mean over its windows, weighted by their bytes. The first layers are folded
into tables over byte pairs (two bytes determine what a filter sees of them),
so a position costs two look-ups.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text if no labelled row was there to learn from; a null label
is never learned; a null id samples and predicts like any other row; an empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import python_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
DEPTH = 8
#: Bounds of the training sample.
MAX_DOCUMENTS = 4000
MAX_WINDOWS = 3
WINDOWS_AT_ONCE = 128
UNKNOWN = "und"


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray            # 256 x DEPTH
    filters: list[np.ndarray]    # a width each: width x DEPTH x FILTERS
    bias: np.ndarray             # len(WIDTHS) * FILTERS
    out: np.ndarray              # features x languages
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, self.bias, self.out, self.out_bias]


def windows(data: bytes) -> np.ndarray:
    """A row for every ``WINDOW`` bytes, with zero bytes after them for the widest filter."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros((n, WINDOW + max(WIDTHS) - 1), np.uint8)
    out[:, :WINDOW] = np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _forward(net: Network, x: np.ndarray):
    """Pooled features and where each maximum was found."""
    e = net.embed[x]
    pooled, at = [], []
    for w, f in zip(WIDTHS, net.filters, strict=True):
        z = sum(e[:, k:k + WINDOW] @ f[k] for k in range(w))
        at.append(z.argmax(axis=1))
        pooled.append(np.take_along_axis(z, at[-1][:, None, :], axis=1)[:, 0, :])
    return np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0), at


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    features, at = _forward(net, x)
    d = softmax(features @ net.out + net.out_bias)
    d[np.arange(len(y)), y] -= 1
    d *= weight[:, None] / weight.sum()
    g_out, g_out_bias = features.T @ d, d.sum(axis=0)
    d = (d @ net.out.T) * (features > 0)
    g_embed, g_filters = np.zeros_like(net.embed), []
    for j, (w, f) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        dj = d[:, j * FILTERS:(j + 1) * FILTERS]
        seen = x[np.arange(len(x))[:, None, None], at[j][:, :, None] + np.arange(w)]
        g_filters.append(np.einsum("bfkd,bf->kdf", net.embed[seen], dj))
        np.add.at(g_embed, seen, dj[:, :, None, None] * f.transpose(2, 0, 1)[None])
    return [g_embed, *g_filters, d.sum(axis=0), g_out, g_out_bias]


def train(samples: list[tuple[str, bytes]], epochs: int = 4, batch: int = 64, rate: float = 0.01,
          seed: int = 8) -> Network | None:
    """A network from (language, window) pairs; languages weigh alike, however frequent."""
    if not samples:
        return None
    rng = np.random.default_rng(seed)
    langs = sorted({s for s, _ in samples})
    x = np.concatenate([windows(data[:WINDOW]) for _, data in samples])
    y = np.array([langs.index(s) for s, _ in samples])
    weight = 1 / np.bincount(y)[y]
    n = len(WIDTHS) * FILTERS
    net = Network(langs, rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
                  [rng.normal(0, (w * DEPTH) ** -0.5, (w, DEPTH, FILTERS)).astype(np.float32)
                   for w in WIDTHS], np.zeros(n, np.float32),
                  rng.normal(0, n ** -0.5, (n, len(langs))).astype(np.float32),
                  np.zeros(len(langs), np.float32))
    params = net.parameters()
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), batch):
            step += 1
            some = order[k:k + batch]
            grads = _gradients(net, x[some], y[some], weight[some])
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * 0.5 ** epoch * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


class Predictor:
    """The network with its first layers folded into tables over pairs of bytes."""

    def __init__(self, net: Network):
        self.net = net
        one = [[(net.embed @ f[k]) if k < len(f) else None for k in range(max(WIDTHS))]
               for f in net.filters]

        def pairs(k: int) -> np.ndarray:
            zero = np.zeros((256, FILTERS), np.float32)
            parts = [((zero if t[k] is None else t[k])[:, None, :]
                      + (zero if t[k + 1] is None else t[k + 1])[None, :, :]).reshape(65536, -1)
                     for t, w in zip(one, WIDTHS, strict=True) if w > k]
            return np.ascontiguousarray(np.concatenate(parts, axis=1))

        self.tables = [pairs(k) for k in range(0, max(WIDTHS), 2)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        out = []
        for k in range(0, len(x), WINDOWS_AT_ONCE):
            some = x[k:k + WINDOWS_AT_ONCE]
            pair = (some[:, :-1].astype(np.uint16) << 8) | some[:, 1:]
            z = self.tables[0][pair[:, :WINDOW]]
            for j, table in enumerate(self.tables[1:], 1):
                part = table[pair[:, 2 * j:2 * j + WINDOW]]
                z[:, :, -part.shape[2]:] += part
            features = np.maximum(z.max(axis=1) + self.net.bias, 0)
            out.append(softmax(features @ self.net.out + self.net.out_bias))
        return np.concatenate(out)


def sample_windows(docs: DataFrame, lang: str, text: str, doc_id: str,
                   max_documents: int = MAX_DOCUMENTS,
                   max_windows: int = MAX_WINDOWS) -> list[tuple[str, bytes]]:
    """At most ``max_documents * max_windows`` labelled windows, chosen by hashes of the id.

    Rows are first thinned by the hash to about the number wanted (a little more),
    so what the tasks return does not grow with their number.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = labelled.count()
    h = F.xxhash64(F.lit(3), F.col(doc_id).cast("string"), text)
    share = min(1.0, 1.2 * max_documents / max(n, 1))
    some = labelled.where((F.pmod(h, F.lit(1 << 30)) < F.lit(share * (1 << 30)))
                          & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.encode(text, "UTF-8").alias("data"), h.alias("h"))
    places = F.ceil(F.octet_length("data") / WINDOW)
    picks = F.array_distinct(F.array(*[F.pmod(F.xxhash64("h", F.lit(k)), places)
                                       for k in range(max_windows)]))
    cut = some.select("h", "lang", F.transform(picks, lambda p: F.substring(
        F.col("data"), (p * WINDOW + 1).cast("int"), F.lit(WINDOW))).alias("w"))
    rows = cut.orderBy("h", "lang", "w").limit(max_documents).collect()
    return [(r["lang"], bytes(w)) for r in rows for w in r["w"]]


def predict(docs: DataFrame, net: Network | None, text: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``__lang`` and ``__score``."""
    carry = docs.columns if carry is None else carry
    letters = F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return docs.select(*carry, F.lit(UNKNOWN).alias("__lang"), F.lit(0.0).alias("__score"))
    python_batches(docs.sparkSession)
    source = docs.select(*carry, F.when(letters, docs[text]).alias("__text"))
    schema = T.StructType([*docs.select(*carry).schema.fields, T.StructField("__lang", T.StringType()),
                           T.StructField("__score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net)
        names = [*net.langs, UNKNOWN]
        for batch in batches:
            best = np.full(batch.num_rows, len(net.langs))
            score = np.zeros(batch.num_rows)
            pending, rows, used = [], [], 0

            def flush():
                if not pending:
                    return
                data = [p.encode() for p in pending]
                cut = [windows(d) for d in data]
                n = np.array([len(c) for c in cut])
                p = predictor(np.concatenate(cut))
                weight = np.full(n.sum(), float(WINDOW))
                weight[np.cumsum(n) - 1] = [len(d) - (len(c) - 1) * WINDOW
                                            for d, c in zip(data, cut, strict=True)]
                total = np.add.reduceat(p * weight[:, None], np.cumsum(n) - n, axis=0)
                total /= total.sum(axis=1, keepdims=True)
                best[rows], score[rows] = total.argmax(axis=1), total.max(axis=1)
                pending.clear()
                rows.clear()

            for r, value in enumerate(batch.column(len(carry))):
                if (t := value.as_py()) is not None:
                    pending.append(t)
                    rows.append(r)
                    used += len(t)
                    if used > 1 << 19:
                        flush()
                        used = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([names[k] for k in best], pa.string()),
                 pa.array(np.minimum(score, 1.0))],
                names=[*batch.schema.names[:-1], "__lang", "__score"])

    return source.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether the CRC-32 of the id as text falls into fold 0 (a null id counts as empty text)."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % folds == 0


def identify(docs: DataFrame, folds: int = 5, lang: str = "lang", text: str = "text",
             doc_id: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Train on the rows outside fold 0 and predict every row."""
    net = train(sample_windows(docs.where(~held_out(F.col(doc_id), folds)), lang, text, doc_id))
    return predict(docs, net, text, carry)
