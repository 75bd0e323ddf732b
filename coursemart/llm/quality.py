"""Quality classifier: supervised subword embeddings averaged per document, softmax output.

A document's features are its words and the character n-grams of its words (boundaries included), hashed
into a fixed number of learned vectors, and one shared feature for a word that repeats the one before
(it counts as often as the word has n-grams, so that they do not outnumber it).
The document's vector is their mean; a softmax over it gives the classes. Vectors and output are trained
in numpy by stochastic gradient descent (step sizes per coordinate, Adagrad) on a bounded sample of labelled
documents. Since the output is linear in the mean, scoring needs one number per hash: model and
scorer are a fixed few MB whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import Words, column_runs, mix64, quoted, text_or_empty

BITS = 17                    # 131,072 hashed vectors
DIM = 8
ORDERS = (1, 2, 3, 4)        # character n-grams
MAX_TRAIN = 4000             # labelled documents that the fit may use, and
MAX_BYTES = 24 << 20         # bytes of their texts: bounds of the sample
RUN_BYTES = 256 << 10        # text of which features are made at once
EPOCHS = 8
BATCH = 16
RATE = 0.1
REPEAT = 0                   # the hash of the repeat feature


def gram_hashes(w: Words, orders=ORDERS, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (hash of the n-gram at every place of the buffer, whether it is one). A gram lies in
    one word and may take in the space before or after it; it belongs to the text of its first letter."""
    buf = w.buf.astype(np.uint64)
    space = w.buf == 32
    with np.errstate(over="ignore"):
        for n in orders:
            m = len(buf) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=np.uint64)
            ok = np.ones(m, dtype=bool)
            for k in range(n):
                h = (h ^ buf[k:k + m]) * np.uint64(0x100000001B3)
                if 0 < k < n - 1:
                    ok &= ~space[k:k + m]
            if n <= 2:  # not of spaces alone
                ok &= ~space[:m] | (~space[1:1 + m] if n == 2 else False)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield (h >> np.uint64(64 - bits)).astype(np.int64), ok


def word_hashes(w: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word; how often the repeat feature counts for it, 0 if it does not repeat the word
    before it in its text)."""
    h = w.hash
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    return (mix64(h ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - bits)).astype(np.int64), again * (w.end - w.start) * len(ORDERS)


def doc_features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes of each text one after the other, their counts, where each text's begin)."""
    w = Words(texts)
    where = np.repeat(np.arange(len(texts)), w.doc_end - w.doc_start + 1)  # text of each place of the buffer
    where = np.append(where, len(texts) - 1)  # the last space
    keys = []
    for h, ok in gram_hashes(w, bits=bits):
        keys.append((where[:len(h)][ok] << bits) | h[ok])
    h, again = word_hashes(w, bits)
    keys += [(w.doc << bits) | h, np.repeat((w.doc << bits) | REPEAT, again)]
    key, n = np.unique(np.concatenate(keys), return_counts=True)
    cut = np.searchsorted(key >> bits, np.arange(len(texts) + 1))
    return (key & (1 << bits) - 1).astype(np.int32), n.astype(np.float32), cut


@dataclass
class Linear:
    """What scoring needs of a fitted model: a number per hash, and the bias."""
    per_hash: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, texts: list[bytes]) -> np.ndarray:
        w = Words(texts)
        v = self.per_hash
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        first = w.doc_start - 1
        for h, ok in gram_hashes(w, bits=self.bits):
            val = np.where(ok, v[h], 0.0)
            at = np.minimum(first, len(h) - 1)
            inside = first < len(h)
            total += np.where(inside, np.add.reduceat(val, at), 0.0)
            count += np.where(inside, np.add.reduceat(ok.astype(np.int64), at), 0)
        h, again = word_hashes(w, self.bits)
        total += np.bincount(w.doc, weights=v[h] + again * v[REPEAT], minlength=len(texts))
        count += np.bincount(w.doc, weights=1.0 + again, minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def train(texts: list[bytes], labels: np.ndarray, seed: int = 17, epochs: int = EPOCHS, bits: int = BITS, dim: int = DIM,
          rate: float = RATE) -> Linear:
    """Fit vectors and softmax; labels are 0 or 1. Without examples the score is 0.5 everywhere; with one
    class, that class."""
    rng = np.random.default_rng(seed)
    if not len(texts):
        return Linear(np.zeros(1 << bits), 0.0, bits)
    # a few large arrays of 4-byte numbers, so that the driver gets their memory back
    feats, a = [], 0
    while a < len(texts):
        z, size = a + 1, len(texts[a])
        while z < len(texts) and size + len(texts[z]) <= RUN_BYTES:
            size += len(texts[z])
            z += 1
        h, n, at = doc_features(texts[a:z], bits)
        feats += [(h[i:j], n[i:j]) for i, j in zip(at[:-1], at[1:])]
        a = z
    y = labels.astype(int)
    share = np.clip(np.bincount(y, minlength=2) / len(y), 1e-3, 1 - 1e-3)
    vec = rng.uniform(-1, 1, (1 << bits, dim)) / dim
    out = rng.normal(0, 1.0, (dim, 2))
    bias = np.log(share)
    acc_vec, acc_out, acc_bias = np.zeros(1 << bits), np.zeros((dim, 2)), np.zeros(2)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(feats))
        for a in range(0, len(order), BATCH):
            part = order[a:a + BATCH]
            size = np.array([len(feats[i][0]) for i in part])
            idx = np.concatenate([feats[i][0] for i in part])
            wt = np.concatenate([feats[i][1] / max(1.0, feats[i][1].sum(dtype=float)) for i in part], dtype=float)
            row = np.repeat(np.arange(len(part)), size)
            hid = np.stack([np.bincount(row, weights=vec[idx, d] * wt, minlength=len(part)) for d in range(dim)], axis=1)
            z = hid @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = p.copy()
            g[np.arange(len(part)), y[part]] -= 1
            g_hid = g @ out.T
            g_out, g_bias = hid.T @ g, g.sum(axis=0)
            uniq, inv = np.unique(idx, return_inverse=True)
            g_vec = np.stack([np.bincount(inv, weights=g_hid[row, d] * wt, minlength=len(uniq)) for d in range(dim)], axis=1)
            acc_vec[uniq] += (g_vec ** 2).mean(axis=1)
            acc_out += g_out ** 2
            acc_bias += g_bias ** 2
            vec[uniq] -= step * g_vec / np.sqrt(acc_vec[uniq] + 1e-12)[:, None]
            out -= step * g_out / np.sqrt(acc_out + 1e-8)
            bias -= step * g_bias / np.sqrt(acc_bias + 1e-8)
    diff = out[:, 1] - out[:, 0]
    return Linear(vec @ diff, float(bias[1] - bias[0]), bits)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, limit: int, id_col: str = "doc_id",
                    text_col: str = "text", seed: int = 17, max_bytes: int = MAX_BYTES) -> tuple[list[bytes], np.ndarray]:
    """(whole texts, labels) of at most ``limit`` labelled documents and ``max_bytes`` of text: those with the smallest hash of
    (seed, id) whose texts fit in together, so a bounded, reproducible sample whatever the table's size. Ids are
    picked before texts are read. An id with labels of both kinds counts as 1, one that repeats has its smallest text."""
    known = (labels.select(F.col("doc_id").alias("l_id"), F.col(label_col).cast("int").alias("label"))
             .filter("label in (0, 1) and l_id is not null").groupBy("l_id").agg(F.max("label").alias("label")))
    rows = docs.select(F.col(id_col).alias("l_id"), text_or_empty(text_col).alias("body"), learn.alias("learn")).filter("learn")
    sizes = rows.groupBy("l_id").agg(F.max(F.octet_length("body")).alias("size"))
    picked, total = [], 0
    for r in sizes.join(known, "l_id").orderBy(F.xxhash64(F.lit(seed), "l_id"), "l_id").limit(limit).collect():  # two numbers a row
        if total + r["size"] <= max_bytes:
            total += r["size"]
            picked.append((r["l_id"], r["label"]))
    if not picked:
        return [], np.zeros(0, dtype=int)
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.sparkSession.createDataFrame(picked, f"l_id {kind}, label int")
    got = (rows.select("l_id", "body").join(F.broadcast(chosen), "l_id").groupBy("l_id").agg(F.min("body").alias("body"), F.max("label").alias("label"))
           .orderBy("l_id").select("body", "label").toArrow().combine_chunks())
    texts = [t for c in got.column("body").chunks for _, _, run in column_runs(c.cast(pa.string())) for t in run]
    return texts, got.column("label").to_numpy().astype(int)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", max_train: int = MAX_TRAIN,
        id_col: str = "doc_id", text_col: str = "text", seed: int = 17, max_bytes: int = MAX_BYTES) -> Linear:
    """Train on at most ``max_train`` labelled documents, ``max_bytes`` of text, among the rows where ``learn`` holds."""
    texts, y = labelled_sample(docs, labels, label_col, learn, max_train, id_col, text_col, seed, max_bytes)
    return train(texts, y, seed)


def score(docs: DataFrame, model: Linear, text_col: str = "text") -> DataFrame:
    """(row: struct of the columns of ``docs``, score): one row per row of ``docs``. Null and empty texts get the
    score of no features (the bias); texts are scored whole, so a very long one takes as long as it is. Repeated rows
    get the same score; an empty table gives an empty one."""
    from pyspark.sql import types as T

    rows = docs.select(F.struct(*quoted(docs)).alias("row")).select("row", text_or_empty(f"row.{text_col}").alias("body"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [model.score(t) for _, _, t in column_runs(b.column("body"))]
            out = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.float64())], names=["row", "score"])

    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Linear, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they were."""
    return score(docs, model, text_col).filter(F.col("score") >= threshold).select("row.*")
