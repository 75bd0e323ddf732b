"""Subword lattice language model: a document's probability is the sum over all its segmentations.

A document is its words and one end. A word's lattice has the pieces of an existing vocabulary as arcs and,
if the training texts hold the word, one arc over the whole word; a word that the document has had before has
one more. The word arc weighs its discounted training frequency; the discounted mass goes to the piece
paths, whose weights start from the vocabulary's scores and are re-estimated on the distinct training words by
expected counts (the pieces themselves stay as they are). The recall arc weighs the word's share of the
document so far, which counts as RECALL tokens of the static model against each token read. Words are
separated, so the forward recursion over pieces runs once for each distinct word, in logarithms, and a
document's marginal is the sum over its tokens. Unseen words are spelled, so all texts' probabilities
sum to one at most (the base gives every unseen word the mass of one).

Counts and word scores are tables as large as the corpus' vocabulary; they are aggregated, joined and read in
*chunks* of documents (a hash of id and text picks the chunk; about ``chunk_bytes`` of text each): every chunk
joins the words table with its distinct words, so no task holds more than a chunk and its words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import cut, text_or_empty
from coursemart.llm.lattice import vocabulary

CHUNK_BYTES = 8 << 20
RECALL = 1600.0
ROUNDS = 2
WORDS_AT_ONCE = 200_000


def tokens(text: str | None) -> list[bytes]:
    """The words of a text: A-Z lowered, cut at space, tab, line feed, vertical tab, form feed, return."""
    return (text or "").encode("utf-8", "replace").lower().split()


@dataclass
class Counts:
    """What the model knows of the training texts as a whole."""
    tokens: int      # N: words and ends
    kinds: int       # V: distinct words, and the end
    ends: int
    discount: float = 0.6

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the add-0.5 estimate of a token seen ``c`` times."""
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))

    @property
    def left(self) -> float:
        """Mass that the discount leaves to the piece paths (all of it without training words)."""
        words, kinds = self.tokens - self.ends, max(0, self.kinds - (1 if self.ends else 0))
        return self.discount * kinds / words if words else 1.0

    def word(self, c: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """log10 probability of a word seen ``c`` times whose piece paths weigh exp(pieces)."""
        words = self.tokens - self.ends
        p_word = 1.0 - 10 ** self.end()
        whole = np.where(c > 0, (c - self.discount) / max(words, 1), 0.0)
        with np.errstate(divide="ignore"):
            return (np.logaddexp(np.log(whole), math.log(self.left) + pieces) + math.log(p_word)) / math.log(10)

    def end(self) -> float:
        return math.log10((self.ends + 0.5) / (self.tokens + 1.0))


def piece_sums(words: list[bytes], weight: np.ndarray, model_path: str) -> np.ndarray:
    """Natural log of the total weight of each word's piece paths (the word's mark in front)."""
    vocab = vocabulary(model_path)
    out = np.empty(len(words))
    for a in range(0, len(words), WORDS_AT_ONCE):
        part = words[a:a + WORDS_AT_ONCE]
        buf, start, end = _joined(part)
        lat = vocab.lattice(buf, start, end)
        out[a:a + len(part)] = lat.forward(weight)[lat.last]
    return out


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"".join(b" " + w for w in words), dtype=np.uint8)
    lens = np.array([len(w) + 1 for w in words], dtype=np.int64)
    end = np.cumsum(lens)
    return buf, end - lens, end


def recalled(kind: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """log10 probability of each token of a document with the recall arc: ``kind`` numbers the tokens' words."""
    order = np.argsort(kind, kind="stable")
    first = np.flatnonzero(np.r_[True, kind[order][1:] != kind[order][:-1]])
    before = np.empty(len(kind))
    before[order] = np.arange(len(kind)) - np.repeat(first, np.diff(np.r_[first, len(kind)]))
    with np.errstate(divide="ignore"):
        own = np.where(before > 0, np.log10(RECALL * 10.0 ** lp + before), math.log10(RECALL) + lp)
    return own - np.log10(RECALL + np.arange(len(kind)))


def chunk_words(rows: DataFrame) -> DataFrame:
    """(chunk, word, seen): the distinct words of each chunk with their training occurrences.
    ``rows``: chunk, training, body; dealt by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, tuple[Counter, set]] = {}
        for b in batches:
            for chunk, training, body in zip(b.column("chunk").to_pylist(), b.column("training").to_pylist(), b.column("body").to_pylist()):
                counts, seen = chunks.setdefault(chunk, (Counter(), set()))
                if training:
                    counts.update(tokens(body))
                else:
                    seen.update(tokens(body))
        for chunk, (counts, seen) in chunks.items():
            words = list(counts) + [w for w in seen if w not in counts]
            n = [counts.get(w, 0) for w in words]
            for a in range(0, len(words), WORDS_AT_ONCE):
                part = words[a:a + WORDS_AT_ONCE]
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(part), pa.int64()), pa.array(part, pa.binary()),
                                                  pa.array(n[a:a + len(part)], pa.int64())], names=["chunk", "word", "seen"])

    return rows.mapInArrow(run, "chunk long, word binary, seen long")


def learn_pieces(words: DataFrame, model_path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece weights: from the vocabulary's scores, then ``rounds`` times the pieces' expected counts over
    the distinct training words (what the piece paths stand for are words not seen as such, so each
    distinct word counts once), with 0.1 added. The table that comes to the driver has at most one row per
    piece of the vocabulary."""
    vocab = vocabulary(model_path)
    weight = vocab.weight
    for _ in range(rounds):
        current = weight

        def run(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            v = vocabulary(model_path)
            total = np.zeros(v.size)
            for b in batches:
                part = b.column("word").to_pylist()
                if part:
                    buf, start, end = _joined(part)
                    total += v.lattice(buf, start, end).expected(current, np.ones(len(part)), v.size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], names=["piece", "uses"])

        uses = (words.filter("seen > 0").select("word").mapInArrow(run, "piece int, uses double")
                .groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas())
        n = np.full(vocab.size, 0.1)
        n[uses["piece"].to_numpy(dtype=np.int64)] += uses["uses"].to_numpy(dtype=float)
        n[~np.isfinite(vocab.weight)] = 0.0
        with np.errstate(divide="ignore"):
            weight = np.log(n) - math.log(n.sum())
    return weight


def lm_score(docs: DataFrame, training: Column, model_path: str, id_col: str = "doc_id", text_col: str = "text",
             chunk_bytes: int = CHUNK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out`` (not ``training``), ``n_tokens``, ``n_known``
    (tokens seen in training), ``train_tokens``, ``base_score`` (add-0.5 unigram) and ``score`` (lattice
    model), both log10 probabilities of all the tokens.

    Null text counts as empty; an empty text is its end alone; repeated rows are scored (and, in training,
    counted) each; without training rows nothing is known and words are spelled by pieces; an empty table
    gives an empty table. Texts are scored whole; a word of any length is one lattice."""
    spark = docs.sparkSession
    body = text_or_empty(text_col)
    total, ends = docs.select(F.octet_length(body).alias("n"), training.alias("t")) \
        .agg(F.sum("n"), F.sum(F.coalesce("t", F.lit(False)).cast("long"))).first()
    chunks = max(1, -(-int(total or 0) // chunk_bytes))
    rows = (docs.select(F.col(id_col).alias("doc_id"), body.alias("body"), F.coalesce(training, F.lit(False)).alias("training"))
            .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "body"), F.lit(chunks))).repartition(chunks, "chunk"))
    per_chunk = cut(chunk_words(rows), "chunk-words")
    words = cut(per_chunk.groupBy("word").agg(F.sum("seen").alias("seen")), "words")
    seen, kinds, once, twice = words.agg(F.sum("seen"), *[F.count_if(c) for c in (F.col("seen") > 0, F.col("seen") == 1, F.col("seen") == 2)]).first()
    ends = int(ends or 0)
    # the usual estimate from the numbers of words seen once and twice
    discount = min(0.95, max(0.1, once / (once + 2.0 * twice))) if once else 0.6
    counts = Counts(tokens=int(seen or 0) + ends, kinds=int(kinds or 0) + (1 if ends else 0), ends=ends, discount=discount)
    weight = learn_pieces(words, model_path, rounds)

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = b.column("seen").to_numpy().astype(float)
            w = b.column("word").to_pylist()
            lp = counts.word(c, piece_sums(w, weight, model_path)) if w else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("seen"), pa.array(lp, pa.float64())], names=["word", "seen", "lp"])

    scored = words.mapInArrow(score_words, "word binary, seen long, lp double")
    chunk_scores = per_chunk.select("chunk", "word").join(scored, "word")

    def score_docs(part: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        place = dict(zip(table["word"], range(len(table))))
        c = np.r_[table["seen"].to_numpy(dtype=float), float(counts.ends)]
        base = counts.base(c)
        lp = np.r_[table["lp"].to_numpy(dtype=float), counts.end()]
        out = []
        for text in part["body"]:
            at = np.array([place[w] for w in tokens(text)] + [len(table)], dtype=np.int64)
            out.append((len(at), int((c[at] > 0).sum()), float(base[at].sum()), float(recalled(at, lp[at]).sum())))
        n = np.array(out, dtype=float).reshape(-1, 4)
        return pd.DataFrame({"doc_id": part["doc_id"], "held_out": ~part["training"].astype(bool), "n_tokens": n[:, 0].astype(np.int64),
                             "n_known": n[:, 1].astype(np.int64), "train_tokens": np.int64(counts.tokens),
                             "base_score": n[:, 2], "score": n[:, 3]})

    id_type = docs.schema[id_col].dataType.simpleString()
    return (rows.groupBy("chunk").cogroup(chunk_scores.groupBy("chunk"))
            .applyInPandas(score_docs, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                       "base_score double, score double"))
