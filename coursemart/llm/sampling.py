"""Sampled sentencepiece segmentation: forward filtering, backward sampling over the piece lattice.

Text and pieces: a space is put before the text, and spaces are the vocabulary's word marks; every other
byte is itself. A literal mark character in the text is spelled by byte pieces, so decoding gives back the
text byte for byte. Between two characters that stand next to each other in no piece, every segmentation
has a boundary; so the lattice of a text is the chain of the lattices of the units between such places
(words with their space, punctuation, line ends), and each distinct unit of a batch is filtered once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.llm.common import column_runs, mix64, span_hash, quoted, text_or_empty
from coursemart.llm.lattice import Lattice, Vocabulary, vocabulary

GRID = float(1 << 36)  # arc probabilities as whole numbers: sums are exact, draws do not depend on the batch
BATCH_BYTES = 512 << 10


def units(buf: np.ndarray, text_start: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Start places of the units of the concatenated texts (each begins with its dummy space): the places
    that no piece spans."""
    cut = np.ones(len(buf), dtype=bool)
    cut[1:] = ~joined.ravel()[(buf[:-1].astype(np.int32) << 8) | buf[1:]]
    cut[text_start] = True
    return np.flatnonzero(cut)


class Sampler:
    """Backward draws from filtered lattices: a node's arcs have running sums of whole numbers (the same
    in any batch), longest arc first, so a draw looks at a few arcs."""

    def __init__(self, lat: Lattice, weight: np.ndarray):
        alpha = lat.forward(weight)
        self.src, self.piece = lat.src, lat.piece
        q = np.round(np.exp(alpha[lat.src] + weight[lat.piece] - alpha[lat.dst]) * GRID).astype(np.int64)
        seg = np.flatnonzero(np.r_[True, lat.dst[1:] != lat.dst[:-1]])
        run = np.cumsum(q)
        self.total = np.ones(len(alpha), dtype=np.int64)
        self.arc = np.zeros(len(alpha), dtype=np.int64)
        ends = np.r_[seg[1:], len(q)] - 1
        base = np.r_[0, run[ends[:-1]]]
        own = lat.dst[seg]
        self.total[own] = run[ends] - base
        self.arc[own] = seg
        self.run = run - np.repeat(base, ends - seg + 1)  # running sum within the node

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An arc into each node, chosen by the number ``u`` in [0, 1)."""
        total = self.total[node]
        r = np.minimum((u * total).astype(np.int64), total - 1)
        arc = self.arc[node]
        more = np.flatnonzero(self.run[arc] <= r)
        while len(more):
            arc[more] += 1
            more = more[self.run[arc[more]] <= r[more]]
        return arc


def sample_texts(vocab: Vocabulary, texts: list[bytes], seeds: np.ndarray, weight: np.ndarray,
                 share_units: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts, how many each text has). ``seeds``: one uint64 per text; equal text and
    seed give equal pieces whatever the batch. The empty text has no pieces."""
    buf = np.frombuffer(b"".join(b" " + t for t in texts if t), dtype=np.uint8)
    full = np.array([len(t) > 0 for t in texts], dtype=bool)
    lens = np.array([len(t) + 1 for t in texts], dtype=np.int64)[full]
    counts = np.zeros(len(texts), dtype=np.int64)
    if not len(buf):
        return np.zeros(0, dtype=np.int32), counts
    text_start = np.cumsum(lens) - lens
    start = units(buf, text_start, vocab.joined)
    end = np.r_[start[1:], len(buf)]
    text = np.searchsorted(text_start, start, side="right") - 1
    if share_units:
        _, pick, kind = np.unique(span_hash(buf, start, end), return_index=True, return_inverse=True)
    else:
        pick, kind = np.arange(len(start)), np.arange(len(start))
    lat = vocab.lattice(buf, start[pick], end[pick])
    sampler = Sampler(lat, weight)
    first_unit = np.searchsorted(start, text_start)
    with np.errstate(over="ignore"):
        stream = mix64(seeds[full][text] ^ ((np.arange(len(start)) - first_unit[text]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    node, stop = lat.last[kind], lat.first[kind]
    live = np.arange(len(start))
    made, drawn = np.zeros(len(start), dtype=np.int64), []
    step = 0
    while len(live):
        with np.errstate(over="ignore"):
            x = mix64(stream[live] + np.uint64((step + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        arc = sampler.draw(node, (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53)))
        drawn.append((live, sampler.piece[arc]))
        made[live] += 1
        node = sampler.src[arc]
        on = node != stop
        live, node, stop = live[on], node[on], stop[on]
        step += 1
    after = np.cumsum(made)
    ids = np.empty(int(after[-1]), dtype=np.int32)
    for k, (who, piece) in enumerate(drawn):  # drawn from the end of each unit
        ids[after[who] - 1 - k] = piece
    counts[full] = np.bincount(text, weights=made, minlength=len(lens)).astype(np.int64)
    return ids, counts


def decode_ids(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The text of each run of pieces: their bytes without the first, which is the dummy space."""
    out = vocab.spell(ids).tobytes()
    ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(vocab.lens[ids])])[np.cumsum(counts)]
    starts = np.r_[0, ends[:-1]]
    return [out[a + 1:b] for a, b in zip(starts.tolist(), ends.tolist())]


def encode(docs: DataFrame, model_path: str, seed: int = 17, sharpness: float = 1.0, id_col: str = "doc_id",
           text_col: str = "text", out_col: str = "piece_ids") -> DataFrame:
    """The columns of ``docs`` plus ``out_col`` (array of int): one sampled segmentation per row.

    A segmentation is drawn with probability proportional to exp(sharpness * sum of piece weights), its random
    numbers hashed from (seed, id): the same row gives the same pieces in any run or partitioning. Every
    text is checked by decoding its pieces. Null and empty texts have no pieces; rows with the same id and
    text get the same pieces; a null id is hashed as such; a column of ``docs`` named ``out_col`` is replaced.
    A text without spaces is one long unit: time grows with its length, memory with its batch."""
    keep = quoted(docs.drop(out_col))
    packed = docs.select(F.struct(*keep).alias("row")) if keep else docs
    rows = packed.select("row", text_or_empty(f"row.{text_col}").alias("body"),
                         F.xxhash64(F.lit(seed), F.col(f"row.{id_col}")).alias("seed"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name == "row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        weight = vocab.weight * sharpness
        for b in batches:
            seeds = b.column("seed").to_numpy().astype(np.uint64)
            for i, j, part in column_runs(b.column("body"), BATCH_BYTES):
                ids, counts = sample_texts(vocab, part, seeds[i:j], weight)
                if decode_ids(vocab, ids, counts) != part:  # two units with one hash: do each on its own
                    ids, counts = sample_texts(vocab, part, seeds[i:j], weight, share_units=False)
                    if decode_ids(vocab, ids, counts) != part:
                        raise ValueError("pieces do not spell their text")
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("row").slice(i, j - i), lists], names=["row", "ids"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("ids").alias(out_col))


def decode(df: DataFrame, model_path: str, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """``df`` plus ``out_col``: the text that the pieces spell (no pieces or null: the empty text)."""
    keep = quoted(df.drop(out_col))
    rows = df.select(F.struct(*keep).alias("row"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name == "row"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                col = part.column("ids")
                counts = np.diff(col.offsets.to_numpy()).astype(np.int64)
                text = decode_ids(vocab, col.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([t.decode("utf-8", "replace") for t in text], type=pa.string())],
                                                 names=["row", "text"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("text").alias(out_col))
