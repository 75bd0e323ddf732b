"""Token ids as Parquet list columns: ordered shards, controlled row groups, page indexes, selective reads.

Layout of a table: one file per shard, shards and rows in ascending id order. Columns: ``doc_id`` and ``seq``
(shard number << 33 | row in shard), ``n_tokens``, ``tokens`` (list of int). Numbers are delta-encoded, tokens
dictionary-encoded (the dictionary is the vocabulary in use; beyond its page size, delta). Pages are
small and row groups bounded, so the column and offset indexes let a reader of some ids, or of the
numbers alone, skip the token pages.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursemart.llm.common import Words, column_runs, scratch_path, span_hash, text_or_empty

CACHE_WORDS = 1_200_000      # runs kept by a worker from batch to batch, about 50 bytes each
RECENT = 1 << 16             # runs that are found before they are merged with those kept longer
RUN_BYTES = 1 << 20          # text encoded at once
ENCODE_AT_ONCE = 4096
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
# Bytes of token runs that need no tokenizer to tell apart: letters of ASCII and Latin-1 (all letters to such a tokenizer,
# and composed already), digits, and ASCII punctuation without the apostrophe, which may begin a run of its own.
SPACE, LETTER, SIGN, DIGIT, OTHER = range(5)
_KIND = np.full(256, OTHER, dtype=np.uint8)
_KIND[33:127] = SIGN
_KIND[ord("'")] = OTHER
_KIND[32], _KIND[48:58], _KIND[65:91], _KIND[97:123] = SPACE, DIGIT, LETTER, LETTER


def kinds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind of each byte, the bytes with their letters lowered). Two bytes of a Latin-1 letter are letters both."""
    kind, low = _KIND[buf], buf.copy()
    low[(buf >= 65) & (buf <= 90)] += 32
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    after = buf[lead + 1]
    lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]  # not the signs of times and division
    kind[lead] = kind[lead + 1] = LETTER
    capital = lead[(buf[lead + 1] < 0x9F)]
    low[capital + 1] += 0x20
    kind[np.flatnonzero((buf[:-1] == ord("<")) & (buf[1:] == ord("|")))] = OTHER        # may be a special token's name
    return kind, low


class WordIds:
    """Token ids of whitespace-free words by a tokenizers file, each run of letters, digit or run of signs encoded once
    while it is kept.

    Holds for tokenizers that lower their text, cut at white space and drop it, and cut between letters, single digits
    and other signs: then a text's ids are its runs' ids in turn. Words with any other byte are encoded whole, as they
    are. Runs are told apart by two 64-bit hashes. The first CACHE_WORDS are kept from batch to batch, later ones for
    their own."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        #: ids that end a run; without word ends in the vocabulary, words are encoded one by one
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.kept, self.recent = _Index(), _Index()
        self.check = np.zeros(0, dtype=np.uint64)  # second hash of each
        self.words = _Lists()

    def _add(self, runs: list[bytes], plain: np.ndarray) -> np.ndarray:
        """Encode the runs, the plain ones many at once; the number of each."""
        number = np.empty(len(runs), dtype=np.int64)
        for whole, which in ((False, np.flatnonzero(plain)), (True, np.flatnonzero(~plain))):
            for a in range(0, len(which), ENCODE_AT_ONCE):
                part = which[a:a + ENCODE_AT_ONCE]
                if whole:
                    ids = [e.ids for e in self.tokenizer.encode_batch_fast([runs[i].decode("utf-8", "replace") for i in part], add_special_tokens=False)]
                    n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                    flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(n.sum()))
                else:  # apart by spaces: each ends with a word end
                    text = b" ".join([runs[i] for i in part]).decode()
                    flat = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)
                    n = np.diff(np.flatnonzero(np.r_[True, self.ends[flat]]))
                    if len(n) != len(part):
                        raise ValueError("a plain run is not one of this tokenizer")
                number[part] = self.words.add(flat, n)
        return number

    def _runs(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start, end, text, plain) of the runs of all words: of a word of plain bytes its parts, of another itself."""
        if not len(w.start) or not self.ends.any():
            return w.buf, w.start, w.end, w.doc, np.zeros(len(w.start), dtype=bool)
        kind, low = kinds(w.buf)
        odd = np.add.reduceat(kind == OTHER, w.start) > 0          # up to the next word's start: a space lies between
        at = np.zeros(len(w.buf), dtype=np.int8)                   # bytes of odd words keep their own form and are not cut
        at[w.start[odd]] = 1
        at[w.end[odd]] -= 1
        inside = np.cumsum(at, dtype=np.int8).astype(bool)
        buf = np.where(inside, w.buf, low)
        cut = np.zeros(len(buf), dtype=bool)
        cut[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & ~(inside[1:] & inside[:-1])
        cut &= kind != SPACE
        cut[w.start] = True
        start = np.flatnonzero(cut)
        space = np.flatnonzero(w.buf == 32)
        end = np.minimum(np.append(start[1:], len(buf)), space[np.searchsorted(space, start)])
        word = np.searchsorted(w.start, start, side="right") - 1
        return buf, start, end, w.doc[word], ~odd[word]

    def encode(self, texts: list[bytes], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has); ``end_id`` closes each text."""
        buf, start, end, doc, plain = self._runs(Words(texts))
        first_hash, second = span_hash(buf, start, end), span_hash(buf, start, end, SECOND)
        uniq, pick, kind = np.unique(first_hash, return_index=True, return_inverse=True)
        if not np.array_equal(second[pick][kind], second):  # two runs with one hash: tell them by position
            pick, kind = np.arange(len(first_hash)), np.arange(len(first_hash))
            uniq = np.zeros(0, dtype=np.uint64)
        number = np.maximum(self.kept.find(uniq), self.recent.find(uniq)) if len(uniq) else np.full(len(pick), -1, dtype=np.int64)
        known = number >= 0
        known[known] = self.check[number[known]] == second[pick][known]
        fresh = np.flatnonzero(~known)
        kept = self.words.count
        if len(fresh):
            whole = buf.tobytes()
            number[fresh] = self._add([whole[a:z] for a, z in zip(start[pick[fresh]].tolist(), end[pick[fresh]].tolist())], plain[pick[fresh]])
        ids, n = self.words.get(number[kind])
        per = np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64)
        total = per + (end_id is not None)
        out = np.full(int(total.sum()), end_id if end_id is not None else 0, dtype=np.int32)
        out[np.arange(len(ids)) + np.repeat(np.cumsum(total) - total - (np.cumsum(per) - per), per)] = ids
        if kept + len(fresh) <= CACHE_WORDS and len(uniq):
            self.recent.add(uniq[fresh], number[fresh])
            if len(self.recent.hash) > RECENT:
                self.kept.add(self.recent.hash, self.recent.number)
                self.recent = _Index()
            check = np.empty(len(fresh), dtype=np.uint64)
            check[number[fresh] - kept] = second[pick[fresh]]
            self.check = np.concatenate([self.check, check])
        else:
            self.words.drop(kept)
        return out, total


class _Index:
    """Numbers of hashes, in sorted arrays."""

    def __init__(self):
        self.hash, self.number = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those that are not there."""
        if not len(self.hash):
            return np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, self.number[at], -1).astype(np.int64)

    def add(self, h: np.ndarray, number: np.ndarray) -> None:
        both = np.concatenate([self.hash, h])
        order = np.argsort(both, kind="stable")
        self.hash, self.number = both[order], np.concatenate([self.number, number.astype(np.int32)])[order]


class _Lists:
    """Numbered lists of ids in one growing array."""

    def __init__(self):
        self.flat, self.at, self.count = np.empty(1 << 12, dtype=np.int32), np.zeros(1 << 12, dtype=np.int64), 0

    @staticmethod
    def _room(x: np.ndarray, need: int) -> np.ndarray:
        if need <= len(x):
            return x
        grown = np.empty(max(need, len(x) * 3 // 2), dtype=x.dtype)
        grown[:len(x)] = x
        return grown

    def add(self, ids: np.ndarray, n: np.ndarray) -> range:
        used = int(self.at[self.count])
        self.flat = self._room(self.flat, used + len(ids))
        self.flat[used:used + len(ids)] = ids
        self.at = self._room(self.at, self.count + len(n) + 1)
        self.at[self.count + 1:self.count + 1 + len(n)] = used + np.cumsum(n)
        self.count += len(n)
        return range(self.count - len(n), self.count)

    def get(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the lists one after the other, their sizes)."""
        n = self.at[k + 1] - self.at[k]
        return self.flat[np.repeat(self.at[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n

    def drop(self, count: int) -> None:
        self.count = count


_CODERS: dict[str, WordIds] = {}


def encode_tokens(docs: DataFrame, tokenizer_path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text",
                  shards: int | None = None) -> DataFrame:
    """(doc_id, seq, n_tokens, tokens) in shards of ascending id (ties by a hash of the text)."""
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"))
            .withColumn("tie", F.xxhash64("body")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
            .select("doc_id", F.monotonically_increasing_id().alias("seq"), "body"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _CODERS.setdefault(tokenizer_path, None) or WordIds(tokenizer_path)
        _CODERS[tokenizer_path] = coder
        for b in batches:
            for a, z, texts in column_runs(b.column("body"), RUN_BYTES):
                ids, counts = coder.encode(texts, end_id)
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(a, z - a), b.column("seq").slice(a, z - a), pa.array(counts, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(ids, pa.int32()))], names=["doc_id", "seq", "n_tokens", "tokens"])

    return rows.mapInArrow(run, f"doc_id {kind}, seq long, n_tokens long, tokens array<int>")


def write_tokens(tokens: DataFrame, path: str, row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10,
                 page_rows: int = 1000, dictionary: bool = True) -> None:
    """Write (doc_id, seq, n_tokens, tokens, ...) rows in the layout above; a retried or lost task leaves
    nothing behind (Spark's own committed Parquet writer)."""
    (tokens.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows).option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", str(dictionary).lower())
     .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#seq", "false")
     .option("parquet.enable.dictionary#n_tokens", "false").parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The numbers without the tokens: token pages are not read."""
    return spark.read.parquet(path).select("doc_id", "seq", "n_tokens")


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Rows with their tokens; ``where`` on the id or seq is pushed to row groups and pages."""
    t = spark.read.parquet(path)
    return t if where is None else t.filter(where)


def token_starts(spark: SparkSession, path: str, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (with seq and n_tokens; by default these two of the table) and start: tokens of all rows before. One total per
    shard, from the metadata, comes to the driver; within a shard the sum runs over its rows."""
    totals = sorted((r["shard"], r["n"]) for r in read_metadata(spark, path).groupBy(F.shiftright("seq", 33).alias("shard"))
                    .agg(F.sum("n_tokens").alias("n")).collect())
    before, offsets = 0, []
    for shard, n in totals:
        offsets.append((shard, before))
        before += n
    rows = read_metadata(spark, path).select("seq", "n_tokens") if rows is None else rows
    w = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("shard", F.shiftright("seq", 33)).withColumn("within", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
            .join(F.broadcast(spark.createDataFrame(offsets, "shard long, before long")), "shard")
            .select(*rows.columns, (F.col("before") + F.col("within")).alias("start")))


def token_crc32(tokens: DataFrame) -> DataFrame:
    """(doc_id, seq, n_tokens, ids_crc32): crc32 of each row's ids as little-endian unsigned 32-bit numbers."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("tokens")
            at = col.offsets.to_numpy() - col.offsets[0].as_py()
            data = memoryview(col.flatten().to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * i:4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("seq"), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                                             names=["doc_id", "seq", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "seq", "tokens").mapInArrow(run, f"doc_id {kind}, seq long, n_tokens long, ids_crc32 long")


def tokenize_to_files(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, path: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> str:
    """Encode every text and write the token table; returns its path (by default a new one under the shared folder).

    Null and empty texts have the end id alone. Rows of one id stay together in an order that the text
    decides; a null id sorts first. An empty table gives a table without rows. Texts are encoded whole."""
    path = path or scratch_path(docs.sparkSession, "llm-tokens")
    write_tokens(encode_tokens(docs, tokenizer_path, end_id, id_col, text_col, shards), path)
    return path
