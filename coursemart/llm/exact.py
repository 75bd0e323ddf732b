"""Exact dedup of a batch against an immutable snapshot, screened by binary-fuse filters.

A snapshot is written once: its *exact buckets* (one row per distinct text: digest, text, size, largest id)
and one *static binary-fuse filter* per bucket of digests. A batch is grouped by itself; its digests
are screened by the bucket's filter, and only the positives join the exact buckets, where the bytes are
compared.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import ascii_lower, cut, mix64, text_or_empty

KEYS_PER_FILTER = 500_000


# ------------------------------------------------------------------ the filter

class BinaryFuse:
    """3-wise binary fuse filter with 16-bit fingerprints (Graf & Lemire 2022): about 18 bits a key, no
    false negatives, false positives 2^-16. Built by peeling in rounds: every slot that holds one key
    gives that key its place; the places are filled in reverse."""

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @staticmethod
    def shape(n: int) -> tuple[int, int]:
        segment = 1 << max(2, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
        segment = min(segment, 1 << 18)
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        segments = max(1, -(-int(round(max(n, 2) * factor)) // segment) - 2)
        return segment, segments

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            h = mix64(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        first = (((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)).astype(np.int64)
        mask = np.int64(segment - 1)
        low = h.astype(np.uint32).astype(np.int64)
        second = (first + segment) ^ ((low >> 14) & mask)
        third = (first + 2 * segment) ^ (low & mask)
        prints = (mix64(h) & np.uint64(0xFFFF)).astype(np.uint16)
        return np.stack([first, second, third]), prints

    @classmethod
    def build(cls, keys: np.ndarray) -> "BinaryFuse":
        keys = np.unique(keys.astype(np.uint64))
        segment, segments = cls.shape(len(keys))
        size = segment * (segments + 2)
        for seed in range(1, 200):
            at, prints = cls.places(keys, seed, segment, segments)
            flat, who = at.T.ravel(), np.repeat(np.arange(len(keys)), 3)
            count = np.bincount(flat, minlength=size)
            held = np.zeros(size, dtype=np.int64)  # xor of the keys' numbers in each slot
            np.bitwise_xor.at(held, flat, who)
            rounds, left = [], len(keys)
            single = np.flatnonzero(count == 1)
            while len(single):
                key, pick = np.unique(held[single], return_index=True)
                slot = single[pick]
                rounds.append((key, slot))
                left -= len(key)
                touched = at[:, key].T.ravel()
                np.subtract.at(count, touched, 1)
                np.bitwise_xor.at(held, touched, np.repeat(key, 3))
                touched = np.unique(touched)
                single = touched[count[touched] == 1]
            if left:
                continue
            slots = np.zeros(size, dtype=np.uint16)
            for key, slot in reversed(rounds):
                a = at[:, key]
                own = slots[a[0]] ^ slots[a[1]] ^ slots[a[2]]  # the own slot is still zero
                slots[slot] = own ^ prints[key]
            return cls(seed, segment, segments, slots)
        raise RuntimeError("binary fuse filter: no seed peels")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, dtype=bool)
        at, prints = self.places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.slots[at[0]] ^ self.slots[at[1]] ^ self.slots[at[2]]) == prints


def _key64(digest: pd.Series) -> np.ndarray:
    return np.array([int(d[:16].ljust(16, "0"), 16) for d in digest], dtype=np.uint64)


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    f = BinaryFuse.build(_key64(pdf["digest"]))
    return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "seed": [f.seed], "segment": [f.segment],
                         "segments": [f.segments], "slots": [f.slots.tobytes()], "keys": [len(pdf)]})


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(batch) or not len(filters):
        return batch[["digest"]].iloc[:0]
    r = filters.iloc[0]
    f = BinaryFuse(int(r["seed"]), int(r["segment"]), int(r["segments"]), np.frombuffer(r["slots"], dtype=np.uint16))
    return batch.loc[f.contains(_key64(batch["digest"])), ["digest"]]


# ------------------------------------------------------------------ snapshot and batch

@dataclass
class Snapshot:
    """Immutable: ``exact`` (digest, check, body, bucket, keep_id, n) and ``filters`` (one row a bucket)."""
    exact: DataFrame
    filters: DataFrame
    buckets: int


def digest_of(body: Column, bits: int = 256) -> Column:
    """Lower-case hex SHA-256 (a prefix of it when ``bits`` < 256, for tests of collisions)."""
    d = F.sha2(body, 256)
    return d if bits >= 256 else F.substring(d, 1, bits // 4)


def normalised(docs: DataFrame, id_col: str, text_col: str, bits: int, is_batch: Column) -> DataFrame:
    body = ascii_lower(text_or_empty(text_col))
    return (docs.select(F.col(id_col).alias("id"), body.alias("body"), F.coalesce(is_batch, F.lit(False)).alias("in_batch"))
            .select("id", "body", "in_batch", digest_of(F.col("body"), bits).alias("digest"), F.xxhash64("body").alias("check")))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per distinct text: digest and bytes are both the key, so unequal texts never meet.
    Combined before the shuffle: a hot text sends one row per task."""
    return rows.groupBy("digest", "check", "body").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))


def bucket_of(digest: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(buckets)).cast("int")


def build_snapshot(rows: DataFrame, keys_per_filter: int = KEYS_PER_FILTER) -> Snapshot:
    """Write the exact buckets and one filter per bucket of about ``keys_per_filter`` digests."""
    exact = cut(grouped(rows), "exact")
    buckets = max(1, -(-exact.count() // keys_per_filter))
    exact = exact.withColumn("bucket", bucket_of(F.col("digest"), buckets))
    filters = (exact.select("bucket", "digest").distinct().groupBy("bucket")
               .applyInPandas(_build_filter, "bucket int, seed int, segment int, segments int, slots binary, keys long"))
    return Snapshot(exact, cut(filters, "fuse"), buckets)


def match_batch(snapshot: Snapshot, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(batch classes, matches): the batch's own groups, and those of them whose text the snapshot has
    with the snapshot's ``s_keep`` and ``s_n``. Only digests that pass their bucket's filter read the
    exact buckets; there digest and bytes must both agree."""
    classes = cut(grouped(batch), "batch")
    digests = classes.select(bucket_of(F.col("digest"), snapshot.buckets).alias("bucket"), "digest").distinct()
    passed = (digests.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket"))
              .applyInPandas(_screen, "digest string"))
    positive = classes.join(passed, "digest", "left_semi")
    s = snapshot.exact.select("digest", F.col("body").alias("s_body"), F.col("keep_id").alias("s_keep"), F.col("n").alias("s_n"))
    matches = (positive.join(s, (positive["digest"] == s["digest"]) & (positive["body"] == s["s_body"]))
               .select(positive["digest"], "check", "keep_id", "n", "s_keep", "s_n"))
    return classes, cut(matches, "matches")


def exact_dedup(docs: DataFrame, is_batch: Column, id_col: str = "doc_id", text_col: str = "text",
                digest_bits: int = 256, keys_per_filter: int = KEYS_PER_FILTER) -> DataFrame:
    """Dedup of ``docs``, of which the rows where ``is_batch`` arrive as a new batch at a snapshot of the rest.

    Texts are equal when identical after lower-casing A-Z. Returns one row per input row: ``doc_id``,
    ``keep_id`` (largest id of the class), ``group_size``, ``kept``, ``text_sha256`` (the digest).
    Null text counts as empty; empty texts are a class like any other. A null id is the smallest id (kept only
    if the class has no other). Of rows that repeat the kept id and text exactly one is kept. An empty
    table gives an empty table; other columns are not read."""
    rows = normalised(docs, id_col, text_col, digest_bits, is_batch)
    old, new = rows.filter(~F.col("in_batch")), rows.filter("in_batch")
    snapshot = build_snapshot(old, keys_per_filter)
    classes, matches = match_batch(snapshot, new)
    key = ["digest", "check"]
    m = matches.select(*key, F.col("keep_id").alias("m_keep"), F.col("n").alias("m_n"))
    merged = (snapshot.exact.select(*key, "keep_id", "n").join(m, key, "left")
              .select(*key, F.greatest("keep_id", "m_keep").alias("keep_id"),
                      (F.col("n") + F.coalesce("m_n", F.lit(0))).alias("group_size")))
    fresh = (classes.select(*key, "keep_id", F.col("n").alias("group_size")).join(m.select(*key), key, "left_anti"))
    # rows equal in id and text are interchangeable: counted before the shuffle, dealt out again after it
    counted = rows.groupBy("id", *key).agg(F.count(F.lit(1)).alias("times"))
    return (counted.join(merged.unionByName(fresh), key)
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("digest").alias("text_sha256"),
                    F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256"))


ORACLE = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') body from documents)
select doc_id, max(doc_id) over (partition by body) keep_id, count(*) over (partition by body) group_size,
       doc_id = max(doc_id) over (partition by body) kept, sha256(body) text_sha256
from t
"""
