"""Helpers shared by the operators: shared tables, byte-level tokens, class merging."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and return the table as read back."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``cut`` that no later read needs."""
    for t in tables:
        path = getattr(t, "_shared_path", None)
        if path:
            spark = t.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quoted(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


# ------------------------------------------------------------------ bytes of a batch of texts

def by_bytes(texts: Iterable[str | None], limit: int = 4 << 20) -> Iterator[list[bytes]]:
    """UTF-8 of the texts in runs of about ``limit`` bytes (one text may be longer)."""
    run, size = [], 0
    for t in texts:
        b = (t or "").encode("utf-8", "replace")
        if run and size + len(b) > limit:
            yield run
            run, size = [], 0
        run.append(b)
        size += len(b)
    if run:
        yield run


def column_runs(column, limit: int = 1 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """(i, j, UTF-8 of the texts i..j-1) of an Arrow string column in runs of about ``limit`` bytes, taken from
    the column's own buffer: a large batch is never turned into Python objects as a whole."""
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + n + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    i = 0
    while i < n:
        j = i + 1
        while j < n and at[j + 1] - at[i] <= limit:
            j += 1
        yield i, j, [bytes(view[at[k]:at[k + 1]]) for k in range(i, j)]
        i = j


class Words:
    """Whitespace-separated words of a run of byte texts, as arrays.

    ``buf`` is every text's words joined by one space, with a space before the first and after the
    last; ``start``/``end`` are the words' places in it, ``doc`` their text, ``n`` words per text.
    ``hash`` is a 64-bit polynomial hash of each word (equal words, equal hash)."""

    def __init__(self, texts: list[bytes]):
        joined = [b" ".join(t.split()) for t in texts]
        self.buf = np.frombuffer(b" " + b" ".join(joined) + b" ", dtype=np.uint8)
        space = np.flatnonzero(self.buf == 32)
        s, e = space[:-1] + 1, space[1:]
        real = e > s
        self.start, self.end = s[real], e[real]
        lens = np.array([len(j) for j in joined], dtype=np.int64)
        self.doc_start = np.cumsum(lens + 1) - lens  # place of each text's first byte
        self.doc_end = self.doc_start + lens
        self.doc = np.searchsorted(self.doc_start, self.start, side="right") - 1
        self.n = np.bincount(self.doc, minlength=len(texts)) if len(self.doc) else np.zeros(len(texts), np.int64)

    @property
    def hash(self) -> np.ndarray:
        return span_hash(self.buf, self.start, self.end)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 (kept up to 16 million per process)."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(out)
        if len(have) <= 1 << 24:
            _POWERS[int(base)] = have
    return have[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


INVERSE = inverse(BASE)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit value (splitmix64's published constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """64-bit hash of each span of ``buf``: differences of a prefix polynomial, shifted back."""
    with np.errstate(over="ignore"):
        pre = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(len(buf), base), dtype=np.uint64, out=pre[1:])
        back = powers(len(buf) + 1, INVERSE if base == BASE else inverse(base))
        return mix64((pre[end] - pre[start]) * back[start] + (end - start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


# ------------------------------------------------------------------ classes of linked ids

def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (a[i], b[i]) with one link to the smallest id of each tree."""
    ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(ids))
    x, y = inv[: len(a)], inv[len(a):]
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[child]], ids[child]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b: long); component is the smallest id
    reachable. Alternating large-star / small-star steps (Kiveris et al. 2014): each step is one
    aggregation (minimum per id, combined before the shuffle) and one join, its result a written table,
    so no component is ever gathered in one place and a lost executor costs one step."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .filter("u <> v").distinct(), "edges")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    state = mark(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = cut(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        new = cut(small, "small-star")
        now = mark(new)
        discard(edges, large)
        edges = new
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    pairs = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return pairs.unionByName(pairs.select(F.col("component").alias("id"), "component").distinct())
