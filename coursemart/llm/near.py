"""N-gram Jaccard join: MinHash bands of one depth find candidates, exact comparison of shingle sets decides.

1. Every document's set of word shingles gets a MinHash signature of ``trees`` x ``max_depth`` values. Documents
   with one set become one class.
2. Bands, in place of an LSH forest: in each of the ``trees`` a class is a path of ``max_depth`` values, and classes that
   share its first values are candidates. How many values is fixed before the run, from the parameters alone
   (``forest_depth``: the most with which pairs at the threshold meet in some tree with the target recall), so the
   join is by equal keys; no prefix is shortened by what the data hold, and a dense node is compared at that depth
   too. The further values serve the signatures alone. A node's members are compared by their whole signatures,
   in bounded blocks, and only a spanning forest of the pairs that may reach the threshold (within four standard
   errors) leaves the task.
3. Exact: the classes of one candidate component are compared pair by pair in bounded blocks on their shingle
   sets, so no link between members is lost to the bands; a task returns a count per class and a
   spanning forest of its links, never pairs.

Work grows with the square of a group only inside these blocks, which are spread over tasks; what is shuffled
grows with the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import Words, column_runs, components, cut, discard, local_forest, mix64, quoted, text_or_empty

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
MAX_DEPTH = 6
TARGET_RECALL = 0.999
BLOCK = 512                  # classes of a block (a task holds two)
BLOCK_SHINGLES = 2_000_000   # and about so many shingles
NODE_BLOCK = 1024            # members of a trie node compared at once, by signature
CELLS = 1 << 25              # entries of a comparison matrix


def forest_depth(threshold: float, trees: int, max_depth: int, target: float) -> int:
    """The longest prefix at which a pair of similarity ``threshold`` shares a trie node in some tree with
    probability ``target`` (similar pairs more); 1 if none does."""
    depth = max_depth
    while depth > 1 and 1.0 - (1.0 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words (A-Z lowered) of each text; a shorter
    text is one shingle, one without words has none."""
    w = Words([t.lower() for t in texts])
    h = w.hash
    n = w.n
    first = np.cumsum(n) - n
    out = []
    with np.errstate(over="ignore"):
        run = np.zeros(len(h), dtype=np.uint64)
        for k in range(min(size, len(h))):
            run[:len(h) - k] = (run[:len(h) - k] ^ h[k:]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
        run = mix64(run)
        for a, c in zip(first.tolist(), n.tolist()):
            if c >= size:
                out.append(np.unique(run[a:a + c - size + 1]))
            elif c:
                x = np.uint64(c)
                for v in h[a:a + c]:
                    x = (x ^ v) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
                out.append(mix64(np.array([x], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def minhash(sets: list[np.ndarray], values: int) -> np.ndarray:
    """(sets x values) minima; a row of zeros for an empty set."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.zeros((len(sets), values), dtype=np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    x = np.concatenate([sets[i] for i in full])
    at = np.cumsum(n[full]) - n[full]
    rng = np.random.default_rng(20)
    with np.errstate(over="ignore"):
        for k in range(values):
            a, b = (int(v) for v in rng.integers(0, 1 << 63, 2))
            out[full, k] = np.minimum.reduceat((x ^ np.uint64(b)) * np.uint64(2 * a + 1 & (1 << 64) - 1), at)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, trees: int, max_depth: int, depth: int) -> DataFrame:
    """(id, tk, set_a, set_b, n, sig, keys): per row the hash of its text, two hashes of its shingle set (null
    without words), the set's size, a byte of each MinHash value and a key per tree for its prefix."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).withColumn("tk", F.xxhash64("body"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for _, _, part in column_runs(b.column("body")):
                sets = shingle_sets(part, size)
                m = minhash(sets, trees * max_depth)
                with np.errstate(over="ignore"):
                    path = m.reshape(len(part), trees, max_depth)[:, :, :depth]
                    key = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), (len(part), trees)).copy()
                    for d in range(depth):
                        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + path[:, :, d])
                byte = (mix64(m) & np.uint64(255)).astype(np.uint8)
                for i, s in enumerate(sets):
                    with np.errstate(over="ignore"):
                        cols[0].append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) if len(s) else None)
                        cols[1].append(int(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else None)
                    cols[2].append(len(s))
                    cols[3].append(byte[i].tobytes())
                    cols[4].append(key[i].astype(np.int64) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("tk"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.list_(pa.int64()))],
                names=["id", "tk", "set_a", "set_b", "n", "sig", "keys"])

    return rows.mapInArrow(run, f"id {kind}, tk long, set_a long, set_b long, n long, sig binary, keys array<long>")


def _pairs(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i < j inside each of the small groups start..start+size."""
    left, right = [], []
    for m in np.unique(size):
        i, j = np.triu_indices(int(m), 1)
        s = start[size == m][:, None]
        left.append((s + i).ravel())
        right.append((s + j).ravel())
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _agree(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    out = np.zeros(len(i), dtype=bool)
    for a in range(0, len(i), 1 << 18):
        z = slice(a, a + (1 << 18))
        out[z] = (sig[i[z]] == sig[j[z]]).mean(axis=1) >= least
    return out


def candidate_links(members: DataFrame, least: float) -> DataFrame:
    """(a, b): spanning forests of the pairs under one trie node whose signatures agree in a share of at
    least ``least``. ``members``: key, lo, hi, side, node, sig - a node's members in blocks lo and hi."""
    dealt = members.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(group: np.ndarray, side: np.ndarray, node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[start, len(group)])
        small = size <= 64
        i, j = _pairs(start[small], size[small])
        keep = _agree(sig, i, j, least) & ((side[i] != side[j]) | (side[i] == 2))
        left, right = [node[i[keep]]], [node[j[keep]]]
        for s, m in zip(start[~small], size[~small]):
            links = []
            for r in range(m - 1):  # a row against those after it: at most 2 * NODE_BLOCK
                jj = np.arange(s + r + 1, s + m)
                ok = ((sig[jj] == sig[s + r]).mean(axis=1) >= least) & ((side[jj] != side[s + r]) | (side[jj] == 2))
                links.append((np.full(int(ok.sum()), node[s + r]), node[jj[ok]]))
            a, b = np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links])
            if len(a):
                a, b = local_forest(a, b)
            left.append(a)
            right.append(b)
        a, b = np.concatenate(left), np.concatenate(right)
        return local_forest(a, b) if len(a) else (a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(t: pa.Table) -> pa.RecordBatch:
            key, lo, hi = (t.column(c).to_numpy() for c in ("key", "lo", "hi"))
            with np.errstate(over="ignore"):
                group = key * np.int64(1_000_003) + lo * np.int64(65_537) + hi
                change = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
            group = np.cumsum(change)
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint8).reshape(len(key), -1)
            a, b = compare(group, t.column("side").to_numpy(), t.column("node").to_numpy(), sig)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        def last(b: pa.RecordBatch, row: int) -> tuple:
            return tuple(b.column(c)[row].as_py() for c in ("key", "lo", "hi"))

        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            if rows >= 50_000 and last(held[-1], held[-1].num_rows - 1) != last(b, 0):
                yield flush(pa.Table.from_batches(held))
                held, rows = [], 0
            elif rows >= 50_000:  # the group goes on: cut before its first row in this batch or later
                k = np.flatnonzero(np.any([b.column(c).to_numpy() != last(b, 0)[i] for i, c in enumerate(("key", "lo", "hi"))], axis=0))
                if len(k):
                    held.append(b.slice(0, int(k[0])))
                    yield flush(pa.Table.from_batches(held))
                    held, rows, b = [], 0, b.slice(int(k[0]))
            held.append(b)
            rows += b.num_rows
        if held:
            yield flush(pa.Table.from_batches(held))

    return dealt.select("key", "lo", "hi", "side", "node", "sig").mapInArrow(run, "a long, b long")


def blocked(members: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each member of a group of ``blocks`` blocks in all pairs of blocks that its own is in: lo, hi and side
    (0 of block lo, 1 of block hi, 2 where both are one)."""
    own = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    m = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    return (m.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .withColumn("side", F.when(F.col("lo") == F.col("hi"), 2).otherwise((F.col("own") == F.col("hi")).cast("int")))
            .drop("own", "other", blocks))


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections (only hashes that two sets hold enter the matrix)."""
    m = len(sets)
    out = np.zeros((m, m), dtype=np.float64)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    renumber = np.cumsum(shared) - 1
    keep = shared[code]
    row, code = row[keep], renumber[code[keep]]
    total = int(shared.sum())
    wide = max(1, CELLS // max(m, 1))
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    for a in range(0, total, wide):
        i, j = np.searchsorted(code, [a, a + wide])
        x = np.zeros((m, min(wide, total - a)), dtype=np.float32)
        x[row[i:j], code[i:j] - a] = 1.0
        out += x @ x.T
    return out


def exact_links(members: DataFrame, size: int, threshold: float) -> DataFrame:
    """(node, links, other): per block task, how many documents each class links to, and the links of a
    spanning forest (``other``: null in count rows). ``members``: component, lo, hi, side, node, docs, body."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets([b.encode() for b in pdf["body"]], size)
        n = np.array([len(s) for s in sets], dtype=float)
        inter = intersections(sets)
        side = pdf["side"].to_numpy()
        union = n[:, None] + n[None, :] - inter
        ok = (inter >= threshold * union) if threshold <= 0 else (inter / np.maximum(union, 1) >= threshold)
        ok &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
        np.fill_diagonal(ok, False)
        node, docs = pdf["node"].to_numpy(), pdf["docs"].to_numpy()
        links = ok @ docs
        some = np.flatnonzero(links)
        i, j = np.nonzero(np.triu(ok))
        a, b = local_forest(node[i], node[j]) if len(i) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pd.DataFrame({"node": np.r_[node[some], a], "links": np.r_[links[some], np.zeros(len(a), np.int64)],
                             "other": pd.array(np.r_[np.zeros(len(some), np.int64), b], dtype="Int64").copy()}).assign(
            other=lambda d: d["other"].where(np.arange(len(d)) >= len(some)))

    return members.groupBy("component", "lo", "hi").applyInPandas(compare, "node long, links long, other long")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH,
                 target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per distinct (id, text) of ``docs``: ``id``, ``tk`` (xxhash64 of the text), ``times`` (rows), ``n``
    (shingles), ``n_links`` (other rows whose set of ``size``-word shingles has a Jaccard similarity of at
    least ``threshold`` with its own, copies included), ``class_id`` (smallest id in its component of links)
    and ``kept`` (one row of each component: the smallest id, then text hash).

    Texts are compared whole, A-Z lowered, cut at ASCII white space; with fewer than ``size`` words the whole
    text is the one shingle. Null and empty texts and texts without words link with nothing, not even with
    each other. A null id sorts after all others; rows with equal id and text are copies of each other. An empty
    table gives an empty table; other columns are not read. Links found are exact; a pair at the threshold
    is missed with a probability of at most 1 - ``target_recall`` (lower for more similar pairs)."""
    depth = forest_depth(threshold, trees, max_depth, target_recall)
    values = trees * max_depth
    least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / values)
    sig = cut(signatures(docs, id_col, text_col, size, trees, max_depth, depth), "signatures")
    rows = sig.groupBy("id", "tk", "set_a", "set_b", "n").agg(F.count(F.lit(1)).alias("times"))
    # one class per shingle set; its node number is the first hash of the set
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tk"))
    classes = cut(sig.filter("n > 0").groupBy("set_a", "set_b")
                  .agg(first.alias("rep"), F.count(F.lit(1)).alias("docs"), F.first("n").alias("n"), F.first("sig").alias("sig"),
                       F.first("keys").alias("keys")).withColumnRenamed("set_a", "node"), "classes")
    paths = classes.select("node", F.explode("keys").alias("key"))
    shared = paths.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = (paths.join(shared, "key").withColumn("blocks", F.ceil(F.col("m") / NODE_BLOCK))
           .join(classes.select("node", "sig"), "node").select("key", "node", "sig", "blocks"))
    maybe = components(candidate_links(blocked(met, "key", "blocks"), least))
    maybe = cut(maybe.join(classes.select(F.col("node").alias("id"), "docs", "n", "rep"), "id")
                .select(F.col("id").alias("node"), "component", "docs", "n", "rep"), "candidates")
    sizes = (maybe.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles"))
             .select("component", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES),
                                             F.lit(1)).alias("blocks")))
    texts = (docs.select(F.col(id_col).alias("t_id"), text_or_empty(text_col).alias("body")).withColumn("t_tk", F.xxhash64("body")))
    # a shuffle join at every size: the texts are too large to send, the candidates grow with them
    members = (maybe.join(sizes, "component").hint("merge")
               .join(texts, F.col("rep.id").eqNullSafe(F.col("t_id")) & (F.col("rep.tk") == F.col("t_tk")))
               .dropDuplicates(["node"]).select("component", "node", "docs", "body", "blocks"))
    found = cut(exact_links(blocked(members, "component", "blocks"), size, threshold), "links")
    links = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    in_class = (classes.select("node", "set_b", "docs", "rep")
                .join(links, "node", "left").join(roots.select(F.col("id").alias("node"), "component"), "node", "left")
                .select("node", "set_b", "rep", (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "node").alias("component"), F.col("component").isNotNull().alias("linked")))
    best = in_class.filter("linked").groupBy("component").agg(F.min("rep").alias("best"))
    in_class = (in_class.join(best, "component", "left").withColumn("best", F.coalesce("best", "rep"))
                .select(F.col("node").alias("c_a"), F.col("set_b").alias("c_b"), "n_links", "best"))
    out = (rows.join(in_class, (F.col("set_a") == F.col("c_a")) & (F.col("set_b") == F.col("c_b")), "left")
           .withColumn("alone", F.col("best").isNull()))
    return out.select("id", "tk", "times", "n", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("alone"), F.col("id")).otherwise(F.col("best.id")).alias("class_id"),
                      (F.col("alone") | (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("tk") == F.col("best.tk")))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row of each component of near copies (and all rows that link with nothing), columns as they
    were. Rows with equal id and text count once; texts without words all stay."""
    kept = jaccard_join(docs, id_col, text_col, **params).filter("kept").select("id", "tk", "n")
    rows = docs.select(F.struct(*quoted(docs)).alias("row"))
    rows = rows.select("row", F.col(f"row.{id_col}").alias("r_id"), F.xxhash64(text_or_empty(f"row.{text_col}")).alias("r_tk"))
    j = rows.join(kept, F.col("r_id").eqNullSafe(F.col("id")) & (F.col("r_tk") == F.col("tk")))
    words = j.filter("n > 0").dropDuplicates(["r_id", "r_tk"]).select("row.*")
    return words.unionByName(j.filter("n = 0").select("row.*"))
