"""Embedding near-dedup by sorted projection passes.

Every pass orders the vectors by a concatenation of random hashes (cross-polytope hashes: the nearest signed
axis after a random projection) and compares all vectors of a run of equal key prefix with each other; pairs whose
cosine in double precision reaches the threshold are verified links. The prefix of a run is as long as the data ask
for: from the row count for evenly spread vectors, longer where a run holds more than CELL of them and they part
sooner than a pair at the threshold would. A run that stays larger is compared in blocks over tasks, never cut.
Each vector takes part in passes until a pair at the threshold has met its run with the target recall, so
dense places get more passes than sparse ones; where all pairs cost no more than those passes they are compared
instead. Runs depend on the vectors alone, not on partitions. The links of all passes are united; each task returns
only a spanning forest of its own. Equal vectors are one class from the start. All pairs of a component are compared
in blocks, and the counts of direct links come from there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import components, cut, discard, local_forest
from coursemart.llm.lines import _small
from coursemart.llm.near import blocked

THRESHOLD = 0.9
RECALL = 0.999               # of a pair at the threshold
AXES = 4                     # projected dimensions of one hash
BITS = 3                     # of one hash: axis and sign
HASHES = 16                  # concatenated per pass; runs share as many of the first as they need
CELL = 2048                  # vectors of a run from which a longer prefix is tried, and of a block of one run
ROUND = 32                   # passes at once at most
PART_ROWS = 16_384           # rows of a task
BLOCK = 2048                 # vectors of a block of one component


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0),
                      F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def projections(dim: int, number: int, seed: int) -> np.ndarray:
    """(dim x HASHES * AXES) Gaussian matrix of one pass."""
    return np.random.default_rng([seed, dim, number]).normal(size=(dim, HASHES * AXES))


def agreement(threshold: float) -> float:
    """Probability that a pair of cosine ``threshold`` has one hash in common (it depends on the cosine alone)."""
    r = np.random.default_rng(11)
    x, z = r.normal(size=(2, 100_000, AXES))
    c = min(max(threshold, -1.0), 1.0)
    y = c * x + math.sqrt(1 - c * c) * z
    i, j, k = np.abs(x).argmax(axis=1), np.abs(y).argmax(axis=1), np.arange(len(x))
    same = float(((i == j) & ((x[k, i] < 0) == (y[k, j] < 0))).mean())
    return min(max(same, 1e-3), 0.999)


def first_depth(n: int, cell: int) -> int:
    """Hashes after which runs of ``n`` evenly spread vectors hold at most ``cell``."""
    depth = 0
    while depth < HASHES and n > cell << BITS * depth:
        depth += 1
    return depth


def gain(share: float, depth: int) -> float:
    """What one pass with runs of ``depth`` hashes adds to -log(1 - recall) of a pair at the threshold."""
    return -math.log1p(-min(share ** depth, 1 - 1e-12))


def sort_keys(x: np.ndarray, numbers: range, seed: int) -> np.ndarray:
    """(vectors x passes): the concatenated hashes of each pass as one number, first hash leading."""
    out = np.zeros((len(x), len(numbers)), dtype=np.int64)
    for p, number in enumerate(numbers):
        y = (x @ projections(x.shape[1], number, seed)).reshape(len(x), HASHES, AXES)
        at = np.abs(y).argmax(axis=2)
        code = 2 * at + (np.take_along_axis(y, at[:, :, None], axis=2)[:, :, 0] < 0)
        for h in range(HASHES):
            out[:, p] = (out[:, p] << BITS) + code[:, h]
    return out


def _matrix(col) -> list[np.ndarray]:
    return [np.asarray(v, dtype=np.float64) for v in col]


def pass_keys(classes: DataFrame, numbers: range, seed: int) -> DataFrame:
    """(pass, dim, key, node): the keys of each vector in the passes ``numbers``. ``classes``: node, v."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = _matrix(b.column("v").to_pylist())
            dims = np.array([len(v) for v in vs])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                keys = sort_keys(unit(np.stack([vs[i] for i in at])), numbers, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.array(numbers, dtype=np.int32), len(at))), pa.array(np.full(keys.size, d, dtype=np.int32)),
                     pa.array(keys.ravel()), b.column("node").take(pa.array(np.repeat(at, len(numbers))))],
                    names=["pass", "dim", "key", "node"])

    return classes.select("node", "v").mapInArrow(keyed, "pass int, dim int, key long, node long")


def prefix(depth) -> Column:
    """The first ``depth`` hashes of the key."""
    return F.expr(f"shiftright(key, {BITS} * ({HASHES} - {depth}))")


def runs(keys: DataFrame, depth: int, share: float, cell: int) -> DataFrame:
    """(pass, dim, depth, cell, node, blocks): the run of each key. From ``depth`` hashes on, a run of more than
    ``cell`` vectors is parted by the next hash if two of its vectors agree on it more rarely than a pair at the
    threshold (``share``); one that is not, such as a group of near copies, has several blocks."""
    at = keys.withColumn("depth", F.lit(depth))
    for k in range(depth, HASHES):
        parted = (at.filter(F.col("depth") == k).groupBy("pass", "dim", prefix(k).alias("cell"), prefix(k + 1).alias("next"))
                  .agg(F.count(F.lit(1)).alias("c")).groupBy("pass", "dim", "cell")
                  .agg(F.sum("c").alias("m"), F.sum(F.col("c").cast("double") * F.col("c")).alias("s"))
                  .filter((F.col("m") > cell) & (F.col("s") < share * F.col("m").cast("double") * F.col("m"))))
        parted = cut(parted.select("pass", "dim", "cell", F.lit(True).alias("parted")), "parted")
        if parted.isEmpty():
            break
        at = (at.withColumn("cell", prefix(k)).join(_small(parted, 64), ["pass", "dim", "cell"], "left")
              .withColumn("depth", F.when(F.col("parted") & (F.col("depth") == k), k + 1).otherwise(F.col("depth"))).drop("cell", "parted"))
    at = cut(at.select("pass", "dim", "depth", prefix("depth").alias("cell"), "node"), "runs")
    run = ["pass", "dim", "depth", "cell"]
    large = cut(at.groupBy(*run).agg(F.ceil(F.count(F.lit(1)) / cell).alias("blocks")).filter("blocks > 1"), "large-runs")
    return at.join(_small(large, 64), run, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))


def run_links(members: DataFrame, threshold: float, rows: int) -> DataFrame:
    """(a, b): verified links inside runs, spanning forests. ``members``: pass, dim, depth, cell, node, blocks, v;
    about ``rows`` of them."""
    group = ["pass", "dim", "depth", "cell", "lo", "hi"]
    dealt = (blocked(members, "cell", "blocks").select(*group, "side", "node", "v")
             .repartition(max(1, math.ceil(rows / PART_ROWS)), *group).sortWithinPartitions(*group))

    def compare(t: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
        v = t.column("v").combine_chunks()
        v = pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v
        flat, at = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, z in zip(starts[:-1], starts[1:]):
            if z - s < 2:
                continue
            x, who = unit(flat[at[s]:at[z]].reshape(z - s, -1)), side[s:z]
            for k in range(0, z - s, 1024):
                ok = np.triu(x[k:k + 1024] @ x[k:].T >= threshold, 1)
                i, j = np.nonzero(ok)
                i, j = i + k, j + k
                keep = (who[i] != who[j]) | (who[i] == 2)
                a, b = node[s + i[keep]], node[s + j[keep]]
                if len(a) > z - s:
                    a, b = local_forest(a, b)
                left.append(a)
                right.append(b)
        a, b = np.concatenate(left), np.concatenate(right)
        return local_forest(a, b) if len(a) else (a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def flush(t: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
            """The links of the table's groups; its last one is kept for what follows unless this is all."""
            cols = [t.column(c).to_numpy() for c in group]
            change = np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)]
            starts = np.r_[np.flatnonzero(change), len(t)] if last else np.flatnonzero(change)
            a, b = compare(t, starts)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]), t.slice(int(starts[-1]))

        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                out, held = flush(t if held is None else pa.concat_tables([held, t]), False)
                yield out
        if held is not None:
            yield flush(held, True)[0]

    return dealt.mapInArrow(run, "a long, b long")


def pass_links(classes: DataFrame, threshold: float, recall: float, seed: int, cell: int) -> DataFrame:
    """(a, b): verified links of all passes. ``classes``: node, v."""
    share = agreement(threshold)
    vectors = classes.select("node", "v")
    rest = vectors.select("node", F.lit(-math.log1p(-recall)).alias("open"))  # -log(1 - recall) that a vector still lacks
    n, number, found = classes.count(), 0, []
    need = math.ceil(-math.log1p(-recall) / gain(share, first_depth(n, cell)))
    while True:
        if n <= cell * need:  # all pairs cost no more
            blocks = max(1, math.ceil(n / cell))
            every = rest.select("node").join(vectors, "node").select(
                F.lit(-1).alias("pass"), F.size("v").alias("dim"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("cell"), "node",
                F.lit(blocks).alias("blocks"), "v")
            found.append(cut(run_links(every, threshold, n * blocks), "links"))
            break
        count, depth = min(need, ROUND), first_depth(n, cell)
        mine = vectors.join(rest.select("node"), "node", "left_semi") if number else vectors
        keys = cut(pass_keys(mine, range(number, number + count), seed), "keys")
        members = cut(runs(keys, depth, share, cell), "members")
        copies = members.agg(F.sum("blocks")).first()[0]
        found.append(cut(run_links(members.join(vectors, "node"), threshold, copies), "links"))
        number += count
        gains = F.element_at(F.array(*[F.lit(gain(share, d)) for d in range(HASHES + 1)]), F.col("depth") + 1)
        got = members.groupBy("node").agg(F.sum(gains).alias("got"))
        new = cut(rest.join(got, "node").select("node", (F.col("open") - F.col("got")).alias("open"), "got").filter("open > 1e-9"), "open")
        discard(keys, members)
        rest = new.select("node", "open")
        n, mean = new.agg(F.count(F.lit(1)), F.avg(F.col("open") / F.col("got"))).first()
        if not n:
            break
        need = max(1, math.ceil(mean * count))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def direct_links(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links): vectors that each class links to among its component, from blocks of all pairs.
    ``members``: component, lo, hi, side, node, copies, v."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(_matrix(pdf["v"])))
        side, copies = pdf["side"].to_numpy(), pdf["copies"].to_numpy()
        links = np.zeros(len(x), dtype=np.int64)
        for a in range(0, len(x), 1024):
            ok = x[a:a + 1024] @ x.T >= threshold
            ok &= (side[a:a + 1024, None] != side[None, :]) | (side[None, :] == 2)
            ok[np.arange(len(ok)), a + np.arange(len(ok))] = False
            links[a:a + 1024] = ok @ copies
        return pd.DataFrame({"node": pdf["node"], "links": links})

    return members.groupBy("component", "lo", "hi").applyInPandas(compare, "node long, links long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 recall: float = RECALL, seed: int = 17) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links`` (other vectors whose cosine with it is at least
    ``threshold``), ``component_id`` (smallest id reachable by links), ``kept`` (its id is that one).

    Vectors that are null, zero or hold null or non-finite components link with nothing; vectors of
    different lengths do not link. Equal vectors, rows that repeat an id among them, link with each other;
    a null id never names a component that has another. An empty table gives an empty table; other columns
    are not read. No link below the threshold is reported; a pair at the threshold is missed with a probability of
    about 1 - ``recall`` (less for nearer pairs, and if a chain of links brings its ends into one component). The
    rows do not depend on the partitions."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable(v), v).alias("v")).withColumn("node", F.xxhash64("v"))
    classes = cut(rows.filter("v is not null").groupBy("v", "node").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low")), "vectors")
    roots = components(pass_links(classes, threshold, recall, seed, CELL))
    roots = cut(roots.select(F.col("id").alias("node"), "component"), "roots")
    sizes = roots.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    members = roots.join(sizes, "component").join(classes.select("node", "copies", "v"), "node")
    links = direct_links(blocked(members, "component", "blocks"), threshold).groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "copies", "low").join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = named.groupBy("component").agg(F.min("low").alias("component_id"))
    result = (named.join(low, "component").join(links, "node", "left")
              .select("node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    alone = rows.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.filter("v is not null").select("vec_id", "node").join(result, "node").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
with recursive v as (select vec_id, embedding::double[] e, sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) n from embeddings),
l as (select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id
      where a.n > 0 and b.n > 0 and isfinite(a.n) and isfinite(b.n) and list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r as (select vec_id, vec_id root from v union select r.vec_id, l.b from r join l on r.root = l.a),
c as (select vec_id, min(root) component_id from r group by vec_id),
d as (select a, count(*) n from l group by a)
select v.vec_id, coalesce(d.n, 0) n_links, c.component_id, v.vec_id = c.component_id kept
from v join c on v.vec_id = c.vec_id left join d on v.vec_id = d.a
"""
