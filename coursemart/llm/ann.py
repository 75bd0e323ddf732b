"""Approximate nearest neighbours by cross-polytope hashing: the candidates of largest inner product.

Vectors are scaled by the largest norm and get one more coordinate that makes them unit vectors, so the largest inner
product is the smallest angle (a query's extra coordinate is 0). A fast pseudo-rotation (three rounds of random signs
and a Hadamard transform) is followed by the nearest signed axis; ``hashes`` of them, over the first ``axes`` axes each,
name a bucket of a table. Every vector is indexed in every table; a query reads the ``probes`` buckets of a table
whose axes lie nearest to it (multiprobe), and what it finds is ranked by the exact inner product.

Tables, axes, hashes and probes come from a bounded sample: the exact neighbours of about SAMPLE_QUERIES queries, and of the
SAMPLE_HEAVY vectors that most rows ask with, among all rows, and about SAMPLE_ROWS rows for what a probe costs. Of the plans whose recall on that sample reaches the target, the
cheapest at the whole table's row counts is taken, the k rows that each block met returns counted among its costs. A plan probes at most a quarter of a table's buckets; vectors
without any structure (uniform ones, whose neighbours are hardly nearer than the rest) need more tables, but
even buckets dealt at random would reach the target in a dozen. All rows are indexed, all queries answered; a
bucket of many rows is compared in blocks over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.llm.common import cut
from coursemart.llm.lines import _small
from coursemart.llm.vectors import usable

NEIGHBOURS = 20
RECALL = 0.97                # aimed at on the sample, so that all queries together reach 0.9 by a margin
SAMPLE_QUERIES = 64
SAMPLE_HEAVY = 16
SAMPLE_ROWS = 1024
MAX_TABLES = 32
MAX_PROBES = 512
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384)   # probes tried
PLANNED_CELL = 16384         # rows of a block of one bucket, each of which returns a query's k rows
CELL = PLANNED_CELL          # blocks cut smaller than planned return more rows and find the same
CELL_VALUES = 1 << 20        # and their components: wider vectors come in smaller blocks
PRODUCTS = 1 << 22           # inner products held at a time
QUERIES = 1024               # queries of a block of one bucket
ROW_COST, PAIR_COST = 200.0, 1.0   # a copy of a vector through a shuffle against one inner product


@dataclass(frozen=True)
class Plan:
    tables: int
    axes: int
    hashes: int
    probes: int
    dim: int
    scale: float
    seed: int
    recall: float             # on the sample

    @property
    def buckets(self) -> int:
        return (2 * self.axes) ** self.hashes


def width(dim: int) -> int:
    """Axes of the rotated space: the power of two that holds ``dim`` coordinates and the extra one."""
    return 1 << max(1, dim).bit_length()


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Hadamard transform of each row (their number of columns is a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x / math.sqrt(n)


def rotate(x: np.ndarray, seed: int, table: int, number: int) -> np.ndarray:
    """The pseudo-rotation of one hash of one table."""
    signs = np.random.default_rng([seed, x.shape[1], table, number])
    for _ in range(3):
        x = hadamard(x * signs.choice([-1.0, 1.0], x.shape[1]))
    return x


def norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def rows_as_units(x: np.ndarray, scale: float) -> np.ndarray:
    out = np.zeros((len(x), width(x.shape[1])))
    out[:, : x.shape[1]] = x / scale
    out[:, x.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (out[:, : x.shape[1]] ** 2).sum(axis=1)))
    return out


def queries_as_units(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), width(x.shape[1])))
    out[:, : x.shape[1]] = x / norms(x)[:, None]
    return out


def signed(y: np.ndarray, axes: int) -> np.ndarray:
    """Nearness to each signed axis, signs in turn: +1, -1, +2, -2 ..."""
    return np.stack([y[:, :axes], -y[:, :axes]], axis=2).reshape(len(y), 2 * axes)


def turns(units: np.ndarray, plan: Plan, table: int) -> list[np.ndarray]:
    """The rotated vectors of each hash of a table."""
    return [rotate(units, plan.seed, table, h) for h in range(plan.hashes)]


def bucket_of(turned: list[np.ndarray], plan: Plan) -> np.ndarray:
    code = np.zeros(len(turned[0]), dtype=np.int64)
    for y in turned[: plan.hashes]:
        code = code * (2 * plan.axes) + signed(y, plan.axes).argmax(axis=1)
    return code


def probes_of(turned: list[np.ndarray], plan: Plan) -> np.ndarray:
    """(queries x probes): buckets by the summed squared distance that their axes lie behind the nearest ones."""
    n, many = len(turned[0]), min(plan.probes, plan.buckets)
    cost, code = np.zeros((n, 1)), np.zeros((n, 1), dtype=np.int64)
    for y in turned[: plan.hashes]:
        s = signed(y, plan.axes)
        behind = (s.max(axis=1, keepdims=True) - s) ** 2
        near = np.argsort(behind, axis=1, kind="stable")[:, :many]
        behind = np.take_along_axis(behind, near, axis=1)
        # the i-th and j-th of two rising lists are among the smallest sums only if (i + 1)(j + 1) are not too many
        i, j = np.nonzero(np.outer(np.arange(1, cost.shape[1] + 1), np.arange(1, near.shape[1] + 1)) <= many)
        cost, code = cost[:, i] + behind[:, j], code[:, i] * (2 * plan.axes) + near[:, j]
        keep = np.argsort(cost, axis=1, kind="stable")[:, :many]
        cost, code = np.take_along_axis(cost, keep, axis=1), np.take_along_axis(code, keep, axis=1)
    return code


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component on (the same for equal vectors wherever they are)."""
    out = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(a.shape[1]):
            out += a[:, d] * b[:, d]
    return out


def cell_rows(dim: int, most: int) -> int:
    """Rows of a block."""
    return max(1, min(most, CELL_VALUES // max(1, dim)))


def nearest(q: np.ndarray, x: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's ``k`` rows of largest inner product, ties by smaller ``low``."""
    step = max(1, PRODUCTS // max(1, len(x)))
    parts = [(s, _nearest(q[s:s + step], x, low, k)) for s in range(0, max(1, len(q)), step)]
    return tuple(np.concatenate(a) for a in zip(*[(i + s, j, score) for s, (i, j, score) in parts], strict=True))


def _nearest(q: np.ndarray, x: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with np.errstate(over="ignore", invalid="ignore"):
        s = q @ x.T
    if s.shape[1] > k:
        kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        room = 1e-9 * norms(q) * norms(x).max()      # the product's own rounding
        i, j = np.nonzero(~(s < (kth - room)[:, None]))
    else:
        i, j = np.divmod(np.arange(s.size), s.shape[1])
    score = inner(q[i], x[j])
    order = np.lexsort((low[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k], score[place < k]


def matrix(column) -> np.ndarray:
    """The list column's rows, all of one length, as a matrix of doubles."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(c, pa.ChunkedArray):
        c = pa.concat_arrays(c.chunks)
    return np.asarray(c.flatten(), dtype=np.float64).reshape(len(c), -1)


# ------------------------------------------------------------------ the plan, from a bounded sample

def sampled(rows: DataFrame, n: int, want: int) -> list:
    """About ``want`` of the rows, by a hash of their node; never more than twice as many."""
    return rows.filter(F.pmod(F.xxhash64("node", F.lit(71)), F.lit(max(1, n))) < want).limit(2 * want).collect()


def exact_sample(classes: DataFrame, q: np.ndarray, k: int) -> list[np.ndarray]:
    """The vectors of the ``k`` classes nearest to each row of ``q`` among all classes of its dimension."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            i, j, score = nearest(q, matrix(b.column("v")), b.column("low").to_numpy(), k)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(score), b.column("low").take(pa.array(j)),
                                              b.column("v").take(pa.array(j))], names=["q", "score", "low", "v"])

    found = classes.select("low", "v").mapInArrow(near, f"q int, score double, low long, v {classes.schema['v'].dataType.simpleString()}")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "low")
    rows = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).collect()   # SAMPLE_QUERIES x k at most
    out = [[] for _ in range(len(q))]
    for r in rows:
        out[r["q"]].append(r["v"])
    return [np.array(o, dtype=np.float64).reshape(len(o), q.shape[1]) for o in out]


def make_plan(classes: DataFrame, queries: DataFrame, dim: int, rows: int, asked: int, scale: float, k: int, recall: float, seed: int) -> Plan:
    """The cheapest plan that finds ``recall`` of the sample's neighbours (see the module)."""
    q = np.array([r["v"] for r in sampled(queries.select("node", "v"), asked, SAMPLE_QUERIES)], dtype=np.float64).reshape(-1, dim)
    x = np.array([r["v"] for r in sampled(classes.select("node", "v"), rows, SAMPLE_ROWS)], dtype=np.float64).reshape(-1, dim)
    top = max(1, math.ceil(math.log2(max(2, rows / 64))))           # bits of a bucket's name at most: cells of about 64 rows
    if not len(q):                                                  # few queries, none of them in the sample
        q = np.array([r["v"] for r in queries.select("v").limit(SAMPLE_QUERIES).collect()], dtype=np.float64).reshape(-1, dim)
    heavy = queries.filter("asks > 1").orderBy(F.desc("asks"), "node").limit(SAMPLE_HEAVY).select("v").collect()
    plain, q = len(q), np.concatenate([q, np.array([r["v"] for r in heavy], dtype=np.float64).reshape(-1, dim)])
    true = exact_sample(classes, q, k)
    who = np.repeat(np.arange(len(q)), [len(t) for t in true])
    parts = [m for m in (who < plain, who >= plain) if m.any()]
    uq, ux, ut = queries_as_units(q), rows_as_units(x, scale), rows_as_units(np.concatenate(true), scale)
    plans = [Plan(1, 1 << b, hashes, min((2 << b) ** hashes // 4, MAX_PROBES), dim, scale, seed, 0.0)
             for hashes in (1, 2, 3) for b in range(1, width(dim).bit_length()) if (b + 1) * hashes <= max(top, 3)]
    grids = [sorted({t for t in STEPS if t < p.probes} | {p.probes}) for p in plans]
    first = [np.full(len(ut), 1 << 30) for _ in plans]              # smallest probe that finds the neighbour, over the tables so far
    share = [np.zeros(len(g)) for g in grids]                       # of all rows that the probes read, summed over tables
    made = [np.zeros(len(g)) for g in grids]                        # rows that a query's blocks return, summed over tables
    best, price = None, math.inf
    for table in range(MAX_TABLES):
        yq, yx, yt = ([rotate(u, seed, table, h) for h in range(3)] for u in (uq, ux, ut))
        for c, p in enumerate(plans):
            if best and best.recall >= recall and ROW_COST * (table + 1) * rows > price:
                continue                                            # no plan of so many tables is cheaper
            order, bt, bx = probes_of(yq, p), bucket_of(yt, p), bucket_of(yx, p)
            hit = order[who] == bt[:, None]
            first[c] = np.minimum(first[c], np.where(hit.any(axis=1), hit.argmax(axis=1), 1 << 30))
            rows_in = np.bincount(bx, minlength=p.buckets) / max(1, len(bx)) if p.buckets <= 1 << 20 else np.full(1, 1 / p.buckets)
            at = order if len(rows_in) > 1 else np.zeros_like(order)
            read = np.cumsum(rows_in[at], axis=1).mean(axis=0)
            back = np.cumsum((np.minimum(k, rows_in * rows) * np.ceil(np.maximum(1.0, rows_in * rows) / cell_rows(dim, PLANNED_CELL)))[at], axis=1).mean(axis=0)
            for g, t in enumerate(grids[c]):
                share[c][g] += read[t - 1]
                made[c][g] += back[t - 1]
                got = min(float((first[c][m] < t).mean()) for m in parts)
                cost = ROW_COST * ((table + 1) * (rows + asked * t) + asked * made[c][g]) + PAIR_COST * asked * rows * share[c][g]
                better = min(got, recall) - (min(best.recall, recall) if best else -1.0)
                if better > 0 or (better == 0 and cost < price):
                    best, price = Plan(table + 1, p.axes, p.hashes, t, dim, scale, seed, got), cost
    return best


# ------------------------------------------------------------------ the search

def in_tables(units, buckets, plan: Plan, others: list[str]):
    """A function for mapInArrow: (table, bucket, the other columns) of each row and each bucket that it goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 15) // (plan.tables * max(1, plan.probes)))
        for b in batches:
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                u = units(matrix(part.column("v")))
                for table in range(plan.tables):
                    code = buckets(turns(u, plan, table), plan).reshape(len(u), -1)
                    at = pa.array(np.repeat(np.arange(len(u)), code.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(code.size, table, dtype=np.int32)), pa.array(code.ravel()),
                                                      *[part.column(c).take(at) for c in others]], names=["table", "bucket", *others])

    return run


def search(classes: DataFrame, queries: DataFrame, plan: Plan, rows: int, asked: int, k: int) -> DataFrame:
    """(q, node, low, score): for each query class the nearest ``k`` classes found. ``classes``: node, low, v."""
    v = f"v {classes.schema['v'].dataType.simpleString()}"
    cell = ["table", "bucket"]

    def placed(df: DataFrame, units, buckets, others: list[str]) -> DataFrame:
        schema = ", ".join(["table int", "bucket long", *[{"v": v}.get(c, f"{c} long") for c in others]])
        return df.select(*dict.fromkeys([*others, "v"])).mapInArrow(in_tables(units, buckets, plan, others), schema)

    def units(x: np.ndarray) -> np.ndarray:
        return rows_as_units(x, plan.scale)

    # hashed once without their vectors, to know which cells need blocks
    held = cut(placed(classes, units, bucket_of, []).groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / cell_rows(plan.dim, CELL)).cast("int").alias("parts"))
               .filter("parts > 1"), "full-cells")
    want = cut(placed(queries, queries_as_units, probes_of, []).groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("asks"))
               .filter("asks > 1"), "asked-cells")
    held, want = _small(held, 32), _small(want, 32)
    index = placed(classes, units, bucket_of, ["node", "low", "v"])
    probe = placed(queries, queries_as_units, probes_of, ["node", "v"])

    def parts(df: DataFrame, mine: str, other: str) -> DataFrame:
        """Own block by hash, copied for every block of the other side."""
        both = df.join(held, cell, "left").join(want, cell, "left").fillna(1, ["parts", "asks"])
        own = F.pmod(F.xxhash64("node", F.lit(5)), F.col(mine)).cast("int")
        return both.withColumn(mine + "_at", own).withColumn(other + "_at", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("parts", "asks")

    group = [*cell, "parts_at", "asks_at"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            empty = pa.array([], pa.int64())
            return pa.table([empty, empty, empty, pa.array([], pa.float64())], names=["q", "node", "low", "score"])
        low = left.column("low").to_numpy()
        i, j, score = nearest(matrix(right.column("v")), matrix(left.column("v")), low, k)
        return pa.table([right.column("node").take(pa.array(i)), left.column("node").take(pa.array(j)), pa.array(low[j]), pa.array(score)],
                        names=["q", "node", "low", "score"])

    found = (parts(index, "parts", "asks").groupBy(*group).cogroup(parts(probe, "asks", "parts").groupBy(*group))
             .applyInArrow(rank, "q long, node long, low long, score double"))
    once = found.groupBy("q", "node").agg(F.max("low").alias("low"), F.max("score").alias("score"))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "low")
    return once.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS,
                       recall: float = RECALL, seed: int = 23) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (over its id) holds, the ``k`` nearest rows found.

    Nearness is the inner product in double precision, summed from the first component on; ties go to the smaller id.
    A query never finds its own id; equal vectors under other ids are found like any others. Rows that repeat an id
    and a vector are one; an id with several vectors counts once, by the best of them, and may leave its neighbours
    fewer. Vectors that are null, zero
    or hold null or non-finite components, and rows without an id, take no part; vectors of different lengths do not
    meet. Fewer than ``k`` candidates are all returned. An empty table gives an empty one; other columns are not read."""
    v = F.col(vector_col)
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & usable(v.cast("array<double>")))
            .withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0).cast(vectors.schema[vector_col].dataType.elementType)).otherwise(x)))  # -0 is 0
            .withColumn("node", F.xxhash64("v")))
    named = cut(rows.groupBy("v", "node", "vec_id").agg(F.max("asks").alias("asks")), "ann-rows")
    ids = named.groupBy("node", "vec_id").agg(F.max("asks").alias("asks"))
    w = Window.partitionBy("node").orderBy("vec_id")
    lows = ids.select("node", "vec_id").withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).drop("r")
    classes = cut(named.groupBy("v", "node").agg(F.min("vec_id").alias("low"), F.sum(F.col("asks").cast("long")).alias("asks"),
                                           F.size("v").alias("dim")), "ann-vectors")
    double = F.col("v").cast("array<double>")
    top = F.array_max(F.transform(double, lambda x: F.abs(x)))
    norm = top * F.sqrt(F.aggregate(F.transform(double, lambda x: x / top), F.lit(0.0), lambda a, x: a + x * x))
    sizes = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks") > 0, 1)).alias("asked"), F.max(norm).alias("scale")).collect()
    found = None
    for s in sorted(sizes, key=lambda r: r["dim"]):  # one row per length of vectors
        if not s["asked"]:
            continue
        mine = classes.filter(F.col("dim") == s["dim"])
        asking = mine.filter("asks > 0")
        plan = make_plan(mine, asking, s["dim"], s["n"], s["asked"], s["scale"] * (1 + 1e-12), k + 1, recall, seed)
        part = search(mine, asking, plan, s["n"], s["asked"], k + 1)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # a class's ids are at most k + 1, so is what each asking class has found; its asking ids are joined to that
    pairs = found.select("q", "node", "score").join(lows, "node").groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    tops = pairs.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).groupBy("q").agg(F.collect_list(F.struct("vec_id", "score")).alias("near"))
    asked = ids.filter("asks").select(F.col("node").alias("q"), F.col("vec_id").alias("query_id"))
    each = asked.join(tops, "q").select("query_id", F.explode("near").alias("x")).select("query_id", "x.vec_id", "x.score").filter("vec_id <> query_id")
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


__all__ = ["Plan", "make_plan", "nearest_neighbours", "search"]
