"""Exact dedup with binary-fuse screening, and mixing."""

import hashlib
from collections import defaultdict

import numpy as np
from fixtures_llm import ROWS, documents, empty, rows_of
from pyspark.sql import functions as F

from coursemart.llm import exact, mixing
from coursemart.llm.common import fold


def expected(rows):
    norm = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))) for i, t, *_ in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x)):
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_edge_rows_equal_brute_force(spark):
    for side in (fold("doc_id", 2) == 1, F.col("doc_id") > 5, F.lit(True), F.lit(False)):
        assert rows_of(exact.exact_dedup(documents(spark), side), *COLS) == expected(ROWS)


def test_colliding_digests_are_told_apart_by_bytes(spark):
    got = exact.exact_dedup(documents(spark), fold("doc_id", 2) == 1, digest_bits=4, keys_per_filter=2)
    assert rows_of(got, *COLS[:4]) == sorted((r[:4] for r in expected(ROWS)), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_empty_table(spark):
    assert exact.exact_dedup(empty(spark), F.lit(True)).count() == 0
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_filter_has_no_false_negatives_and_few_positives():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 50_000):
        keys = r.integers(0, 1 << 63, n, dtype=np.uint64)
        f = exact.BinaryFuse.build(keys)
        assert f.contains(keys).all()
        assert f.contains(r.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)).mean() < 0.001
    assert f.slots.nbytes * 8 / n < 20  # bits a key


def test_mixing_meets_its_weights_and_repeats(spark):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 7}", i) for i in range(20_000)]
    docs = documents(spark, rows)
    got = mixing.mix_sources(docs, total=30_000)
    n = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    out = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    weight = {s: c ** 0.5 for s, c in n.items()}
    for s in n:
        mean = 30_000 * weight[s] / sum(weight.values())
        assert abs(out[s] - mean) < 5 * mean ** 0.5
    cols = ("doc_id", "mix_copy", "mix_copies", "mix_key")
    assert rows_of(got, *cols) == rows_of(mixing.mix_sources(docs.repartition(7), total=30_000), *cols)
    assert got.groupBy("doc_id").agg(F.count("*").alias("c"), F.max("mix_copies").alias("m")).filter("c <> m").count() == 0
    assert set(docs.columns) - {"mix_copies"} <= set(got.columns)


def test_mixing_targets_nulls_and_large_rates(spark):
    docs = documents(spark)
    t = spark.createDataFrame([("a", 3.0), (None, 1.0)], "source string, weight double")
    got = mixing.mix_sources(docs, t, total=4000)
    by = {r["source"]: r["c"] for r in got.groupBy("source").agg(F.count("*").alias("c")).collect()}
    assert set(by) <= {"a", None} and abs(by["a"] - 3000) < 300 and abs(by[None] - 1000) < 200
    assert got.filter("text is null").count() == by[None]
    counts = {r["mix_copies"] for r in got.filter("doc_id = 2").select("mix_copies").collect()}
    assert len(counts) == 1  # repeated rows get equal counts
