"""Operators 11 to 13: odd tables against plain versions, forced blocks and layers, recall against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from fixtures_llm import ROWS, documents, empty
from pyspark.sql import functions as F

from coursemart.llm import ann, audit, merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ 11

def plain_divergence(rows, min_docs=10, top=10):
    term = regex.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [((r[2] or ""), (r[3] or ""), term.findall((r[1] or "").translate(LOWER))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df, total = Counter(), Counter()
        by = defaultdict(Counter)
        for _, s, ts in mine:
            df.update(set(ts))
            by[s].update(ts)
        kept = [t for t in df if df[t] >= min_docs]
        for s in by:
            total.update({t: by[s][t] for t in kept})
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + (10 ** 9 * (c[t] + 2)) // (n + 2 * v) for t in kept}

        p, q = {s: shares(by[s]) for s in by}, shares(total)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in by:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in by if o != s))
            out += [(lang, s, "pair", o, -x, i + 1) for i, (x, _, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if by[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -x, i + 1) for i, (x, _, t) in enumerate(terms[:top])]
    return sorted(out)


def many_rows():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{'é' if i % 7 == 0 else ''}{chr(65 + i // 26)}" for i in range(90)]
    rows = [(i, " ".join(rng.choice(words, 30 + i % 50)) + "!x7y", ["en", "fr", None][i % 3], f"s{(i * i) % 9}", 1) for i in range(260)]
    rows += [(1000 + i, "One text, the SAME in many rows. one", "en", f"s{i % 5}" if i % 4 else None, 1) for i in range(150)]
    return rows + [(2000, None, "xx", "only", None), (2001, "", "en", "without terms", 0), (2002, "12 -- 34", "en", "without terms", 8)]


def as_rows(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


@pytest.mark.parametrize("chunk, block", [(100_000, 128), (40, 3)])
def test_divergence_equals_a_plain_version(spark, chunk, block):
    rows = many_rows()
    got = as_rows(audit.divergence(documents(spark, rows), chunk=chunk, block=block))
    assert got == plain_divergence(rows)
    assert any(r[2] == "term" for r in got)


def test_divergence_of_odd_and_empty_tables(spark):
    assert as_rows(audit.divergence(documents(spark), min_docs=2)) == plain_divergence(ROWS, min_docs=2)
    assert as_rows(audit.divergence(documents(spark))) == plain_divergence(ROWS)     # no term is kept: pairs of value 0
    assert as_rows(audit.divergence(empty(spark))) == []


def test_shares_are_exact_for_counts_beyond_a_long(spark):
    big = 3_000_000_000_000
    got = spark.range(1).select(audit.share(F.lit(big), F.lit(7 * big + 1), F.lit(1_000_003)).alias("p")).first()["p"]
    assert got == 1 + (10 ** 9 * (big + 2)) // (7 * big + 1 + 2 * 1_000_003)


# ------------------------------------------------------------------ 12

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def leaf(r, text):
        vals = (r[0], r[3], r[2], r[4], text)
        return H(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in vals])

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def up(t, i):
        for level in t[:-1]:
            a = i // 16 * 16
            yield "".join(level[a:i]), "".join(level[i + 1:a + 16])
            i //= 16

    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = [*up(trees[s], i), *up(top, k)]
            shown = own
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0:
                shown = leaf(r, None if r[1] is None else r[1].translate(LOWER))
            for a, b in path:
                shown = H(a, shown, b)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), shown, shown == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [3, 1])
def test_manifest_equals_a_plain_version(spark, levels):
    """With one level a superblock holds 16 nodes, so the same rows take up to four layers, and the sources two."""
    rows = [(i, f"Text {i} of A", "en", "hot" if i % 3 == 0 else f"s{i % 23:02d}é", i) for i in range(1700)]
    rows += [(5, "a repeated Id", None, "hot", None), (5, "a repeated Id", None, "hot", None), (None, "No id", "en", None, 4), (None, None, None, None, None)]
    got = manifest_rows(merkle.manifest(documents(spark, rows), tampered=merkle.tampered_rows(), levels=levels))
    assert got == plain_manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_of_odd_lone_and_empty_tables(spark):
    assert manifest_rows(merkle.manifest(documents(spark), tampered=merkle.tampered_rows())) == plain_manifest(ROWS)
    assert manifest_rows(merkle.manifest(documents(spark, ROWS[:1]), tampered=merkle.tampered_rows())) == plain_manifest(ROWS[:1])
    assert manifest_rows(merkle.manifest(empty(spark))) == []
    one = merkle.manifest(documents(spark, ROWS[:1])).first()                          # nothing is tampered with by default
    assert one.verified and one.proof_sha256 == H("") and one.root == one.subroot == one.leaf


# ------------------------------------------------------------------ 13

VECTORS = "vec_id long, embedding array<float>, row string, node string, v string, score string"


def vectors(spark, pairs):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in pairs], VECTORS).repartition(3)


def in_turn(x, y):
    """Summed from the first component on (the built-in sum compensates)."""
    out = 0.0
    for a, b in zip(x.tolist(), y.tolist()):
        out += a * b
    return out


def plain_neighbours(pairs, every=20, k=20):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in pairs
            if i is not None and v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all() and np.any(np.array(v))]
    out = {}
    for q, x in good:
        if q % every == 0:
            s = [(-in_turn(x, y), i) for i, y in good if i != q and len(y) == len(x)]
            out[q] = [(i, -t) for t, i in sorted(set(s))[:k]]
    return out


def found_of(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def recall_of(got, want):
    assert set(got) == {q for q in want if want[q]}
    for q in got:
        assert [x[1] for x in got[q]] == sorted((x[1] for x in got[q]), reverse=True) and len(set(got[q])) == len(want[q])
    return sum(len(set(got[q]) & set(want[q])) for q in got) / sum(map(len, want.values()))


def clustered(n, dim, seed, copies=0):
    """Clusters of different tightness and norms from 0.5 to 3, a third of the rows in one, and copies of one vector."""
    r = np.random.default_rng(seed)
    centre = r.normal(size=(12, dim))
    own = np.where(np.arange(n) % 3 == 0, 0, r.integers(0, 12, n))
    x = centre[own] + r.normal(size=(n, dim)) * (0.2 + 0.1 * own)[:, None]
    x *= r.uniform(0.5, 3, n)[:, None] / np.linalg.norm(x, axis=1)[:, None]
    x[:copies] = x[0]
    return [(i, [float(a) for a in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("n, dim, copies", [(3000, 24, 900), (700, 64, 0)])
def test_neighbours_reach_recall_against_brute_force(spark, n, dim, copies):
    rows = clustered(n, dim, 5, copies)
    got = found_of(ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert recall_of(got, plain_neighbours(rows)) >= 0.95
    if copies:  # equal scores: the smaller ids, in order
        assert [i for i, _ in got[0] if i < copies] == list(range(1, 21))[: sum(i < copies for i, _ in got[0])]


def test_blocks_of_a_bucket_change_nothing(spark, monkeypatch):
    rows = clustered(900, 16, 9)
    whole = found_of(ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 5 == 0))
    monkeypatch.setattr(ann, "CELL", 40)
    monkeypatch.setattr(ann, "QUERIES", 7)
    assert found_of(ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 5 == 0)) == whole


def test_blocks_that_return_rows_stay_few(spark):
    """Each block that a query meets returns k rows: vectors without structure must not be dealt over ever more of them."""
    x = np.random.default_rng(8).normal(size=(10000, 64))
    rows = spark.createDataFrame([(i, i, v) for i, v in enumerate(x.tolist())], "node long, low long, v array<double>").withColumn("asks", F.lit(1))
    plan = ann.make_plan(rows, rows.filter("node % 20 = 0"), 64, 10000, 500, float(ann.norms(x).max()) * (1 + 1e-12), 21, ann.RECALL, 23)
    assert plan.recall >= ann.RECALL and plan.tables * plan.probes * math.ceil(10000 / plan.buckets / ann.CELL) <= 12


def test_products_in_steps_change_nothing(monkeypatch):
    g = np.random.default_rng(4)
    q, x, low = g.normal(size=(50, 8)), g.normal(size=(300, 8)), np.arange(300)
    whole = ann.nearest(q, x, low, 5)
    monkeypatch.setattr(ann, "PRODUCTS", 2000)
    assert all((a == b).all() for a, b in zip(whole, ann.nearest(q, x, low, 5), strict=True))


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [3.0, -1.0]), (2, None), (40, None), (3, [0.0, 0.0]), (60, [0.0, -0.0]),
            (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (80, [1.0, 1.0, 1.0]), (8, [])]
    got = found_of(ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == {0: [(20, 5.0), (1, 1.0)], 20: [(0, 5.0), (1, 1.0)], 80: [(7, 6.0)]}
    none = ann.nearest_neighbours(vectors(spark, []), F.col("vec_id") % 20 == 0)
    assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0
    assert ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") == 999).count() == 0


def test_probes_are_the_nearest_buckets():
    """Multiprobe order against all buckets' summed distances."""
    x = ann.queries_as_units(np.random.default_rng(1).normal(size=(20, 10)))
    plan = ann.Plan(1, 4, 2, 16, 10, 1.0, 3, 0.0)
    turned = ann.turns(x, plan, 0)
    got = ann.probes_of(turned, plan)
    a, b = (ann.signed(y, 4) for y in turned)
    cost = ((a.max(1, keepdims=True) - a) ** 2)[:, :, None] + ((b.max(1, keepdims=True) - b) ** 2)[:, None, :]
    cost = cost.reshape(len(x), -1)
    assert np.allclose(np.take_along_axis(cost, got, axis=1), np.sort(cost, axis=1)[:, :16])
    assert (got[:, 0] == ann.bucket_of(turned, plan)).all()
    y = ann.rotate(x, 3, 0, 0)
    assert np.allclose((y * y).sum(1), 1) and np.allclose(y @ y.T, x @ x.T)             # a rotation
