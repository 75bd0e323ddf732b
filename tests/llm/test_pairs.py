"""Near-duplicate operators against brute force: vectors, lines, documents."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures_llm import NEAR, ROWS, documents, empty, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from coursemart.llm import common, lines, near, vectors


# ------------------------------------------------------------------ components

def roots_of(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components_of_chains_stars_and_loops(spark):
    r = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5)]
    pairs += [(int(a), int(b)) for a, b in r.integers(-300, -1, (150, 2))]
    got = common.components(spark.createDataFrame(pairs, "a long, b long").repartition(4))
    want = roots_of([p for p in pairs if p[0] != p[1]])
    assert {r["id"]: r["component"] for r in got.collect()} == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ vectors

def brute_vectors(rows, threshold=0.9):
    ok = {}
    for k, (i, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=float)
            ok[k] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    links = defaultdict(set)
    for a in ok:
        for b in ok:
            if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold:
                links[a].add(b)
                links[b].add(a)
    root = roots_of([(a, b) for a in links for b in links[a]])
    low = defaultdict(list)
    for k, r in root.items():
        low[r].append(rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in low.get(root.get(k), [i]) if x is not None]
        c = min(ids) if ids else None
        out.append((i, len(links[k]), c, i == c))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_vectors_edge_rows(spark):
    base = [1.0, 2.0, 3.0, 0.5]
    rows = [(1, base), (2, base), (2, base), (3, [2.0, 4.0, 6.0, 1.0]), (4, None), (5, [0.0] * 4), (6, [1.0, None, 2.0, 1.0]),
            (7, [float("nan"), 1.0, 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0, 1.0]), (9, []), (None, base), (10, [1.0, 2.0, 3.0]),
            (11, [-1.0, -2.0, -3.0, -0.5]), (12, [1e200, 2e200, 3e200, 5e199]), (13, [1e-200, 2e-200, 3e-200, 5e-201])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, v int")
    assert rows_of(vectors.near_vectors(df), "vec_id", "n_links", "component_id", "kept") == brute_vectors(rows)
    assert vectors.near_vectors(df.filter("vec_id < 0")).count() == 0


def test_vectors_recall_and_precision(spark):
    r = np.random.default_rng(5)
    n = 1500
    a = vectors.unit(r.normal(size=(n, 32)))
    z = r.normal(size=(n, 32))
    z = vectors.unit(z - (z * a).sum(axis=1, keepdims=True) * a)
    c = r.uniform(0.9, 0.95, (n, 1))
    hub = vectors.unit(a[:1] + 0.03 * r.normal(size=(400, 32)))  # one group far larger than a window
    x = np.concatenate([a, c * a + np.sqrt(1 - c * c) * z, hub])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = {k["vec_id"]: k["n_links"] for k in vectors.near_vectors(df).collect()}
    want = ((vectors.unit(x) @ vectors.unit(x).T) >= 0.9).sum(axis=1) - 1
    assert all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.98 * want.sum()


def planted(n, pairs, dense, cone, seed, dim=64, cosine=0.905):
    """Unit vectors that do not link but for ``pairs`` isolated pairs (rows 2i and 2i + 1) of the given cosine. A share
    ``dense`` of the rows lies in one cone (cosine about ``cone`` with each other), every second pair in it."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    axis = vectors.unit(r.normal(size=(1, dim)))
    narrow = np.zeros(n, dtype=bool)
    narrow[2 * pairs:] = r.random(n - 2 * pairs) < dense
    if dense:
        narrow[0:2 * pairs:4] = True
    x = vectors.unit(x)
    x[narrow] = vectors.unit(np.sqrt(cone) * axis + np.sqrt(1 - cone) * x[narrow])
    a = x[0:2 * pairs:2]
    z = r.normal(size=a.shape)
    z = vectors.unit(z - (z * a).sum(axis=1, keepdims=True) * a)
    # in the cone the partner lies as far along its axis
    in_cone = narrow[0:2 * pairs:2]
    side = z - (z @ axis.T) * axis
    side -= (side * a).sum(axis=1, keepdims=True) / (1 - (a @ axis.T) ** 2) * (a - (a @ axis.T) * axis)
    q, along = a - (a @ axis.T) * axis, a @ axis.T
    c = np.clip((cosine - along ** 2) / (1 - along ** 2), -1, 1)
    b = along * axis + c * q + np.sqrt(1 - c * c) * np.sqrt((q * q).sum(axis=1, keepdims=True)) * vectors.unit(side)
    x[1:2 * pairs:2] = np.where(in_cone[:, None], b, cosine * a + np.sqrt(1 - cosine ** 2) * z)
    return x, in_cone


def pairs_found(spark, x, pairs):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {k["vec_id"]: k["component_id"] for k in vectors.near_vectors(df).collect()}
    return np.array([got[2 * i] == got[2 * i + 1] for i in range(pairs)])


def test_isolated_pairs_are_found_in_a_dense_third(spark, monkeypatch):
    """Runs so small that 6,000 vectors need passes, as millions do with runs of the usual size."""
    monkeypatch.setattr(vectors, "CELL", 64, raising=False)
    x, in_cone = planted(6000, 400, 1 / 3, 0.7, 3)
    found = pairs_found(spark, x, 400)
    assert found[in_cone].mean() >= 0.98 and found[~in_cone].mean() >= 0.98


def test_vectors_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 64, raising=False)
    x, _ = planted(600, 200, 0.95, 0.75, 4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    before, out = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (8, 1000):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            out.append(rows_of(vectors.near_vectors(df), "vec_id", "n_links", "component_id", "kept"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


# ------------------------------------------------------------------ lines

def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == (b[i + 1:] if len(a) == len(b) else b[i:])


def brute_lines(rows):
    docs = sorted({(i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert len({d[0] for d in docs if d[0] is not None}) == len([d for d in docs if d[0] is not None])
    seen, drop = {}, defaultdict(list)
    for i, t in docs:
        for k, x in enumerate(lines.split_lines(t)):
            if x and (x in seen or (len(x) >= lines.MIN_FUZZY and any(len(y) >= lines.MIN_FUZZY and within_one(x, y) for y in seen))):
                drop[i, t].append(k)
            if x:
                seen.setdefault(x, None)
    return drop


def test_lines_edge_rows(spark):
    got = lines.dedup_lines(documents(spark))
    out = got.select("row.doc_id", "row.text", "row.row", "clean", "n_lines", "dropped").collect()
    assert len(out) == len(ROWS)
    want = brute_lines([r for r in ROWS if r[0] is not None])
    for r in out:
        assert r["row"] == "x_row"
        if r["doc_id"] is None:
            continue
        drop = want[r["doc_id"], r["text"] or ""]
        assert list(r["dropped"]) == drop
        assert r["clean"] == (r["text"] if not drop else "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in drop))
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_lines_one_edit_everywhere(spark):
    r = np.random.default_rng(3)
    base = ["".join(r.choice(list("abcdé xyz中"), 30 + k)).strip() + "." for k in range(25)]
    texts = list(base)
    for s in base:
        i = int(r.integers(0, len(s)))
        texts += [s[:i] + "Q" + s[i + 1:], s[:i] + s[i + 1:], s[:i] + "W" + s[i:], s[:i] + "QQ" + s[i + 2:] + "!"]
    texts += ["aaaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaaa", "short", "shorT", "aaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    order = r.permutation(len(texts))
    rows = [(int(k), "\n".join(texts[i] for i in part), "en", "a", 1) for k, part in enumerate(np.array_split(order, 20))]
    want = brute_lines(rows)
    got = {x["doc_id"]: list(x["dropped"]) for x in lines.dedup_lines(documents(spark, rows)).select("row.doc_id", "dropped").collect()}
    assert got == {i: want[i, t] for i, t, *_ in rows}


def test_short_lines_within_one_edit(spark, monkeypatch):
    monkeypatch.setattr(lines, "MIN_FUZZY", 1)  # of the plain version
    r = np.random.default_rng(8)
    texts = ["Share this article", "Share this article!", "Read more...", "Read more..", "a line of 19 letters", "a line of 19 letter", "é", "中", "ab", "b"]
    texts += ["".join(r.choice(list("abc"), int(r.integers(1, 19)))) for _ in range(120)]
    rows = [(int(k), "\n".join(texts[i] for i in part), "en", "a", 1) for k, part in enumerate(np.array_split(r.permutation(len(texts)), 20))]
    want = brute_lines(rows)
    got = {x["doc_id"]: list(x["dropped"]) for x in lines.dedup_lines(documents(spark, rows), min_fuzzy=1).select("row.doc_id", "dropped").collect()}
    assert got == {i: want[i, t] for i, t, *_ in rows}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abé中 ", min_size=20, max_size=45), st.integers(0, 44), st.sampled_from("sdi"))
def test_an_edit_always_meets(s, i, kind):
    i = i % len(s)
    t = s[:i] + ("Z" + s[i + 1:] if kind == "s" else s[i + 1:] if kind == "d" else "Z" + s[i:])
    x = lines.Lines([s, t])
    keys = lines.block_keys(x)
    shared = np.array([[k in set(keys[1 - j].tolist()) for k in keys[j].tolist()] for j in (0, 1)])
    assert shared.any(axis=1).all()
    line, key, what = lines.variant_keys(x, shared)
    assert set(key[line == 0].tolist()) & set(key[line == 1].tolist())


# ------------------------------------------------------------------ documents

def shingles(t, size=5):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_near(rows, threshold=0.8):
    sets = [shingles(r[1]) for r in rows]
    links = defaultdict(set)
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j != k).items():
            if n / (len(s) + len(sets[j]) - n) >= threshold:
                links[k].add(j)
    return links


@pytest.mark.parametrize("words", range(7))
def test_shingles_of_a_run_of_few_words(words):
    """A run that holds one short text alone gives the sets it has beside longer ones."""
    t = b" ".join(b"w%d" % i for i in range(words))
    alone, beside = near.shingle_sets([t]), near.shingle_sets([t, NEAR.encode()])
    assert len(alone) == 1 and len(alone[0]) == len(shingles(t.decode())) and np.array_equal(alone[0], beside[0])


def test_near_edge_rows(spark):
    got = {(r["id"], r["tk"]): r for r in near.jaccard_join(documents(spark)).collect()}
    links = brute_near(ROWS)
    keys = {(r["doc_id"], r["tk"]) for r in documents(spark, clash=False).selectExpr("doc_id", "xxhash64(coalesce(text, '')) tk").collect()}
    assert set(got) == keys
    by_id = defaultdict(list)
    for k, r in enumerate(ROWS):
        by_id[r[0]].append(len(links[k]))
    for (i, _), r in got.items():
        assert r["n_links"] in by_id[i]
    assert {r["class_id"] for (i, _), r in got.items() if i in (8, 9, 10, 11)} == {8}
    assert sum(r["kept"] for (i, _), r in got.items() if i in (8, 9, 10, 11)) == 1
    assert got[next(k for k in got if k[0] == 2)]["times"] == 2
    kept = near.keep_one(documents(spark))  # 2 is a near copy of 1 (8 of 9 shingles)
    assert set(kept.columns) == set(documents(spark).columns)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 12] and ids.count(None) == 2
    assert near.jaccard_join(empty(spark)).count() == 0


@pytest.mark.parametrize("block, node_block", [(512, 1024), (3, 4)])
def test_near_equals_brute_force(spark, monkeypatch, block, node_block):
    """Also with blocks so small that groups span many of them."""
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "NODE_BLOCK", node_block)
    r = np.random.default_rng(7)
    rows, vocabulary = [], [f"w{i}" for i in range(5000)]
    for g in range(12):
        base = list(r.choice(vocabulary, 120 + 5 * g))
        for c in range(int(r.integers(1, 16))):
            t = list(base)
            for _ in range(int(r.integers(0, 4))):
                t[int(r.integers(0, len(t)))] = str(r.choice(vocabulary))
            rows.append((len(rows), " ".join(t), "en", "a", 1))
    links = brute_near(rows)
    got = {x["id"]: x for x in near.jaccard_join(documents(spark, rows)).collect()}
    assert {i: got[i]["n_links"] for i in got} == {i: len(links[i]) for i in got}
    root = roots_of([(a, b) for a in links for b in links[a]])
    assert {i: got[i]["class_id"] for i in got} == {i: root.get(i, i) for i in got}
    assert {i for i in got if got[i]["kept"]} == {i for i in got if root.get(i, i) == i}


def test_forest_depth_shortens_until_the_recall():
    assert near.forest_depth(0.8, 16, 6, 0.999) == 4
    assert near.forest_depth(0.8, 16, 6, 0.9) == 6
    assert near.forest_depth(0.3, 2, 6, 0.999) == 1
