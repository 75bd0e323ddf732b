"""The pipeline's stages on the whole small table, each against a plain version of its decision."""

from collections import Counter

import pytest
from fixtures_llm import ROWS, documents, empty, rows_of
from pyspark.sql import functions as F
from test_pairs import brute_lines, brute_near, roots_of

import corpus_pipeline as cp
from coursemart.llm import lattice, mixing, quality, queries, sampling
from coursemart.llm.common import by_bytes, cut, fold, read

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = [read(spark, SF, "documents")]
    for name, f in cp.STAGES:
        docs.append(cut(f(spark, docs[-1], SF), name))
    return docs


def data(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.select(*COLS).collect()]


def test_quality_stage(spark, stages):
    docs = stages[0]
    model = quality.fit(docs, read(spark, SF, "labels"), fold("doc_id", 3) != 1)
    rows = data(docs)
    score = [s for run in by_bytes([r[1] for r in rows]) for s in model.score(run)]
    assert sorted(data(stages[1])) == sorted(r for r, s in zip(rows, score) if s >= 0.5)
    assert stages[1].count() < len(rows)


def test_line_stage(stages):
    rows = data(stages[1])
    drop = brute_lines(rows)
    want = []
    for i, t, *rest in rows:
        k = drop[i, t or ""]
        if k:
            t = "\n".join(x for j, x in enumerate(t.split("\n")) if j not in k)
            rest[-1] = len(t)
        if not k or t.strip():
            want.append((i, t, *rest))
    assert sorted(data(stages[2])) == sorted(want)
    assert stages[2].columns == COLS


def test_near_stage(stages):
    rows = sorted(data(stages[2]))
    links = brute_near(rows)
    root = roots_of([(a, b) for a in links for b in links[a]])
    assert sorted(data(stages[3])) == [r for k, r in enumerate(rows) if root.get(k, k) == k]


def test_mix_stage(stages):
    rows = data(stages[3])
    want = Counter({(r["doc_id"]): r["mix_copies"] for r in mixing.mix_sources(stages[3]).collect()})
    got = data(stages[4])
    assert Counter(r[0] for r in got) == want and set(got) <= set(rows)
    assert stages[4].columns == COLS


def test_piece_stage(stages):
    v = lattice.vocabulary(queries.piece_model())
    out = stages[5].collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in data(stages[4]))
    for r in out:
        assert b"".join(v.pieces[i] for i in r["piece_ids"])[1:].decode() == r["text"]


def test_stages_take_odd_and_empty_tables(spark):
    for name, f in cp.STAGES:
        docs = documents(spark)
        out = f(spark, docs, SF)
        assert set(out.columns) >= set(docs.columns), name
        assert out.count() <= 4 * len(ROWS)
        assert f(spark, empty(spark), SF).count() == 0, name


def test_run_equals_its_stages(spark, stages):
    assert rows_of(cp.run(spark, SF), "doc_id", "text", "piece_ids") == rows_of(stages[5], "doc_id", "text", "piece_ids")
