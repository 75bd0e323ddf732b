"""The classifiers' scores against plain versions: loops over words, letters and windows, one document at a time."""

import math

import numpy as np
import pytest
from fixtures_llm import LONG, ROWS, documents
from pyspark.sql import functions as F

from coursemart.llm import quality, toxic
from coursemart.llm.common import Words, mix64

ONES = (1 << 64) - 1


def word_hash(word: bytes) -> int:
    """The shared word hash, of the word alone."""
    return int(Words([word]).hash[0])


def mixed(x: int) -> int:
    return int(mix64(np.array([x & ONES], dtype=np.uint64))[0])


def plain_quality(model: quality.Linear, text: str) -> float:
    """The mean of all features' numbers through the logistic function."""
    words = text.encode().split()
    s = b" " + b" ".join(words) + b" "
    used = []
    for n in quality.ORDERS:
        for i in range(len(s) - n + 1):
            g = s[i:i + n]
            if b" " in g[1:-1] or not g.strip() or not words:
                continue
            h = n * 0x9E3779B97F4A7C15 & ONES
            for b in g:
                h = (h ^ b) * 0x100000001B3 & ONES
            h = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & ONES
            used.append(h >> 64 - model.bits)
    for k, w in enumerate(words):
        used.append(mixed(word_hash(w) ^ 0x5851F42D4C957F2D) >> 64 - model.bits)
        if k and words[k - 1] == w:
            used += [quality.REPEAT] * (len(w) * len(quality.ORDERS))
    mean = sum(model.per_hash[h] for h in used) / max(1, len(used))
    return 1 / (1 + math.exp(-(mean + model.bias)))


TEXTS = ["", "a", "a a a", "The quick brown fox, the the quick!", "é ▁ ünï 中文 🙂", "x" * 40, "b bb bbb " * 20, "  spaces \n\t and lines \n"]


def fitted(module, seed=4):
    r = np.random.default_rng(seed)
    good, bad = [f"good{i}" for i in range(60)], [f"bad{i}" for i in range(60)]
    texts = [" ".join(r.choice(bad if k % 2 else good, 25 + k % 30)).encode() for k in range(120)]
    return module.train(texts, np.arange(120) % 2), good, bad


def test_quality_score_is_the_mean_of_its_features():
    model, good, bad = fitted(quality)
    texts = TEXTS + [" ".join(good[:30]), " ".join(bad[:30]), " ".join(good[:5] + bad[:5])]
    want = [plain_quality(model, t) for t in texts]
    assert np.allclose(model.score([t.encode() for t in texts]), want, atol=1e-9)
    assert max(want) - min(want) > 0.5


def test_quality_scores_of_rows_equal_the_plain_version(spark):
    model, *_ = fitted(quality)
    got = {(r["doc_id"], r["text"]): r["score"] for r in quality.score(documents(spark, clash=False), model).select("row.*", "score").collect()}
    for i, t, *_ in ROWS:
        if t != LONG:
            assert math.isclose(got[(i, t)], plain_quality(model, t or ""), abs_tol=1e-9)


# ------------------------------------------------------------------ toxicity

def sig(x):
    return 1 / (1 + np.exp(-x))


def plain_input(net: toxic.Network, word: bytes) -> np.ndarray:
    """Word vector, mean of its n-grams' vectors, largest salience of them (0 at least)."""
    spaced, grams = b" " + word + b" ", []
    for n in toxic.ORDERS:
        pieces = [spaced[i:i + n] for i in range(len(spaced) - n + 1)] or ([spaced + bytes(n - len(spaced))] if n == toxic.ORDERS[0] else [])
        for g in pieces:
            h = n
            for b in g:
                h = (h ^ b) * 0x100000001B3 & ONES
            grams.append(int(net.gram_index.find(np.array([mixed(h)], dtype=np.uint64))[0]))
    row = int(net.word_index.find(np.array([word_hash(word)], dtype=np.uint64))[0])
    return np.concatenate([net.words[row], np.mean([net.grams[g] for g in grams], axis=0), [max(0.0, *[net.salience[g] for g in grams])]]).astype(float)


def plain_window(net: toxic.Network, words: list[bytes]) -> float:
    """One window: both recurrences step by step, attention over their states, the output unit."""
    p, h = {k: v.astype(float) for k, v in net.p.items()}, toxic.HIDDEN
    x = [plain_input(net, w) for w in words]
    if not x:
        return float(p["bo"][0])
    states = {}
    for side, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        s, out = np.zeros(h), {}
        for t in order:
            g = x[t] @ p["wx" + side] + p["b" + side]
            z = sig(g[:h] + s @ p["wh" + side][:, :h])
            r = sig(g[h:2 * h] + s @ p["wh" + side][:, h:2 * h])
            c = np.tanh(g[2 * h:] + r * (s @ p["wh" + side][:, 2 * h:]))
            s = (1 - z) * s + z * c
            out[t] = s
        states[side] = out
    both = [np.concatenate([states["f"][t], states["b"][t]]) for t in range(len(x))]
    e = np.exp([np.tanh(b @ p["wa"] + p["ba"]) @ p["va"] for b in both])
    return float(sum(a * b for a, b in zip(e / e.sum(), both)) @ p["wo"] + p["bo"][0])


def plain_toxicity(net: toxic.Network, text: str) -> float:
    """The highest window: one every SCORE_STRIDE words, the last ending with the text."""
    words, size = text.encode().lower().split(), toxic.WINDOW
    starts = [0] if len(words) <= size else [*range(0, len(words) - size, toxic.SCORE_STRIDE), len(words) - size]
    return max(sig(plain_window(net, words[a:a + size])) for a in starts)


def test_toxicity_is_the_highest_plain_window():
    net, good, bad = fitted(toxic)
    texts = TEXTS + [" ".join(good), " ".join(good[:40] + bad[:12] + good[20:] * 2), " ".join(bad), " ".join(good * 3 + bad[:3])]
    want = [plain_toxicity(net, t) for t in texts]
    assert np.allclose(net.score([t.encode() for t in texts]), want, atol=1e-4)
    assert max(want) > 0.8 and min(want) < 0.2


def test_toxicity_scores_of_rows_equal_the_plain_version(spark):
    net, *_ = fitted(toxic)
    got = {(r["doc_id"], r["text"]): r["score"] for r in toxic.score(documents(spark, clash=False), net).select("row.*", "score").collect()}
    for i, t, *_ in ROWS:
        if t != LONG:
            assert math.isclose(got[(i, t)], plain_toxicity(net, t or ""), abs_tol=1e-4)


# ------------------------------------------------------------------ the sample that both learn from

def test_sample_is_bounded_in_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "é" * (i % 7)) for i in range(200)] + [(5, "a"), (6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(8, 1), (9, None), (None, 1)], "doc_id long, quality int")
    sample = quality.labelled_sample(docs, labels, "quality", F.col("doc_id") % 2 == 0, 30)
    assert len(sample[0]) == 30 == len(sample[1])
    texts, y = quality.labelled_sample(docs, labels, "quality", F.lit(True), 500)
    assert len(texts) == 200 and b"a" in texts and b"" in texts          # a repeated id has its smallest text
    assert y.sum() == 101                                                # labels of both kinds: 1
    few, _ = quality.labelled_sample(docs, labels, "quality", F.lit(True), 500, max_bytes=400)
    assert 0 < sum(map(len, few)) <= 400 and few != texts


@pytest.mark.parametrize("name", ["a.b", "a`b", "x y"])
def test_signs_in_the_names_of_other_columns(spark, name):
    from coursemart.llm import lines, mixing, near, sampling
    from coursemart.llm.queries import piece_model

    docs = documents(spark, clash=False).withColumn(name, F.lit("kept"))
    model, *_ = fitted(quality)
    assert name in quality.keep_good(docs, model, 0.0).columns and name in mixing.mix_sources(docs).columns
    assert name in near.keep_one(docs).columns and name in sampling.encode(docs, piece_model()).columns
    assert lines.dedup_lines(docs).select("row.*").columns == docs.columns


def test_variants_of_very_long_lines_come_in_bounded_batches(spark):
    from coursemart.llm import lines

    r = np.random.default_rng(2)
    long = "".join(r.choice(list("abcdefgh "), 120_000)).strip()
    docs = spark.createDataFrame([(1, long), (2, long[:60_000] + "X" + long[60_001:]), (3, long[1:]), (4, long + "tail")], "doc_id long, text string")
    got = {x["row"]["doc_id"]: list(x["dropped"]) for x in lines.dedup_lines(docs).collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: []}
