"""Lattice, language model, sampled pieces, token files, classifiers."""

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from fixtures_llm import LONG, ROWS, SF, documents, empty, rows_of
from pyspark.sql import functions as F

from coursemart.llm import lattice, lm, quality, queries, sampling, tokenfile, toxic
from coursemart.llm.common import by_bytes, fold, read

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def all_paths(vocab, unit: bytes):
    """Every segmentation of a unit with its log weight, by recursion over its bytes."""
    lat = vocab.lattice(np.frombuffer(unit, dtype=np.uint8), np.array([0]), np.array([len(unit)]))
    arcs = list(zip(lat.src.tolist(), lat.dst.tolist(), lat.piece.tolist()))

    def from_node(k):
        if k == len(unit):
            yield ()
        for s, d, p in arcs:
            if s == k:
                for rest in from_node(d):
                    yield (p, *rest)

    return list(from_node(0))


@pytest.mark.parametrize("unit", [b" the", " été".encode(), b" wh\x01t", " 🙂".encode(), b" attention"])
def test_forward_sums_all_segmentations(unit):
    v = lattice.vocabulary(MODEL)
    paths = all_paths(v, unit)
    assert all(b"".join(v.pieces[p] for p in path) == unit for path in paths)
    want = np.logaddexp.reduce([sum(v.weight[p] for p in path) for path in paths])
    lat = v.lattice(np.frombuffer(unit, dtype=np.uint8), np.array([0]), np.array([len(unit)]))
    assert math.isclose(lat.forward(v.weight)[lat.last[0]], want, rel_tol=1e-12)
    posterior = Counter()
    for path in paths:
        for p in path:
            posterior[p] += math.exp(sum(v.weight[q] for q in path) - want)
    got = lat.expected(v.weight, np.ones(1), v.size)
    assert all(math.isclose(got[p], n, rel_tol=1e-9) for p, n in posterior.items()) and math.isclose(got.sum(), sum(posterior.values()))


def test_sampling_follows_the_posterior():
    v = lattice.vocabulary(MODEL)
    paths = all_paths(v, b" these")
    weight = np.array([sum(v.weight[p] for p in path) for path in paths])
    prob = np.exp(weight - np.logaddexp.reduce(weight))
    n = 20_000
    ids, counts = sampling.sample_texts(v, [b"these"] * n, np.arange(n).astype(np.uint64), v.weight)
    at = np.cumsum(counts)
    seen = Counter(tuple(ids[z - c:z].tolist()) for z, c in zip(at, counts))
    assert set(seen) <= set(paths)
    for path, p in zip(paths, prob):
        assert abs(seen[path] - n * p) < 6 * math.sqrt(n * p + 1)


def test_pieces_are_reproducible_and_lossless(spark):
    docs = documents(spark)
    a = sampling.encode(docs, MODEL)
    assert set(a.columns) == set(docs.columns)  # piece_ids replaces the caller's
    assert rows_of(a, "doc_id", "text", "piece_ids") == rows_of(sampling.encode(docs.repartition(9), MODEL), "doc_id", "text", "piece_ids")
    assert rows_of(a, "piece_ids") != rows_of(sampling.encode(docs, MODEL, seed=18), "piece_ids")
    back = sampling.decode(a, MODEL)
    assert back.filter("coalesce(text, '') <> decoded").count() == 0 and back.count() == len(ROWS)
    assert sampling.encode(empty(spark), MODEL).count() == 0
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in a.filter("doc_id in (1, 6, 7, 8)").collect():
        assert sp.decode(r["piece_ids"]) == r["text"]


def test_units_may_share_work_or_not():
    v = lattice.vocabulary(MODEL)
    texts = [(t or "").encode() for _, t, *_ in ROWS if t != LONG]
    seeds = np.arange(len(texts)).astype(np.uint64)
    a, b = sampling.sample_texts(v, texts, seeds, v.weight), sampling.sample_texts(v, texts, seeds, v.weight, share_units=False)
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


# ------------------------------------------------------------------ language model

def test_lm_equals_a_plain_version(spark):
    train = lambda i: zlib.crc32((str(i) if i is not None else "").encode()) % 5 != 1
    got = lm.lm_score(documents(spark), fold("doc_id", 5) != 1, MODEL, chunk_bytes=50_000)
    docs = [(i, lm.tokens(t)) for i, t, *_ in ROWS]
    c = Counter(w for i, ws in docs if train(i) for w in ws)
    ends = sum(train(i) for i, _ in docs)
    n, kinds = sum(c.values()) + ends, len(c) + 1
    once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    counts = lm.Counts(n, kinds, ends, min(0.95, max(0.1, once / (once + 2 * twice))))
    weight = lm.learn_pieces(spark.createDataFrame([(bytearray(w), k) for w, k in c.items()], "word binary, seen long"), MODEL)
    want = []
    for i, ws in docs:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in ws) + math.log10((ends + 0.5) / (n + 0.5 * (kinds + 1)))
        score, before = 0.0, Counter()
        for t, w in enumerate([*ws, None]):
            lp = counts.end() if w is None else float(counts.word(np.array([float(c[w])]), lm.piece_sums([w], weight, MODEL))[0])
            score += math.log10((lm.RECALL * 10 ** lp + before[w]) / (lm.RECALL + t)) if lp > -300 or before[w] else lp + math.log10(lm.RECALL / (lm.RECALL + t))
            before[w] += 1
        want.append((i, not train(i), len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, base, score))
    key = lambda r: (r[0] is None, str(r[0]), r[2])
    rows = sorted((tuple(r) for r in got.collect()), key=key)
    want.sort(key=key)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    for r, w in zip(rows, want):
        assert math.isclose(r[5], w[5], rel_tol=1e-9) and math.isclose(r[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


def test_lm_words_sum_to_one_at_most():
    """Every word over a small alphabet up to four letters: the piece paths' mass stays under one."""
    v = lattice.vocabulary(MODEL)
    words = ["".join(x).encode() for n in (1, 2, 3) for x in product("aeht", repeat=n)]
    assert np.exp(lm.piece_sums(words, v.weight, MODEL)).sum() < 1
    assert math.isclose(np.exp(v.weight[np.isfinite(v.weight)]).sum(), 1.0, rel_tol=1e-9)


def test_lm_without_training_rows_and_empty(spark):
    got = lm.lm_score(documents(spark), F.lit(False), MODEL).collect()
    assert len(got) == len(ROWS) and all(r["held_out"] and r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)
    assert lm.lm_score(empty(spark), F.lit(True), MODEL).count() == 0


# ------------------------------------------------------------------ token files

def test_token_files_equal_whole_text_encoding(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op6_token_files"](spark, SF).collect()}
    start = 0
    for r in read(spark, SF, "documents").orderBy("doc_id").collect():
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        assert got[r["doc_id"]] == (r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_word_ids_of_odd_texts(monkeypatch):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    texts = ["It's, dogs', a b Ünï,x <|endoftext|>, A.B.C...! 'S'T x\x0by\x85z é, É! ﬁ 12,5 ½ 中文, İstanbul, ΣΑΣ, ", "", None, "  ",
             "'s 'll,", "don't!! WE'LL.", "á. ́b", "A,́ x!́", "x" * 3000, "ÉÀÿß, ÷a a÷ Ñandú!! ñ$$$ ŸẞÖ. Œuvre¿ d'Été' éé’é İ,"]
    for keep in (1000, 3):  # also when nearly nothing is kept
        monkeypatch.setattr(tokenfile, "CACHE_WORDS", keep)
        coder = tokenfile.WordIds(WORD_BPE)
        for _ in range(2):
            ids, n = coder.encode([(x or "").encode() for x in texts], 2)
            assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_word_ids_of_random_strings():
    """Letters, digits, signs, special tokens' names and characters beyond Latin-1 in any order."""
    import random

    from tokenizers import Tokenizer

    t, coder, r = Tokenizer.from_file(WORD_BPE), tokenfile.WordIds(WORD_BPE), random.Random(1)
    some = [*"abcXYZ019.,;!?'\"-_<|>()[]{}@#$%^&*+=~`/\\ \n\t", *"ÉéßþÞ×÷ÿÀ中🙂İſﬁ²½٣ǅKª", "\u0301", "\u00a0", "\u2003", "\u0085", "\x00", "\x1f", "\u200d", "\ufeff",
            "<|startoftext|>", "'s", "'ll"]
    for _ in range(3000):
        x = "".join(r.choice(some) for _ in range(r.randrange(1, 25)))
        assert coder.encode([x.encode()], None)[0].tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_token_files_layout_and_edges(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tokenfile.tokenize_to_files(documents(spark), WORD_BPE, 2, str(tmp_path / "t"), shards=3)
    rows = tokenfile.read_tokens(spark, path).orderBy("seq").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i)) and len(ids) == len(ROWS)
    assert [r["tokens"] for r in rows if r["doc_id"] in (3, 4, 5)] == [[2], [2], [2]]
    start, want = {r["seq"]: r["start"] for r in tokenfile.token_starts(spark, path).collect()}, 0
    for r in rows:
        assert start[r["seq"]] == want
        want += r["n_tokens"]
    assert tokenfile.read_tokens(spark, path, F.col("doc_id") == 8).count() == 1
    plan = tokenfile.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert ",tokens:" not in plan.split("ReadSchema")[1]
    for f in (tmp_path / "t").glob("*.parquet"):
        m = pq.ParquetFile(f).metadata
        for g in range(m.num_row_groups):
            for c in range(m.num_columns):
                col = m.row_group(g).column(c)
                assert col.has_offset_index and col.has_column_index
                if col.path_in_schema in ("doc_id", "seq", "n_tokens"):
                    assert "DELTA_BINARY_PACKED" in col.encodings
                else:
                    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(col.encodings)
    none = tokenfile.tokenize_to_files(empty(spark), WORD_BPE, 2, str(tmp_path / "e"), shards=2)
    assert tokenfile.read_tokens(spark, none).count() == 0


def test_row_groups_follow_their_bound(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(40_000).selectExpr("id doc_id", "id seq", "50L n_tokens", "transform(sequence(1, 50), x -> cast(xxhash64(id, x) % 40000 as int)) tokens").coalesce(1)
    tokenfile.write_tokens(df, str(tmp_path / "g"), row_group_bytes=1 << 20, page_bytes=64 << 10)
    (f,) = (tmp_path / "g").glob("*.parquet")
    assert pq.ParquetFile(f).metadata.num_row_groups > 2


# ------------------------------------------------------------------ classifiers

def test_quality_on_held_out_documents(spark):
    got = queries.QUERIES["op10_quality"](spark, "/root/testdata/sf0.01")
    j = got.join(read(spark, "/root/testdata/sf0.01", "labels"), "doc_id").filter("held_out").collect()
    assert len(j) > 80 and sum(r["predicted"] == r["quality"] for r in j) / len(j) > 0.95


def test_toxicity_on_held_out_documents(spark):
    got = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1")
    j = got.join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("held_out").collect()
    assert len(j) > 500 and sum(r["predicted"] == r["toxic"] for r in j) / len(j) > 0.95


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxic, "toxic")])
def test_classifier_edges(spark, module, label):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 0, 0), (3, None, 1), (None, 1, 1), (8, 1, 0), (99, 7, 7)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.filter("doc_id = 1"), labels.filter("doc_id < 0")):
        model = module.fit(docs, known, F.lit(True), label)
        out = module.score(docs, model).select("row.*", F.col("score").alias("p")).collect()
        assert len(out) == len(ROWS) and all(0 <= r["p"] <= 1 and r["score"] == "x_score" for r in out)
        blank = {r["p"] for r in out if not (r["text"] or "").strip()}
        assert max(blank) - min(blank) < 1e-9
    assert module.score(empty(spark), model).count() == 0


def test_scores_do_not_depend_on_the_batch():
    texts = [(t or "").encode() for _, t, *_ in ROWS]
    y = np.array([k % 2 for k in range(len(texts))])
    for model in (quality.train(texts, y), toxic.train(texts, y)):
        whole = model.score(texts)
        alone = np.concatenate([model.score([t]) for t in texts])
        assert np.allclose(whole, alone, atol=1e-5)


def test_network_gradients(monkeypatch):
    monkeypatch.setattr(toxic, "F4", np.float64)
    none = np.zeros(0, dtype=np.uint64)
    net = toxic.Network.start(3, toxic.Known(none, none), toxic.Known(none, none))
    r = np.random.default_rng(0)
    x, at, g_out = r.normal(size=(10, toxic.INPUTS)), r.integers(0, 10, (4, toxic.WINDOW)), r.normal(size=4)
    at[1, 20:] = -1
    _, saved = net.run(x, at, keep=True)
    g, g_x = net.back(x, at, saved, g_out)
    loss = lambda: float((net.run(x, at) * g_out).sum())
    for array, grad in [(net.p[k], g[k]) for k in net.p] + [(x, g_x)]:
        where = tuple(r.integers(0, s) for s in array.shape)
        old = array[where]
        array[where] = old + 1e-5
        up = loss()
        array[where] = old - 1e-5
        down = loss()
        array[where] = old
        assert math.isclose((up - down) / 2e-5, grad[where], rel_tol=1e-4, abs_tol=1e-7)


def test_windows_cover_every_word():
    n = np.array([0, 1, 31, 32, 33, 56, 57, 1000])
    text, first = toxic.windows(n)
    for k, words in enumerate(n):
        seen = {int(f) + j for f in first[text == k] for j in range(toxic.WINDOW) if f + j < words}
        assert seen == set(range(words)) and (text == k).any()


def test_by_bytes_keeps_order_and_bounds():
    texts = ["a" * 10, None, "b" * 100, "", "c" * 5]
    runs = list(by_bytes(texts, 50))
    assert [x for run in runs for x in run] == [(t or "").encode() for t in texts] and len(runs) > 1


def test_a_toxic_passage_counts_wherever_it_starts(monkeypatch):
    """Passages of 10 to 16 words at 32 offsets of a long clean text lie whole in a window, with one decision."""
    r = np.random.default_rng(6)
    clean, bad = [f"word{i}" for i in range(200)], [f"vile{i}" for i in range(20)]
    texts, y = [], []
    for k in range(300):
        words = [str(w) for w in r.choice(clean, int(r.integers(20, 120)))]
        if k % 2:
            at = int(r.integers(0, len(words)))
            words[at:at] = [str(w) for w in r.choice(bad, int(r.integers(10, 17)))]
        texts.append(" ".join(words).encode())
        y.append(k % 2)
    net = toxic.train(texts, np.array(y))
    plain = toxic.places
    seen = []

    def places(kind, base, n, text, first):
        seen.append((text, first))
        return plain(kind, base, n, text, first)

    monkeypatch.setattr(toxic, "places", places)
    long = [str(w) for w in r.choice(clean, 200)]
    for size in (10, 13, 16):
        passage = [str(w) for w in r.choice(bad, size)]
        seen.clear()
        score = net.score([" ".join(long[:64 + k] + passage + long[64 + k:]).encode() for k in range(32)])
        text, first = (np.concatenate(c) for c in zip(*seen))
        for k in range(32):
            f = first[text == k]
            assert ((f <= 64 + k) & (64 + k + size <= f + toxic.WINDOW)).any()
        assert (score >= 0.5).all()
    assert net.score([" ".join(long).encode()])[0] < 0.5
