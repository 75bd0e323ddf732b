"""Toxicity: a bidirectional gated recurrent network with attention pooling over overlapping windows.

Each position of a window takes in its word twice: a vector of the word itself and the mean of the vectors of
its character n-grams (boundaries included), with the highest of the n-grams' saliences. Words and n-grams have a vector if enough sample documents hold
them, found by hash and checked by a second; all others are zero. Two gated recurrent layers read the window
in both directions; attention weighs the positions and an output unit gives the window's score. A document
scores as its highest window: windows overlap and cover every word. Trained in numpy (backpropagation
through time, Adagrad) on a bounded sample of labelled documents; of each toxic document the windows that score
highest are taken as toxic. Word vectors (in one dimension) and saliences start as log-odds in the sample.

Scoring computes a word's inputs once for each distinct word of a batch and runs all windows of the batch
side by side; the model is a fixed few MB whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.llm.common import Words, column_runs, mix64, quoted, text_or_empty
from coursemart.llm.quality import MAX_BYTES, labelled_sample

INDEX_BITS = 18              # slots of an index: at most so many words, and n-grams, have a vector
MIN_WORD, MIN_GRAM = 3, 5    # documents of the sample that a word, an n-gram must be in
PRIOR = 10.0
WORD_DIM, GRAM_DIM, HIDDEN = 8, 8, 8
ORDERS = (3, 4, 5, 6)
INPUTS = WORD_DIM + GRAM_DIM + 1
WINDOW, STRIDE = 32, 24      # of the fit
SCORE_STRIDE = WINDOW // 2   # of scoring: any WINDOW - SCORE_STRIDE + 1 words lie whole in some window
MAX_TRAIN = 3000             # labelled documents that the fit may use: bound of the sample
EPOCHS = 4
BATCH = 64
RATE = 0.05
F4 = np.float32


def distinct_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each distinct word among the words, number of each word's distinct word, hash)."""
    h, pick, kind = np.unique(w.hash, return_index=True, return_inverse=True)
    return pick, kind, h


class Known:
    """Rows of known 64-bit hashes: one slot per hash, told apart by 32 further bits; row 0 is unknown. Of
    hashes that share a slot the one with the higher ``worth`` stays."""

    def __init__(self, hashes: np.ndarray, worth: np.ndarray):
        self.check = np.zeros(1 << INDEX_BITS, dtype=np.uint32)
        self.row = np.zeros(1 << INDEX_BITS, dtype=np.int32)
        slot, check = self._split(hashes)
        order = np.lexsort((hashes, worth))  # the last written stays
        self.row[slot[order]], self.check[slot[order]] = 1, check[order]
        at = np.flatnonzero(self.row)
        self.row[at] = np.arange(1, len(at) + 1)
        self.size = len(at) + 1

    @staticmethod
    def _split(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (h >> np.uint64(64 - INDEX_BITS)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def find(self, h: np.ndarray) -> np.ndarray:
        slot, check = self._split(h)
        return np.where(self.check[slot] == check, self.row[slot], 0)


def word_grams(w: Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash of n-gram) of the chosen words, each with a space at both ends; shorter words have one
    n-gram, the whole."""
    s, e = w.start[pick] - 1, w.end[pick] + 1
    size = e - s
    who, hashes = [], []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            count = np.maximum(size - n + 1, (size < n) & (n == ORDERS[0]))
            k = np.repeat(np.arange(len(pick)), count)
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + s[k]
            h = np.full(len(at), n, dtype=np.uint64)
            for j in range(n):
                ok = at + j < e[k]
                h = (h ^ np.where(ok, w.buf[np.minimum(at + j, len(w.buf) - 1)], 0).astype(np.uint64)) * np.uint64(0x100000001B3)
            who.append(k)
            hashes.append(mix64(h))
    return np.concatenate(who), np.concatenate(hashes)


def windows(n_words: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word within it) of all windows: every ``stride`` words, the last one ending with the text;
    one window for a text of up to WINDOW words, empty ones included."""
    count = np.maximum(1, -(-(n_words - WINDOW) // stride) + 1)
    text = np.repeat(np.arange(len(n_words)), count)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * stride
    return text, np.minimum(first, np.maximum(n_words[text] - WINDOW, 0))


def _sig(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """The indexes and vectors of words and n-grams (row 0: zero); p: for each direction wx (inputs x 3H), wh (H x 3H), b; attention wa, ba, va; output wo, bo."""
    word_index: Known
    gram_index: Known
    words: np.ndarray
    grams: np.ndarray
    salience: np.ndarray
    p: dict

    @staticmethod
    def start(seed: int, word_index: Known, gram_index: Known) -> "Network":
        r = np.random.default_rng(seed)
        d, h = INPUTS, HIDDEN
        p = {}
        for side in ("f", "b"):
            p["wx" + side] = r.normal(0, 1 / np.sqrt(d), (d, 3 * h))
            p["wh" + side] = r.normal(0, 0.5 / np.sqrt(h), (h, 3 * h))
            p["b" + side] = np.zeros(3 * h)
        p |= {"wa": r.normal(0, 1 / np.sqrt(2 * h), (2 * h, h)), "ba": np.zeros(h), "va": r.normal(0, 1, h),
              "wo": r.normal(0, 1 / np.sqrt(2 * h), 2 * h), "bo": np.zeros(1)}
        words, grams = r.normal(0, 0.1, (word_index.size, WORD_DIM)), r.normal(0, 0.1, (gram_index.size, GRAM_DIM))
        words[0], grams[0] = 0, 0
        return Network(word_index, gram_index, words.astype(F4), grams.astype(F4), np.zeros(gram_index.size, F4), {k: v.astype(F4) for k, v in p.items()})

    def inputs(self, slots: np.ndarray, who: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """Input vector of each distinct word; ``who`` (sorted runs per order) and ``gram`` list its n-grams."""
        n = len(slots)
        count = np.bincount(who, minlength=n)
        mean = np.stack([np.bincount(who, weights=self.grams[gram, d], minlength=n) for d in range(GRAM_DIM)], axis=1) if n else np.zeros((0, GRAM_DIM))
        top = np.zeros(n, F4)
        np.maximum.at(top, who, self.salience[gram])
        return np.concatenate([self.words[slots], mean / np.maximum(count, 1)[:, None], top[:, None]], axis=1).astype(F4)

    def run(self, x: np.ndarray, at: np.ndarray, keep: bool = False):
        """Scores (before the logistic) of windows: ``at`` (windows x WINDOW) numbers rows of ``x``, -1 past the
        text's end. The states that training needs come along if ``keep``."""
        p, h = self.p, HIDDEN
        m = len(at)
        mask = at >= 0
        states, memo = {}, {}
        for side, steps in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            gx = np.concatenate([x @ p["wx" + side] + p["b" + side], np.zeros((1, 3 * h), F4)])  # row -1: past the end
            s = np.zeros((m, h), F4)
            out = np.empty((WINDOW, m, h), F4)
            wzr, wn = p["wh" + side][:, :2 * h], p["wh" + side][:, 2 * h:]
            zs, rs, ns, un = [], [], [], []
            for t in steps:
                g = gx[at[:, t]]
                zr = _sig(g[:, :2 * h] + s @ wzr)
                z, r = zr[:, :h], zr[:, h:]
                u = s @ wn
                c = np.tanh(g[:, 2 * h:] + r * u)
                new = s + z * (c - s)
                if keep:
                    zs.append(z); rs.append(r); ns.append(c); un.append(u)
                s = np.where(mask[:, t, None], new, s)  # past the end the state stays
                out[t] = s
            states[side] = out
            memo[side] = (zs, rs, ns, un)
        both = np.concatenate([states["f"], states["b"]], axis=2)
        a = np.tanh(both @ p["wa"] + p["ba"])
        e = np.where(mask.T, a @ p["va"], F4(-1e9))
        e = np.exp(e - e.max(axis=0))
        e = e * mask.T
        alpha = e / np.maximum(e.sum(axis=0), F4(1e-9))
        ctx = (alpha[:, :, None] * both).sum(axis=0)
        out = ctx @ p["wo"] + p["bo"][0]
        return (out, (mask, states, memo, both, a, alpha, ctx)) if keep else out

    def back(self, x: np.ndarray, at: np.ndarray, saved, g_out: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters and of ``x`` for ``g_out`` (windows)."""
        p, h = self.p, HIDDEN
        mask, states, memo, both, a, alpha, ctx = saved
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["wo"], g["bo"] = ctx.T @ g_out, np.array([g_out.sum()], F4)
        g_ctx = g_out[:, None] * p["wo"]
        g_both = alpha[:, :, None] * g_ctx
        g_alpha = (both * g_ctx).sum(axis=2)
        g_e = alpha * (g_alpha - (alpha * g_alpha).sum(axis=0))
        g["va"] = np.einsum("tm,tmh->h", g_e, a)
        g_pre = (g_e[:, :, None] * p["va"]) * (1 - a * a)
        g["wa"], g["ba"] = np.einsum("tmi,tmh->ih", both, g_pre), g_pre.sum(axis=(0, 1))
        g_both = g_both + g_pre @ p["wa"].T
        g_x = np.zeros((len(x) + 1, x.shape[1]), F4)
        for side, steps in (("f", list(range(WINDOW))), ("b", list(range(WINDOW - 1, -1, -1)))):
            part = g_both[:, :, :h] if side == "f" else g_both[:, :, h:]
            zs, rs, ns, un = memo[side]
            wh = p["wh" + side]
            wzr, wn = wh[:, :2 * h], wh[:, 2 * h:]
            g_s = np.zeros((len(at), h), F4)
            g_gx = np.zeros((len(x) + 1, 3 * h), F4)
            for i in range(WINDOW - 1, -1, -1):
                t = steps[i]
                before = states[side][steps[i - 1]] if i else np.zeros((len(at), h), F4)
                z, r, c, u = zs[i], rs[i], ns[i], un[i]
                total = g_s + part[t]
                live = mask[:, t, None]
                g_new = np.where(live, total, 0)
                g_c = g_new * z * (1 - c * c)
                g_z = g_new * (c - before) * z * (1 - z)
                g_u = g_c * r
                g_r = g_c * u * r * (1 - r)
                g_zr = np.concatenate([g_z, g_r], axis=1)
                g["wh" + side][:, :2 * h] += before.T @ g_zr
                g["wh" + side][:, 2 * h:] += before.T @ g_u
                np.add.at(g_gx, at[:, t], np.concatenate([g_zr, g_c], axis=1))
                g_s = np.where(live, g_new * (1 - z) + g_zr @ wzr.T + g_u @ wn.T, total)
            g_gx = g_gx[:-1]
            g["wx" + side], g["b" + side] = x.T @ g_gx, g_gx.sum(axis=0)
            g_x[:-1] += g_gx @ p["wx" + side].T
        return g, g_x[:-1]

    def score(self, texts: list[bytes]) -> np.ndarray:
        """0 to 1 for each text: its highest window."""
        w = Words([t.lower() for t in texts])
        pick, kind, h = distinct_words(w)
        x = np.zeros((0, INPUTS), F4)
        if len(pick):
            who, gram = word_grams(w, pick)
            x = self.inputs(self.word_index.find(h), who, self.gram_index.find(gram))
        text, first = windows(w.n, SCORE_STRIDE)
        base = np.cumsum(w.n) - w.n
        best = np.full(len(texts), -np.inf)
        for a in range(0, len(text), 8192):
            t, f = text[a:a + 8192], first[a:a + 8192]
            np.maximum.at(best, t, self.run(x, places(kind, base, w.n, t, f)))
        return 1 / (1 + np.exp(-best))


def places(kind: np.ndarray, base: np.ndarray, n: np.ndarray, text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(windows x WINDOW) numbers of the distinct words, -1 past the end."""
    off = first[:, None] + np.arange(WINDOW)
    inside = off < n[text][:, None]
    if not len(kind):
        return np.full(off.shape, -1, dtype=np.int64)
    return np.where(inside, kind[np.minimum(base[text][:, None] + off, len(kind) - 1)], -1)


class Support:
    """Documents and toxic documents that hold each item, added up over runs of documents."""

    def __init__(self):
        self.item, self.n, self.pos = np.zeros(0, dtype=np.uint64), np.zeros(0), np.zeros(0)

    def add(self, item: np.ndarray, doc: np.ndarray, y: np.ndarray) -> None:
        order = np.lexsort((doc, item))
        item, doc = item[order], doc[order]
        new = np.r_[True, (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])][:len(item)]
        every = np.concatenate([self.item, item[new]])
        self.item, kind = np.unique(every, return_inverse=True)
        self.n = np.bincount(kind, weights=np.concatenate([self.n, np.ones(int(new.sum()))]), minlength=len(self.item))
        self.pos = np.bincount(kind, weights=np.concatenate([self.pos, y[doc[new]]]), minlength=len(self.item))

    def known(self, rate: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Items that at least ``least`` documents hold, with the log-odds of label 1 over the sample's own, as if
        PRIOR more documents at the sample's rate held each."""
        odds = np.log((self.pos + PRIOR * rate) / (self.n - self.pos + PRIOR * (1 - rate))) - np.log(rate / (1 - rate))
        keep = self.n >= least
        return self.item[keep], odds[keep]


def train(texts: list[bytes], labels: np.ndarray, seed: int = 17, epochs: int = EPOCHS) -> Network:
    """Fit the network; labels are 0 or 1. Without examples, or of one class only, the output unit alone is
    set (0.5, or that class)."""
    y = labels.astype(float)
    none = np.zeros(0, dtype=np.uint64)
    if not len(texts) or y.min() == y.max():
        net = Network.start(seed, Known(none, none), Known(none, none))
        net.p["wo"][:] = 0
        net.p["bo"][:] = 0 if not len(texts) else (4.0 if y[0] else -4.0)
        return net
    rng = np.random.default_rng(seed)
    w = Words([t.lower() for t in texts])
    pick, kind, h = distinct_words(w)
    by_word, by_gram = Support(), Support()
    by_word.add(h[kind], w.doc, y)
    for a in range(0, len(y), 64):  # n-grams of a few documents' distinct words at a time
        of = np.flatnonzero((w.doc >= a) & (w.doc < a + 64))
        used = np.unique(kind[of].astype(np.int64) * len(y) + w.doc[of])  # (distinct word, document)
        k, g = word_grams(w, pick[used // len(y)])
        by_gram.add(g, (used % len(y))[k], y)
    words, word_odds = by_word.known(y.mean(), MIN_WORD)
    grams, gram_odds = by_gram.known(y.mean(), MIN_GRAM)
    net = Network.start(seed, Known(words, np.abs(word_odds)), Known(grams, np.abs(gram_odds)))
    # warm start: document log-odds in the first dimension, of n-grams as of words
    slots = net.word_index.find(h)
    parts = []
    for a in range(0, len(pick), 20_000):
        k, g = word_grams(w, pick[a:a + 20_000])
        order = np.argsort(k, kind="stable")
        parts.append(((k[order] + a).astype(np.int32), net.gram_index.find(g)[order].astype(np.int32)))
    who, gram = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
    at = np.searchsorted(who, np.arange(len(pick) + 1))
    net.words[net.word_index.find(words), 0] = word_odds / 2
    net.salience[net.gram_index.find(grams)] = gram_odds / 2
    net.words[0], net.salience[0] = 0, 0
    text, first = windows(w.n)
    base = np.cumsum(w.n) - w.n
    sums = {k: np.zeros_like(v) for k, v in net.p.items()}
    sum_salience = np.zeros(len(net.salience), F4)
    sum_words, sum_grams = np.zeros(len(net.words), F4), np.zeros(len(net.grams), F4)
    def all_inputs() -> np.ndarray:
        return np.concatenate([net.inputs(slots[a:a + 20_000], who[at[a]:at[min(a + 20_000, len(slots))]] - a,
                                          gram[at[a]:at[min(a + 20_000, len(slots))]]) for a in range(0, len(slots), 20_000)])

    x_all = all_inputs()
    odds = x_all[:, 0] + x_all[:, -1]
    for epoch in range(epochs):
        if epoch == 0:  # by the words' log-odds before there is a network
            s = np.concatenate([np.where((pl := places(kind, base, w.n, text[a:a + 8192], first[a:a + 8192])) >= 0, odds[pl], -9).max(axis=1)
                                for a in range(0, len(text), 8192)])
        else:
            x_all = all_inputs()
            s = np.concatenate([net.run(x_all, places(kind, base, w.n, text[a:a + 8192], first[a:a + 8192])) for a in range(0, len(text), 8192)])
        by_doc = np.lexsort((-s, text))
        rank = np.arange(len(text)) - np.searchsorted(text, text)  # of the sorted windows within their text
        chosen = by_doc[rank <= np.where(y[text] > 0, 0, 1)]
        extra = rng.choice(np.flatnonzero(y[text] == 0), size=min(len(y), int((y[text] == 0).sum())), replace=False)
        chosen = rng.permutation(np.unique(np.concatenate([chosen, extra])))
        weight = np.where(y[text[chosen]] > 0, max(1.0, 0.3 * (y[text[chosen]] == 0).sum() / max(1, (y[text[chosen]] > 0).sum())), 1.0)
        for a in range(0, len(chosen), BATCH):
            c = chosen[a:a + BATCH]
            at_words = places(kind, base, w.n, text[c], first[c])
            own, inv = np.unique(at_words, return_inverse=True)
            inv = inv.reshape(at_words.shape)
            pad = int(own[0] == -1) if len(own) else 0
            own = own[pad:]
            local = inv - pad
            n = np.diff(at)[own]
            lw = np.repeat(np.arange(len(own)), n)
            lg = gram[np.repeat(at[own], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
            x = net.inputs(slots[own], lw, lg)
            out, saved = net.run(x, local, keep=True)
            g_out = ((_sig(out) - y[text[c]]) * weight[a:a + BATCH] / len(c)).astype(F4)
            g, g_x = net.back(x, local, saved, g_out)
            for k in net.p:
                sums[k] += g[k] ** 2
                net.p[k] -= (RATE * g[k] / np.sqrt(sums[k] + 1e-8)).astype(F4)
            hit = net.salience[lg] == x[lw, -1]  # the n-grams that gave the word its salience
            for table, sums_t, idx, grad in ((net.words, sum_words, slots[own], g_x[:, :WORD_DIM]),
                                             (net.grams, sum_grams, lg, (g_x[:, WORD_DIM:-1] / np.maximum(n, 1)[:, None])[lw]),
                                             (net.salience, sum_salience, lg[hit], g_x[lw[hit], -1:])):
                u, ui = np.unique(idx, return_inverse=True)
                total = np.stack([np.bincount(ui, weights=grad[:, d], minlength=len(u)) for d in range(grad.shape[1])], axis=1).astype(F4) \
                    if len(u) else np.zeros((0, grad.shape[1]), F4)
                sums_t[u] += (total ** 2).mean(axis=1)
                step = RATE * total / np.sqrt(sums_t[u] + 1e-8)[:, None]
                table[u] -= step if table.ndim == 2 else step[:, 0]
                table[0] = 0
    return net


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", max_train: int = MAX_TRAIN,
        id_col: str = "doc_id", text_col: str = "text", seed: int = 17, max_bytes: int = MAX_BYTES) -> Network:
    """Train on at most ``max_train`` labelled documents, ``max_bytes`` of text, among the rows where ``learn`` holds."""
    texts, y = labelled_sample(docs, labels, label_col, learn, max_train, id_col, text_col, seed, max_bytes)
    return train(texts, y, seed)


def score(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """(row: struct of the columns of ``docs``, score): one row per row of ``docs``. Null and empty texts are
    one window without words, which scores by the output's bias; every word of a text is in a window; a very
    long text has many windows, scored in bounded runs. Repeated rows get the same score; an empty table gives an
    empty one."""
    packed = docs.select(F.struct(*quoted(docs)).alias("row")).select("row", text_or_empty(f"row.{text_col}").alias("body"))
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed size: two tables of vectors and small matrices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [shared.value.score(t) for _, _, t in column_runs(b.column("body"))]
            out = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.float64())], names=["row", "score"])

    return packed.mapInArrow(run, schema)
