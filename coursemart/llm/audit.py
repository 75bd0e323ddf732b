"""Source divergence audit: how far the word shares of a language's sources lie from each other.

Identical texts of a language are collapsed to one row with its multiplicity in each source, so a text that thousands of rows
hold is split into terms once; counts and document frequencies are weighted by the multiplicities. The terms that are
frequent enough give every source a smoothed share p of each (in billionths), and two sources differ in a term by
f(p, q) = floor((p - q)^2 / (p + q)).

The sum over all terms of a pair of sources is taken sparsely. With p0 for the share of a term that a source lacks and T
for the terms that it has,

    sum f = V f(p0_g, p0_h)
            + sum over T_g of [f(p_g, p0_h) - f(p0_g, p0_h)] + the same for h
            + sum over T_g and T_h of [f(p_g, p_h) - f(p_g, p0_h) - f(p0_g, p_h) + f(p0_g, p0_h)]

so that only terms which a source has are read, and only those that two share are compared. Terms are dealt into chunks
and sources into blocks; a task holds one chunk of two blocks and returns one number a pair. All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.llm.common import column_runs, cut
from coursemart.llm.lines import _small

MIN_DOCS = 10
SHARE = 1_000_000_000         # shares are counted in billionths
TOP = 10
RUN_BYTES = 512 << 10         # text split at once
CHUNK = 100_000               # (source, term) rows of a chunk of a language, about
BLOCK = 128                   # sources of a block, about

# bytes of a term, upper case lowered; every other byte parts terms
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, dtype=bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(text, terms, n): each text's distinct terms and how often it has them, as parallel arrays."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = _TERM[buf]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(_LOWER[buf[inside]]))
    coded = words.dictionary_encode()
    of = np.searchsorted(ends, start, side="right")
    pair, n = np.unique(of * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
    text, code = np.divmod(pair, max(1, len(coded.dictionary)))
    return text, coded.dictionary.take(pa.array(code)), n


def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (lang, text, held: its sources and multiplicities) to (lang, source, term, n, docs), summed within a run."""
    for b in batches:
        lang, held = b.column("lang"), b.column("held")
        for i, j, texts in column_runs(b.column("text"), RUN_BYTES):
            text, terms, n = terms_of(texts)
            if not len(text):
                continue
            group, names = {}, []
            at, source, times = [], [], []
            for k in range(i, j):
                for s in held[k].as_py():
                    key = (lang[k].as_py(), s["source"])
                    if key not in group:
                        group[key] = len(names)
                        names.append(key)
                    at.append(k - i)
                    source.append(group[key])
                    times.append(s["times"])
            source, times = np.array(source), np.array(times, dtype=np.int64)
            coded = terms.dictionary_encode()
            first = np.searchsorted(at, np.arange(j - i + 1))              # sources of a text, in text order
            many = np.diff(first)[text]
            row = np.repeat(np.arange(len(text)), many)
            own = np.repeat(first[:-1][text], many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            pair, inv = np.unique(source[own] * len(coded.dictionary) + coded.indices.to_numpy()[row], return_inverse=True)
            count, docs = np.zeros(len(pair), dtype=np.int64), np.zeros(len(pair), dtype=np.int64)
            np.add.at(count, inv, n[row] * times[own])
            np.add.at(docs, inv, times[own])
            g, code = np.divmod(pair, len(coded.dictionary))
            names_l, names_s = pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.string())
            yield pa.RecordBatch.from_arrays([names_l.take(pa.array(g)), names_s.take(pa.array(g)), coded.dictionary.take(pa.array(code)),
                                              pa.array(count), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, docs) of all documents, each distinct text of a language split once; and every (lang, source)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    rows = rows.withColumn("h", F.unhex(F.sha2("text", 256)))
    # copies are counted by digest; their text goes through the shuffle once for each task that reads it
    held = cut(rows.groupBy("lang", "h", "source").agg(F.count(F.lit(1)).alias("times")), "audit-copies")
    sources = held.select("lang", "source").distinct()
    by_text = held.groupBy("lang", "h").agg(F.collect_list(F.struct("source", "times")).alias("held"))
    texts = rows.groupBy("lang", "h").agg(F.any_value("text").alias("text"))
    each = texts.join(by_text, ["lang", "h"]).select("lang", "text", "held")
    found = each.mapInArrow(split, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), sources


def share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(SHARE (count + 2) / (total + 2 v)), exact for any count."""
    up = (count + 2).cast("decimal(24,0)") * F.lit(SHARE).cast("decimal(10,0)")
    return F.call_function("div", up, (total + 2 * v).cast("decimal(24,0)")) + 1


def differ(p, q):
    """floor((p - q)^2 / (p + q)) of columns or arrays of whole numbers."""
    return F.call_function("div", (p - q) * (p - q), p + q) if isinstance(p, Column) else (p - q) ** 2 // (p + q)


def sums_of_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One chunk of two blocks of sources: (lang, a, b, value) with a of block lo and b of block hi, less V f(p0, p0).
    Rows without a term give the sources themselves and their p0."""
    head = pdf[pdf["term"].isna()].reset_index(drop=True)
    at = {s: k for k, s in enumerate(head["source"])}
    zero, side = head["p0"].to_numpy(), head["side"].to_numpy()
    rows = pdf[pdf["term"].notna()].sort_values("term", kind="stable")
    src, p = rows["source"].map(at).to_numpy(dtype=np.int64), rows["p"].to_numpy(dtype=np.int64)
    out = np.zeros((len(head), len(head)), dtype=np.int64)
    # terms of one source: its distinct shares against every other source's p0
    for g in range(len(head)):
        shares, times = np.unique(p[src == g], return_counts=True)
        for k in range(0, len(shares), 4096):
            s, m = shares[k:k + 4096, None], times[k:k + 4096, None]
            single = ((differ(s, zero[None, :]) - differ(zero[g], zero)[None, :]) * m).sum(axis=0)
            out[g] += single
            out[:, g] += single
    # shared terms: rows of one term lie together, so each offset compares rows with those behind them
    term = pd.factorize(rows["term"])[0]
    for d in range(1, len(head)):
        i = np.flatnonzero(term[:-d] == term[d:]) if len(term) > d else np.zeros(0, np.int64)
        if not len(i):
            break
        a, b = src[i], src[i + d]
        both = differ(p[i], p[i + d]) - differ(p[i], zero[b]) - differ(zero[a], p[i + d]) + differ(zero[a], zero[b])
        np.add.at(out, (a, b), both)
        np.add.at(out, (b, a), both)
    np.fill_diagonal(out, 0)
    lo, hi = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    a, b = np.repeat(lo, len(hi)), np.tile(hi, len(lo))
    keep = (a != b) & ((side[a] != side[b]) | (a < b))
    name = head["source"].to_numpy(dtype=object)
    return pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": name[a[keep]], "b": name[b[keep]], "value": out[a[keep], b[keep]]})


def pair_sums(kept: DataFrame, stats: DataFrame, chunk: int, block: int) -> DataFrame:
    """(lang, a, b, value) for each two sources of a language, once. ``kept``: lang, source, term, p, p0, chunks, blocks;
    ``stats``: lang, source, p0, v, chunks, blocks."""
    terms = kept.select("lang", "source", "term", "p", "p0", F.pmod(F.xxhash64("term"), "chunks").alias("chunk"), "blocks")
    heads = stats.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), "p0",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "blocks")
    own = F.pmod(F.xxhash64("source", F.lit(3)), "blocks")
    both = (terms.unionByName(heads).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .withColumn("side", F.when(F.col("lo") == F.col("hi"), 2).otherwise((F.col("own") == F.col("hi")).cast("int"))).drop("own", "other", "blocks"))
    sums = both.groupBy("lang", "chunk", "lo", "hi").applyInPandas(sums_of_block, "lang string, a string, b string, value long")
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    zero = stats.select("lang", "source", "p0", "v")
    a, b = (zero.select("lang", F.col("source").alias(x), F.col("p0").alias(f"{x}0"), F.col("v").alias(f"{x}v")) for x in "ab")
    whole = total.join(_small(a, 96), ["lang", "a"]).join(_small(b, 96), ["lang", "b"])
    return whole.select("lang", "a", "b", F.when(F.col("av") == 0, F.lit(0).cast("long"))
                        .otherwise(F.col("value") + F.col("av") * differ(F.col("a0"), F.col("b0"))).alias("value"))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
               top: int = TOP, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs, even without a term.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased; a language keeps those in at least ``min_docs``
    of its documents. Part `pair`: every other source of the language and the summed difference from it; part `term`: the
    ``top`` terms that the source has and that have a larger share there than in the language. Ranks from 1 by value, ties by
    the item's UTF-8 bytes. Null text, language and source count as empty; repeated rows are documents of their own. A
    language without kept terms gives its pairs the value 0, one with a single source gives none. Texts of any length are split
    whole; an empty table gives an empty one; other columns are not read."""
    counts, sources = term_counts(docs, text_col, lang_col, source_col)
    w = Window.partitionBy("lang", "term")
    kept = (counts.withColumns({"df": F.sum("docs").over(w), "all": F.sum("n").over(w), "one": F.row_number().over(w.orderBy("source"))})
            .filter(F.col("df") >= min_docs).select("lang", "source", "term", "n", "all", (F.col("one") == 1).cast("long").alias("lead")))
    kept = cut(kept, "audit-terms")
    per = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("m"), F.sum("lead").alias("lead"))
    stats = sources.join(per, ["lang", "source"], "left").fillna(0, ["total", "m", "lead"])
    by_lang = stats.groupBy("lang").agg(F.sum("lead").alias("v"), F.sum("total").alias("lang_total"), F.sum("m").alias("rows"), F.count(F.lit(1)).alias("s"))
    p0 = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(1)
    stats = cut(stats.join(by_lang, "lang").select(
        "lang", "source", "total", "v", "lang_total", p0.alias("p0"), F.greatest(F.lit(1), F.ceil(F.col("rows") / chunk)).cast("long").alias("chunks"),
        F.ceil(F.col("s") / block).cast("long").alias("blocks")), "audit-sources")
    shares = kept.join(_small(stats, 128), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("all"), F.col("lang_total"), F.col("v")).alias("q"),
        "p0", "chunks", "blocks")
    once = cut(pair_sums(shares, stats, chunk, block), "audit-pairs")
    pairs = once.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        once.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    more = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), differ(F.col("p"), F.col("q")).alias("value"))
    more = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(more.withColumn("part", F.lit("term")).select(*columns))


ORACLE = r"""
with d as (select coalesce(lang, '') lang, coalesce(source, '') source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t, row_number() over () r from documents),
w as (select lang, source, r, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
k as (select lang, term, count(*)::hugeint n from w group by lang, term having count(distinct r) >= 10),
vl as (select lang, count(*)::hugeint v, sum(n)::hugeint n from k group by lang),
g as (select distinct lang, source from d),
c as (select g.lang, g.source, k.term, coalesce(x.n, 0)::hugeint n
      from g join k on g.lang = k.lang left join (select lang, source, term, count(*) n from w group by all) x
      on x.lang = g.lang and x.source = g.source and x.term = k.term),
s as (select *, sum(n) over (partition by lang, source)::hugeint tot from c),
p as (select s.lang, s.source, s.term, s.n, 1 + (1000000000::hugeint * (s.n + 2)) // (s.tot + 2 * vl.v) p,
             1 + (1000000000::hugeint * (k.n + 2)) // (vl.n + 2 * vl.v) q
      from s join vl on s.lang = vl.lang join k on k.lang = s.lang and k.term = s.term),
pr as (select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) value
       from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' part, b.source item, coalesce(pr.value, 0)::bigint value
          from g a join g b on a.lang = b.lang and a.source <> b.source
          left join pr on pr.lang = a.lang and pr.source = a.source and pr.item = b.source),
terms as (select lang, source, 'term' part, term item, ((p - q) * (p - q) // (p + q))::bigint value from p where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) rank from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank::int rank from ranked where part = 'pair' or rank <= 10
"""
