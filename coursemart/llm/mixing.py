"""Mixing sources to target weights by Poisson replication (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import cut, quoted

BITS = 52
BROADCAST_BYTES = 32 * 1024 * 1024


def hash_uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts' texts (52 bits; null counts as empty)."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << BITS))


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities of a Poisson variable at 0, 1, ..., up to a tail below 1e-18
    (terms in logarithms, so a large mean does not underflow)."""
    last = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(40.0)).cast("int")
    state = F.struct(F.lit(0.0).alias("log_fact"), F.lit(0.0).alias("below"), F.array().cast("array<double>").alias("cdf"))

    def step(s, k):
        fact = s["log_fact"] + F.when(k > 1, F.log(k.cast("double"))).otherwise(F.lit(0.0))
        below = s["below"] + F.exp(k * F.log(rate) - rate - fact)
        return F.struct(fact.alias("log_fact"), below.alias("below"), F.concat(s["cdf"], F.array(below)).alias("cdf"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), last), state, step, lambda s: s["cdf"]))


def source_rates(docs: DataFrame, targets: DataFrame | None = None, power: float = 0.5,
                 total: float | None = None, source_col: str = "source") -> DataFrame:
    """(source, n, rate, cdf): one row per source. ``targets`` (source, weight) gives target weights
    (a source without one gets weight 0 and so no copies); without it a source's weight is its row count
    to the power ``power``. Rates make the expected output ``total`` rows (default: as many as come in)."""
    n = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if targets is None:
        n = n.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        t = targets.select(F.col("source").alias("t_source"), F.col("weight").cast("double").alias("weight"))
        n = n.join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_source") \
            .withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    n = cut(n, "sources")
    w, rows = n.agg(F.sum("weight"), F.sum("n")).first()  # two numbers
    rate = F.lit(float(total if total is not None else rows or 0)) * F.col("weight") / F.lit(float(w or 1)) / F.col("n")
    return n.select("source", "n", rate.alias("rate"), poisson_cdf(rate).alias("cdf"))


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, power: float = 0.5, total: float | None = None,
                seed: int = 17, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Repeat each document k times, k from Poisson(rate of its source) by inverting the distribution at
    a hash of (seed, id); shuffle all copies globally.

    Returns the columns of ``docs`` plus ``mix_copy`` (1..k), ``mix_copies`` (k) and ``mix_key`` (the place
    in the global order; rows are dealt by its hash and sorted by it within each partition). Columns of these
    names in ``docs`` are replaced.
    Null sources form one source; rows with equal ids get equal counts; an empty table gives an empty
    table; texts are not looked at. A hot source costs nothing extra: rates are joined from a table of one
    row per source (broadcast when its measured bytes are few, else a shuffle join) and copies are dealt by their own keys."""
    keep = quoted(docs.drop("mix_copy", "mix_copies", "mix_key"))
    rates = cut(source_rates(docs, targets, power, total, source_col), "rates")
    size = rates.agg(F.sum(64 + 8 * F.size(F.coalesce("cdf", F.array())) + F.coalesce(F.octet_length("source"), F.lit(0)))).first()[0] or 0
    rates = rates.select(F.col("source").cast("string").alias("r_source"), "cdf")
    base = docs.select(F.struct(*keep).alias("row"))
    src, rid = F.col(f"row.{source_col}"), F.col(f"row.{id_col}")
    side = F.broadcast(rates) if size <= BROADCAST_BYTES else rates
    j = base.join(side, src.cast("string").eqNullSafe(F.col("r_source")), "left")
    u = hash_uniform(F.lit(seed), rid)
    counted = j.select("row", F.coalesce(F.size(F.filter("cdf", lambda c: c < u)), F.lit(0)).alias("mix_copies"))
    copies = (counted.filter("mix_copies > 0")
              .select("row", "mix_copies", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("mix_copy")))
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(f"row.{id_col}").cast("string"), F.lit("")),
                                               F.col("mix_copy").cast("string"))), 1, 15), 16, 10).cast("bigint")
    out = copies.select("row.*", "mix_copy", "mix_copies", key.alias("mix_key"))
    return out.repartition(F.col("mix_key")).sortWithinPartitions("mix_key")


ORACLE = """
with n as (select source, count(*) n, pow(count(*)::double, 0.5) weight from documents group by source),
s as (select sum(weight) w, sum(n) "rows" from n),
r as (select source, "rows" * weight / w / n rate from n, s),
k as (select source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::bigint + 1)) k from r),
c as (select source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) cdf from k),
cl as (select source, list(cdf order by k) cdf from c group by source),
d as (select d.*, (('0x' || substr(md5(concat_ws('|', '17', coalesce(doc_id::varchar, ''))), 1, 13))::bigint + 0.5)
        / 4503599627370496.0 u from documents d),
m as (select d.doc_id, d.text, d.lang, d.source, d.n_chars, len(list_filter(cl.cdf, lambda x: x < d.u))::integer mix_copies
      from d join cl on d.source is not distinct from cl.source),
e as (select *, unnest(range(1, mix_copies + 1))::integer mix_copy from m)
select doc_id, text, lang, source, n_chars, mix_copy, mix_copies,
       ('0x' || substr(md5(concat_ws('|', '17', coalesce(doc_id::varchar, ''), mix_copy::varchar)), 1, 15))::bigint mix_key
from e
"""
