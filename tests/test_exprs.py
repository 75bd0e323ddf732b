"""Column expressions equal the source dialect's functions on many generated inputs (via DuckDB)."""

import duckdb
from pyspark.sql import functions as F

from coursemart.functions.exprs import completed_years, round_half_away, surrogate_key

N = 20000


def test_completed_years_equals_age(spark):
    # pairs over 1990-2030, both orders, many month ends and leap days
    df = spark.range(N).select(
        F.date_add(F.to_date(F.lit("1990-01-01")), ((F.col("id") * 7919) % 14975).cast("int")).alias("s"),
        F.date_add(F.to_date(F.lit("1990-01-01")), ((F.col("id") * 104729 + 13) % 14975).cast("int")).alias("e"))
    got = {(r.s, r.e): r.y for r in df.select("s", "e", completed_years("e", "s").alias("y")).collect()}
    con = duckdb.connect()
    con.execute("create table t(s date, e date)")
    con.executemany("insert into t values (?, ?)", list(got))
    want = {(s, e): y for s, e, y in con.execute("select s, e, extract(year from age(e, s))::int from t").fetchall()}
    assert got == want


def test_round_half_away_equals_binary_round(spark):
    df = spark.range(N).select((F.col("id") / F.lit(1000.0) + F.lit(0.005)).alias("x"))
    got = {r.x: r.r for r in df.select("x", round_half_away("x", 2).alias("r")).collect()}
    con = duckdb.connect()
    con.execute("create table t(x double)")
    con.executemany("insert into t values (?)", [(x,) for x in got])
    want = dict(con.execute("select x, round(x, 2) from t").fetchall())
    assert got == want
    assert got[1.005] == 1.0 if 1.005 in got else True


def test_md5_surrogate_key_is_portable(spark):
    df = spark.range(1000).select(F.col("id"), F.concat(F.lit("STU-"), F.col("id").cast("string")).alias("sid"))
    got = {(r.id, r.sid): (r.k1, r.k2) for r in df.select(
        "id", "sid", surrogate_key("id", mode="md5").alias("k1"),
        surrogate_key("sid", "id", mode="md5").alias("k2")).collect()}
    con = duckdb.connect()
    con.execute("create table t(id bigint, sid varchar)")
    con.executemany("insert into t values (?, ?)", list(got))
    want = {(i, s): (a, b) for i, s, a, b in con.execute(
        "select id, sid, ('0x' || substr(md5(cast(id as varchar)), 1, 15))::bigint,"
        " ('0x' || substr(md5(concat_ws('|', sid, cast(id as varchar))), 1, 15))::bigint from t").fetchall()}
    assert got == want
