"""Skew-safe ordered windows equal the plain window for every row."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from coursemart.operators import windows


def _data(spark):
    # group NULL holds most rows; group 1 is mid-sized; groups 2.. are tiny; order ties on t
    return spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit(None)).otherwise(F.col("id") % 10 - 6).cast("bigint").alias("g"),
        (F.col("id") % 37).alias("t"),
        F.col("id").alias("uid"),
        (F.col("id") * 7 % 101).cast("double").alias("v"))


def test_row_number_and_lag_hot_path(spark, monkeypatch):
    monkeypatch.setattr(windows, "HOT_PARTITION_ROWS", 300)
    df = _data(spark)
    order = [F.col("t").asc_nulls_last(), F.col("uid").asc()]
    w = Window.partitionBy("g").orderBy(*order)
    want = {r.uid: (r.rn, r.prev) for r in df.select("uid", F.row_number().over(w).alias("rn"),
                                                     F.lag("v").over(w).alias("prev")).collect()}
    rn = windows.row_number(df, ["g"], order, "rn", threshold=400, fraction=1.0)
    lg = windows.lag(df, ["g"], order, "v", "prev", threshold=400, fraction=1.0)
    got_rn = {r.uid: r.rn for r in rn.collect()}
    got_lag = {r.uid: r.prev for r in lg.collect()}
    assert len(got_rn) == len(want) == len(got_lag)
    assert got_rn == {k: v[0] for k, v in want.items()}
    assert got_lag == {k: v[1] for k, v in want.items()}


def test_no_hot_group_keeps_plain_window(spark):
    df = _data(spark)
    out = windows.row_number(df, ["g"], [F.col("uid").asc()], "rn")   # default threshold: nothing hot
    assert out.count() == 5000 and out.filter(F.col("g").isNull() & (F.col("rn") == 1)).count() == 1


def test_hot_group_found_through_narrow_detection_input(spark, monkeypatch):
    monkeypatch.setattr(windows, "HOT_PARTITION_ROWS", 300)
    df = _data(spark)
    order = [F.col("t").asc_nulls_last(), F.col("uid").asc()]
    cold, hot, n_hot, _ = windows.split_hot(df, ["g"], threshold=400, fraction=0.5, detect_on=df.select("g"))
    assert n_hot >= 1 and hot.filter(F.col("g").isNull()).count() == 3500
    w = Window.partitionBy("g").orderBy(*order)
    want = {r.uid: r.rn for r in df.select("uid", F.row_number().over(w).alias("rn")).collect()}
    got = windows.row_number(df, ["g"], order, "rn", threshold=400, fraction=0.5, detect_on=df.select("g"))
    assert {r.uid: r.rn for r in got.collect()} == want
