"""Named tables: upserts into buckets, rebuilt tables with pinned readers, co-partitioned joins, streams into them."""

import contextlib
import datetime as dt
import io
import random
import uuid

import pytest
from pyspark.sql import functions as F

from coursemart.functions.exprs import ts_lit
from coursemart.operators import facts, obt
from coursemart.operators.joins import Lookup
from coursemart.params import Params
from coursemart.plans import dashboards
from coursemart.session import list_folder, scratch_path
from coursemart.sources.lake import Lake, database
from coursemart.sources.staging import SchemaDrift
from coursemart.streaming import stream

EV = "event_id long, ts timestamp_ntz, v string"


def ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def lake(spark):
    return Lake(spark, scratch_path(spark, "t_lake"), prefix=f"t{uuid.uuid4().hex[:8]}_", buckets=4)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def tree(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pairs(spark, rows, cols="k long, v string"):
    return spark.createDataFrame(list(rows.items()) if isinstance(rows, dict) else rows, cols)


def held(df):
    return dict(sorted(tuple(r) for r in df.collect()))


# ------------------------------------------------------------------ delete + insert

def test_upsert_twice_equals_once(spark, lake):
    lake.upsert_delete_insert(pairs(spark, {i: f"v{i}" for i in range(10)}), "warehouse", "t", "k")
    batch = pairs(spark, {3: "new3", 12: "new12"})
    once = held(lake.upsert_delete_insert(batch, "warehouse", "t", "k"))
    assert once == held(lake.upsert_delete_insert(batch, "warehouse", "t", "k"))
    assert once[3] == "new3" and once[12] == "new12" and len(once) == 11


def test_many_upserts_equal_a_dictionary(spark, lake):
    rng, want = random.Random(5), {f"k{i}": "a" for i in range(300)}                       # string keys
    lake.upsert_delete_insert(pairs(spark, want, "k string, v string"), "warehouse", "t", "k")
    for n in range(4):
        batch = {f"k{rng.randrange(400)}": f"v{n}" for _ in range(rng.choice([1, 5, 60]))}
        want |= batch
        out = lake.upsert_delete_insert(pairs(spark, batch, "k string, v string"), "warehouse", "t", "k")
        assert held(out) == want and out.columns == ["k", "v"]
    assert held(lake.upsert_delete_insert(pairs(spark, {}, "k string, v string"), "warehouse", "t", "k")) == want   # an empty batch


def test_only_touched_buckets_are_read_and_written(spark, lake, monkeypatch):
    lake.upsert_delete_insert(pairs(spark, {i: "a" for i in range(200)}), "warehouse", "t", "k")
    folder = lake.folder("warehouse", "t")
    files = {b: set(_files(spark, f"{folder}/{b}")) for b in list_folder(spark, folder) if b.startswith("_bucket")}
    seen = []
    write = Lake._write
    monkeypatch.setattr(Lake, "_write", lambda self, rows, name, touched: (seen.append(plan(rows)), write(self, rows, name, touched))[1])
    lake.upsert_delete_insert(pairs(spark, {7: "b"}), "warehouse", "t", "k")
    mine = spark.range(7, 8).select(F.pmod(F.hash("id"), F.lit(4))).first()[0]
    filters = [x for x in seen[0].splitlines() if x.startswith("PartitionFilters")]
    assert any("_bucket" in x and str(mine) in x for x in filters), seen[0]
    now = {b: set(_files(spark, f"{folder}/{b}")) for b in files}
    assert [b for b in files if files[b] != now[b]] == [f"_bucket={mine}"]


def _files(spark, folder):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]


def test_rows_that_change_their_bucket_leave_the_old_one(spark, lake):
    cols = "k long, parent string, v string"
    lake.upsert_delete_insert(pairs(spark, [(1, None, "a"), (2, "p", "a"), (3, "q", "a")], cols), "warehouse", "t", "k", by="parent")
    out = lake.upsert_delete_insert(pairs(spark, [(1, "p", "b"), (3, "r", "b")], cols), "warehouse", "t", "k", stays=False)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "p", "b"), (2, "p", "a"), (3, "r", "b")]
    assert sorted(tuple(r) for r in lake.table("warehouse", "t").collect()) == [(1, "p", "b"), (2, "p", "a"), (3, "r", "b")]


def test_null_keys_are_never_replaced(spark, lake):
    lake.upsert_delete_insert(pairs(spark, [(None, "a"), (1, "a")]), "warehouse", "t", "k")
    for _ in range(2):
        out = lake.upsert_delete_insert(pairs(spark, [(None, "b"), (1, "b"), (1, "c")]), "warehouse", "t", "k")
    assert sorted((str(r.k), r.v) for r in out.collect()) == [("1", "b"), ("1", "c"), ("None", "a"), ("None", "b"), ("None", "b")]


def test_full_refresh_replaces_everything_and_readers_keep_their_folder(spark, lake):
    lake.upsert_delete_insert(pairs(spark, {i: "a" for i in range(20)}), "warehouse", "t", "k")
    old = lake.folder("warehouse", "t")
    out = lake.upsert_delete_insert(pairs(spark, {1: "b"}), "warehouse", "t", "k", full_refresh=True)
    assert held(out) == {1: "b"} and held(lake.table("warehouse", "t")) == {1: "b"}
    assert spark.read.parquet(old).count() == 20


def test_schema_drift_fails_an_upsert(spark, lake):
    lake.upsert_delete_insert(pairs(spark, {1: "a"}), "warehouse", "t", "k")
    with pytest.raises(SchemaDrift):
        lake.upsert_delete_insert(pairs(spark, [(1, "a", 2)], "k long, v string, extra int"), "warehouse", "t", "k")


def test_a_load_is_noted_after_its_rows(spark, lake, monkeypatch):
    rows = pairs(spark, {1: "a"}).withColumn("_loaded_at", ts_lit("2024-01-01 00:00:00"))
    assert lake.loaded_at("warehouse", "t") is None
    lake.upsert_delete_insert(rows, "warehouse", "t", "k")
    assert lake.loaded_at("warehouse", "t") == "2024-01-01 00:00:00"
    later = rows.withColumn("_loaded_at", ts_lit("2024-01-02 03:04:05.678"))

    def die(*a):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(lake, "_note", die)
        with pytest.raises(RuntimeError):
            lake.upsert_delete_insert(later, "warehouse", "t", "k")
    assert lake.loaded_at("warehouse", "t") == "2024-01-01 00:00:00"                        # so the next run loads it again
    lake.upsert_delete_insert(later, "warehouse", "t", "k")
    assert lake.loaded_at("warehouse", "t") == "2024-01-02 03:04:05.678" and lake.table("warehouse", "t").count() == 1


# ------------------------------------------------------------------ names, versions, catalogs

def test_rebuilt_tables_have_names_and_running_readers_their_version(spark, lake):
    lake.rebuild(pairs(spark, {1: "a"}), "obt", "t")
    opened = lake.table("obt", "t")
    # what a run that died left behind: a folder without its marker
    pairs(spark, {9: "x"}).write.parquet(f"{lake.root}/obt/t/v000002/_temporary/0")
    assert held(lake.table("obt", "t")) == {1: "a"}
    out = lake.rebuild(pairs(spark, {2: "b", 3: "c"}), "obt", "t")
    assert out._materialized_rows == 2 and held(spark.table(lake.name("obt", "t"))) == {2: "b", 3: "c"}
    assert held(opened) == {1: "a"}
    assert database("obt") == "obt" and database("obt", "x_") == "x_obt"
    with pytest.raises(ValueError):
        database("gold")


def test_two_lakes_cannot_share_a_database(spark, lake):
    with pytest.raises(ValueError):
        Lake(spark, scratch_path(spark, "t_other"), prefix=lake.prefix)


def test_a_new_catalog_finds_the_tables_again(spark, lake):
    lake.rebuild(pairs(spark, {1: "a"}), "obt", "whole")
    lake.rebuild(pairs(spark, [(1, "x"), (2, "y")]), "obt", "parted", ["v"])
    lake.upsert_delete_insert(pairs(spark, {i: "a" for i in range(50)}), "warehouse", "fact", "k")
    for layer, table in (("obt", "whole"), ("obt", "parted"), ("warehouse", "fact")):
        spark.sql(f"DROP TABLE {lake.name(layer, table)}")
    assert len(lake.attach()) == 3 and lake.attach() == []
    assert held(lake.table("obt", "whole")) == {1: "a"} and lake.table("obt", "parted").count() == 2
    assert "Exchange" not in tree(lake.table("warehouse", "fact").groupBy("k").count())
    out = lake.upsert_delete_insert(pairs(spark, {3: "b"}), "warehouse", "fact", "k")
    assert held(out)[3] == "b" and out.count() == 50


def test_column_statistics_are_kept_by_name(spark, lake):
    lake.rebuild(pairs(spark, {i: "a" for i in range(30)}), "warehouse", "d")
    lake.analyze("warehouse", "d", ["k"])
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {lake.name('warehouse', 'd')}").collect()}
    assert "30 rows" in info["Statistics"]
    assert {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {lake.name('warehouse', 'd')} k").collect()}["distinct_count"] == "30"


# ------------------------------------------------------------------ co-partitioned facts

def _no_broadcast(spark):
    @contextlib.contextmanager
    def off():
        confs = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
        old = {c: spark.conf.get(c, None) for c in confs}
        for c in confs:
            spark.conf.set(c, "-1")
        try:
            yield
        finally:
            for c, v in old.items():
                spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    return off()


def _exchanged(plan_text: str, fact: str) -> bool:
    """True if an Exchange lies between the fact's scan and the join above it."""
    lines = plan_text.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line and fact in line:
            depth = line.index("FileScan")
            for up in reversed(lines[:i]):
                at = len(up) - len(up.lstrip(" :+-*()0123456789"))
                if at < depth:
                    depth = at
                    if "Exchange" in up:
                        return True
                    if "Join" in up:
                        break
    return False


def test_facts_are_joined_where_they_lie(spark, lake):
    p = Params()
    ids = spark.range(400)
    se = ids.select(F.concat(F.lit("se"), "id").alias("subject_enrollment_id"), F.lit("m").alias("final_mark")).withColumn(
        "subject_enrollment_key", F.xxhash64("subject_enrollment_id")).withColumns({c: F.lit(1) for c in ("subject_key", "student_key", "program_key")})
    lake.upsert_delete_insert(se, "warehouse", "f2", "subject_enrollment_id", by="subject_enrollment_key")
    ar = spark.range(3000).select(F.col("id").alias("result_id"), F.xxhash64(F.concat(F.lit("se"), F.col("id") % 500)).alias("subject_enrollment_key"))
    lake.upsert_delete_insert(ar, "warehouse", "f3", "result_id", by="subject_enrollment_key", stays=False)
    f2, f3 = lake.table("warehouse", "f2"), lake.table("warehouse", "f3")
    journal = spark.range(50).select(F.col("id").alias("result_id"), F.concat(F.lit("se"), "id").alias("subject_enrollment_id")).repartition(3)
    with _no_broadcast(spark):
        wide = f3.join(f2.select("subject_enrollment_key", "final_mark"), "subject_enrollment_key", "left")
        assert not _exchanged(tree(wide), "f2") and not _exchanged(tree(wide), "f3"), tree(wide)
        assert wide.count() == 3000 and wide.filter("final_mark is null").count() == 600
        built = facts.parent_lookup(journal, f2.select("subject_enrollment_id", "subject_enrollment_key", "subject_key"), "subject_enrollment_id",
                                    "subject_enrollment_key", p)
        assert not _exchanged(tree(built), "f2"), tree(built)
        assert built.filter("subject_enrollment_key is not null").count() == 50
        last = obt.last_activity(f2.withColumn("program_enrollment_key", F.lit(1)), f3.withColumn("submitted_at", ts_lit("2024-01-01 00:00:00")))
        assert tree(last).count("Exchange") == 1 and last.count() == 1, tree(last)          # only the programme's own grouping


def test_dashboards_prune_by_status(spark, lake):
    from coursemart.params import ORACLE_PARAMS
    from coursemart.plans.warehouse import Warehouse
    w = Warehouse.from_driver(spark, "/root/testdata/sf0.001", ORACLE_PARAMS)
    ope = w.obt_program_enrollment()
    named = lake.rebuild(ope, "obt", "obt_program_enrollment", ["status"])
    for name in ("dash_active_summary", "dash_graduation_trend", "dash_by_department", "dash_by_level", "dash_by_grad_month"):
        got = getattr(dashboards, name)(named)
        filters = [x for x in plan(got).splitlines() if x.startswith("PartitionFilters")]
        assert filters and all("status" in x for x in filters), plan(got)
        assert sorted(map(str, got.collect())) == sorted(map(str, getattr(dashboards, name)(ope).collect()))
    assert Lookup(ORACLE_PARAMS).fits(named)


# ------------------------------------------------------------------ streams

def _drop(spark, folder, rows):
    spark.createDataFrame(rows, EV).coalesce(1).write.parquet(folder)


def test_stream_takes_a_row_once_and_none_behind_the_watermark(spark):
    base = scratch_path(spark, "t_stream")
    _drop(spark, f"{base}/src/d0", [(i, ts(f"2024-01-01 01:{i:02d}:00"), "x") for i in range(60)])
    run = [spark, f"{base}/src/*", spark.read.parquet(f"{base}/src/d0").schema, f"{base}/out", f"{base}/ckpt", "ts", "event_id"]
    stream.land_stream(*run, "2024-01-02 00:00:00")
    # again within the lookback, new ones, one late within the bound, one beyond it
    _drop(spark, f"{base}/src/d1", [(i, ts(f"2024-01-01 01:{i:02d}:00"), "x") for i in range(52, 60)]
          + [(i, ts(f"2024-01-01 02:{i - 60:02d}:00"), "x") for i in range(60, 90)]
          + [(500, ts("2024-01-01 01:55:30"), "late"), (501, ts("2024-01-01 01:20:30"), "too late")])
    stream.land_stream(*run, "2024-01-03 00:00:00")
    got = spark.read.parquet(f"{base}/out")
    assert sorted(r.event_id for r in got.collect()) == [*range(90), 500]
    stream.land_stream(*run, "2024-01-04 00:00:00")                                         # nothing new
    assert spark.read.parquet(f"{base}/out").count() == 91
    assert got.columns == ["event_id", "ts", "v", "_ingested_at"]


def test_in_order_drops_land_alike_whatever_the_batches(spark):
    base = scratch_path(spark, "t_stream_batches")
    for k, hour in enumerate([1, 3, 5, 8]):
        _drop(spark, f"{base}/src/d{k}", [(100 * hour + i, ts(f"2024-01-01 0{hour}:{i // 2:02d}:00"), "x") for i in range(100)])
    schema = spark.read.parquet(f"{base}/src/d0").schema
    for n in (None, 1):
        stream.land_stream(spark, f"{base}/src/*", schema, f"{base}/out{n}", f"{base}/ckpt{n}", "ts", "event_id", "2024-01-02 00:00:00",
                           max_files_per_trigger=n)
        got = spark.read.parquet(f"{base}/out{n}")
        assert got.count() == 400 == got.select("event_id").distinct().count()


LATEST = "k long, v string, _ingested_at timestamp_ntz"


def test_latest_keeps_newer_rows_and_an_epoch_counts_once(spark, lake):
    new = pairs(spark, [(1, "new", ts("2024-01-02 00:00:00")), (2, "b", ts("2024-01-02 00:00:00")), (None, "n", None)], LATEST)
    old = pairs(spark, [(1, "old", ts("2024-01-01 00:00:00"))], LATEST)
    lake.upsert_latest(new, "warehouse", "t", "k", epoch="s-0")
    lake.upsert_latest(old, "warehouse", "t", "k", epoch="s-1")                             # an older version comes late
    files = _files(spark, f"{lake.folder('warehouse', 't')}/_bucket={_bucket(spark, 1)}")
    for epoch in ("s-0", "s-1"):                                                            # delivered again
        lake.upsert_latest(new, "warehouse", "t", "k", epoch=epoch)
    assert sorted((str(r.k), r.v) for r in lake.table("warehouse", "t").collect()) == [("1", "new"), ("2", "b"), ("None", "n")]
    assert files == _files(spark, f"{lake.folder('warehouse', 't')}/_bucket={_bucket(spark, 1)}")
    with pytest.raises(ValueError):
        lake.upsert_latest(pairs(spark, {1: "a"}), "warehouse", "t", "k")


def _bucket(spark, k):
    return spark.createDataFrame([(k,)], "k long").select(F.pmod(F.hash("k"), F.lit(4))).first()[0]


def test_upsert_stream_restarted_and_replayed(spark, lake):
    base = scratch_path(spark, "t_stream_upsert")
    pairs(spark, [(1, "a", ts("2024-01-01 00:00:00")), (2, "a", ts("2024-01-01 00:00:00"))], LATEST).coalesce(1).write.parquet(f"{base}/src/d0")
    schema = spark.read.parquet(f"{base}/src/d0").schema
    run = [spark, f"{base}/src/*", schema, lake, "warehouse", "t"]
    stream.upsert_stream(*run, f"{base}/ckpt", "k")
    pairs(spark, [(2, "b", ts("2024-01-02 00:00:00")), (3, "b", ts("2024-01-02 00:00:00"))], LATEST).coalesce(1).write.parquet(f"{base}/src/d1")
    stream.upsert_stream(*run, f"{base}/ckpt", "k")
    want = [(1, "a"), (2, "b"), (3, "b")]
    assert sorted((r.k, r.v) for r in lake.table("warehouse", "t").collect()) == want
    stream.upsert_stream(*run, f"{base}/ckpt2", "k", 1)                                     # all once more, by another stream
    assert sorted((r.k, r.v) for r in lake.table("warehouse", "t").collect()) == want
    assert len(list_folder(spark, f"{lake.folder('warehouse', 't')}/_epochs")) >= 3
