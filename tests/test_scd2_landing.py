"""SCD2 runs, landing boundaries, upsert idempotence, DQ NULL rules (literal rows)."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures_small import ts

from coursemart.operators import dq, scd2
from coursemart.session import scratch_path
from coursemart.sources import landing

COLS = "program_id string, program_name string, department string, degree_level string, " \
       "total_credit_points_required int, _loaded_at timestamp_ntz"


def _cur(spark, rows, run):
    return spark.createDataFrame([r + (ts(run),) for r in rows], COLS)


def _snap(spark, rows, prev, run):
    out = scd2.scd2_snapshot(_cur(spark, rows, run), prev, "program_id", scd2.PROGRAM_CHECK_COLS, run)
    return spark.createDataFrame(out.collect(), out.schema)  # pin the version (no lineage to later inputs)


def test_scd2_runs(spark):
    r1, r2, r3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
    v1 = _snap(spark, [("A", "a", "D1", "Bachelor's", 144), ("B", "b", "D2", "Master's", 96),
                       ("C", "c", None, "Doctoral", 72), ("E", "e", "D5", "Doctoral", 72)], None, r1)
    # B changes department; C goes NULL → value; E disappears (stays open); N is new; A unchanged
    v2 = _snap(spark, [("A", "a", "D1", "Bachelor's", 144), ("B", "b", "D9", "Master's", 96),
                       ("C", "c", "D3", "Doctoral", 72), ("N", "n", "D4", "Bachelor's", 144)], v1, r2)
    # B back to D2 (A→B→A makes three versions); replay of an unchanged source is a no-op
    v3 = _snap(spark, [("A", "a", "D1", "Bachelor's", 144), ("B", "b", "D2", "Master's", 96),
                       ("C", "c", "D3", "Doctoral", 72), ("N", "n", "D4", "Bachelor's", 144)], v2, r3)
    v3b = _snap(spark, [("A", "a", "D1", "Bachelor's", 144), ("B", "b", "D2", "Master's", 96),
                        ("C", "c", "D3", "Doctoral", 72), ("N", "n", "D4", "Bachelor's", 144)], v3, r3)
    got = sorted((r.program_id, str(r.department), str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in v3b.collect())
    assert got == sorted((a, str(b), c, e) for a, b, c, e in [
        ("A", "D1", r1, "None"),
        ("B", "D2", r1, r2), ("B", "D9", r2, r3), ("B", "D2", r3, "None"),
        ("C", None, r1, r2), ("C", "D3", r2, "None"),
        ("E", "D5", r1, "None"),
        ("N", "D4", r2, "None"),
    ])
    assert v3b.select("dbt_scd_id").distinct().count() == v3b.count()


EV = "event_id long, ts timestamp_ntz, v string"


def test_lookback_boundary(spark):
    target = scratch_path(spark, "t_lookback")
    landed = spark.createDataFrame([(1, ts("2024-01-01 11:00:00"), "x"), (3, ts("2024-01-01 12:00:00"), "x")], EV)
    landing.land_full(spark, landed, target, "2024-01-01 12:30:00")
    src = spark.createDataFrame([
        (1, ts("2024-01-01 11:00:00"), "x"),
        (2, ts("2024-01-01 11:50:00"), "late, at the bound"),        # ts = wm - 10 min: strict > drops it
        (4, ts("2024-01-01 11:50:01"), "late, inside the lookback"),
        (3, ts("2024-01-01 12:00:00"), "x"),                         # already landed with equal (pk, cursor)
        (5, ts("2024-01-01 12:05:00"), "new")], EV)
    res = landing.land_incremental(spark, src, target, "ts", "event_id", "2024-01-01 13:00:00")
    assert res.mode == "incremental" and res.rows == 2
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == [1, 3, 4, 5]


def test_empty_source_and_empty_target(spark):
    target = scratch_path(spark, "t_empty")
    three = spark.createDataFrame([(i, ts("2024-01-01 00:00:00"), "x") for i in range(3)], EV)
    landing.land_full(spark, three, target, "2024-01-01 01:00:00")
    assert landing.land_full(spark, three.limit(0), target, "2024-01-02 00:00:00").mode == "skipped"
    assert spark.read.parquet(target).count() == 3
    # an existing but empty target has no watermark: the next run is a full load
    empty = scratch_path(spark, "t_empty2")
    landing.land_full(spark, three.limit(0), empty, "2024-01-01 00:00:00")
    res = landing.land_incremental(spark, three, empty, "ts", "event_id", "2024-01-02 00:00:00")
    assert res.mode == "full" and spark.read.parquet(empty).count() == 3



def test_dq_null_rules(spark):
    df = spark.createDataFrame([(1, None, None), (2, "Active", 50.0), (2, "Bogus", 150.0), (None, None, None)],
                               "id long, status string, mark double")
    assert dq.dq_unique(df, "id").count() == 1                      # the two 2s; NULL ignored
    assert dq.dq_accepted_values(df, "status", ["Active"]).count() == 1  # NULL passes
    assert dq.dq_accepted_range(df, "mark", 0, 100).count() == 1    # NULL passes
    assert dq.dq_not_null(df, "id").count() == 1
    assert dq.dq_unique_combination(df, ["status", "mark"]).count() == 1  # (NULL, NULL) twice
    parent = spark.createDataFrame([(1,)], "id long")
    assert dq.dq_relationships(df, "id", parent, "id").count() == 2  # the two 2s; NULL child passes


def test_suite_declares_100_checks():
    assert len(dq.STAGING_CHECKS) == 48 and len(dq.WAREHOUSE_CHECKS) == 50 and len(dq.ALL_CHECKS) == 100



def test_landed_rows_are_observed_exactly(spark):
    target = scratch_path(spark, "t_metrics")
    first = spark.createDataFrame([(i, ts("2024-01-01 00:00:00"), "x") for i in range(50)], EV)
    r1 = landing.land_incremental(spark, first, target, "ts", "event_id", "2024-01-01 01:00:00")
    more = first.unionByName(spark.createDataFrame([(i, ts("2024-01-01 00:30:00"), "y") for i in range(50, 80)], EV))
    r2 = landing.land_incremental(spark, more, target, "ts", "event_id", "2024-01-01 02:00:00")
    assert (r1.mode, r1.rows, r2.mode, r2.rows) == ("full", 50, "incremental", 30)




def _dict(df):
    return dict(sorted(tuple(r) for r in df.collect()))






def test_landing_raises_on_schema_drift(spark):
    import pytest
    from coursemart.sources import staging
    target = scratch_path(spark, "t_land_drift")
    rows = spark.createDataFrame([(1, ts("2024-01-01 00:00:00"), "x")], EV)
    landing.land_incremental(spark, rows, target, "ts", "event_id", "2024-01-01 01:00:00")
    for bad in (rows.withColumn("extra", F.lit(1)), rows.drop("v"), rows.withColumn("v", F.lit(1))):
        with pytest.raises(staging.SchemaDrift):
            landing.land_incremental(spark, bad, target, "ts", "event_id", "2024-01-01 02:00:00")
    raw = spark.createDataFrame([("S1", ts("2024-01-01 00:00:00"))], "subject_code string, _ingested_at timestamp_ntz")
    with pytest.raises(staging.SchemaDrift):
        staging.staged(raw, "subjects")


def test_watermark_is_noted_beside_the_data(spark):
    target = scratch_path(spark, "t_note")
    rows = spark.createDataFrame([(i, ts(f"2024-01-01 0{i}:00:00"), "x") for i in range(5)], EV)
    landing.land_incremental(spark, rows, target, "ts", "event_id", "2024-01-02 00:00:00")
    assert landing.watermark(spark, target, "ts") == dt.datetime(2024, 1, 1, 4)
    assert spark.read.parquet(target).count() == 5                     # the note is not data



def test_jdbc_options():
    import pytest
    from coursemart.sources import jdbc
    with pytest.raises(ValueError):
        jdbc.scan_options("students")
    o = jdbc.scan_options("t", jdbc.cursor_bound("updated_at", "2024-01-01 00:00:00", 10), "id", 1, 100, 8)
    assert o["dbtable"] == "(select * from t where updated_at > timestamp '2024-01-01 00:00:00' - interval '10' minute) as bounded"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "1", "100", "8")
    assert jdbc.cursor_bound("c", None, 10) is None and jdbc.scan_options("t", single_connection=True) == {"dbtable": "t"}
    p = jdbc.key_predicates("student_id", 16)
    assert len(p) == 17 and sum(f"'{i:02d}'" in x for x in p[:-1] for i in range(100)) == 100


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    import pytest
    from coursemart import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.work_root(Session())


def test_derived_marks_keep_rows_without_marks(spark):
    from coursemart.operators import derive
    r = spark.createDataFrame([(1, 10, None), (1, 11, None), (2, 10, 30.0), (2, 11, None)], "subject_enrollment_id int, assessment_id int, raw_score double")
    a = spark.createDataFrame([(10, 50.0, 60.0), (11, 50.0, 60.0)], "assessment_id int, weight_percentage double, max_score double")
    e = spark.createDataFrame([(1,), (2,), (3,)], "subject_enrollment_id int")
    assert _dict(derive.weighted_final_mark(r, a, e)) == {1: None, 2: 50.0, 3: None}
    s = spark.createDataFrame([(1, "Completed", 90.0), (2, "Enrolled", None), (2, "Dropped", 80.0)], "program_enrollment_id int, status string, final_mark double")
    p = spark.createDataFrame([(1,), (2,), (3,)], "program_enrollment_id int")
    got = {x["program_enrollment_id"]: (x["completed_subjects"], x["final_degree_result"]) for x in derive.final_degree_result(s, p).collect()}
    assert got == {1: (1, "High Distinction"), 2: (0, None), 3: (0, None)}
