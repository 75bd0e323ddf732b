"""What the warehouse writes once for the models that share it: the same rows, and none of the work twice."""

import contextlib
import io
from decimal import Decimal as D

from pyspark.sql import functions as F

from fixtures_small import SF_SMALL, base_rows, d, make_staged, ts

from coursemart.operators import dq, facts, obt
from coursemart.operators.joins import Lookup
from coursemart.params import ORACLE_PARAMS
from coursemart.plans.warehouse import Warehouse
from coursemart.sources.binding import landed_tables, raw_tables


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_kept_binding_gives_the_same_rows_without_joining_the_lines_again(spark):
    lazy, kept = landed_tables(spark, SF_SMALL, ORACLE_PARAMS), landed_tables(spark, SF_SMALL, ORACLE_PARAMS, keep=True)
    assert list(lazy) == list(kept)
    for name in lazy:
        same(lazy[name], kept[name])
    p = plan(kept["assessment_results"])
    assert "l_orderkey" not in p and "o_custkey" not in p  # the written lines, not lineitem and orders
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_tables_are_built_when_asked_for(spark):
    t = raw_tables(spark, SF_SMALL, keep=True)
    assert "line" not in t._built and len(t) == len(list(t))
    t["programs"].count()
    assert "line" not in t._built


def test_wide_tables_read_the_written_facts(spark):
    w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS, keep=True)
    for df in (w.obt_subject_enrollment(), w.obt_assessment_result()):
        p = plan(df)
        assert "l_orderkey" not in p and "o_orderkey" not in p and "WindowGroupLimit" not in p


def test_students_looked_up_by_their_enrollments(spark):
    """A student table over the budget: the same wide rows as with one that is broadcast, also where students and
    program enrollments come twice or miss; the large inputs are not shuffled by student."""
    lk_small, lk_large = Lookup(ORACLE_PARAMS), Lookup(ORACLE_PARAMS.with_(broadcast_max_bytes=1))
    w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS)
    students = w.dim_student().filter(F.col("student_key") % 5 != 0)
    students = students.unionByName(students.filter(F.col("student_key") % 5 == 1))  # some come twice
    stg = w.stg
    some = stg["program_enrollments"].filter(F.col("program_enrollment_id") % 11 != 0)  # some have not arrived
    f_pe = facts.fact_program_enrollment(some, students, w.dim_program(), w.lk, w.p)
    f_se = facts.fact_subject_enrollment(stg["subject_enrollments"], f_pe, w.dim_subject_offering(), w.lk, w.p, bucketed=False)
    f_ar = facts.fact_assessment_result(stg["assessment_results"], f_se, w.dim_assessment(), w.lk, w.p, bucketed=False)
    dims = (w.dim_subject_offering(), w.dim_subject(), w.dim_semester())
    order = ["subject_enrollment_key", "student_id", "program_enrollment_key", "class_size", "rank_in_offering", "final_mark"]
    a = obt.obt_subject_enrollment(f_se, students, w.dim_program(), *dims, lk_small, w.p).select(order)
    b = obt.obt_subject_enrollment(f_se, students, w.dim_program(), *dims, lk_large, w.p, f_pe).select(order)
    same(a, b)
    cols = ["result_key", "student_id", "first_name", "last_name", "final_mark", "final_grade", "subject_code"]
    x = obt.result_enriched(f_ar, f_se, students, w.dim_assessment(), *dims, lk_small).select(*cols)
    y = obt.result_enriched(f_ar, f_se, students, w.dim_assessment(), *dims, lk_large, built_together=True).select(*cols)
    same(x, y)


def test_parent_by_id_alone_equals_the_one_by_key_and_id(spark):
    w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS)
    j = w.stg["subject_enrollments"].withColumn("program_enrollment_id", F.when(F.col("program_enrollment_id") % 7 != 0, F.col("program_enrollment_id")))
    args = (j, w.fact_program_enrollment(), w.dim_subject_offering(), w.lk, w.p)
    same(facts.fact_subject_enrollment(*args), facts.fact_subject_enrollment(*args, bucketed=False))


def test_scans_of_checked_models():
    n = dq.scans([dq.Check("fact_assessment_result", "result_key", "not_null"), dq.Check("fact_assessment_result", None, "singular", {"predicate": "score"}),
                  dq.Check("fact_subject_enrollment", "x", "unique"), dq.Check("fact_subject_enrollment", "y", "unique"),
                  dq.Check("a", "k", "relationships", {"to": "fact_subject_enrollment", "field": "k"})])
    assert n == {"fact_assessment_result": 1, "fact_subject_enrollment": 3, "a": 1}


def test_own_lake_has_buckets_for_its_rows(spark):
    from coursemart.plans import catalog
    assert catalog.own_lake(spark, "few", 10).buckets == 8
    assert catalog.own_lake(spark, "many", 200 * catalog.BUCKET_ROWS + 1).buckets == 201


def test_results_are_not_moved_again_for_their_parent_and_their_order(spark):
    """Latest versions, parents and orders of kept lines and results: read in buckets of the subject enrollment."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS, keep=True)
        latest = facts.dedup_latest(w.stg["subject_enrollments"], "subject_enrollment_id")
        wide = w.obt_assessment_result().select("result_id", "mark_trend_within_subject", "z_score_within_assessment")
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (latest, wide)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning(se_id" not in plans[0] and "Exchange hashpartitioning(subject_enrollment" not in plans[0]
    assert "md5" not in plans[1]  # no key that is not asked for
    moved = [ln for ln in plans[1].splitlines() if "Exchange hashpartitioning(subject_enrollment" in ln]
    assert len(moved) == 1, plans[1]  # the enrollments alone, to the results' buckets


def test_results_without_their_parent_are_followed_by_key(spark):
    """Some enrollments miss: their results are one group in the order of submission, kept or not."""
    def wide(keep):
        w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS, keep=keep)
        w.put("fact_subject_enrollment", w.fact_subject_enrollment().filter(F.col("subject_enrollment_id") % 3 != 0))
        exact = ["result_key", "result_id", "student_id", "final_mark", "score_percentage", "mark_trend_within_subject"]
        return w.obt_assessment_result().select(*exact)
    same(wide(True), wide(False))
    assert not wide(True).filter("final_mark is null").isEmpty()


def test_few_repeated_ids_are_settled_apart(spark):
    rows = [(i, i % 5, 1) for i in range(50)] + [(7, 3, 2), (7, 9, 3), (8, 1, 0), (None, 1, 1), (None, 2, 2)]
    j = spark.createDataFrame(rows, "id long, v long, _ingested_at long")
    want = facts.dedup_latest(j, "id")
    assert want.filter("id = 7").first()["v"] == 9 and want.filter("id is null").count() == 1
    few, many = Lookup(ORACLE_PARAMS), Lookup(ORACLE_PARAMS.with_(broadcast_max_bytes=1))
    same(facts.dedup_few(j, "id", few), want)
    same(facts.dedup_few(j, "id", many), want)
    once = j.filter("id > 8")
    p = plan(facts.dedup_few(once, "id", few))
    assert "Exchange" not in p and "Window" not in p
    same(facts.dedup_few(once, "id", few), once)


def test_relationships_count_values_before_they_move_them(spark):
    """Rows of a value are counted in their task: what is moved to a large parent is values, not rows; same report."""
    child = spark.createDataFrame([(i % 7, i % 3) for i in range(400)] + [(None, 1), (99, None)], "k long, s long").coalesce(1)
    parents = {"large": spark.range(5).withColumnRenamed("id", "k"), "small": spark.range(2).withColumnRenamed("id", "s"), "child": child}
    cs = [dq.Check("child", "k", "relationships", {"to": "large", "field": "k"}), dq.Check("child", "s", "relationships", {"to": "small", "field": "s"})]
    want = {("k", 400 - sum(i % 7 < 5 for i in range(400)) + 1), ("s", sum(i % 3 == 2 for i in range(400)))}
    for lk in (None, Lookup(ORACLE_PARAMS), Lookup(ORACLE_PARAMS.with_(broadcast_max_bytes=1))):
        rows = dq._relationship_checks(child, cs, parents.get, lk)
        assert {(r["column_name"], r["failures"]) for r in rows.collect()} == want
    p = plan(dq._relationship_checks(child, cs[:1], parents.get, None))
    assert "partial_count" in p and "LeftAnti" in p and "LeftOuter" not in p


def test_columns_that_the_suite_reads():
    read = dq.columns(dq.ALL_CHECKS, "fact_assessment_result")
    assert read == ["assessment_key", "raw_score", "result_key", "subject_enrollment_key"]
    assert dq.columns(dq.CONTRACT_CHECKS, "src_assessment_results") == ["assessment_id", "raw_score", "result_id", "subject_enrollment_id"]


def test_ids_are_not_looked_for_where_results_may_go_unread(spark, monkeypatch):
    """The dashboards' table asks for results lazily: a dashboard that needs none runs nothing over them."""
    def never(*a):
        raise AssertionError("looked for")
    monkeypatch.setattr(facts, "dedup_few", never)
    Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS, keep=True).obt_program_enrollment()


def test_repeated_result_ids_are_read_from_what_was_written(spark, monkeypatch):
    """The journal of results is derived once where each id comes once; where one does not, the latest versions are kept."""
    looked = []
    few = facts.dedup_few
    monkeypatch.setattr(facts, "dedup_few", lambda *a: looked.append(1) or few(*a))
    t0, t1, t2 = ts("2021-01-01 00:00:00"), ts("2021-01-02 00:00:00"), ts("2021-01-03 00:00:00")
    day = [ts(f"2020-03-0{i} 00:00:00") for i in range(1, 5)]
    rows = {**base_rows(), "program_enrollments": [(1, "U1", "P1", d("2020-01-15"), None, "Active", None, t0, t0)],
            "subject_enrollments": [(i, 1, 10, "Completed", D("60"), None, t0, t0) for i in (11, 12)]}
    once = [(1, 11, 100, D("10.00"), day[0], t0, t0), (2, 11, 101, D("14.00"), day[1], t0, t0), (3, 12, 100, D("5.00"), day[0], t0, t0),
            (None, 12, 101, D("2.00"), day[1], t0, t0)]
    # 2: a later version with another score; 3: the last one under another enrollment; a second row without an id
    later = [(2, 11, 101, D("8.00"), day[1], t1, t1), (3, 12, 100, D("9.00"), day[0], t1, t1), (3, 11, 100, D("7.00"), day[2], t2, t2),
             (None, 12, 101, D("4.00"), day[3], t1, t1)]

    def wide(results):
        w = Warehouse(spark, make_staged(spark, {**rows, "assessment_results": results}), ORACLE_PARAMS, keep_facts=True)
        return {(r[0], float(r[1]), r[2]) for r in w.obt_assessment_result().select("result_id", "raw_score", "mark_trend_within_subject").collect()}

    assert wide(once) == {(1, 10.0, "First"), (2, 14.0, "Improving"), (3, 5.0, "First"), (None, 2.0, "Declining")}
    assert not looked
    assert wide(once + later) == {(1, 10.0, "First"), (2, 8.0, "Declining"), (3, 7.0, "Declining"), (None, 4.0, "First")}
    assert looked


def test_each_once(spark):
    ids = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    assert facts.each_once(ids, "id", 3) and facts.each_once(ids.filter("id > 9"), "id", 3)
    assert not facts.each_once(ids.union(ids.filter("id = 2")), "id", 3)
    assert not facts.each_once(ids.union(ids.filter("id is null")), "id", 3)
