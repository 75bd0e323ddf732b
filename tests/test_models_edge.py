"""Hand-made cases with literal expected rows (FIXTURES.md, part A)."""

from decimal import Decimal as D

from fixtures_small import base_rows, d, make_staged, ts

from coursemart.params import Params
from coursemart.plans.warehouse import Warehouse

P = Params(as_of="2021-09-01", run_ts="2021-09-01 00:00:00")
T1, T2, T3 = ts("2021-01-01 00:00:00"), ts("2021-01-02 00:00:00"), ts("2021-01-03 00:00:00")


def build(spark, extra):
    rows = base_rows()
    rows.update(extra)
    return Warehouse(spark, make_staged(spark, rows), P)


def test_journal_dedup_latest_by_arrival(spark):
    # one id, three versions; arrival order t1<t2<t3 while updated_at runs backwards
    pe = [(1, "U1", "P1", d("2020-01-15"), None, "Active", None, ts("2020-03-01 00:00:00"), T1),
          (1, "U1", "P1", d("2020-01-15"), None, "Suspended", None, ts("2020-02-01 00:00:00"), T2),
          (1, "U1", "P1", d("2020-01-15"), None, "Withdrawn", None, ts("2020-01-20 00:00:00"), T3)]
    w = build(spark, {"program_enrollments": pe})
    got = [r.status for r in w.fact_program_enrollment().collect()]
    assert got == ["Withdrawn"]


def _pe(i, student, prog, enrolled, status="Active", completed=None):
    return (i, student, prog, d(enrolled), None if completed is None else d(completed), status, None,
            ts("2020-01-01 00:00:00"), T1)


def _se(i, pe, off, mark, status="Completed"):
    return (i, pe, off, status, None if mark is None else D(mark), None, ts("2020-01-01 00:00:00"), T1)


def test_rank_nulls_last_and_ties(spark):
    pe = [_pe(1, "U1", "P1", "2020-01-15"), _pe(2, "U2", "P1", "2020-01-15"),
          _pe(3, "U3", "P1", "2020-01-15"), _pe(4, "U4", "P1", "2020-01-15")]
    se = [_se(11, 1, 10, "90"), _se(12, 2, 10, "90"), _se(13, 3, 10, None, "Enrolled"), _se(14, 4, 10, "40")]
    w = build(spark, {"program_enrollments": pe, "subject_enrollments": se})
    o1 = {r.subject_enrollment_id: (r.rank_in_offering, r.class_size)
          for r in w.obt_subject_enrollment().collect()}
    assert o1 == {11: (1, 4), 12: (1, 4), 13: (4, 4), 14: (3, 4)}


def test_attempts_retakes_credits(spark):
    pe = [_pe(1, "U1", "P1", "2020-01-15")]
    se = [_se(11, 1, 10, "40"), _se(12, 1, 11, "45"), _se(13, 1, 12, "60")]
    w = build(spark, {"program_enrollments": pe, "subject_enrollments": se})
    o1 = {r.subject_enrollment_id: (r.attempt_number, r.is_retake, r.credit_points_earned)
          for r in w.obt_subject_enrollment().collect()}
    assert o1 == {11: (1, False, 0), 12: (2, True, 0), 13: (3, True, 6)}
    o3 = w.obt_program_enrollment().collect()[0]
    assert o3.total_retakes == 3          # 0 + 1 + 2
    assert o3.credits_completed_percentage == round(100 * 6 / 144, 2)
    assert o3.program_gpa == round((40 + 45 + 60) / 3, 2)


def test_trend_bands_and_zscore(spark):
    pe = [_pe(1, "U1", "P1", "2020-01-15"), _pe(2, "U2", "P1", "2020-01-15")]
    se = [_se(11, 1, 10, "60"), _se(21, 1, 20, "60"), _se(12, 2, 10, "60")]
    # subject enrollment 11: fractions .5, .7, .7, NULL, .6 over five submissions of assessment 100/101
    ar = [(1, 11, 100, D("10.00"), ts("2020-03-01 00:00:00"), T1, T1),
          (2, 11, 101, D("14.00"), ts("2020-03-02 00:00:00"), T1, T1),
          (3, 11, 100, D("14.00"), ts("2020-03-03 00:00:00"), T1, T1),
          (4, 11, 101, None, ts("2020-03-04 00:00:00"), T1, T1),
          (5, 11, 100, D("12.00"), ts("2020-03-05 00:00:00"), T1, T1),
          # assessment 200 has a single result: no stddev → z NULL
          (6, 21, 200, D("8.50"), ts("2020-03-01 00:00:00"), T1, T1),
          (7, 12, 101, D("9.99"), ts("2020-03-01 00:00:00"), T1, T1)]
    w = build(spark, {"program_enrollments": pe, "subject_enrollments": se, "assessment_results": ar})
    o2 = {r.result_id: r for r in w.obt_assessment_result().collect()}
    assert [o2[i].mark_trend_within_subject for i in (1, 2, 3, 4, 5)] == \
        ["First", "Improving", "Stable", "Stable", "First"]
    assert o2[6].score_band == "Excellent" and o2[6].z_score_within_assessment is None
    assert o2[4].score_band == "Fail"                      # NULL score
    assert o2[1].score_band == "Needs Improvement"         # exactly .5
    assert o2[7].score_band == "Fail"                      # .4995 < .5
    assert o2[2].weighted_contribution == 35.0


def test_leap_day_duration_and_no_gpa_at_risk(spark):
    pe = [_pe(1, "U1", "P1", "2024-02-29", "Graduated", "2025-02-28"),
          _pe(2, "U2", "P1", "2021-07-01")]  # active, no marks, enrolled 62 days before as_of
    w = build(spark, {"program_enrollments": pe})
    o3 = {r.program_enrollment_id: r for r in w.obt_program_enrollment().collect()}
    assert o3[1].current_year_of_study == 1
    assert str(o3[1].expected_graduation_date) == "2028-02-29 00:00:00"
    assert o3[2].academic_standing is None
    assert o3[2].is_at_risk is True
    assert o3[2].days_since_last_activity == 62


def test_orphan_fact_gets_null_key(spark):
    pe = [_pe(1, "U9", "P1", "2020-01-15")]      # unknown student
    w = build(spark, {"program_enrollments": pe})
    f = w.fact_program_enrollment().collect()[0]
    assert f.student_key is None and f.program_key is not None
