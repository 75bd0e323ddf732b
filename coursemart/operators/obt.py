"""Wide analysis tables (one big table per grain) over the facts and dims.

Skew notes. Per-offering statistics (rank, class size, mark averages) are not computed by
windows over the raw rows — one offering may hold a large share of all enrollments.
Rows are first pre-aggregated to (offering, mark) counts (partial aggregation before the
shuffle); the rank of a mark is then 1 + the number of rows with a higher mark, a window
over at most 10,001 marks per offering. The (offering, mark) counts are written once (one
pass over the wide input for all per-offering statistics); the statistics aggregated from
them are joined back, broadcast when their proven row bound fits the budget.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.functions.exprs import (cents_sum_count, completed_years, date_lit, degree_years, exact_avg,
                                        exact_round_avg, key, round_half_away, safe_div, score_band, trend, ts_lit)
from coursemart.operators import windows
from coursemart.operators.joins import Lookup
from coursemart.params import Params
from coursemart.session import known_rows, materialize


def _materialize(df: DataFrame, name: str = "intermediate") -> DataFrame:
    return materialize(df, name)


# ---------------------------------------------------------------------------------------
# O1: subject enrollments

STUDENT_COLS = ["student_key", "student_id", "first_name", "last_name"]


def students_of_programs(f_pe: DataFrame, d_student: DataFrame, lk: Lookup) -> tuple[DataFrame, bool]:
    """(the student columns by program enrollment, whether each enrollment has one row), written once. For subject
    enrollments that took their student from these program enrollments."""
    own = _materialize(f_pe.select("program_enrollment_key", "student_key").distinct(), "students_of")
    named = _materialize(lk.join(own, d_student, "student_key", cols=STUDENT_COLS).drop("student_key"), "students_of_programs")
    n = known_rows(named)
    return named, n is not None and n == known_rows(own)


def subject_enriched(f_se, d_student, d_program, d_offering, d_subject, d_semester, lk: Lookup,
                     named: DataFrame | None = None) -> DataFrame:
    """``named``: the student columns by program enrollment, in place of the join with all students: the rows are moved to
    their program enrollment, where their attempts are numbered as well."""
    e = f_se.select("subject_enrollment_key", "subject_enrollment_id", "program_enrollment_key", "offering_key",
                    "status", "final_mark", "final_grade", "student_key", "program_key")
    if named is None:
        e = lk.join(e, d_student, "student_key", cols=STUDENT_COLS)
    else:
        e = e.join(named, "program_enrollment_key", "left")
    return _looked_up(e, d_program, d_offering, d_subject, d_semester, lk)


def _looked_up(e: DataFrame, d_program, d_offering, d_subject, d_semester, lk: Lookup) -> DataFrame:
    """With the columns of the small dimensions."""
    if "subject_key" in e.columns:  # a whole fact: the offering's own subject counts
        e = e.drop("subject_key")
    e = lk.join(e, d_program, "program_key", cols=["program_key", "program_id", "program_name"])
    e = lk.join(e, d_offering, "offering_key", cols=["offering_key", "offering_id", "coordinator_name", "subject_key",
                                     "semester_key"])
    e = lk.join(e, d_subject, "subject_key", cols=["subject_key", "subject_code", "subject_title", "credit_points"])
    e = lk.join(e, d_semester, "semester_key", cols=["semester_key", "semester_id", "semester_name", "academic_year",
                                     F.col("start_date").alias("semester_start_date")])
    return e


def mark_counts(enriched: DataFrame) -> DataFrame:
    """Rows per (offering, mark), with the offering's descriptive keys (functional in offering)."""
    return (enriched.groupBy("offering_key", "subject_code", "semester_id", "coordinator_name", "final_mark")
            .agg(F.count(F.lit(1)).alias("n")))


def offering_mark_ranks(counts: DataFrame) -> DataFrame:
    """rank() over (partition by offering order by mark desc nulls last) and class size, per
    (offering, mark). NULL marks rank after all marks, tied."""
    per = counts.groupBy("offering_key", "final_mark").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("offering_key").orderBy(F.col("final_mark").desc_nulls_last())
    higher = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return per.select("offering_key", "final_mark",
                      (F.coalesce(higher, F.lit(0)) + 1).cast("bigint").alias("rank_in_offering"),
                      F.sum("n").over(Window.partitionBy("offering_key")).cast("bigint").alias("class_size"))


def _weighted_mark_stats(counts: DataFrame, by: list[str], p: Params, pass_col: str | None):
    m = counts.filter(F.col("final_mark").isNotNull())
    aggs = [(F.sum(F.col("final_mark") * F.col("n")).cast("double") / F.sum("n")).alias("_avg")]
    if pass_col:
        aggs.append((F.sum(F.when(F.col("final_mark") >= F.lit(p.subject_pass_mark), F.col("n")).otherwise(0))
                     .cast("double") / F.sum("n")).alias(pass_col))
    return m.groupBy(*by).agg(*aggs)


#: columns that a row is enriched with before its statistics
SUBJECT_BASE = ["subject_enrollment_key", "subject_enrollment_id", "program_enrollment_key", "offering_key", "status", "final_mark",
                "final_grade", "student_key", "program_key", "student_id", "first_name", "last_name", "program_id", "program_name",
                "offering_id", "coordinator_name", "subject_key", "semester_key", "subject_code", "subject_title", "credit_points",
                "semester_id", "semester_name", "academic_year", "semester_start_date"]
SUBJECT_COLUMNS = ["subject_enrollment_key", "subject_enrollment_id", "program_enrollment_key", "student_id", "first_name", "last_name",
                   "program_id", "program_name", "offering_id", "coordinator_name", "subject_code", "subject_title", "credit_points",
                   "semester_id", "semester_name", "academic_year", "status", "final_mark", "final_grade", "attempt_number", "is_retake",
                   "is_pass", "credit_points_earned", "class_size", "program_average_mark_for_this_subject", "subject_pass_rate",
                   "rank_in_offering"]
#: kept beside them in the stored table, for the next refresh
SUBJECT_STORED = [c for c in SUBJECT_BASE if c not in SUBJECT_COLUMNS]


def attempts(e: DataFrame, p: Params, detect: DataFrame | None = None) -> DataFrame:
    """row_number per (enrollment, subject); hot groups (e.g. the NULL-enrollment group of early-arriving rows) are numbered
    across partitions."""
    return windows.row_number(e, ["program_enrollment_key", "subject_code"], [F.col("semester_start_date").asc_nulls_last(),
                                                                        F.col("subject_enrollment_id").asc_nulls_last()], "attempt_number",
                              p.hot_group_rows, p.hot_sample_fraction, detect_on=detect)


def coordinator_stats(counts: DataFrame, p: Params) -> DataFrame:
    return _weighted_mark_stats(counts, ["coordinator_name"], p, None).withColumnRenamed("_avg", "coordinator_average_mark")


def subject_rows(x: DataFrame, counts: DataFrame, lk: Lookup, p: Params) -> DataFrame:
    """Numbered rows with the statistics of their offering and their subject in the semester: SUBJECT_COLUMNS and
    SUBJECT_STORED. ``counts``: mark counts of (at least) the offerings of ``x``."""
    # each small table is written once: its own row count decides whether it is broadcast
    ranks = _materialize(offering_mark_ranks(counts), "offering_mark_ranks")
    subj = _materialize(_weighted_mark_stats(counts, ["subject_code", "semester_id"], p, "subject_pass_rate")
                        .withColumnRenamed("_avg", "program_average_mark_for_this_subject"), "subject_stats")
    # NULL-safe on both keys: NULL offering / NULL mark rows get their group's rank
    r = lk.side(ranks)
    x = x.join(r, x.offering_key.eqNullSafe(r.offering_key) & x.final_mark.eqNullSafe(r.final_mark), "left") \
        .drop(r.offering_key).drop(r.final_mark)
    x = x.join(lk.side(subj), ["subject_code", "semester_id"], "left")

    mark = F.col("final_mark")
    is_pass = mark.isNotNull() & (mark >= F.lit(p.subject_pass_mark))
    # the class-size join is an equality join: no size for a NULL offering
    return x.withColumns({"is_retake": F.col("attempt_number") > 1, "is_pass": is_pass,
                          "credit_points_earned": F.when(is_pass, F.col("credit_points")).otherwise(F.lit(0)),
                          "class_size": F.when(F.col("offering_key").isNotNull(), F.col("class_size"))}).select(*SUBJECT_COLUMNS, *SUBJECT_STORED)


def subject_wide(rows: DataFrame, coordinators: DataFrame, loaded_at) -> DataFrame:
    return rows.join(coordinators, "coordinator_name", "left").select(*SUBJECT_COLUMNS, "coordinator_average_mark", loaded_at.alias("_loaded_at"))


def subject_tables(f_se, d_student, d_program, d_offering, d_subject, d_semester, lk: Lookup, p: Params,
                   f_pe: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, mark counts) of all subject enrollments. ``f_pe``: the program enrollments that these took their student from;
    if there are too many students to broadcast, they are looked up there."""
    named, single = (None, False) if f_pe is None or lk.fits(d_student) else students_of_programs(f_pe, d_student, lk)
    e = subject_enriched(f_se, d_student, d_program, d_offering, d_subject, d_semester, lk, named)
    # where each program enrollment has one row, names change no count: the rows need not be moved to them
    counted = _looked_up(f_se, d_program, d_offering, d_subject, d_semester, lk) if single else e
    counts = _materialize(mark_counts(counted), "offering_mark_counts")
    # detection samples a narrow input: the fact's two key columns and one dimension lookup
    detect = lk.join(f_se.select("program_enrollment_key", "subject_key"), d_subject, "subject_key",
                     cols=["subject_key", "subject_code"]).drop("subject_key")
    return subject_rows(attempts(e, p, detect), counts, lk, p), counts


def obt_subject_enrollment(f_se, d_student, d_program, d_offering, d_subject, d_semester, lk: Lookup,
                           p: Params, f_pe: DataFrame | None = None) -> DataFrame:
    rows, counts = subject_tables(f_se, d_student, d_program, d_offering, d_subject, d_semester, lk, p, f_pe)
    coord = _materialize(coordinator_stats(counts, p), "coordinator_stats")
    return subject_wide(rows, lk.side(coord), ts_lit(p.run_ts))


def _in(column: str, values: set) -> Column:
    """The column is one of the values, NULL among them or not: a filter that prunes partitions."""
    some = sorted(v for v in values if v is not None)
    cond = F.col(column).isin(some) if some else F.lit(False)
    return cond | F.col(column).isNull() if None in values else cond


def _values(*columns: DataFrame) -> set:
    """The distinct values of one-column tables (semesters: few by nature)."""
    return {r[0] for r in reduce(DataFrame.union, columns).distinct().collect()}


def _among(df: DataFrame, keys: DataFrame, cols: list[str], lk: Lookup) -> DataFrame:
    """The rows of ``df`` that agree with one of the written ``keys`` in ``cols``, NULL equal to NULL."""
    side = lk.side(keys).select(*[F.col(c).alias(f"_{c}") for c in cols])
    return df.join(side, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]), "left_semi")


def refreshed_subjects(before: DataFrame, changed: DataFrame, d_student, d_program, d_offering, d_subject, d_semester, lk: Lookup,
                       p: Params) -> tuple[DataFrame, set, DataFrame, set]:
    """(rows, their semesters, mark counts, their semesters): all rows of the semesters that ``changed`` fact rows touch.
    ``before``: the stored rows, partitioned by semester.

    An offering, its ranks and its averages lie in one semester; what reaches into others are the attempts of one
    (enrollment, subject). These are numbered again for the changed rows' pairs, from six columns. The semesters of the changed
    rows, and of what they were before, get new statistics; those where only a sibling's number is another now get that
    number. The stored rows of these alone are read whole. The result equals the full build's rows of these semesters, if the
    dimensions' rows have not changed."""
    new = _materialize(subject_enriched(changed, d_student, d_program, d_offering, d_subject, d_semester, lk), "subjects_changed")
    ids = lk.side(new).select("subject_enrollment_id")
    pair, place = ["program_enrollment_key", "subject_code"], ["subject_enrollment_id", "semester_id", "semester_start_date"]
    narrow = before.select(*place, *pair, "attempt_number")
    old = _materialize(narrow.join(ids, "subject_enrollment_id", "left_semi"), "subjects_before")
    pairs = _materialize(new.select(*pair).unionByName(old.select(*pair)).distinct(), "subjects_touched")
    kin = _among(narrow, pairs, pair, lk).join(ids, "subject_enrollment_id", "left_anti").withColumnRenamed("attempt_number", "was")
    kin = _materialize(kin.unionByName(new.select(*place, *pair, F.lit(None).cast("bigint").alias("was"))), "subjects_kin")
    numbered = _materialize(attempts(kin, p), "subjects_numbered")
    moved = numbered.filter("was <> attempt_number")
    counted = _values(new.select("semester_id"), old.select("semester_id"))
    others = _values(moved.select("semester_id")) - counted
    again = lk.side(numbered).select("subject_enrollment_id", F.col("attempt_number").alias("again"))

    def renumbered(rows: DataFrame) -> DataFrame:
        x = rows.join(again, "subject_enrollment_id", "left")
        return x.withColumn("attempt_number", F.coalesce("again", "attempt_number")).drop("again")

    kept = before.filter(_in("semester_id", counted)).join(ids, "subject_enrollment_id", "left_anti")
    x = kept.select(*SUBJECT_BASE, "attempt_number").unionByName(new.withColumn("attempt_number", F.lit(None).cast("bigint")))
    x = _materialize(renumbered(x), "subjects_of_semesters")
    counts = _materialize(mark_counts(x), "offering_mark_counts")
    rows = subject_rows(x, counts, lk, p)
    if others:
        rest = renumbered(before.filter(_in("semester_id", others))).withColumn("is_retake", F.col("attempt_number") > 1)
        rows = rows.unionByName(rest.select(*rows.columns))
    return rows, counted | others, counts, counted


# ---------------------------------------------------------------------------------------
# O2: assessment results

RESULT_INPUT = ["result_key", "result_id", "subject_enrollment_key", "assessment_key", "raw_score", "submitted_at", "student_key"]
RESULT_BASE = ["result_key", "result_id", "subject_enrollment_key", "assessment_key", "raw_score", "submitted_at", "student_key",
               "student_id", "first_name", "last_name", "offering_key", "assessment_title", "weight_percentage", "max_score", "subject_key",
               "semester_key", "subject_code", "subject_title", "semester_id", "semester_name", "academic_year", "final_mark", "final_grade",
               "score_percentage"]
RESULT_COLUMNS = ["result_key", "result_id", "student_id", "first_name", "last_name", "subject_code", "subject_title", "semester_id",
                  "semester_name", "academic_year", "assessment_title", "weight_percentage", "max_score", "raw_score", "submitted_at",
                  "final_mark", "final_grade", "score_percentage", "weighted_contribution", "assessment_average_score_for_offering",
                  "assessment_pass_rate", "z_score_within_assessment", "score_band", "mark_trend_within_subject"]
RESULT_STORED = [c for c in RESULT_BASE if c not in RESULT_COLUMNS] + ["previous_score_percentage"]


def result_enriched(f_ar, f_se, d_student, d_assessment, d_offering, d_subject, d_semester, lk: Lookup,
                    built_together: bool = False) -> DataFrame:
    """``built_together``: the results took their student from these very subject enrollments, so a student table too large to
    broadcast is joined to the enrollments and the results are not shuffled once more for it. Facts that are upserted
    apart may differ, so there each result looks up its own student."""
    parent = _parent_of(f_ar)
    e = f_ar.select(*RESULT_INPUT, *[c for c in parent if c not in RESULT_INPUT])
    # fact-to-fact first, on the parent: stored in buckets of it, the results are not moved
    marks = [*parent, "final_mark", "final_grade"]
    if built_together and not lk.fits(d_student):
        named = lk.join(f_se.select(*marks, "student_key"), d_student, "student_key", cols=STUDENT_COLS)
        e = e.join(named.drop("student_key"), parent, "left")
    else:
        e = e.join(f_se.select(*marks), parent, "left")
        e = lk.join(e, d_student, "student_key", cols=STUDENT_COLS)
    e = lk.join(e, d_assessment, "assessment_key", cols=["assessment_key", "offering_key", F.col("title").alias("assessment_title"),
                                       "weight_percentage", "max_score"])
    e = lk.join(e, d_offering, "offering_key", cols=["offering_key", "subject_key", "semester_key"])
    e = lk.join(e, d_subject, "subject_key", cols=["subject_key", "subject_code", "subject_title"])
    e = lk.join(e, d_semester, "semester_key", cols=["semester_key", "semester_id", "semester_name", "academic_year"])
    return e.withColumn("score_percentage", safe_div("raw_score", "max_score")) \
        .select(*RESULT_BASE, *[c for c in parent if c not in RESULT_BASE])


def _parent_of(results: DataFrame) -> list[str]:
    """What names the subject enrollment of a result: its id, where the results were written with it, in buckets of it; else its key."""
    return ["subject_enrollment_id" if "subject_enrollment_id" in results.columns else "subject_enrollment_key"]


def previous_scores(e: DataFrame, p: Params, detect: DataFrame | None = None) -> DataFrame:
    """The score before each one of its subject enrollment, in the order of submission."""
    return windows.lag(e, _parent_of(e), [F.col("submitted_at").asc_nulls_last(), F.col("result_id").asc_nulls_last()],
                       "score_percentage", "previous_score_percentage", p.hot_group_rows, p.hot_sample_fraction, detect_on=detect)


def result_rows(x: DataFrame, scored: DataFrame, lk: Lookup, p: Params) -> DataFrame:
    """Rows with the statistics of their assessment: RESULT_COLUMNS and RESULT_STORED. ``scored``: (assessment_key, raw_score,
    score_percentage) of (at least) the assessments of ``x``."""
    # one row per assessment key seen in the fact (keys of deleted assessments included), written
    # once with its row count observed: broadcast only when that count fits the budget
    stats = _materialize(
        scored.groupBy("assessment_key").agg(
            exact_avg("raw_score").alias("assessment_average_score_for_offering"),
            F.stddev_samp(F.col("raw_score").cast("double")).alias("_sd"),
            F.avg(F.when(F.col("score_percentage") >= F.lit(p.pass_threshold_pct), 1.0).otherwise(0.0))
            .alias("assessment_pass_rate")), "assessment_stats")
    x = lk.join(x, stats, "assessment_key")
    sd = F.col("_sd")
    z = F.when(sd.isNull() | (sd == 0), F.lit(None).cast("double")) \
        .otherwise((F.col("raw_score").cast("double") - F.col("assessment_average_score_for_offering")) / sd)
    return x.withColumns({
        "weighted_contribution": round_half_away(F.col("score_percentage") * F.col("weight_percentage").cast("double"), 2),
        "z_score_within_assessment": z, "score_band": score_band("score_percentage", p),
        "mark_trend_within_subject": trend("score_percentage", "previous_score_percentage")}).select(*RESULT_COLUMNS, *RESULT_STORED)


def result_table(f_ar, f_se, d_student, d_assessment, d_offering, d_subject, d_semester, lk: Lookup, p: Params,
                 built_together: bool = False) -> DataFrame:
    """The rows of all results."""
    e = result_enriched(f_ar, f_se, d_student, d_assessment, d_offering, d_subject, d_semester, lk, built_together)
    # per-assessment statistics need only the result and its assessment (the fact grain keeps
    # the other left joins one-to-one), so they are computed from the narrow pair
    scored = lk.join(f_ar.select("assessment_key", "raw_score"), d_assessment, "assessment_key",
                     cols=["assessment_key", "max_score"]) \
        .withColumn("score_percentage", safe_div("raw_score", "max_score"))
    return result_rows(previous_scores(e, p, f_ar.select(*_parent_of(f_ar))), scored, lk, p)


def obt_assessment_result(f_ar, f_se, d_student, d_assessment, d_offering, d_subject, d_semester, lk: Lookup,
                          p: Params, built_together: bool = False) -> DataFrame:
    rows = result_table(f_ar, f_se, d_student, d_assessment, d_offering, d_subject, d_semester, lk, p, built_together)
    return rows.select(*RESULT_COLUMNS, ts_lit(p.run_ts).alias("_loaded_at"))


def refreshed_results(before: DataFrame, changed: DataFrame, parents: DataFrame, f_se, d_student, d_assessment, d_offering, d_subject,
                      d_semester, lk: Lookup, p: Params) -> tuple[DataFrame, set]:
    """(rows, semesters): all rows of the semesters that ``changed`` results and changed subject enrollments (``parents``) touch.

    An assessment lies in one semester; what reaches into others are the results of one subject enrollment: the order in which
    they follow each other, which is taken again for the changed ones' enrollments, and the mark that they carry. The
    semesters are those of the changed results, of what they were before, of results that follow another score now, and of
    the changed enrollments' results; other rows are read by six columns alone."""
    new = _materialize(result_enriched(changed, f_se, d_student, d_assessment, d_offering, d_subject, d_semester, lk), "results_changed")
    ids, own = lk.side(new).select("result_id"), ["subject_enrollment_key"]
    order = ["result_id", *own, "semester_id", "submitted_at", "score_percentage"]
    narrow = before.select(*order, "previous_score_percentage")
    old = _materialize(narrow.join(ids, "result_id", "left_semi"), "results_before")
    keys = _materialize(new.select(*own).unionByName(old.select(*own)).distinct(), "results_touched")
    marks = _materialize(parents.select(*own, F.col("final_mark").alias("new_mark"), F.col("final_grade").alias("new_grade"),
                                        F.lit(True).alias("marked")), "marks_changed")
    kin = _among(narrow, keys, own, lk).join(ids, "result_id", "left_anti").withColumnRenamed("previous_score_percentage", "was")
    kin = _materialize(kin.unionByName(new.select(*order, F.lit(None).cast("double").alias("was"))), "results_kin")
    followed = _materialize(previous_scores(kin, p), "results_followed")
    moved = followed.filter(~F.col("was").eqNullSafe(F.col("previous_score_percentage")))
    semesters = _values(*[t.select("semester_id") for t in (new, old, moved, narrow.join(lk.side(marks), own, "left_semi"))])
    kept = before.filter(_in("semester_id", semesters)).join(ids, "result_id", "left_anti").join(lk.side(marks), own, "left")
    kept = kept.withColumns({c: F.when(F.col("marked"), F.col(f"new_{c[6:]}")).otherwise(F.col(c)) for c in ("final_mark", "final_grade")})
    x = kept.select(*RESULT_BASE, "previous_score_percentage").unionByName(new.withColumn("previous_score_percentage", F.lit(None).cast("double")))
    again = lk.side(followed).select("result_id", F.col("previous_score_percentage").alias("again"), F.lit(True).alias("_hit"))
    x = x.join(again, "result_id", "left").withColumn("previous_score_percentage", F.when(F.col("_hit"), F.col("again"))
                                                      .otherwise(F.col("previous_score_percentage"))).drop("again", "_hit")
    x = _materialize(x, "results_of_semesters")
    return result_rows(x, x.select("assessment_key", "raw_score", "score_percentage"), lk, p), semesters


# ---------------------------------------------------------------------------------------
# O3: program enrollments

def last_activity(f_se: DataFrame, f_ar: DataFrame) -> DataFrame:
    """max(submitted_at) per program enrollment over F2 ⟕ F3, with results pre-aggregated
    per subject enrollment before the join."""
    per_se = f_ar.groupBy("subject_enrollment_key").agg(F.max("submitted_at").alias("_last"))
    j = f_se.select("subject_enrollment_key", "program_enrollment_key").join(per_se, "subject_enrollment_key", "left")
    return j.groupBy("program_enrollment_key").agg(F.max("_last").alias("last_activity_at"))


def multi_program(f_pe: DataFrame) -> DataFrame:
    """Enrollments per student. The fact holds one row per program_enrollment_id (its
    grain, checked by the unique test), so a plain count equals count(distinct id) and
    keeps map-side partial aggregation."""
    return f_pe.groupBy("student_key").agg(F.count("program_enrollment_id").alias("program_count"))


def subject_agg(obt_se: DataFrame) -> DataFrame:
    marked = F.col("final_mark").isNotNull()
    return obt_se.groupBy("program_enrollment_key").agg(
        F.sum(F.col("attempt_number") - 1).alias("total_retakes"),
        F.sum("credit_points_earned").alias("credits_earned"),
        safe_div(F.sum(F.when(marked, F.col("final_mark") * F.col("credit_points")).otherwise(0)),
                 F.sum(F.when(marked, F.col("credit_points")).otherwise(0))).alias("gpa_raw"))


def obt_program_enrollment(f_pe, f_se, f_ar, obt_se, d_student, d_program, lk: Lookup, p: Params) -> DataFrame:
    x = lk.join(f_pe, d_student, "student_key", cols=["student_key", "student_id", "first_name", "last_name", "email"])
    x = lk.join(x, d_program, "program_key", cols=["program_key", "program_id", "program_name", "department", "degree_level",
                                    "total_credit_points_required"])
    x = x.join(subject_agg(obt_se), "program_enrollment_key", "left")
    x = x.join(last_activity(f_se, f_ar), "program_enrollment_key", "left")
    x = x.join(multi_program(f_pe), "student_key", "left")

    as_of = date_lit(p.as_of)
    end = F.coalesce(F.col("completion_date"), as_of)
    gpa = F.col("gpa_raw")
    inactive_days = F.datediff(as_of, F.coalesce(F.col("last_activity_at"), F.col("enrollment_date").cast("timestamp_ntz"))
                               .cast("date")).cast("bigint")
    retakes = F.coalesce(F.col("total_retakes"), F.lit(0)).cast("bigint")
    return x.select(
        "program_enrollment_key", "program_enrollment_id", "student_id", "first_name", "last_name", "email",
        "program_id", "program_name", "department", "degree_level", "total_credit_points_required",
        "enrollment_date", "completion_date", "status", "final_degree_result",
        F.year("enrollment_date").alias("cohort_year"),
        (completed_years(end, "enrollment_date") + 1).alias("current_year_of_study"),
        round_half_away(F.datediff(end, F.col("enrollment_date")).cast("double") / 365.25, 2)
        .alias("actual_duration_years"),
        F.add_months("enrollment_date", degree_years("degree_level") * 12).cast("timestamp_ntz")
        .alias("expected_graduation_date"),
        round_half_away(safe_div(F.col("credits_earned") * 100.0, "total_credit_points_required"), 2)
        .alias("credits_completed_percentage"),
        round_half_away(gpa, 2).alias("program_gpa"),
        retakes.alias("total_retakes"),
        (retakes > F.lit(p.retake_heavy_threshold)).alias("is_retake_heavy"),
        (F.coalesce(F.col("program_count"), F.lit(1)) > 1).alias("is_multi_program_student"),
        inactive_days.alias("days_since_last_activity"),
        F.when(gpa.isNull(), F.lit(None).cast("string"))
        .when(gpa >= F.lit(p.good_standing_gpa), "Good Standing")
        .when(gpa >= F.lit(p.at_risk_gpa), "Probation")
        .otherwise("At Risk").alias("academic_standing"),
        (((inactive_days > F.lit(p.at_risk_inactivity_days)) | (F.coalesce(gpa, F.lit(100.0)) < F.lit(p.at_risk_gpa)))
         & (F.col("status") == "Active")).alias("is_at_risk"),
        ts_lit(p.run_ts).alias("_loaded_at"))


# ---------------------------------------------------------------------------------------
# O4: program × cohort summary

def obt_program_summary(obt_pe: DataFrame, p: Params) -> DataFrame:
    """Grain (program, cohort year). O3 is one row per enrollment with the current program
    attributes (inner join to the dim = program_id present), so the conditional distinct
    counts are conditional counts, and no Expand of several distinct aggregates is needed.
    Averages of the 2-decimal GPA and duration are exact (integer hundredths)."""
    b = obt_pe.filter(F.col("program_id").isNotNull())
    st = F.col("status")
    k = F.col("program_enrollment_key")
    total = F.count(k)

    def cnt(cond):
        return F.count(F.when(cond, k))

    gpa_s, gpa_c = cents_sum_count("program_gpa")
    ttd_s, ttd_c = cents_sum_count(F.when(st == "Graduated", F.col("actual_duration_years")))
    g = b.groupBy("program_id", "program_name", "department", "degree_level", "cohort_year").agg(
        total.alias("total_enrolled_students"),
        cnt(st == "Active").alias("total_active_students"),
        cnt(st == "Graduated").alias("total_graduated_students"),
        cnt(st.isin("Withdrawn", "Dismissed")).alias("total_withdrawn_students"),
        gpa_s.alias("_gpa_s"), gpa_c.alias("_gpa_c"),
        safe_div(cnt(st.isin("Active", "Graduated")), total).alias("_ret"),
        safe_div(cnt(st == "Graduated"), total).alias("_grad"),
        ttd_s.alias("_ttd_s"), ttd_c.alias("_ttd_c"))
    return g.select(
        key(g, "program_id", "cohort_year", p=p).alias("program_summary_key"),
        "program_id", "program_name", "department", "degree_level", "cohort_year",
        "total_enrolled_students", "total_active_students", "total_graduated_students", "total_withdrawn_students",
        exact_round_avg("_gpa_s", "_gpa_c").alias("average_gpa"),
        round_half_away("_ret", 2).alias("retention_rate"),
        round_half_away("_grad", 2).alias("graduation_rate"),
        exact_round_avg("_ttd_s", "_ttd_c").alias("average_time_to_degree_years"),
        ts_lit(p.run_ts).alias("_loaded_at"))
