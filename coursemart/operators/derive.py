"""Derived marks and grades: weighted final mark, letter grade, degree result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.exprs import DEGREE_RESULT_BANDS, DEGREE_RESULT_OTHERWISE, grade_from_mark


def weighted_final_mark(results: DataFrame, assessments: DataFrame, enrollments: DataFrame | None = None) -> DataFrame:
    """Per subject enrollment: Σ(raw / max · weight) / Σ weight · 100 over scored results
    (NULL when nothing is scored), as DOUBLE. ``enrollments`` adds those without any result."""
    r = results.join(assessments.select("assessment_id", "weight_percentage", "max_score"), "assessment_id", "left")
    scored = F.col("raw_score").isNotNull() & (F.col("max_score") > 0)
    weight = F.col("weight_percentage").cast("double")
    frac = F.col("raw_score").cast("double") / F.col("max_score").cast("double") * weight
    g = r.groupBy("subject_enrollment_id").agg(F.sum(F.when(scored, frac)).alias("_w"),
                                               F.sum(F.when(scored, weight)).alias("_tw"))
    if enrollments is not None:
        g = enrollments.select("subject_enrollment_id").distinct().join(g, "subject_enrollment_id", "left")
    return g.select("subject_enrollment_id",
                    F.when(F.col("_tw") > 0, F.col("_w") / F.col("_tw") * 100.0)
                    .alias("weighted_final_mark"))


def with_grade(df: DataFrame, mark: str = "final_mark", level: str = "degree_level") -> DataFrame:
    return df.withColumn("grade", grade_from_mark(mark, level))


def final_degree_result(subject_rows: DataFrame, enrollments: DataFrame | None = None) -> DataFrame:
    """Per programme enrollment: band of the mean mark of completed, marked subjects; NULL without any.
    ``enrollments`` adds the programme enrollments that have no subject at all. The band test is exact (Σ mark ≥ t · n on DECIMAL marks), so a mean sitting on a
    threshold is never pushed below it by floating point."""
    mark = F.when(F.col("status") == "Completed", F.col("final_mark"))
    g = subject_rows.groupBy("program_enrollment_id").agg(F.sum(mark).alias("_s"), F.count(mark).alias("_n"))
    if enrollments is not None:
        g = enrollments.select("program_enrollment_id").distinct().join(g, "program_enrollment_id", "left") \
            .withColumn("_n", F.coalesce("_n", F.lit(0)))
    s, n = F.col("_s"), F.col("_n")
    band = None
    for t, r in DEGREE_RESULT_BANDS:
        cond = s >= F.lit(t) * n
        band = F.when(cond, r) if band is None else band.when(cond, r)
    band = F.when(n > 0, band.otherwise(DEGREE_RESULT_OTHERWISE))
    return g.select("program_enrollment_id", "_n", band.alias("final_degree_result")) \
        .withColumnRenamed("_n", "completed_subjects")
