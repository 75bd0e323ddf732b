"""Conformed dimensions (type-1 projections with surrogate keys; dim_program from SCD2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.exprs import key, ts_lit
from coursemart.operators.joins import Lookup
from coursemart.params import Params


def _loaded(p: Params):
    return ts_lit(p.run_ts).alias("_loaded_at")


def dim_student(stg: DataFrame, p: Params) -> DataFrame:
    return stg.select(key(stg, "student_id", p=p).alias("student_key"), "student_id", "first_name", "last_name",
                      "email", "created_at", _loaded(p))


def dim_subject(stg: DataFrame, p: Params) -> DataFrame:
    return stg.select(key(stg, "subject_code", p=p).alias("subject_key"), "subject_code", "subject_title",
                      "credit_points", _loaded(p))


def dim_semester(stg: DataFrame, p: Params) -> DataFrame:
    return stg.select(key(stg, "semester_id", p=p).alias("semester_key"), "semester_id", "semester_name",
                      "academic_year", "start_date", "end_date", _loaded(p))


def dim_program(snapshot: DataFrame, p: Params) -> DataFrame:
    """Current version of each program (``dbt_valid_to is null``) from the SCD2 snapshot."""
    cur = snapshot.filter(F.col("dbt_valid_to").isNull())
    return cur.select(key(cur, "program_id", p=p).alias("program_key"), "program_id", "program_name", "department",
                      "degree_level", "total_credit_points_required",
                      F.col("dbt_valid_from").alias("effective_from"), "_loaded_at")


def dim_subject_offering(stg: DataFrame, d_subject: DataFrame, d_semester: DataFrame, lk: Lookup,
                         p: Params) -> DataFrame:
    so = lk.join(stg, d_subject, "subject_code", cols=["subject_code", "subject_key"])
    so = lk.join(so, d_semester, "semester_id", cols=["semester_id", "semester_key"])
    return so.select(key(so, "offering_id", p=p).alias("offering_key"), "offering_id", "subject_key",
                     "semester_key", "coordinator_name", _loaded(p))


def dim_assessment(stg: DataFrame, d_offering: DataFrame, lk: Lookup, p: Params) -> DataFrame:
    a = lk.join(stg, d_offering, "offering_id", cols=["offering_id", "offering_key"])
    return a.select(key(a, "assessment_id", p=p).alias("assessment_key"), "assessment_id", "offering_key",
                    "title", "weight_percentage", "max_score", _loaded(p))


# Calendar names.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
               "October", "November", "December"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def dim_date(spark: SparkSession, start: str = "2000-01-01", end: str = "2035-12-31") -> DataFrame:
    """One row per day. Generated by ``spark.range`` so the rows are made in parallel."""
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1  # Sunday = 0
    days = spark.range(n_days).select(F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias("full_date"))
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d)).alias("month_name"),
        dow.alias("day_of_week"),
        F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), dow + 1).alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("iso_week"),
        F.trunc(d, "month").alias("month_start"),
        F.date_trunc("quarter", d).cast("date").alias("quarter_start"),
        (F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)).alias("fiscal_year"),
    )
