"""Source contracts and staging projections (explicit column lists over the landed tables)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Source types per table (ids are INT at the source; LONG inputs are accepted as a widening).
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "programs": T.StructType([
        T.StructField("program_id", T.StringType()), T.StructField("program_name", T.StringType()),
        T.StructField("department", T.StringType()), T.StructField("degree_level", T.StringType()),
        T.StructField("total_credit_points_required", T.IntegerType())]),
    "subjects": T.StructType([
        T.StructField("subject_code", T.StringType()), T.StructField("subject_title", T.StringType()),
        T.StructField("credit_points", T.IntegerType())]),
    "semesters": T.StructType([
        T.StructField("semester_id", T.StringType()), T.StructField("semester_name", T.StringType()),
        T.StructField("academic_year", T.IntegerType()), T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType())]),
    "program_subjects": T.StructType([
        T.StructField("program_subject_id", T.IntegerType()), T.StructField("program_id", T.StringType()),
        T.StructField("subject_code", T.StringType()), T.StructField("subject_type", T.StringType()),
        T.StructField("recommended_semester", T.IntegerType())]),
    "students": T.StructType([
        T.StructField("student_id", T.StringType()), T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()), T.StructField("email", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType())]),
    "subject_offerings": T.StructType([
        T.StructField("offering_id", T.IntegerType()), T.StructField("subject_code", T.StringType()),
        T.StructField("semester_id", T.StringType()), T.StructField("coordinator_name", T.StringType())]),
    "assessments": T.StructType([
        T.StructField("assessment_id", T.IntegerType()), T.StructField("offering_id", T.IntegerType()),
        T.StructField("title", T.StringType()), T.StructField("weight_percentage", T.DecimalType(5, 2)),
        T.StructField("max_score", T.DecimalType(5, 2))]),
    "program_enrollments": T.StructType([
        T.StructField("program_enrollment_id", T.IntegerType()), T.StructField("student_id", T.StringType()),
        T.StructField("program_id", T.StringType()), T.StructField("enrollment_date", T.DateType()),
        T.StructField("completion_date", T.DateType()), T.StructField("status", T.StringType()),
        T.StructField("final_degree_result", T.StringType()), T.StructField("updated_at", T.TimestampNTZType())]),
    "subject_enrollments": T.StructType([
        T.StructField("subject_enrollment_id", T.IntegerType()), T.StructField("program_enrollment_id", T.IntegerType()),
        T.StructField("offering_id", T.IntegerType()), T.StructField("status", T.StringType()),
        T.StructField("final_mark", T.DecimalType(5, 2)), T.StructField("final_grade", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType())]),
    "assessment_results": T.StructType([
        T.StructField("result_id", T.IntegerType()), T.StructField("subject_enrollment_id", T.IntegerType()),
        T.StructField("assessment_id", T.IntegerType()), T.StructField("raw_score", T.DecimalType(5, 2)),
        T.StructField("submitted_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType())]),
}

# Load mode of each table: dimensions are reloaded whole, facts land incrementally.
FULL_TABLES = ["programs", "subjects", "semesters", "program_subjects", "subject_offerings", "assessments", "students"]
INCREMENTAL_TABLES = {
    "program_enrollments": {"cursor": "updated_at", "pk": "program_enrollment_id"},
    "subject_enrollments": {"cursor": "updated_at", "pk": "subject_enrollment_id"},
    "assessment_results": {"cursor": "updated_at", "pk": "result_id"},
}

_WIDENS = {(T.IntegerType(), T.LongType())}


class SchemaDrift(ValueError):
    pass


def check_schema(df: DataFrame, expected: T.StructType, allow_extra: bool = True) -> None:
    """Raise ``SchemaDrift`` when a required column is missing or has another type
    (INT→LONG widening is accepted)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType and (f.dataType, have[f.name]) not in _WIDENS:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if not allow_extra:
        extra = set(have) - {f.name for f in expected.fields}
        problems += [f"unexpected {c}" for c in sorted(extra)]
    if problems:
        raise SchemaDrift("; ".join(problems))


def check_same_schema(new: DataFrame, existing: DataFrame) -> None:
    """on_schema_change='fail': an incremental batch must have the target's exact columns and types."""
    a = [(f.name, f.dataType) for f in new.schema.fields]
    b = [(f.name, f.dataType) for f in existing.schema.fields]
    if a != b:
        raise SchemaDrift(f"schema changed: {[(n, t.simpleString()) for n, t in a]} vs "
                          f"{[(n, t.simpleString()) for n, t in b]}")


def staged(raw: DataFrame, table: str) -> DataFrame:
    """Staging view: the source columns plus ``_ingested_at``, nothing else. A missing column or another type
    raises ``SchemaDrift``."""
    check_schema(raw, SOURCE_SCHEMAS[table])
    return raw.select(*staged_columns(raw, table))


def staged_columns(raw: DataFrame, table: str) -> list[str]:
    cols = [f.name for f in SOURCE_SCHEMAS[table].fields] + ["_ingested_at"]
    if "src_seq" in raw.columns:  # landing sequence, the last tie-break of arrival order
        cols.append("src_seq")
    if "_ingest_date" in raw.columns:  # journal partition column: lets incremental reads prune folders
        cols.append("_ingest_date")
    return cols


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: staged(df, t) for t, df in raw.items()}
