"""Data-quality operators and the declared suite.

Each check returns its failing rows (0 rows = pass). The suite runner turns every declared
check into one (model, column_name, test, failures) row, with one job per checked model:
row-level checks (not_null, accepted_range, CHECK predicates, singular tests) fused into a
single aggregate pass; unique / unique_combination / accepted_values as typed grouped counts
reading only their columns; all foreign keys of the model as left joins to the parents'
distinct keys in one plan.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.functions.exprs import (DEGREE_LEVELS, DEGREE_RESULTS, PROGRAM_STATUSES, SOURCE_GRADES,
                                        STAGED_GRADES, SUBJECT_ENROLLMENT_STATUSES, SUBJECT_TYPES)


# ---------------------------------------------------------------------------------------
# single checks: failing rows

def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` held by more than one row (NULLs are not checked)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def dq_relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no parent row."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def dq_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Distinct values outside the accepted list, with their row counts (NULL passes)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values)).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")))


def range_violation(col: str, lo=None, hi=None, inclusive: bool = True) -> Column:
    c = F.col(col)
    conds = []
    if lo is not None:
        conds.append(c >= F.lit(lo) if inclusive else c > F.lit(lo))
    if hi is not None:
        conds.append(c <= F.lit(hi) if inclusive else c < F.lit(hi))
    ok = reduce(lambda a, b: a & b, conds)
    return c.isNotNull() & ~ok


def dq_accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    return df.filter(range_violation(col, lo, hi, inclusive))


def dq_unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Combinations held by more than one row (NULLs group together)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def singular_score(col: str = "raw_score") -> Column:
    c = F.col(col)
    return (c < 0) | (c > 200)


def singular_program() -> Column:
    """Three-valued OR: a NULL operand never flags a row by itself."""
    return ((F.col("enrollment_date") > F.col("completion_date"))
            | ~F.col("status").isin(*PROGRAM_STATUSES)
            | F.col("program_enrollment_id").isNull()
            | F.col("student_key").isNull()
            | ~F.col("final_degree_result").isin(*DEGREE_RESULTS))


def dq_singular(df: DataFrame, predicate: Column) -> DataFrame:
    # a NULL predicate is not a failure (WHERE semantics)
    return df.filter(F.coalesce(predicate, F.lit(False)))


# ---------------------------------------------------------------------------------------
# declared suite

@dataclass(frozen=True)
class Check:
    model: str
    column: str | None
    test: str                     # unique, not_null, relationships, accepted_values, accepted_range,
    #                               unique_combination, singular
    args: dict = field(default_factory=dict, hash=False, compare=False)


def _pk(model, col):
    return [Check(model, col, "unique"), Check(model, col, "not_null")]


def _fk(model, col, parent, parent_col):
    return [Check(model, col, "not_null"), Check(model, col, "relationships", {"to": parent, "field": parent_col})]


# The declared checks (staging 48, warehouse 50, singular 2).
STAGING_CHECKS = (
    _pk("stg_programs", "program_id") + _pk("stg_subjects", "subject_code") + _pk("stg_semesters", "semester_id")
    + _pk("stg_program_subjects", "program_subject_id")
    + _fk("stg_program_subjects", "program_id", "stg_programs", "program_id")
    + _fk("stg_program_subjects", "subject_code", "stg_subjects", "subject_code")
    + _pk("stg_subject_offerings", "offering_id")
    + _fk("stg_subject_offerings", "subject_code", "stg_subjects", "subject_code")
    + _fk("stg_subject_offerings", "semester_id", "stg_semesters", "semester_id")
    + _pk("stg_students", "student_id")
    + _pk("stg_assessments", "assessment_id")
    + _fk("stg_assessments", "offering_id", "stg_subject_offerings", "offering_id")
    + [Check("stg_assessments", "weight_percentage", "accepted_range", {"min": 0, "max": 100})]
    + [Check("stg_program_enrollments", "program_enrollment_id,updated_at", "unique_combination"),
       Check("stg_program_enrollments", "program_enrollment_id", "not_null")]
    + _fk("stg_program_enrollments", "student_id", "stg_students", "student_id")
    + _fk("stg_program_enrollments", "program_id", "stg_programs", "program_id")
    + [Check("stg_program_enrollments", "status", "accepted_values", {"values": PROGRAM_STATUSES}),
       Check("stg_program_enrollments", "final_degree_result", "accepted_values", {"values": DEGREE_RESULTS})]
    + [Check("stg_subject_enrollments", "subject_enrollment_id,updated_at", "unique_combination"),
       Check("stg_subject_enrollments", "subject_enrollment_id", "not_null")]
    + _fk("stg_subject_enrollments", "program_enrollment_id", "stg_program_enrollments", "program_enrollment_id")
    + _fk("stg_subject_enrollments", "offering_id", "stg_subject_offerings", "offering_id")
    + [Check("stg_subject_enrollments", "final_mark", "accepted_range", {"min": 0, "max": 100}),
       Check("stg_subject_enrollments", "final_grade", "accepted_values", {"values": STAGED_GRADES})]
    + [Check("stg_assessment_results", "result_id,updated_at", "unique_combination"),
       Check("stg_assessment_results", "result_id", "not_null")]
    + _fk("stg_assessment_results", "subject_enrollment_id", "stg_subject_enrollments", "subject_enrollment_id")
    + _fk("stg_assessment_results", "assessment_id", "stg_assessments", "assessment_id")
    + [Check("stg_assessment_results", "raw_score", "accepted_range", {"min": 0, "max": 200})]
)

WAREHOUSE_CHECKS = (
    _pk("dim_program", "program_key") + _pk("dim_program", "program_id")
    + _pk("dim_student", "student_key") + _pk("dim_student", "student_id")
    + _pk("dim_subject", "subject_key") + _pk("dim_subject", "subject_code")
    + _pk("dim_semester", "semester_key") + _pk("dim_semester", "semester_id")
    + _pk("dim_subject_offering", "offering_key")
    + _fk("dim_subject_offering", "subject_key", "dim_subject", "subject_key")
    + _fk("dim_subject_offering", "semester_key", "dim_semester", "semester_key")
    + _pk("dim_assessment", "assessment_key")
    + _fk("dim_assessment", "offering_key", "dim_subject_offering", "offering_key")
    + _pk("fact_program_enrollment", "program_enrollment_key")
    + _fk("fact_program_enrollment", "student_key", "dim_student", "student_key")
    + _fk("fact_program_enrollment", "program_key", "dim_program", "program_key")
    + [Check("fact_program_enrollment", "final_degree_result", "accepted_values", {"values": DEGREE_RESULTS})]
    + _pk("fact_subject_enrollment", "subject_enrollment_key")
    + _fk("fact_subject_enrollment", "subject_key", "dim_subject", "subject_key")
    + _fk("fact_subject_enrollment", "offering_key", "dim_subject_offering", "offering_key")
    + _fk("fact_subject_enrollment", "program_enrollment_key", "fact_program_enrollment", "program_enrollment_key")
    + [Check("fact_subject_enrollment", "final_mark", "accepted_range", {"min": 0, "max": 100}),
       Check("fact_subject_enrollment", "final_grade", "accepted_values", {"values": STAGED_GRADES})]
    + _pk("fact_assessment_result", "result_key")
    + _fk("fact_assessment_result", "subject_enrollment_key", "fact_subject_enrollment", "subject_enrollment_key")
    + _fk("fact_assessment_result", "assessment_key", "dim_assessment", "assessment_key")
    + [Check("fact_assessment_result", "raw_score", "accepted_range", {"min": 0, "max": 200})]
)

SINGULAR_CHECKS = [
    Check("fact_assessment_result", None, "singular", {"name": "fact_assignment_result", "predicate": "score"}),
    Check("fact_program_enrollment", None, "singular", {"name": "fact_program_enrollment", "predicate": "program"}),
]

ALL_CHECKS = STAGING_CHECKS + WAREHOUSE_CHECKS + SINGULAR_CHECKS


def _chk(model, name, expr):
    return Check(model, name, "check", {"expr": expr})


# The source contract (CHECK / UNIQUE / FK / NOT NULL of the source DDL) as
# checks on landed data; journal tables are checked on their latest version per id
# ("src_*" models). A CHECK passes on NULL.
CONTRACT_CHECKS = (
    _pk("stg_programs", "program_id")
    + [Check("stg_programs", "degree_level", "accepted_values", {"values": DEGREE_LEVELS}),
       _chk("stg_programs", "total_credit_points_required", "total_credit_points_required > 0")]
    + _pk("stg_subjects", "subject_code") + [_chk("stg_subjects", "credit_points", "credit_points > 0")]
    + _pk("stg_semesters", "semester_id") + [_chk("stg_semesters", "end_date", "end_date > start_date")]
    + _pk("stg_program_subjects", "program_subject_id")
    + [Check("stg_program_subjects", "program_id,subject_code", "unique_combination")]
    + _fk("stg_program_subjects", "program_id", "stg_programs", "program_id")
    + _fk("stg_program_subjects", "subject_code", "stg_subjects", "subject_code")
    + [Check("stg_program_subjects", "subject_type", "accepted_values", {"values": SUBJECT_TYPES}),
       _chk("stg_program_subjects", "recommended_semester", "recommended_semester > 0")]
    + _pk("stg_students", "student_id") + [Check("stg_students", "email", "unique")]
    + _pk("src_program_enrollments", "program_enrollment_id")
    + _fk("src_program_enrollments", "student_id", "stg_students", "student_id")
    + _fk("src_program_enrollments", "program_id", "stg_programs", "program_id")
    + [Check("src_program_enrollments", "status", "accepted_values", {"values": PROGRAM_STATUSES}),
       _chk("src_program_enrollments", "completion_date", "completion_date > enrollment_date")]
    + _pk("stg_subject_offerings", "offering_id")
    + [Check("stg_subject_offerings", "subject_code,semester_id", "unique_combination")]
    + _fk("stg_subject_offerings", "subject_code", "stg_subjects", "subject_code")
    + _fk("stg_subject_offerings", "semester_id", "stg_semesters", "semester_id")
    + _pk("src_subject_enrollments", "subject_enrollment_id")
    + [Check("src_subject_enrollments", "program_enrollment_id,offering_id", "unique_combination")]
    + _fk("src_subject_enrollments", "program_enrollment_id", "src_program_enrollments", "program_enrollment_id")
    + _fk("src_subject_enrollments", "offering_id", "stg_subject_offerings", "offering_id")
    + [Check("src_subject_enrollments", "status", "accepted_values", {"values": SUBJECT_ENROLLMENT_STATUSES}),
       _chk("src_subject_enrollments", "final_mark", "final_mark >= 0 and final_mark <= 100"),
       Check("src_subject_enrollments", "final_grade", "accepted_values", {"values": SOURCE_GRADES})]
    + _pk("stg_assessments", "assessment_id")
    + _fk("stg_assessments", "offering_id", "stg_subject_offerings", "offering_id")
    + [_chk("stg_assessments", "weight_percentage", "weight_percentage >= 0 and weight_percentage <= 100"),
       _chk("stg_assessments", "max_score", "max_score > 0")]
    + _pk("src_assessment_results", "result_id")
    + [Check("src_assessment_results", "subject_enrollment_id,assessment_id", "unique_combination")]
    + _fk("src_assessment_results", "subject_enrollment_id", "src_subject_enrollments", "subject_enrollment_id")
    + _fk("src_assessment_results", "assessment_id", "stg_assessments", "assessment_id")
    + [_chk("src_assessment_results", "raw_score", "raw_score >= 0")]
)

_ROW_LEVEL = {"not_null", "accepted_range", "singular", "check"}


def _row_condition(c: Check) -> Column:
    if c.test == "not_null":
        return F.col(c.column).isNull()
    if c.test == "accepted_range":
        return range_violation(c.column, c.args.get("min"), c.args.get("max"), c.args.get("inclusive", True))
    if c.test == "check":
        return F.coalesce(~F.expr(c.args["expr"]), F.lit(False))
    pred = singular_score() if c.args["predicate"] == "score" else singular_program()
    return F.coalesce(pred, F.lit(False))


def _report_row(c: Check, failures: Column) -> list[Column]:
    return [F.lit(c.model).alias("model"), F.lit(c.column if c.column else c.args.get("name")).alias("column_name"),
            F.lit(c.test).alias("test"), failures.cast("bigint").alias("failures")]


def _keyed_check(df: DataFrame, c: Check) -> DataFrame:
    """One grouped check as a one-row report: typed grouping on the checked column(s) only, so
    the scan reads just those columns and the shuffle carries narrow typed keys."""
    if c.test == "unique":
        failing = dq_unique(df.select(c.column), c.column)
    elif c.test == "unique_combination":
        cols = c.column.split(",")
        failing = dq_unique_combination(df.select(*cols), cols)
    else:
        failing = dq_accepted_values(df.select(c.column), c.column, c.args["values"])
    return failing.agg(*_report_row(c, F.count(F.lit(1))))


def _keyed_checks(df: DataFrame, cs: list[Check]) -> DataFrame:
    """unique, unique_combination and accepted_values checks of one model: independent typed
    aggregations, run as stages of one job."""
    return reduce(DataFrame.unionByName, [_keyed_check(df, c) for c in cs])


def _stack(one_row: DataFrame, cs: list[Check]) -> DataFrame:
    return one_row.select(F.explode(F.array(*[F.struct(*_report_row(c, F.coalesce(F.col(f"f{i}"), F.lit(0))))
                                              for i, c in enumerate(cs)])).alias("r")).select("r.*")


def _relationship_checks(child: DataFrame, cs: list[Check], models, lookup) -> DataFrame:
    """All relationship checks of one child model. Parents that are broadcast: one pass, a left join per foreign key to the
    parent's distinct keys (each flagged), then one count per key of unmatched values. Any other parent: the child's rows are
    counted by foreign key first, so that a key is moved once a task and not once a row."""
    small = [c for c in cs if lookup is not None and lookup.fits(models(c.args["to"]))]
    pieces = [_unmatched_by_value(child, c, models) for c in cs if c not in small]
    if small:
        x = child.select(*sorted({c.column for c in small}))
        for i, c in enumerate(small):
            keys = models(c.args["to"]).select(F.col(c.args["field"]).alias(f"_k{i}")).distinct().withColumn(f"_m{i}", F.lit(True))
            x = x.join(F.broadcast(keys), F.col(c.column) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        agg = x.agg(*[F.count(F.when(F.col(c.column).isNotNull() & F.col(f"_m{i}").isNull(), 1)).alias(f"f{i}")
                      for i, c in enumerate(small)])
        pieces.append(_stack(agg, small))
    return reduce(DataFrame.unionByName, pieces)


def _unmatched_by_value(child: DataFrame, c: Check, models) -> DataFrame:
    counts = child.filter(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("_n"))
    missing = dq_relationships(counts, c.column, models(c.args["to"]), c.args["field"])
    return missing.agg(*_report_row(c, F.coalesce(F.sum("_n"), F.lit(0))))


def run_suite(models: Callable[[str], DataFrame], checks=ALL_CHECKS, lookup=None, eager: bool = True,
              parallelism: int = 8) -> DataFrame:
    """Report (model, column_name, test, failures), one row per declared check.

    Per model: one aggregate pass for all row-level checks, one grouped pass for all unique /
    accepted_values checks; a grouped count per unique combination; an anti join per
    relationship, against the parent's distinct keys (broadcast when ``lookup`` finds the
    parent small).

    ``eager``: every part runs as its own small job (several submitted at once), is written
    under the shared work folder, and the report is the union of those tiny tables. One
    union over all parts would be one plan with a hundred branches, which adaptive execution
    re-plans at every stage boundary."""
    parts = suite_parts(models, checks, lookup)
    if not eager:
        return reduce(DataFrame.unionByName, parts)
    from concurrent.futures import ThreadPoolExecutor

    from coursemart.session import scratch_path
    spark = parts[0].sparkSession
    paths = [scratch_path(spark, "dq_part") for _ in parts]

    def write(i):
        parts[i].write.parquet(paths[i])
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(write, range(len(parts))))
    return spark.read.parquet(*paths)


def scans(checks) -> Counter:
    """How many scans of each model the suite makes: one for its row-level checks, one a keyed check, one for its
    relationships, one for each relationship to it."""
    own = {(c.model, "row" if c.test in _ROW_LEVEL else "rel" if c.test == "relationships" else c.column + c.test) for c in checks}
    return Counter([m for m, _ in own] + [c.args["to"] for c in checks if c.test == "relationships"])


def columns(checks, model: str) -> list[str]:
    """The columns of ``model`` that the suite reads, for models without row predicates of several columns."""
    own = [col for c in checks if c.model == model for col in (c.column or "raw_score").split(",")]
    return sorted({*own, *[c.args["field"] for c in checks if c.test == "relationships" and c.args["to"] == model]})


def suite_parts(models: Callable[[str], DataFrame], checks=ALL_CHECKS, lookup=None) -> list[DataFrame]:
    """One part per checked model (up to three scans of it: row-level, keyed, relationships)."""
    groups: dict[str, dict[str, list[Check]]] = {}
    for c in checks:
        kind = ("row" if c.test in _ROW_LEVEL else "rel" if c.test == "relationships" else "keyed")
        groups.setdefault(c.model, {}).setdefault(kind, []).append(c)
    parts: list[DataFrame] = []
    for model, kinds in groups.items():
        df = models(model)
        pieces = []
        if "row" in kinds:
            cs = kinds["row"]
            pieces.append(_stack(df.agg(*[F.sum(F.when(_row_condition(c), 1).otherwise(0)).alias(f"f{i}")
                                          for i, c in enumerate(cs)]), cs))
        if "keyed" in kinds:
            pieces.append(_keyed_checks(df, kinds["keyed"]))
        if "rel" in kinds:
            pieces.append(_relationship_checks(df, kinds["rel"], models, lookup))
        parts.append(reduce(DataFrame.unionByName, pieces))
    return parts
