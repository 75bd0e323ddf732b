"""Wires the models together: staging → SCD2 → dims → facts → wide tables.

Every model is a memoized DataFrame. Dimensions are small by nature and are materialized
(written once under the shared work folder) so that their size check is a cheap scan, they
are computed once, and every fact join can broadcast them. Facts and wide tables stay lazy
here; ``plans.pipeline`` writes them as tables. ``keep_facts``: the enrollment facts, which every
later model reads more than once, are written once as well, and the results where a model reads them several times.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.exprs import key
from coursemart.operators import dims, facts, obt, scd2
from coursemart.operators.joins import Lookup
from coursemart.params import Params
from coursemart.session import buckets_for, materialize, materialize_in_buckets, work_root
from coursemart.sources.binding import Tables, landed_tables
from coursemart.sources.staging import staged


class Warehouse:
    def __init__(self, spark: SparkSession, staged: dict[str, DataFrame], p: Params,
                 snapshot: DataFrame | None = None, since: dict[str, str | None] | None = None,
                 materialize_dims: bool = True, keep_facts: bool = False, buckets: Callable[[], int] | None = None):
        self.spark = spark
        self.stg = staged
        self.p = p
        self.lk = Lookup(p)
        self._snapshot = snapshot
        self.since = since or {}
        self.materialize_dims = materialize_dims
        self.keep_facts = keep_facts
        self.buckets = buckets or (lambda: buckets_for(staged["subject_enrollments"].count()))
        self._memo: dict[str, DataFrame] = {}
        if materialize_dims:
            work_root(spark)

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, p: Params, keep: bool = False, **kw) -> "Warehouse":
        """``keep``: what several models read (the journals' common rows, the enrollment facts) is written once."""
        landed = landed_tables(spark, sf_dir, p, keep)
        staged_later = Tables({t: partial(lambda t: staged(landed[t], t), t) for t in landed})
        return cls(spark, staged_later, p, keep_facts=keep, buckets=landed.buckets, **kw)

    def _get(self, name, build, dim=False, fact=False):
        if name not in self._memo:
            df = build()
            if dim and self.materialize_dims or fact and self.keep_facts:
                df = materialize(df, name)
            self._memo[name] = df
        return self._memo[name]

    # SCD2 ------------------------------------------------------------------------------
    def snapshot(self) -> DataFrame:
        def build():
            src = scd2.program_snapshot_source(self.stg["programs"], self.p)
            return scd2.scd2_snapshot(src, self._snapshot, scd2.PROGRAM_KEY, scd2.PROGRAM_CHECK_COLS, self.p.run_ts)
        return self._get("snapshot", build)

    # dims ------------------------------------------------------------------------------
    def dim_program(self):
        return self._get("dim_program", lambda: dims.dim_program(self.snapshot(), self.p), dim=True)

    def dim_student(self):
        return self._get("dim_student", lambda: dims.dim_student(self.stg["students"], self.p), dim=True)

    def dim_subject(self):
        return self._get("dim_subject", lambda: dims.dim_subject(self.stg["subjects"], self.p), dim=True)

    def dim_semester(self):
        return self._get("dim_semester", lambda: dims.dim_semester(self.stg["semesters"], self.p), dim=True)

    def dim_subject_offering(self):
        return self._get("dim_subject_offering", lambda: dims.dim_subject_offering(
            self.stg["subject_offerings"], self.dim_subject(), self.dim_semester(), self.lk, self.p), dim=True)

    def dim_assessment(self):
        return self._get("dim_assessment", lambda: dims.dim_assessment(
            self.stg["assessments"], self.dim_subject_offering(), self.lk, self.p), dim=True)

    def dim_date(self):
        return self._get("dim_date", lambda: dims.dim_date(self.spark))

    # facts -----------------------------------------------------------------------------
    def fact_program_enrollment(self):
        return self._get("fact_program_enrollment", lambda: facts.fact_program_enrollment(
            self.stg["program_enrollments"], self.dim_student(), self.dim_program(), self.lk, self.p,
            self.since.get("fact_program_enrollment")), fact=True)

    def fact_subject_enrollment(self):
        return self._get("fact_subject_enrollment", lambda: facts.fact_subject_enrollment(
            self.stg["subject_enrollments"], self.fact_program_enrollment(), self.dim_subject_offering(), self.lk,
            self.p, self.since.get("fact_subject_enrollment"), bucketed=not self.keep_facts), fact=True)

    def assessment_results(self, *also: str, few: bool | None = False) -> DataFrame:
        return facts.fact_assessment_result(
            self.stg["assessment_results"], self.fact_subject_enrollment(), self.dim_assessment(), self.lk, self.p,
            self.since.get("fact_assessment_result"), bucketed=not self.keep_facts, also=also, few=few)

    def fact_assessment_result(self):
        return self._get("fact_assessment_result", self.assessment_results)

    # wide tables -----------------------------------------------------------------------
    def obt_subject_enrollment(self):
        return self._get("obt_subject_enrollment", lambda: obt.obt_subject_enrollment(
            self.fact_subject_enrollment(), self.dim_student(), self.dim_program(), self.dim_subject_offering(),
            self.dim_subject(), self.dim_semester(), self.lk, self.p,
            self.fact_program_enrollment() if self.keep_facts else None))

    def _results_kept(self) -> DataFrame:
        """The results for models that read them several times, in buckets of their subject enrollment's id."""
        if not self.keep_facts:
            return self.fact_assessment_result()

        def build():
            # without the key that follows from the id and is the widest column of all
            own = [c for c in obt.RESULT_INPUT if c != "result_key"]
            parent = "subject_enrollment_id"

            def kept(few: bool | None) -> DataFrame:
                return materialize_in_buckets(self.assessment_results(parent, few=few).select(*own, parent), "results_kept", parent, self.buckets())

            # taken as they are: whether an id comes twice is read from the one column written, not derived once more (the joins
            # lose no row, so an id that comes once here comes once in the journal). If one does, the latest versions are written
            rows = kept(few=None)
            if not facts.each_once(rows, "result_id", self.buckets()):
                rows = kept(few=True)
            # the id stands for the key where each has one; results without their parent are one group by key
            if not rows.filter(F.col("subject_enrollment_key").isNull() & F.col(parent).isNotNull()).isEmpty():
                rows = rows.drop(parent)
            return rows.withColumn("result_key", key(rows, "result_id", p=self.p))
        return self._get("results_kept", build)

    def obt_assessment_result(self):
        return self._get("obt_assessment_result", lambda: obt.obt_assessment_result(
            self._results_kept(), self.fact_subject_enrollment(), self.dim_student(), self.dim_assessment(),
            self.dim_subject_offering(), self.dim_subject(), self.dim_semester(), self.lk, self.p,
            built_together=self.keep_facts))

    def obt_program_enrollment(self):
        return self._get("obt_program_enrollment", lambda: obt.obt_program_enrollment(
            self.fact_program_enrollment(), self.fact_subject_enrollment(), self.fact_assessment_result(),
            self.obt_subject_enrollment(), self.dim_student(), self.dim_program(), self.lk, self.p))

    def obt_program_summary(self):
        return self._get("obt_program_summary", lambda: obt.obt_program_summary(self.obt_program_enrollment(), self.p))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Replace a model by its materialized table (later models read the table)."""
        self._memo[name] = df
        return df

    def forget(self, name: str) -> None:
        self._memo.pop(name, None)
