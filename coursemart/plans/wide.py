"""The two large wide tables, refreshed by the semesters that a load touches.

Both are kept as rows partitioned by semester (``obt.subject_enrollment_rows``, ``obt.assessment_result_rows``); the model's
tables are views of them. What a coordinator's average is changes for nearly all rows with nearly every load, so
it is kept as a table of one row a coordinator, summed from the stored mark counts, and the view looks it up.

A refresh reads the facts that were loaded since the last finished one (noted with the rows) and the semesters that these touch,
and overwrites those partitions. Everything is rebuilt when there is no such note, when a dimension's row has changed or gone
(new ones touch no older row), or on a full refresh; a change of the model variables asks for a full refresh.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.exprs import ts_lit
from coursemart.operators import obt
from coursemart.plans.warehouse import Warehouse
from coursemart.sources.lake import Lake

#: the dimensions' columns that the wide tables hold
USED = {"dim_student": ["student_key", "student_id", "first_name", "last_name"],
        "dim_program": ["program_key", "program_id", "program_name"],
        "dim_subject_offering": ["offering_key", "offering_id", "coordinator_name", "subject_key", "semester_key"],
        "dim_subject": ["subject_key", "subject_code", "subject_title", "credit_points"],
        "dim_semester": ["semester_key", "semester_id", "semester_name", "academic_year", "start_date"],
        "dim_assessment": ["assessment_key", "offering_key", "title", "weight_percentage", "max_score"]}
SEMESTER = "semester_id"


def dimensions(lake: Lake) -> dict[str, tuple[str, DataFrame]]:
    """The dimensions as they are now, each with its version: taken before a run rebuilds them."""
    return {d: (lake.folder("warehouse", d).rsplit("/", 1)[1], lake.table("warehouse", d)) for d in USED if lake.exists("warehouse", d)}


def versions(dims: dict[str, tuple[str, DataFrame]]) -> str:
    return "-".join(dims[d][0] for d in USED) if set(USED) <= set(dims) else ""


def rows_kept(before: dict[str, tuple[str, DataFrame]], w: Warehouse) -> bool:
    """Every row of the dimensions before is there now, in the columns that matter."""
    gone = []
    for d, cols in USED.items():
        old, new = (df.select(F.xxhash64(F.lit(d), *cols).alias("h")) for df in (before[d][1], w.table(d)))
        gone.append(old.join(new, "h", "left_anti"))
    return reduce(DataFrame.unionByName, gone).isEmpty()


class Wide:
    """The wide tables of one run. ``before``: ``dimensions`` from before the run; ``since``: the facts' loads before it."""

    def __init__(self, lake: Lake, w: Warehouse, before: dict, since: dict[str, str | None], full_refresh: bool):
        self.lake, self.w, self.since, self.full = lake, w, since, full_refresh
        self.now = {f: str(lake.loaded_at("warehouse", f) or "") for f in since}
        self.dims_before, self.dims_now = versions(before), versions(dimensions(lake))
        self.before = before
        self._same: bool | None = None

    def _may_refresh(self, table: str, facts: list[str]) -> dict[str, str] | None:
        """What the stored rows were made from, if they can be carried on."""
        made = {} if self.full else self.lake.inputs("obt", table)
        if any(not made.get(f) for f in facts) or not self.dims_before or made.get("dims") != self.dims_before:
            return None
        return made if self.dimensions_kept() else None

    def dimensions_kept(self) -> bool:
        if self._same is None:
            self._same = bool(self.dims_before) and rows_kept(self.before, self.w)
        return self._same

    def _changed(self, fact: str, made: dict[str, str]) -> DataFrame:
        """The fact's rows loaded since then."""
        day, time = made[fact].split("T", 1)
        h, m, s = time.split(".", 2)
        return self.w.table(fact).filter(F.col("_loaded_at") > ts_lit(f"{day} {h}:{m}:{s}"))

    def _note(self, table: str, facts: list[str]) -> None:
        self.lake.note_inputs("obt", table, {**{f: self.now[f] for f in facts}, "dims": self.dims_now})

    def subject_enrollment(self) -> DataFrame:
        w, lake, facts = self.w, self.lake, ["fact_subject_enrollment"]
        dims = (w.dim_student(), w.dim_program(), w.dim_subject_offering(), w.dim_subject(), w.dim_semester())
        made = self._may_refresh("subject_enrollment_rows", facts)
        if made is None:
            rows, counts = obt.subject_tables(w.fact_subject_enrollment(), *dims, w.lk, w.p)
            lake.rebuild(rows, "obt", "subject_enrollment_rows", [SEMESTER])
            lake.rebuild(counts, "obt", "offering_marks", [SEMESTER])
        elif self.now[facts[0]].replace(" ", "T").replace(":", ".") != made[facts[0]]:
            rows, semesters, counts, counted = obt.refreshed_subjects(lake.table("obt", "subject_enrollment_rows"), self._changed(facts[0], made),
                                                                      *dims, w.lk, w.p)
            lake.overwrite_partitions(counts, "obt", "offering_marks", SEMESTER, counted)
            lake.overwrite_partitions(rows, "obt", "subject_enrollment_rows", SEMESTER, semesters)
        lake.rebuild(obt.coordinator_stats(lake.table("obt", "offering_marks"), w.p), "obt", "coordinator_marks")
        self._note("subject_enrollment_rows", facts)
        cols = ", ".join(f"r.`{c}`" for c in obt.SUBJECT_COLUMNS)
        return lake.view("obt", "obt_subject_enrollment", f"SELECT {cols}, c.coordinator_average_mark, TIMESTAMP_NTZ '{w.p.run_ts}' AS _loaded_at "
                         f"FROM {lake.name('obt', 'subject_enrollment_rows')} r LEFT JOIN {lake.name('obt', 'coordinator_marks')} c "
                         "ON r.coordinator_name = c.coordinator_name")

    def assessment_result(self) -> DataFrame:
        w, lake, facts = self.w, self.lake, ["fact_assessment_result", "fact_subject_enrollment"]
        dims = (w.dim_student(), w.dim_assessment(), w.dim_subject_offering(), w.dim_subject(), w.dim_semester())
        made = self._may_refresh("assessment_result_rows", facts)
        if made is None:
            lake.rebuild(obt.result_table(w.fact_assessment_result(), w.fact_subject_enrollment(), *dims, w.lk, w.p), "obt",
                         "assessment_result_rows", [SEMESTER])
        else:
            rows, semesters = obt.refreshed_results(lake.table("obt", "assessment_result_rows"), self._changed(facts[0], made),
                                                    self._changed(facts[1], made), w.fact_subject_enrollment(), *dims, w.lk, w.p)
            if semesters:
                lake.overwrite_partitions(rows, "obt", "assessment_result_rows", SEMESTER, semesters)
        self._note("assessment_result_rows", facts)
        cols = ", ".join(f"`{c}`" for c in obt.RESULT_COLUMNS)
        return lake.view("obt", "obt_assessment_result", f"SELECT {cols}, TIMESTAMP_NTZ '{w.p.run_ts}' AS _loaded_at "
                         f"FROM {lake.name('obt', 'assessment_result_rows')}")
