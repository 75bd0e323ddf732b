"""Incremental facts: latest version per id from the landed journal, keyed through the dims."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursemart.functions.exprs import key, ts_lit
from coursemart.operators.joins import Lookup
from coursemart.params import Params
from coursemart.session import known_rows, materialize

# Arrival order of journal rows: the landing time first, then the source's own
# update time, then the landing sequence when the landed table carries one.
ARRIVAL_ORDER = ["_ingested_at", "updated_at", "src_seq"]


def dedup_latest(df: DataFrame, pk, order=None) -> DataFrame:
    """Keep the latest row per ``pk`` (row_number() = 1 by arrival, newest first).

    Planned as a WindowGroupLimit: a partial limit runs before the shuffle, so even a
    key with a huge number of versions sends at most one row per map task. Rows without any of the order's
    columns are ordered by all their values, so that the same row stays whatever the partitions.
    """
    order = [c for c in (order or ARRIVAL_ORDER) if c in df.columns] or df.columns
    pk = [pk] if isinstance(pk, str) else list(pk)
    w = Window.partitionBy(*pk).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_few(df: DataFrame, pk: str, lk: Lookup) -> DataFrame:
    """``dedup_latest`` for a journal most of whose ids come once. The ids that come several times are looked for first, by the
    id alone; if they are few enough to broadcast, only their rows are moved and the others stay where they lie (in a plan
    dealt by another column this spares the join by it a shuffle). With more of them, all rows are moved."""
    several = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(F.col(pk).alias("_pk"))
    several = materialize(several, "ids_of_several_versions")
    if known_rows(several) == 0:
        return df
    if not lk.fits(several):
        return dedup_latest(df, pk)
    again = F.col(pk).eqNullSafe(F.col("_pk"))
    once = df.join(F.broadcast(several), again, "left_anti")
    return once.unionByName(dedup_latest(df.join(F.broadcast(several), again, "left_semi"), pk))


def each_once(df: DataFrame, pk: str, n: int) -> bool:
    """Whether no ``pk`` (NULL counts as one) comes several times, counted in ``n`` tasks."""
    counts = df.select(pk).repartition(n, pk).groupBy(pk).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.agg(F.max("_n")).first()[0] or 0) <= 1


def incremental_source(stg: DataFrame, since: str | None) -> DataFrame:
    """Journal rows that arrived after the target's last load (``since`` is a literal, so the
    predicate reaches the Parquet scan; on a journal partitioned by ingest date the implied
    date bound prunes the folders of earlier runs). ``None`` means first load / full refresh."""
    if since is None:
        return stg
    out = stg.filter(F.col("_ingested_at") > ts_lit(since))
    if "_ingest_date" in stg.columns:
        out = out.filter(F.col("_ingest_date") >= F.to_date(ts_lit(since)))
    return out


def parent_lookup(d: DataFrame, parent: DataFrame, id_col: str, key_col: str, p: Params, bucketed: bool = True) -> DataFrame:
    """Fact-to-fact: ``parent``'s columns by its natural id. The key, which follows from the id, is joined on as well, so a
    parent stored in buckets of its key is read where it lies and only ``d`` is shuffled (or broadcast by AQE). A parent
    that is not ``bucketed`` is shuffled too, by the id alone: the key would only make the rows longer."""
    if not bucketed:
        return d.join(parent, id_col, "left")
    side = parent.select(F.col(key_col).alias("_parent"), *parent.columns)
    return d.withColumn("_parent", key(d, id_col, p=p)).join(side, ["_parent", id_col], "left").drop("_parent")


def fact_program_enrollment(stg: DataFrame, d_student: DataFrame, d_program: DataFrame, lk: Lookup,
                            p: Params, since: str | None = None) -> DataFrame:
    d = dedup_latest(incremental_source(stg, since), "program_enrollment_id")
    d = lk.join(d, d_student, "student_id", cols=["student_id", "student_key"])
    d = lk.join(d, d_program, "program_id", cols=["program_id", "program_key"])
    return d.select(key(d, "program_enrollment_id", p=p).alias("program_enrollment_key"), "program_enrollment_id",
                    "student_key", "program_key", "enrollment_date", "completion_date", "status",
                    "final_degree_result", ts_lit(p.run_ts).alias("_loaded_at"))


def fact_subject_enrollment(stg: DataFrame, f_pe: DataFrame, d_offering: DataFrame, lk: Lookup,
                            p: Params, since: str | None = None, bucketed: bool = True) -> DataFrame:
    d = dedup_latest(incremental_source(stg, since), "subject_enrollment_id")
    pe = f_pe.select("program_enrollment_id", "program_enrollment_key", "student_key", "program_key")
    d = parent_lookup(d, pe, "program_enrollment_id", "program_enrollment_key", p, bucketed)
    d = lk.join(d, d_offering, "offering_id", cols=["offering_id", "offering_key", "subject_key"])
    return d.select(key(d, "subject_enrollment_id", p=p).alias("subject_enrollment_key"), "subject_enrollment_id",
                    "subject_key", "program_enrollment_key", "student_key", "program_key", "offering_key",
                    "status", "final_mark", "final_grade", ts_lit(p.run_ts).alias("_loaded_at"))


def fact_assessment_result(stg: DataFrame, f_se: DataFrame, d_assessment: DataFrame, lk: Lookup,
                           p: Params, since: str | None = None, bucketed: bool = True, also: tuple[str, ...] = (),
                           few: bool | None = False) -> DataFrame:
    """``also``: journal columns to keep beside the fact's own. ``few``: ids of several versions are looked for at once
    (``dedup_few``), for a fact that is surely read; None: every version stays, for a caller that looks for them itself."""
    src = incremental_source(stg, since)
    d = src if few is None else dedup_few(src, "result_id", lk) if few else dedup_latest(src, "result_id")
    se = f_se.select("subject_enrollment_id", "subject_enrollment_key", "subject_key", "student_key", "program_key")
    d = parent_lookup(d, se, "subject_enrollment_id", "subject_enrollment_key", p, bucketed)
    d = lk.join(d, d_assessment, "assessment_id", cols=["assessment_id", "assessment_key"])
    return d.select(key(d, "result_id", p=p).alias("result_key"), "result_id", "subject_enrollment_key",
                    "subject_key", "student_key", "program_key", "assessment_key", "raw_score", "submitted_at",
                    ts_lit(p.run_ts).alias("_loaded_at"), *also)
