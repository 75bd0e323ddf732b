"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their oracle SQL.

Every query reads the driver tables of ``sf_dir`` (through the binding) and runs its
operator over the whole input. Floating statistics are rounded to 6 places in both the
query and its oracle (sums of the same values in another order differ in the last bit).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.exprs import round_half_away
from coursemart.params import ORACLE_PARAMS
from coursemart.plans import oracle_sql as O
from coursemart.plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over ``sf_dir``, wired once per application (its dimensions and enrollment facts are written once)."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _WAREHOUSES:
        _WAREHOUSES[k] = Warehouse.from_driver(spark, sf_dir, ORACLE_PARAMS, keep=True)
    return _WAREHOUSES[k]


def r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: round_half_away(c, 6) for c in cols})


def r6_sql(cols_all: list[str], rounded: list[str]) -> str:
    return ", ".join(O.R6(c) + f" as {c}" if c in rounded else c for c in cols_all)


# ---------------------------------------------------------------------------------------
# dims and facts (whole tables)

for _name in ["dim_program", "dim_student", "dim_subject", "dim_semester", "dim_subject_offering", "dim_assessment",
              "fact_program_enrollment", "fact_subject_enrollment", "fact_assessment_result"]:
    def _mk(n):
        return lambda spark, sf_dir: wh(spark, sf_dir).table(n)
    register(_name, O.q(f"select * from {_name}"))(_mk(_name))


@register("dim_date", O.q("""
select d as full_date, extract(year from d)::int as year, extract(quarter from d)::int as quarter,
       extract(month from d)::int as month, monthname(d) as month_name, extract(dow from d)::int as day_of_week,
       dayname(d) as day_name, extract(dow from d)::int in (0, 6) as is_weekend, extract(day from d)::int as day_of_month,
       extract(week from d)::int as iso_week, date_trunc('month', d)::date as month_start,
       date_trunc('quarter', d)::date as quarter_start,
       case when extract(month from d)::int >= 7 then extract(year from d)::int + 1 else extract(year from d)::int end
         as fiscal_year
from (select unnest(generate_series(min(start_date), date '2035-12-31', interval '1 day'))::date as d
      from raw_semesters) s"""))
def q_dim_date(spark, sf_dir):
    """The calendar dimension from the first semester's start to the end of the warehouse's own span (2000-01-01 to
    2035-12-31, which it holds whole)."""
    from coursemart.operators.dims import dim_date
    w = wh(spark, sf_dir)
    lo = w.stg["semesters"].agg(F.min("start_date")).first()[0]
    return dim_date(spark, lo.isoformat())


# ---------------------------------------------------------------------------------------
# wide tables

O1_ROUND = ["program_average_mark_for_this_subject", "subject_pass_rate", "coordinator_average_mark"]
O1_COLS = ["subject_enrollment_key", "subject_enrollment_id", "program_enrollment_key", "student_id", "first_name",
           "last_name", "program_id", "program_name", "offering_id", "coordinator_name", "subject_code",
           "subject_title", "credit_points", "semester_id", "semester_name", "academic_year", "status", "final_mark",
           "final_grade", "attempt_number", "is_retake", "is_pass", "credit_points_earned", "class_size",
           "program_average_mark_for_this_subject", "subject_pass_rate", "rank_in_offering",
           "coordinator_average_mark", "_loaded_at"]


@register("obt_subject_enrollment", O.q(f"select {r6_sql(O1_COLS, O1_ROUND)} from obt_subject_enrollment"))
def q_obt_subject_enrollment(spark, sf_dir):
    return r6(wh(spark, sf_dir).obt_subject_enrollment(), O1_ROUND)


O2_ROUND = ["score_percentage", "assessment_average_score_for_offering", "assessment_pass_rate",
            "z_score_within_assessment"]
O2_COLS = ["result_key", "result_id", "student_id", "first_name", "last_name", "subject_code", "subject_title",
           "semester_id", "semester_name", "academic_year", "assessment_title", "weight_percentage", "max_score",
           "raw_score", "submitted_at", "final_mark", "final_grade", "score_percentage", "weighted_contribution",
           "assessment_average_score_for_offering", "assessment_pass_rate", "z_score_within_assessment",
           "score_band", "mark_trend_within_subject", "_loaded_at"]


@register("obt_assessment_result", O.q(f"select {r6_sql(O2_COLS, O2_ROUND)} from obt_assessment_result"))
def q_obt_assessment_result(spark, sf_dir):
    return r6(wh(spark, sf_dir).obt_assessment_result(), O2_ROUND)


@register("obt_program_enrollment", O.q("select * from obt_program_enrollment"))
def q_obt_program_enrollment(spark, sf_dir):
    return wh(spark, sf_dir).obt_program_enrollment()


@register("obt_program_summary", O.q("select * from obt_program_summary"))
def q_obt_program_summary(spark, sf_dir):
    return wh(spark, sf_dir).obt_program_summary()


# ---------------------------------------------------------------------------------------
# landing (each run lands into a fresh folder under the shared work folder)

from coursemart.functions.exprs import ts_lit  # noqa: E402
from coursemart.operators import derive, dq, facts as factops, obt as obtops, scd2  # noqa: E402
from coursemart.operators.joins import Lookup  # noqa: E402
from coursemart.plans import dashboards  # noqa: E402
from coursemart.session import materialize, materialize_in_buckets, scratch_path  # noqa: E402
from coursemart.sources import landing  # noqa: E402
from coursemart.sources.lake import Lake  # noqa: E402
from coursemart.sources.binding import read_driver  # noqa: E402
from coursemart.sources.staging import staged  # noqa: E402
from coursemart.streaming import stream  # noqa: E402

BUCKET_ROWS = 500_000


def own_lake(spark, name: str, rows: int = 0) -> Lake:
    """A lake of this query alone under the work folder, with buckets for ``rows`` rows: a task reads one bucket."""
    buckets = max(8, -(-rows // BUCKET_ROWS))
    return Lake(spark, scratch_path(spark, name), prefix=f"q{uuid.uuid4().hex[:10]}_", buckets=buckets)


# Fixed scenario clock for the landing / upsert / history queries.
RUN1, RUN2, RUN3 = "2024-01-16 00:00:00", "2024-02-01 00:00:00", "2024-02-02 00:00:00"
EVENTS_CUT = "2024-01-15 12:00:00"           # first landing sees events up to here ...
LATE_FROM = "2024-01-15 11:30:00"            # ... except 'error' events after this: they commit late
JOURNAL_CUT = "1998-01-01 00:00:00"          # subject-enrollment journal: base build / later batch

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_first_run(ev: DataFrame) -> DataFrame:
    late = (F.col("event_type") == "error") & (F.col("ts") > ts_lit(LATE_FROM))
    return ev.filter((F.col("ts") <= ts_lit(EVENTS_CUT)) & ~late)


FIRST_RUN_SQL = (f"select * from events where ts <= timestamp '{EVENTS_CUT}'"
                 f" and not (event_type = 'error' and ts > timestamp '{LATE_FROM}')")


def _two_landings(spark, sf_dir, force_full=False):
    target = scratch_path(spark, "raw_events")
    ev = read_driver(spark, sf_dir, "events")
    r1 = landing.land_incremental(spark, _events_first_run(ev), target, "ts", "event_id", RUN1, name="events")
    r2 = landing.land_incremental(spark, ev, target, "ts", "event_id", RUN2, force_full=force_full, name="events")
    return target, r1, r2


LANDED_SQL = f"""with landed1 as ({FIRST_RUN_SQL}),
wm as (select max(ts) as wm from landed1),
landed2 as (select e.* from events e, wm where e.ts > wm.wm - interval 10 minute
            and not exists (select 1 from landed1 l where l.event_id = e.event_id and l.ts = e.ts)),
landed as (select *, timestamp '{RUN1}' as _ingested_at from landed1
           union all select *, timestamp '{RUN2}' as _ingested_at from landed2)
"""


@register("land_incremental", LANDED_SQL + "select * from landed")
def q_land_incremental(spark, sf_dir):
    target, _, _ = _two_landings(spark, sf_dir)
    return spark.read.parquet(target)


@register("land_metrics", LANDED_SQL + "select _ingested_at, count(*) as rows_landed from landed group by _ingested_at")
def q_land_metrics(spark, sf_dir):
    """Rows landed per run, as each landing reports them (observed while writing)."""
    _, r1, r2 = _two_landings(spark, sf_dir)
    return spark.createDataFrame([(RUN1, r1.rows), (RUN2, r2.rows)], "run string, rows_landed long") \
        .select(F.col("run").cast("timestamp_ntz").alias("_ingested_at"), "rows_landed")


@register("watermark", f"with landed1 as ({FIRST_RUN_SQL}) select max(ts) as watermark from landed1")
def q_watermark(spark, sf_dir):
    target = scratch_path(spark, "raw_events")
    ev = read_driver(spark, sf_dir, "events")
    landing.land_incremental(spark, _events_first_run(ev), target, "ts", "event_id", RUN1, name="events")
    return spark.createDataFrame([(landing.watermark(spark, target, "ts"),)], "watermark timestamp_ntz")


@register("land_force_full", f"select *, timestamp '{RUN2}' as _ingested_at from events")
def q_land_force_full(spark, sf_dir):
    target, _, _ = _two_landings(spark, sf_dir, force_full=True)
    return spark.read.parquet(target)


STUDENT_COLS = "student_id, first_name, last_name, email, created_at"


@register("land_full", O.q(f"select {STUDENT_COLS}, timestamp '{RUN1}' as _ingested_at from raw_students"))
def q_land_full(spark, sf_dir):
    target = scratch_path(spark, "raw_students")
    src = wh(spark, sf_dir).stg["students"].drop("_ingested_at")
    landing.land_full(spark, src, target, RUN1, "students")
    return spark.read.parquet(target)


@register("land_empty_guard", O.q(f"select {STUDENT_COLS}, timestamp '{RUN1}' as _ingested_at from raw_students"))
def q_land_empty_guard(spark, sf_dir):
    target = scratch_path(spark, "raw_students")
    src = wh(spark, sf_dir).stg["students"].drop("_ingested_at")
    landing.land_full(spark, src, target, RUN1, "students")
    res = landing.land_full(spark, src.filter(F.lit(False)), target, RUN2, "students")
    assert res.mode == "skipped"
    return spark.read.parquet(target)


@register("insert_if_absent", O.q("""select offering_id, subject_code, semester_id,
  case when semester_id < 'SEM-1998' then coordinator_name else coordinator_name || ' (new intake)' end
    as coordinator_name
from raw_subject_offerings"""))
def q_insert_if_absent(spark, sf_dir):
    target = scratch_path(spark, "raw_subject_offerings")
    so = wh(spark, sf_dir).stg["subject_offerings"].drop("_ingested_at")
    landing.insert_if_absent(spark, so.filter(F.col("semester_id") < "SEM-1998"), target, ["offering_id"])
    intake = so.withColumn("coordinator_name", F.concat("coordinator_name", F.lit(" (new intake)")))
    # the batch carries every key twice: one row per key survives, existing keys are left alone
    landing.insert_if_absent(spark, intake.unionByName(intake), target, ["offering_id"])
    return spark.read.parquet(target)


SE_STG_COLS = ["subject_enrollment_id", "program_enrollment_id", "offering_id", "status", "final_mark",
               "final_grade", "updated_at", "_ingested_at"]


@register("stg_project", O.q(f"select {', '.join(SE_STG_COLS)} from stg_subject_enrollments"))
def q_stg_project(spark, sf_dir):
    return staged(wh(spark, sf_dir).stg["subject_enrollments"], "subject_enrollments").select(*SE_STG_COLS)


@register("incremental_filter", O.q(f"select * from stg_subject_enrollments where _ingested_at > timestamp '{JOURNAL_CUT}'"))
def q_incremental_filter(spark, sf_dir):
    """A first build at JOURNAL_CUT sees the journal up to then; the next build's source is
    what arrived after max(_loaded_at) of the target."""
    w = wh(spark, sf_dir)
    p1 = ORACLE_PARAMS.with_(run_ts=JOURNAL_CUT)
    stg = w.stg["subject_enrollments"]
    lake = own_lake(spark, "incremental_filter", stg.count())
    base = factops.fact_subject_enrollment(stg.filter(F.col("_ingested_at") <= ts_lit(JOURNAL_CUT)),
                                           w.fact_program_enrollment(), w.dim_subject_offering(), w.lk, p1)
    lake.upsert_delete_insert(base, "warehouse", "fact_subject_enrollment", "subject_enrollment_id", by="subject_enrollment_key")
    return factops.incremental_source(stg, lake.loaded_at("warehouse", "fact_subject_enrollment"))


@register("upsert_delete_insert", O.q("select * from fact_subject_enrollment"))
def q_upsert_delete_insert(spark, sf_dir):
    """Base = fact built from the journal up to a cut; batch = latest versions that arrived
    later; delete+insert by key gives the fact over the whole journal."""
    w = wh(spark, sf_dir)
    p = ORACLE_PARAMS
    stg = w.stg["subject_enrollments"]
    lake = own_lake(spark, "upsert_delete_insert", stg.count())
    base = factops.fact_subject_enrollment(stg.filter(F.col("_ingested_at") <= ts_lit(JOURNAL_CUT)),
                                           w.fact_program_enrollment(), w.dim_subject_offering(), w.lk, p)
    lake.upsert_delete_insert(base, "warehouse", "fact_subject_enrollment", "subject_enrollment_id", by="subject_enrollment_key")
    batch = factops.fact_subject_enrollment(stg, w.fact_program_enrollment(), w.dim_subject_offering(), w.lk, p,
                                            since=JOURNAL_CUT)
    return lake.upsert_delete_insert(batch, "warehouse", "fact_subject_enrollment", "subject_enrollment_id")


# ---------------------------------------------------------------------------------------
# SCD2 over three runs, on students (an entity that grows with the data; the programme
# snapshot of the warehouse uses the same operator): run 2 changes the e-mail of one segment
# and drops another segment from the source (hard delete, ignored); run 3 restores the source.

SCD_KEY, SCD_CHECK = "student_id", ["first_name", "last_name", "email"]
CHANGED_SEGMENT, DROPPED_SEGMENT = "BUILDING", "MACHINERY"


def _scd_runs(spark, sf_dir):
    w = wh(spark, sf_dir)
    src = w.stg["students"].select(SCD_KEY, *SCD_CHECK)
    snaps = scratch_path(spark, "student_snapshot")

    def run(cur, ts, prev_path, path):
        prev = spark.read.parquet(prev_path) if prev_path else None
        cur = cur.withColumn("_loaded_at", ts_lit(ts))
        scd2.scd2_snapshot(cur, prev, SCD_KEY, SCD_CHECK, ts).write.parquet(path)
        return path

    v1 = run(src, RUN1, None, f"{snaps}/v=1")
    changed = (src.filter(F.col("first_name") != DROPPED_SEGMENT)
               .withColumn("email", F.when(F.col("first_name") == CHANGED_SEGMENT, F.concat(F.lit("new."), "email"))
                           .otherwise(F.col("email"))))
    v2 = run(changed, RUN2, v1, f"{snaps}/v=2")
    v3 = run(src, RUN3, v2, f"{snaps}/v=3")
    return spark.read.parquet(v3)


def _scd_version_sql(ts, valid_to, email="email", where=""):
    vt = "cast(null as timestamp)" if valid_to is None else valid_to
    return (f"select md5(student_id || '|' || cast(timestamp '{ts}' as varchar)) as dbt_scd_id, student_id,"
            f" first_name, last_name, {email} as email, timestamp '{ts}' as _loaded_at,"
            f" timestamp '{ts}' as dbt_updated_at, timestamp '{ts}' as dbt_valid_from, {vt} as dbt_valid_to"
            f" from raw_students {where}")


_CHANGED = f"first_name = '{CHANGED_SEGMENT}'"
SCD_SQL = ("," + "scd_all as (" + _scd_version_sql(RUN1, f"case when {_CHANGED} then timestamp '{RUN2}' end")
           + " union all " + _scd_version_sql(RUN2, f"timestamp '{RUN3}'", "'new.' || email", f"where {_CHANGED}")
           + " union all " + _scd_version_sql(RUN3, None, "email", f"where {_CHANGED}") + ")")


def _scd_q(select):
    return O.PREFIX + SCD_SQL + "\n" + select


@register("scd2_snapshot", _scd_q("select * from scd_all"))
def q_scd2_snapshot(spark, sf_dir):
    return _scd_runs(spark, sf_dir)


@register("scd2_current", _scd_q("""select student_id, first_name, last_name, email, dbt_valid_from as effective_from
from scd_all where dbt_valid_to is null"""))
def q_scd2_current(spark, sf_dir):
    return scd2.scd2_current(_scd_runs(spark, sf_dir)).select(
        SCD_KEY, *SCD_CHECK, F.col("dbt_valid_from").alias("effective_from"))


@register("scd2_history", _scd_q("""select student_id, email, dbt_valid_from, dbt_valid_to,
  row_number() over (partition by student_id order by dbt_valid_from) as version from scd_all"""))
def q_scd2_history(spark, sf_dir):
    return scd2.scd2_history(_scd_runs(spark, sf_dir), SCD_KEY).select(SCD_KEY, "email", "dbt_valid_from", "dbt_valid_to", "version")


# ---------------------------------------------------------------------------------------
# single operators (each the operator's own output over the whole input)

def _sel(*cols):
    return ", ".join(cols)


@register("dedup_latest", O.q(f"select {', '.join(SE_STG_COLS)} from latest_subject_enrollments"))
def q_dedup_latest(spark, sf_dir):
    return factops.dedup_latest(wh(spark, sf_dir).stg["subject_enrollments"], "subject_enrollment_id") \
        .select(*SE_STG_COLS)


@register("attempt_number", O.q("select subject_enrollment_id, program_enrollment_key, subject_code, attempt_number,"
                                " is_retake from obt_subject_enrollment"))
def q_attempt_number(spark, sf_dir):
    return wh(spark, sf_dir).obt_subject_enrollment().select(
        "subject_enrollment_id", "program_enrollment_key", "subject_code", "attempt_number", "is_retake")


@register("rank_in_group", O.q("select subject_enrollment_id, offering_id, final_mark, rank_in_offering"
                               " from obt_subject_enrollment"))
def q_rank_in_group(spark, sf_dir):
    return wh(spark, sf_dir).obt_subject_enrollment().select(
        "subject_enrollment_id", "offering_id", "final_mark", "rank_in_offering")


@register("class_size", O.q("select class as offering_id, count(*) as class_size from subject_chain where class is not null"
                            " group by class"))
def q_class_size(spark, sf_dir):
    w = wh(spark, sf_dir)
    e = obtops.subject_enriched(w.fact_subject_enrollment(), w.dim_student(), w.dim_program(),
                                w.dim_subject_offering(), w.dim_subject(), w.dim_semester(), w.lk)
    ranks = obtops.offering_mark_ranks(obtops.mark_counts(e))
    sizes = ranks.groupBy("offering_key").agg(F.max("class_size").alias("class_size"))
    return w.lk.join(sizes, w.dim_subject_offering(), "offering_key", "inner",
                     cols=["offering_key", "offering_id"]).select("offering_id", "class_size")


@register("pass_rate", O.q(f"select subject_code, semester_id, {O.R6('program_average_mark_for_this_subject')} as"
                           f" program_average_mark_for_this_subject, {O.R6('subject_pass_rate')} as subject_pass_rate"
                           " from (select subject_code, semester_id, avg(final_mark) as program_average_mark_for_this_subject,"
                           " avg((final_mark >= 50)::int) as subject_pass_rate from obt_subject_enrollment"
                           " where final_mark is not null group by all) s"))
def q_pass_rate(spark, sf_dir):
    w = wh(spark, sf_dir)
    e = obtops.subject_enriched(w.fact_subject_enrollment(), w.dim_student(), w.dim_program(),
                                w.dim_subject_offering(), w.dim_subject(), w.dim_semester(), w.lk)
    st = obtops._weighted_mark_stats(obtops.mark_counts(e), ["subject_code", "semester_id"], w.p, "subject_pass_rate")
    return r6(st.withColumnRenamed("_avg", "program_average_mark_for_this_subject"),
              ["program_average_mark_for_this_subject", "subject_pass_rate"])


@register("group_stats_attach", O.q(f"select subject_enrollment_id, subject_code, semester_id,"
                                    f" {O.R6('program_average_mark_for_this_subject')} as program_average_mark_for_this_subject,"
                                    f" {O.R6('subject_pass_rate')} as subject_pass_rate from obt_subject_enrollment"))
def q_group_stats_attach(spark, sf_dir):
    return r6(wh(spark, sf_dir).obt_subject_enrollment().select(
        "subject_enrollment_id", "subject_code", "semester_id", "program_average_mark_for_this_subject",
        "subject_pass_rate"), ["program_average_mark_for_this_subject", "subject_pass_rate"])


@register("trend_vs_previous", O.q(f"select result_id, {O.R6('score_percentage')} as score_percentage,"
                                   " mark_trend_within_subject from obt_assessment_result"))
def q_trend_vs_previous(spark, sf_dir):
    return r6(wh(spark, sf_dir).obt_assessment_result().select(
        "result_id", "score_percentage", "mark_trend_within_subject"), ["score_percentage"])


@register("z_score", O.q(f"select result_id, {O.R6('assessment_average_score_for_offering')} as"
                         f" assessment_average_score_for_offering, {O.R6('z_score_within_assessment')} as"
                         " z_score_within_assessment, score_band from obt_assessment_result"))
def q_z_score(spark, sf_dir):
    return r6(wh(spark, sf_dir).obt_assessment_result().select(
        "result_id", "assessment_average_score_for_offering", "z_score_within_assessment", "score_band"),
        ["assessment_average_score_for_offering", "z_score_within_assessment"])


@register("credit_weighted_gpa", O.q(f"select program_enrollment_key, cast(total_retakes as bigint) as total_retakes,"
                                     f" cast(credits_earned as bigint) as credits_earned, {O.R6('program_gpa')} as"
                                     " gpa_raw from enrollment_credits"))
def q_credit_weighted_gpa(spark, sf_dir):
    a = obtops.subject_agg(wh(spark, sf_dir).obt_subject_enrollment())
    return r6(a.withColumn("total_retakes", F.col("total_retakes").cast("bigint"))
              .withColumn("credits_earned", F.col("credits_earned").cast("bigint")), ["gpa_raw"])


@register("last_activity", O.q("select * from enrollment_activity"))
def q_last_activity(spark, sf_dir):
    w = wh(spark, sf_dir)
    return obtops.last_activity(w.fact_subject_enrollment(), w.fact_assessment_result())


@register("multi_program", O.q("select * from student_programs"))
def q_multi_program(spark, sf_dir):
    return obtops.multi_program(wh(spark, sf_dir).fact_program_enrollment())


@register("program_cohort_counts", O.q("select program_id, cohort_year, total_enrolled_students, total_active_students,"
                                       " total_graduated_students, total_withdrawn_students from obt_program_summary"))
def q_program_cohort_counts(spark, sf_dir):
    return wh(spark, sf_dir).obt_program_summary().select(
        "program_id", "cohort_year", "total_enrolled_students", "total_active_students", "total_graduated_students",
        "total_withdrawn_students")


for _name, _col in [("duration_years", "actual_duration_years"), ("year_of_study", "current_year_of_study"),
                    ("expected_graduation", "expected_graduation_date")]:
    def _mk2(c):
        return lambda spark, sf_dir: wh(spark, sf_dir).obt_program_enrollment().select(
            "program_enrollment_id", "degree_level", "enrollment_date", "completion_date", c)
    register(_name, O.q(f"select program_enrollment_id, degree_level, enrollment_date, completion_date, {_col}"
                        " from obt_program_enrollment"))(_mk2(_col))


@register("surrogate_key", O.q(f"select student_id, {O.K('student_id')} as student_key,"
                               f" {O.K2('student_id', 'email')} as student_email_key from raw_students"))
def q_surrogate_key(spark, sf_dir):
    from coursemart.functions.exprs import key
    s = wh(spark, sf_dir).stg["students"]
    return s.select("student_id", key(s, "student_id", p=ORACLE_PARAMS).alias("student_key"),
                    key(s, "student_id", "email", p=ORACLE_PARAMS).alias("student_email_key"))


@register("dim_lookup_left", O.q("select subject_enrollment_id, subject_code, subject_title, credit_points"
                                 " from subject_chain left join raw_subjects on subj = subject_code"))
def q_dim_lookup_left(spark, sf_dir):
    w = wh(spark, sf_dir)
    return w.lk.join(w.fact_subject_enrollment().select("subject_enrollment_id", "subject_key"), w.dim_subject(),
                     "subject_key", cols=["subject_key", "subject_code", "subject_title", "credit_points"]) \
        .drop("subject_key")


@register("snowflake_hop", O.q("""select assessment_id, raw_subjects.subject_code, raw_semesters.semester_id, academic_year
from raw_assessments left join raw_subject_offerings using (offering_id)
left join raw_subjects on raw_subjects.subject_code = raw_subject_offerings.subject_code
left join raw_semesters on raw_semesters.semester_id = raw_subject_offerings.semester_id"""))
def q_snowflake_hop(spark, sf_dir):
    w = wh(spark, sf_dir)
    x = w.lk.join(w.dim_assessment().select("assessment_id", "offering_key"), w.dim_subject_offering(),
                  "offering_key", cols=["offering_key", "subject_key", "semester_key"])
    x = w.lk.join(x, w.dim_subject(), "subject_key", cols=["subject_key", "subject_code"])
    x = w.lk.join(x, w.dim_semester(), "semester_key", cols=["semester_key", "semester_id", "academic_year"])
    return x.select("assessment_id", "subject_code", "semester_id", "academic_year")


# ---------------------------------------------------------------------------------------
# derived marks and grades

@register("weighted_final_mark", O.q(f"""select r.subject_enrollment_id,
  {O.R6('sum(r.raw_score::double / r.max_score::double * r.weight_percentage::double)'
        ' / sum(r.weight_percentage::double) * 100.0')} as weighted_final_mark
from (select e.subject_enrollment_id, x.raw_score, x.max_score, x.weight_percentage
      from (select distinct subject_enrollment_id from raw_subject_enrollments) e
      left join (select * from raw_assessment_results join raw_assessments using (assessment_id)
                 where raw_score is not null and max_score > 0) x using (subject_enrollment_id)) r
group by r.subject_enrollment_id"""))
def q_weighted_final_mark(spark, sf_dir):
    w = wh(spark, sf_dir)
    return r6(derive.weighted_final_mark(w.stg["assessment_results"], w.stg["assessments"], w.stg["subject_enrollments"]),
              ["weighted_final_mark"])


@register("grade_from_mark", O.q(f"""select f.subject_enrollment_id, f.final_mark, dp.degree_level,
  {O.GRADE_SQL} as grade from fact_subject_enrollment f left join dim_program dp on f.program_key = dp.program_key"""))
def q_grade_from_mark(spark, sf_dir):
    w = wh(spark, sf_dir)
    x = w.lk.join(w.fact_subject_enrollment().select("subject_enrollment_id", "final_mark", "program_key"),
                  w.dim_program(), "program_key", cols=["program_key", "degree_level"]).drop("program_key")
    return derive.with_grade(x)


@register("final_degree_result", O.q("""select pe.program_enrollment_id, count(m) as completed_subjects,
  case when count(m) = 0 then null when sum(m) >= 85 * count(m) then 'High Distinction'
       when sum(m) >= 75 * count(m) then 'Distinction' when sum(m) >= 65 * count(m) then 'Merit' else 'Pass' end
    as final_degree_result
from (select distinct program_enrollment_id from raw_program_enrollments) pe
left join (select program_enrollment_id, final_mark as m from latest_subject_enrollments where status = 'Completed') s
  on s.program_enrollment_id = pe.program_enrollment_id
group by pe.program_enrollment_id"""))
def q_final_degree_result(spark, sf_dir):
    w = wh(spark, sf_dir)
    return derive.final_degree_result(factops.dedup_latest(w.stg["subject_enrollments"], "subject_enrollment_id"),
                                      w.stg["program_enrollments"])


# ---------------------------------------------------------------------------------------
# dashboards over the programme-enrollment wide table

_ACTIVE = "from obt_program_enrollment where status = 'Active'"


def _risk_sql(by):
    return O.q(f"""select {by}, count(*) as active_enrollments, count(case when is_at_risk then 1 end) as at_risk,
  count(case when not is_at_risk then 1 end) as on_track,
  round(count(case when is_at_risk then 1 end)::double / nullif(count(*), 0), 4) as at_risk_rate
{_ACTIVE} group by {by}""")


@register("dash_active_summary", O.q(f"select is_at_risk, count(*) as enrollments {_ACTIVE} group by is_at_risk"))
def q_dash_active_summary(spark, sf_dir):
    return dashboards.dash_active_summary(wh(spark, sf_dir).obt_program_enrollment())


@register("dash_graduation_trend", O.q("""select date_trunc('month', completion_date)::date as completion_month,
  count(*) as graduations from obt_program_enrollment where status = 'Graduated' group by 1"""))
def q_dash_graduation_trend(spark, sf_dir):
    return dashboards.dash_graduation_trend(wh(spark, sf_dir).obt_program_enrollment())


@register("dash_by_department", _risk_sql("department"))
def q_dash_by_department(spark, sf_dir):
    return dashboards.dash_by_department(wh(spark, sf_dir).obt_program_enrollment())


@register("dash_by_level", _risk_sql("degree_level"))
def q_dash_by_level(spark, sf_dir):
    return dashboards.dash_by_level(wh(spark, sf_dir).obt_program_enrollment())


@register("dash_by_grad_month", O.q(f"""select date_trunc('month', expected_graduation_date)::date as expected_graduation_month,
  count(*) as active_enrollments {_ACTIVE} group by 1"""))
def q_dash_by_grad_month(spark, sf_dir):
    return dashboards.dash_by_grad_month(wh(spark, sf_dir).obt_program_enrollment())


# ---------------------------------------------------------------------------------------
# data quality

def _dq_models(w: Warehouse, checks):
    """Resolver of checked model names; journals, results and latest versions that several scans read are written once (the other facts
    are by the warehouse)."""
    memo, scans = {}, dq.scans(checks)

    def once(df, name, by=None):
        if scans[name] <= 1:
            return df
        return materialize_in_buckets(df, name, by, w.buckets()) if by else materialize(df, name)

    def results(df, name):
        """The columns that checks read, and what the rows are dealt by: the results are the longest tables."""
        read = dq.columns(checks, name)
        return df.select(*[c for c in df.columns if c in read or c == "subject_enrollment_id"])

    def get(name):
        if name not in memo:
            # subject enrollments and results in buckets of the enrollment, as they are dealt already: checks by it move no rows
            if name == "stg_assessment_results":
                memo[name] = once(results(w.stg["assessment_results"], name), name, "subject_enrollment_id")
            elif name == "stg_program_enrollments":  # joins behind it
                memo[name] = once(w.stg["program_enrollments"], name)
            elif name.startswith("stg_"):
                memo[name] = w.stg[name[4:]]
            elif name == "src_assessment_results":
                latest = factops.dedup_few(w.stg["assessment_results"], "result_id", w.lk)
                memo[name] = once(results(latest, name), name, "subject_enrollment_id")
            elif name == "src_subject_enrollments":
                memo[name] = once(factops.dedup_latest(w.stg["subject_enrollments"], "subject_enrollment_id"), name, "subject_enrollment_id")
            elif name == "src_program_enrollments":
                memo[name] = once(factops.dedup_latest(w.stg["program_enrollments"], "program_enrollment_id"), name)
            elif name == "fact_assessment_result":
                memo[name] = once(results(w.assessment_results(few=w.keep_facts), name), name)
            else:
                memo[name] = w.table(name)
        return memo[name]
    return get


def _dq_query(checks):
    def run(spark, sf_dir):
        w = wh(spark, sf_dir)
        return dq.run_suite(_dq_models(w, checks), checks, w.lk)
    return run


for _test in ["unique", "not_null", "relationships", "accepted_values", "accepted_range", "unique_combination"]:
    _cs = [c for c in dq.ALL_CHECKS if c.test == _test]
    register(f"dq_{_test}", O.dq_report_sql([c for c in O.EXPECTED_CHECKS if c.test == _test]))(_dq_query(_cs))

register("dq_suite", O.dq_report_sql(O.EXPECTED_CHECKS))(_dq_query(dq.ALL_CHECKS))
register("dq_contract", O.dq_report_sql(O.EXPECTED_CONTRACT))(_dq_query(dq.CONTRACT_CHECKS))


@register("dq_singular_score", O.q("select * from fact_assessment_result where raw_score < 0 or raw_score > 200"))
def q_dq_singular_score(spark, sf_dir):
    return dq.dq_singular(wh(spark, sf_dir).fact_assessment_result(), dq.singular_score())


@register("dq_singular_program", O.q(f"select * from fact_program_enrollment where {O.SINGULAR_PROGRAM}"))
def q_dq_singular_program(spark, sf_dir):
    return dq.dq_singular(wh(spark, sf_dir).fact_program_enrollment(), dq.singular_program())


# ---------------------------------------------------------------------------------------
# streaming (file drops under the work folder, availableNow triggers)

@register("stream_land_dedup", f"select *, timestamp '{RUN1}' as _ingested_at from events")
def q_stream_land_dedup(spark, sf_dir):
    """Drops of events in order of their time, each with the last ten minutes of the one before once more, one file per
    micro-batch. The stream lands every event once."""
    base = scratch_path(spark, "stream_land")
    ev = read_driver(spark, sf_dir, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    cuts = [lo + (hi - lo) * k / 4 for k in range(1, 4)]
    edges = [None, *cuts, None]
    back = F.expr("INTERVAL 10 MINUTES")
    for k in range(4):
        drop = ev
        if edges[k] is not None:
            drop = drop.filter(F.col("ts") > ts_lit(str(edges[k])) - back)
        if edges[k + 1] is not None:
            drop = drop.filter(F.col("ts") <= ts_lit(str(edges[k + 1])))
        drop.coalesce(1).write.parquet(f"{base}/src/d{k}")
    schema = spark.read.parquet(f"{base}/src/d0").schema
    stream.land_stream(spark, f"{base}/src/*", schema, f"{base}/out", f"{base}/ckpt", "ts", "event_id", RUN1,
                       max_files_per_trigger=1)
    return spark.read.parquet(f"{base}/out")


@register("stream_upsert", O.q(f"select {', '.join(SE_STG_COLS)}, src_seq from latest_subject_enrollments"))
def q_stream_upsert(spark, sf_dir):
    """The subject-enrollment journal arrives in three drops by landing time; each
    micro-batch is merged into the table by key; the result is the latest version per id."""
    base = scratch_path(spark, "stream_upsert")
    j = wh(spark, sf_dir).stg["subject_enrollments"]
    ing = F.col("_ingested_at")
    j.filter(ing < ts_lit("1996-01-01 00:00:00")).write.parquet(f"{base}/src/d1")
    j.filter((ing >= ts_lit("1996-01-01 00:00:00")) & (ing < ts_lit(JOURNAL_CUT))).write.parquet(f"{base}/src/d2")
    j.filter(ing >= ts_lit(JOURNAL_CUT)).write.parquet(f"{base}/src/d3")
    schema = spark.read.parquet(f"{base}/src/d1").schema
    lake = own_lake(spark, "stream_upsert_lake", j.count())
    # each merge rewrites the touched buckets: the journal comes in about three of them, however many files it has
    files = len(spark.read.parquet(f"{base}/src/*").inputFiles())
    stream.upsert_stream(spark, f"{base}/src/*", schema, lake, "warehouse", "latest", f"{base}/ckpt", "subject_enrollment_id",
                         max_files_per_trigger=max(2, -(-files // 3)))
    return lake.table("warehouse", "latest").select(*SE_STG_COLS, "src_seq")


# ---------------------------------------------------------------------------------------
# staging projections, and quality operators on rows of the driver tables that do violate them

from coursemart.sources.staging import INCREMENTAL_TABLES, SOURCE_SCHEMAS  # noqa: E402

for _t in [t for t in SOURCE_SCHEMAS if t != "subject_enrollments"]:
    _cols = [f.name for f in SOURCE_SCHEMAS[_t].fields] + ["_ingested_at"]

    def _mk3(t, cols):
        return lambda spark, sf_dir: wh(spark, sf_dir).stg[t].select(*cols)
    # full-reload tables are stamped with the run's time
    _sql = [c if c != "_ingested_at" or _t in INCREMENTAL_TABLES else f"{O.TS} as {c}" for c in _cols]
    register(f"stg_{_t}", O.q(f"select {', '.join(_sql)} from raw_{_t}"))(_mk3(_t, _cols))


@register("dq_rows_unique", O.q("""select subject_enrollment_id, count(*) as n_records from raw_subject_enrollments
where subject_enrollment_id is not null group by 1 having count(*) > 1"""))
def q_dq_rows_unique(spark, sf_dir):
    """Ids that the journal holds in several versions."""
    return dq.dq_unique(wh(spark, sf_dir).stg["subject_enrollments"], "subject_enrollment_id")


@register("dq_rows_not_null", O.q("select subject_enrollment_id, status from latest_subject_enrollments where final_mark is null"))
def q_dq_rows_not_null(spark, sf_dir):
    """Enrollments without a final mark."""
    w = wh(spark, sf_dir)
    return dq.dq_not_null(factops.dedup_latest(w.stg["subject_enrollments"], "subject_enrollment_id"), "final_mark") \
        .select("subject_enrollment_id", "status")


@register("dq_rows_relationships", O.q(f"""select subject_enrollment_id, program_enrollment_id from raw_subject_enrollments
where program_enrollment_id not in (select program_enrollment_id from raw_program_enrollments
                                    where _ingested_at <= timestamp '{JOURNAL_CUT}')"""))
def q_dq_rows_relationships(spark, sf_dir):
    """Subject enrollments whose programme enrollment had not arrived at the cut."""
    w = wh(spark, sf_dir)
    arrived = w.stg["program_enrollments"].filter(F.col("_ingested_at") <= ts_lit(JOURNAL_CUT))
    return dq.dq_relationships(w.stg["subject_enrollments"], "program_enrollment_id", arrived, "program_enrollment_id") \
        .select("subject_enrollment_id", "program_enrollment_id")


@register("dq_rows_accepted_values", O.q("""select status, count(*) as n_records from raw_subject_enrollments
where status <> 'Enrolled' group by status"""))
def q_dq_rows_accepted_values(spark, sf_dir):
    """Statuses other than that of a running enrollment, with their rows."""
    return dq.dq_accepted_values(wh(spark, sf_dir).stg["subject_enrollments"], "status", ["Enrolled"])


@register("dq_rows_accepted_range", O.q("""select result_id, raw_score from raw_assessment_results
where raw_score < 40 or raw_score > 60"""))
def q_dq_rows_accepted_range(spark, sf_dir):
    """Scores outside a band that many leave."""
    return dq.dq_accepted_range(wh(spark, sf_dir).stg["assessment_results"], "raw_score", 40, 60).select("result_id", "raw_score")


@register("dq_rows_singular", O.q(f"""select program_enrollment_id, status from (
  select *, if(status = 'Withdrawn', null, {O.K('student_id')}) as student_key from raw_program_enrollments) f
where {O.SINGULAR_PROGRAM}"""))
def q_dq_rows_singular(spark, sf_dir):
    """The singular programme check over the journal, where withdrawn enrollments are taken to have no student."""
    from coursemart.functions.exprs import key
    j = wh(spark, sf_dir).stg["program_enrollments"]
    j = j.withColumn("student_key", F.when(F.coalesce(F.col("status") != "Withdrawn", F.lit(True)), key(j, "student_id", p=ORACLE_PARAMS)))
    return dq.dq_singular(j, dq.singular_program()).select("program_enrollment_id", "status")


@register("dq_rows_unique_combination", O.q("""select program_enrollment_id, offering_id, count(*) as n_records from raw_subject_enrollments
group by 1, 2 having count(*) > 1"""))
def q_dq_rows_unique_combination(spark, sf_dir):
    """(programme enrollment, offering) pairs that the journal holds more than once."""
    return dq.dq_unique_combination(wh(spark, sf_dir).stg["subject_enrollments"], ["program_enrollment_id", "offering_id"])


@register("dq_rows_singular_score", O.q("""select result_id, raw_score * 4 - 60 as raw_score from raw_assessment_results
where raw_score * 4 - 60 < 0 or raw_score * 4 - 60 > 200"""))
def q_dq_rows_singular_score(spark, sf_dir):
    """The singular score check over scores on a wider scale, of which some leave 0 to 200 on either side."""
    r = wh(spark, sf_dir).stg["assessment_results"].withColumn("raw_score", F.col("raw_score") * 4 - 60)
    return dq.dq_singular(r, dq.singular_score()).select("result_id", "raw_score")


@register("dim_date_of_facts", O.q("""select d as full_date, extract(year from d)::int as year, extract(dow from d)::int as day_of_week,
       case when extract(month from d)::int >= 7 then extract(year from d)::int + 1 else extract(year from d)::int end as fiscal_year,
       coalesce(e.n, 0) as enrollments, coalesce(r.n, 0) as results
from (select unnest(generate_series(least((select min(enrollment_date) from fact_program_enrollment), (select min(submitted_at)::date from fact_assessment_result)),
                                    greatest((select max(coalesce(completion_date, enrollment_date)) from fact_program_enrollment),
                                             (select max(enrollment_date) from fact_program_enrollment),
                                             (select max(submitted_at)::date from fact_assessment_result)), interval '1 day'))::date as d) s
left join (select enrollment_date as d1, count(*) as n from fact_program_enrollment group by 1) e on e.d1 = d
left join (select submitted_at::date as d2, count(*) as n from fact_assessment_result group by 1) r on r.d2 = d"""))
def q_dim_date_of_facts(spark, sf_dir):
    """The calendar over all days that the facts span, with what happened on each day."""
    from coursemart.operators.dims import dim_date
    w = wh(spark, sf_dir)
    pe, ar = w.fact_program_enrollment(), w.fact_assessment_result().select(F.to_date("submitted_at").alias("d"))
    ar = materialize(ar.groupBy("d").agg(F.count(F.lit(1)).alias("n")), "results_by_day")  # read twice: one row a day
    a = pe.agg(F.min("enrollment_date"), F.greatest(F.max("enrollment_date"), F.max("completion_date"))).first()
    b = ar.agg(F.min("d"), F.max("d")).first()
    days = dim_date(spark, min(a[0], b[0]).isoformat(), max(a[1], b[1]).isoformat()).select("full_date", "year", "day_of_week", "fiscal_year")
    e = pe.groupBy(F.col("enrollment_date").alias("full_date")).agg(F.count(F.lit(1)).alias("enrollments"))
    r = ar.filter(F.col("d").isNotNull()).select(F.col("d").alias("full_date"), F.col("n").alias("results"))
    return days.join(e, "full_date", "left").join(r, "full_date", "left").fillna(0, ["enrollments", "results"])


@register("surrogate_key_default", O.q("""select student_id, count(*) as rows_by_key, count(*) as rows_by_id from raw_program_enrollments
group by student_id"""))
def q_surrogate_key_default(spark, sf_dir):
    """Rows per student found by joining on the default (xxhash64) key and on the id itself."""
    from coursemart.functions.exprs import key
    from coursemart.params import Params
    w, p = wh(spark, sf_dir), Params()
    s, e = w.stg["students"], w.stg["program_enrollments"].select("student_id")
    keys = s.select("student_id", key(s, "student_id", p=p).alias("k"))
    by_key = keys.join(e.select(key(e, "student_id", p=p).alias("k")), "k").groupBy("student_id").agg(F.count(F.lit(1)).alias("rows_by_key"))
    return by_key.join(e.groupBy("student_id").agg(F.count(F.lit(1)).alias("rows_by_id")), "student_id")
