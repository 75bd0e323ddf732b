"""Pipeline invariants: incremental runs ≡ full refresh (up to early-arriving children, which keep
NULL parent keys until they change again); facts unique per key; wide tables keep the fact grain
(left joins never fan out); the DQ report has one row per declared check."""

import tempfile
import uuid

from pyspark.sql import functions as F

from fixtures_small import SF_SMALL

from coursemart.functions.exprs import ts_lit
from coursemart.operators import dq
from coursemart.params import Params
from coursemart.plans import pipeline
from coursemart.plans.warehouse import Warehouse
from coursemart.session import list_folder
from coursemart.sources.binding import landed_tables
from coursemart.sources.staging import INCREMENTAL_TABLES
from coursemart.sources.lake import Lake

RUN1, RUN2 = "2002-01-01 00:00:00", "2002-01-02 00:00:00"
CUT = "1997-06-30 00:00:00"


def _sources(spark, root):
    out = {}
    for name, df in landed_tables(spark, SF_SMALL, Params()).items():
        df.drop("_ingested_at").write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def _lake(spark, root):
    return Lake(spark, root, prefix=f"t{uuid.uuid4().hex[:8]}_")


def _facts(lake):
    return {f: lake.table("warehouse", f).drop("_loaded_at") for f in pipeline.FACT_KEYS}


def test_incremental_equals_full_refresh(spark):
    scratch = tempfile.mkdtemp(prefix="cm-pipe-")
    src = _sources(spark, f"{scratch}/src")
    first = dict(src)
    for t in INCREMENTAL_TABLES:
        first[t] = src[t].filter(F.col("updated_at") <= ts_lit(CUT))

    inc = _lake(spark, f"{scratch}/inc")
    pipeline.run_pipeline(spark, first, inc, Params(run_ts=RUN1))
    rep = pipeline.run_pipeline(spark, src, inc, Params(run_ts=RUN2))
    assert str(rep.since["fact_subject_enrollment"]) == RUN1
    assert rep.landed["subject_enrollments"].mode == "incremental" and rep.landed["subject_enrollments"].rows > 0

    full = _lake(spark, f"{scratch}/full")
    pipeline.run_pipeline(spark, src, full, Params(run_ts=RUN2))

    a, b = _facts(inc), _facts(full)
    for f, key in pipeline.FACT_KEYS.items():
        assert a[f].count() == b[f].count(), f
        assert a[f].select(key).distinct().count() == a[f].count(), f"{f} not unique"
        # Early-arriving children: a row landed before its parent keeps NULL parent keys until
        # the row itself changes again (a full refresh repairs it). Every other row is equal.
        diff = a[f].exceptAll(b[f])
        assert diff.filter(F.col("program_key").isNotNull()).count() == 0, f
    assert a["fact_program_enrollment"].exceptAll(b["fact_program_enrollment"]).count() == 0

    # the wide tables, refreshed by semester, hold what a rebuild from the same facts gives
    staged = pipeline.stage_all(pipeline.read_landed(spark, inc.root))
    w = Warehouse(spark, staged, Params(run_ts=RUN2), snapshot=inc.table("snapshots", "dim_program"))
    for d in [*pipeline.DIMS, *pipeline.FACT_KEYS]:
        w.put(d, inc.table("warehouse", d))
    for o in ("obt_subject_enrollment", "obt_assessment_result", "obt_program_enrollment", "obt_program_summary"):
        got, want = inc.table("obt", o), w.table(o)
        doubles = [c for c, t in want.dtypes if t == "double"]
        got, want = (x.withColumns({c: F.round(c, 6) for c in doubles}).select(*want.columns) for x in (got, want))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), o
    made = inc.inputs("obt", "subject_enrollment_rows")
    assert made["fact_subject_enrollment"].startswith("2002-01-02") and len(list_folder(spark, f"{inc.folder('obt', 'subject_enrollment_rows')}/_inputs")) == 2

    for o, f in [("obt_subject_enrollment", "fact_subject_enrollment"),
                 ("obt_assessment_result", "fact_assessment_result"),
                 ("obt_program_enrollment", "fact_program_enrollment")]:
        assert inc.table("obt", o).count() == a[f].count(), o

    assert inc.table("warehouse", "dim_date").count() == 13149
    report = inc.table("dq", "report")
    assert report.count() == 100
    # every layer is a database; the staging views give the contract's columns
    assert spark.table(inc.name("staging", "stg_subject_enrollments")).count() == spark.table(inc.name("raw", "raw_subject_enrollments")).count()
    assert spark.table(inc.name("obt", "obt_program_summary")).count() > 0
    # the failures carried through two runs give the report of the whole suite
    def models(name):
        return staged[name[4:]] if name.startswith("stg_") else w.table(name)
    cols = ["model", "column_name", "test", "failures"]
    assert sorted(map(tuple, report.select(*cols).collect())) == sorted(map(tuple, dq.run_suite(models, lookup=w.lk).select(*cols).collect()))
    assert inc.inputs("dq", "failures")["fact_assessment_result"].startswith("2002-01-02")
    # the journals keep every landed version; their unique checks are not declared, so the facts pass
    bad = {(r.model, r.column_name, r.test) for r in report.filter("failures > 0").collect()}
    assert not any(m.startswith("fact_") and t == "unique" for m, _, t in bad)


def test_a_run_that_dies_can_be_started_again(spark, monkeypatch):
    scratch = tempfile.mkdtemp(prefix="cm-restart-")
    src = _sources(spark, f"{scratch}/src")
    lake, once = _lake(spark, f"{scratch}/lake"), _lake(spark, f"{scratch}/once")

    def die(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(lake, "upsert_delete_insert", die)         # after the snapshot and the dims
        try:
            pipeline.run_pipeline(spark, src, lake, Params(run_ts=RUN1))
            raise AssertionError("the run should have died")
        except RuntimeError as e:
            assert str(e) == "killed"
    pipeline.run_pipeline(spark, src, lake, Params(run_ts=RUN1))
    pipeline.run_pipeline(spark, src, once, Params(run_ts=RUN1))
    a, b = _facts(lake), _facts(once)
    assert all(a[f].exceptAll(b[f]).isEmpty() and b[f].exceptAll(a[f]).isEmpty() for f in pipeline.FACT_KEYS)
    assert lake.table("snapshots", "dim_program").count() == once.table("snapshots", "dim_program").count()
