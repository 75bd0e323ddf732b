"""End-to-end build: land → SCD2 snapshot → dims → incremental facts → wide tables → DQ.

Each layer is a database of named tables (``sources.lake``), its files under ``root`` (a shared folder on a cluster):

    raw.raw_<table>                 views of the landed journals and full reloads (Parquet)
    staging.stg_<table>             views: the contract's columns of a raw table
    snapshots.dim_program           SCD2 history, rebuilt per run from the one before
    warehouse.<dim|fact>            dims rebuilt per run; facts upserted in buckets of their keys
    obt.<table>                     wide tables: the two large ones refreshed by semester (``plans.wide``), the others rebuilt
    dq.report                       data-quality report, rebuilt per run

A run that fails leaves tables that serve readers and can be started again.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.exprs import ts_lit
from coursemart.operators import dq, dq_carry
from coursemart.operators.facts import incremental_source
from coursemart.params import Params
from coursemart.plans.warehouse import Warehouse
from coursemart.plans.wide import Wide, dimensions
from coursemart.sources import landing
from coursemart.sources.lake import Lake
from coursemart.sources.staging import FULL_TABLES, INCREMENTAL_TABLES, SOURCE_SCHEMAS, check_schema, stage_all, staged_columns

DIMS = ["dim_student", "dim_subject", "dim_semester", "dim_program", "dim_subject_offering", "dim_assessment",
        "dim_date"]
# upserts match on the natural id, not on the hashed surrogate key
FACT_KEYS = {"fact_program_enrollment": "program_enrollment_id",
             "fact_subject_enrollment": "subject_enrollment_id",
             "fact_assessment_result": "result_id"}
# the key whose buckets a fact lies in: results lie with their subject enrollment, so joining the two moves neither
FACT_BUCKETS = {"fact_program_enrollment": "program_enrollment_key",
                "fact_subject_enrollment": "subject_enrollment_key",
                "fact_assessment_result": "subject_enrollment_key"}
OBT_PARTITIONS = {"obt_program_enrollment": ["status"]}  # what the dashboards filter by
SKEW, SKEW_ROWS = 4, 1_000_000


@dataclass
class RunReport:
    timings: dict = field(default_factory=dict)
    landed: dict = field(default_factory=dict)
    since: dict = field(default_factory=dict)


def _timed(rep: RunReport, name: str, fn):
    t0 = time.perf_counter()
    out = fn()
    rep.timings[name] = round(time.perf_counter() - t0, 3)
    return out


def bucket_key(lake: Lake, fact: str, staged: dict[str, DataFrame]) -> tuple[str, bool]:
    """(column whose buckets the fact gets, whether a row's bucket never changes). Results of which one subject enrollment has
    so many that its bucket would hold several times the others' are laid out by their own key instead; their join is
    then a shuffle join, whose skewed partitions AQE splits."""
    own = {"fact_assessment_result": "result_key"}.get(fact, FACT_BUCKETS[fact])
    if own == FACT_BUCKETS[fact]:
        return own, True
    held = (staged["assessment_results"].groupBy(F.pmod(F.xxhash64("subject_enrollment_id"), F.lit(lake.buckets)).alias("b"))
            .agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first())
    uneven = (held["most"] or 0) > max(SKEW_ROWS, SKEW * held["all"] / lake.buckets if held["all"] else 0)
    return (own, True) if uneven else (FACT_BUCKETS[fact], False)


def land(spark: SparkSession, sources: dict[str, DataFrame], root: str, p: Params, force_full: bool = False,
         rep: RunReport | None = None) -> RunReport:
    """Land the seven full-reload tables and the three incremental journals (fail-fast; every source is checked
    against its contract before anything is written)."""
    rep = rep or RunReport()
    for t in [*FULL_TABLES, *INCREMENTAL_TABLES]:
        check_schema(sources[t], SOURCE_SCHEMAS[t])
    for t in FULL_TABLES:
        rep.landed[t] = landing.land_full(spark, sources[t], f"{root}/raw/raw_{t}", p.run_ts, t)
    for t, spec in INCREMENTAL_TABLES.items():
        rep.landed[t] = landing.land_incremental(spark, sources[t], f"{root}/raw/raw_{t}", spec["cursor"], spec["pk"],
                                                 p.run_ts, p.lookback_minutes, force_full, t, by_ingest_date=True)
    return rep


def read_landed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{root}/raw/raw_{t}") for t in list(FULL_TABLES) + list(INCREMENTAL_TABLES)}


def layer_views(lake: Lake) -> None:
    """The landed tables and their staging projections by name."""
    for t in [*FULL_TABLES, *INCREMENTAL_TABLES]:
        if not lake.exists("raw", f"raw_{t}"):
            lake.spark.sql(f"CREATE VIEW {lake.name('raw', f'raw_{t}')} AS SELECT * FROM parquet.`{lake.root}/raw/raw_{t}`")
            cols = ", ".join(f"`{c}`" for c in staged_columns(lake.spark.table(lake.name("raw", f"raw_{t}")), t))
            lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.name('staging', f'stg_{t}')} AS SELECT {cols} FROM {lake.name('raw', f'raw_{t}')}")


def check_quality(lake: Lake, staged: dict[str, DataFrame], w: Warehouse, wide: Wide, since: dict[str, str | None]) -> DataFrame:
    """The declared suite: the small models whole, journals and facts by what this run loaded, with the failures before it
    carried (``operators.dq_carry``). All rows count as loaded when there is no finished check of the run before, or a
    dimension has lost a row."""
    def models(name):
        return staged[name[4:]] if name.startswith("stg_") else w.table(name)

    facts = {f: FACT_KEYS[f] for f in FACT_KEYS}
    now = {f: str(lake.loaded_at("warehouse", f) or "").replace(" ", "T").replace(":", ".") for f in facts}
    made = lake.inputs("dq", "failures")
    carried = not wide.full and all(made.get(f) and since[f] and made[f] == str(since[f]).replace(" ", "T").replace(":", ".") for f in facts) \
        and made.get("dims") == wide.dims_before and wide.dimensions_kept()
    loads = {}
    for f, key in facts.items():
        journal = staged[f"{f[5:]}s"]
        loads[f"stg_{f[5:]}s"] = dq_carry.Load(journal, incremental_source(journal, since[f]) if carried else journal, None, not carried)
        new = w.table(f).filter(F.col("_loaded_at") > ts_lit(since[f])) if carried else w.table(f)
        loads[f] = dq_carry.Load(w.table(f), new, key, not carried)
    large = [c for c in dq.ALL_CHECKS if c.model in loads]
    before = lake.table("dq", "failures") if carried else None
    for name in {c.args["to"] for c in dq.ALL_CHECKS if c.test == "relationships"}:
        models(name)                                            # wired once, before several threads ask for them
    with ThreadPoolExecutor(max_workers=2) as pool:             # the small models beside the large ones
        large_entries = pool.submit(dq_carry.carry, lake.spark, loads, large, before, models)
        small = pool.submit(dq.run_suite, models, [c for c in dq.ALL_CHECKS if c.model not in loads], w.lk).result()
        entries = lake.rebuild(large_entries.result(), "dq", "failures")
    lake.note_inputs("dq", "failures", {**now, "dims": wide.dims_now})
    return lake.rebuild(small.unionByName(dq_carry.report(entries, large)), "dq", "report")


def build(spark: SparkSession, staged: dict[str, DataFrame], lake: Lake, p: Params, full_refresh: bool = False,
          run_dq: bool = True, rep: RunReport | None = None) -> RunReport:
    """One warehouse run over staged (landed) tables."""
    rep = rep or RunReport()
    prev = lake.table("snapshots", "dim_program") if lake.exists("snapshots", "dim_program") else None
    w = Warehouse(spark, staged, p, snapshot=prev, materialize_dims=False)
    before = dimensions(lake)
    w.put("snapshot", _timed(rep, "scd2_snapshot", lambda: lake.rebuild(w.snapshot(), "snapshots", "dim_program")))

    for d in DIMS:
        w.put(d, _timed(rep, d, lambda d=d: lake.rebuild(w.table(d), "warehouse", d)))

    for f, key in FACT_KEYS.items():
        since = None if full_refresh else lake.loaded_at("warehouse", f)
        rep.since[f] = since
        w.since[f] = since
        w.forget(f)
        by, stays = bucket_key(lake, f, staged) if since is None else (None, f != "fact_assessment_result")
        batch = w.table(f)
        w.put(f, _timed(rep, f, lambda f=f, batch=batch, key=key, by=by, stays=stays, since=since: lake.upsert_delete_insert(
            batch, "warehouse", f, key, by=by, stays=stays, full_refresh=since is None)))

    wide = Wide(lake, w, before, rep.since, full_refresh)
    w.put("obt_subject_enrollment", _timed(rep, "obt_subject_enrollment", wide.subject_enrollment))
    w.put("obt_assessment_result", _timed(rep, "obt_assessment_result", wide.assessment_result))
    for o in ("obt_program_enrollment", "obt_program_summary"):
        w.put(o, _timed(rep, o, lambda o=o: lake.rebuild(w.table(o), "obt", o, OBT_PARTITIONS.get(o))))

    if run_dq:
        _timed(rep, "dq_suite", lambda: check_quality(lake, staged, w, wide, rep.since))
    return rep


def run_pipeline(spark: SparkSession, sources: dict[str, DataFrame], lake: Lake | str, p: Params,
                 full_refresh: bool = False) -> RunReport:
    """Land the sources, then build the warehouse from the landed journal. ``lake``: its folder, or the lake itself
    where several share a catalog."""
    rep = RunReport()
    lake = Lake(spark, lake, buckets=p.fact_buckets) if isinstance(lake, str) else lake
    lake.attach()
    _timed(rep, "land", lambda: land(spark, sources, lake.root, p, force_full=full_refresh, rep=rep))
    staged = stage_all(read_landed(spark, lake.root))
    _timed(rep, "views", lambda: layer_views(lake))
    return build(spark, staged, lake, p, full_refresh=full_refresh, rep=rep)


__all__ = ["land", "build", "run_pipeline", "read_landed", "RunReport"]
