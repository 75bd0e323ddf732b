"""Plan shape: the physical strategies the operators are written for."""

import contextlib
import io

from pyspark.sql import functions as F

from fixtures_small import SF_SMALL

from coursemart.functions.exprs import ts_lit
from coursemart.operators.facts import dedup_latest, incremental_source
from coursemart.params import ORACLE_PARAMS
from coursemart.plans.warehouse import Warehouse
from coursemart.session import scratch_path


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_dedup_is_window_group_limit(spark):
    w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS)
    p = plan(dedup_latest(w.stg["subject_enrollments"], "subject_enrollment_id"))
    assert "WindowGroupLimit" in p


def test_incremental_bound_reaches_parquet_scan(spark):
    path = scratch_path(spark, "journal")
    spark.range(100).select(F.col("id").alias("k"),
                            (ts_lit("2024-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.col("id").cast("int")))
                            .alias("_ingested_at")).write.parquet(path)
    p = plan(incremental_source(spark.read.parquet(path), "2024-01-01 10:00:00"))
    assert "PushedFilters: [IsNotNull(_ingested_at), GreaterThan(_ingested_at" in p


def test_wide_table_broadcasts_dims_and_has_no_python(spark):
    w = Warehouse.from_driver(spark, SF_SMALL, ORACLE_PARAMS)
    p = plan(w.obt_subject_enrollment())
    assert "BroadcastHashJoin" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    # column pruning: the lineitem scan reads only the columns the binding needs
    scans = [ln for ln in p.splitlines() if ln.startswith("ReadSchema: struct<l_")]
    assert scans and all("l_tax" not in s and "l_discount" not in s and "l_quantity" not in s for s in scans)


def test_journal_partitions_pruned_by_ingest_date(spark):
    from coursemart.sources import landing
    from coursemart.sources.staging import staged
    target = scratch_path(spark, "journal_by_date")
    rows = spark.range(10).select(F.col("id").alias("result_id"), F.col("id").alias("subject_enrollment_id"),
                                  F.col("id").alias("assessment_id"), F.lit(None).cast("decimal(5,2)").alias("raw_score"),
                                  ts_lit("2024-01-01 00:00:00").alias("submitted_at"),
                                  ts_lit("2024-01-01 00:00:00").alias("updated_at"))
    landing.land_full(spark, rows, target, "2024-01-02 00:00:00", by_ingest_date=True)
    stg = staged(spark.read.parquet(target), "assessment_results")
    p = plan(incremental_source(stg, "2024-03-01 00:00:00"))
    part = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters")]
    assert part and "_ingest_date" in part[0] and ">= 2024-03-01" in part[0], p


def test_small_budget_does_not_shuffle_the_wide_input_for_small_statistics(spark):
    """Each statistics table is judged by its own rows: the coordinators' few rows are broadcast although the
    (offering, mark) counts they come from would not fit the budget."""
    from coursemart.params import Params
    from coursemart.plans.warehouse import Warehouse
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse.from_driver(spark, SF_SMALL, Params(broadcast_max_bytes=100_000))
        plan = w.obt_subject_enrollment()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(coordinator_name" not in plan
