"""Benchmark: the warehouse pipeline over the driver tables at one scale factor.

Steps (each timed; the JSON line reports every step and their total):
  setup        (untimed) derive the ten source tables from the driver tables and write them.
  full_*       first run: land all sources (journals up to a cut at the 99th percentile of
               each one's update time), SCD2 snapshot, dims, facts (full), wide tables, DQ suite.
  incr_*       second run: land the rest (watermark + lookback + anti join), SCD2, dims,
               facts by delete+insert of the ~1 % changed keys (touched buckets), wide tables, DQ suite.
  dash_*       the five dashboard aggregates over the programme-enrollment wide table.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from coursemart.functions.exprs import ts_lit  # noqa: E402
from coursemart.params import Params  # noqa: E402
from coursemart.plans import dashboards, pipeline  # noqa: E402
from coursemart.session import build_session  # noqa: E402
from coursemart.sources.binding import landed_tables  # noqa: E402
from coursemart.sources.lake import Lake  # noqa: E402
from coursemart.sources.staging import INCREMENTAL_TABLES  # noqa: E402

RUN1, RUN2 = "2002-01-01 00:00:00", "2002-01-02 00:00:00"


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="coursemart-bench-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"})
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    p = Params()

    # setup: the source system (untimed)
    src_root = f"{scratch}/source"
    for name, df in landed_tables(spark, sf_dir, p).items():
        df.drop("_ingested_at").write.parquet(f"{src_root}/{name}")
    sources = {n: spark.read.parquet(f"{src_root}/{n}") for n in
               ["programs", "subjects", "semesters", "program_subjects", "students", "subject_offerings",
                "assessments", "program_enrollments", "subject_enrollments", "assessment_results"]}
    first = dict(sources)
    for t in INCREMENTAL_TABLES:  # each journal at its own percentile, so that all three change in the second run
        cut = sources[t].agg(F.percentile_approx("updated_at", 0.99).alias("c")).first()["c"]
        first[t] = sources[t].filter(F.col("updated_at") <= ts_lit(str(cut)))

    lake = Lake(spark, f"{scratch}/lake", buckets=2 * cpus)
    timings = {}

    t0 = time.perf_counter()
    r1 = pipeline.run_pipeline(spark, first, lake, p.with_(run_ts=RUN1))
    timings["full_run"] = round(time.perf_counter() - t0, 3)
    timings.update({f"full_{k}": v for k, v in r1.timings.items()})

    t0 = time.perf_counter()
    r2 = pipeline.run_pipeline(spark, sources, lake, p.with_(run_ts=RUN2))
    timings["incr_run"] = round(time.perf_counter() - t0, 3)
    timings.update({f"incr_{k}": v for k, v in r2.timings.items()})

    ope = lake.table("obt", "obt_program_enrollment")
    t0 = time.perf_counter()
    for name in ["dash_active_summary", "dash_graduation_trend", "dash_by_department", "dash_by_level",
                 "dash_by_grad_month"]:
        t1 = time.perf_counter()
        getattr(dashboards, name)(ope).collect()
        timings[name] = round(time.perf_counter() - t1, 3)
    timings["dashboards"] = round(time.perf_counter() - t0, 3)

    total = timings["full_run"] + timings["incr_run"] + timings["dashboards"]
    landed2 = {t: r.rows for t, r in r2.landed.items() if t in INCREMENTAL_TABLES}
    print(json.dumps({"metric": "pipeline_total_sec", "value": round(total, 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "incremental_rows_landed": landed2}))
    spark.stop()


if __name__ == "__main__":
    main()
