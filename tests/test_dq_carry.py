"""Carried failures against the whole suite, load by load, on rows that violate it."""

import random

from pyspark.sql import functions as F

from coursemart.operators import dq, dq_carry
from coursemart.operators.dq import Check
from coursemart.session import materialize

JOURNAL = "id long, at int, parent string, status string, mark double"
CHECKS = [Check("journal", "id,at", "unique_combination"), Check("journal", "id", "not_null"), Check("journal", "parent", "not_null"),
          Check("journal", "parent", "relationships", {"to": "parents", "field": "key"}),
          Check("journal", "status", "accepted_values", {"values": ["a", "b"]}),
          Check("journal", "mark", "accepted_range", {"min": 0, "max": 100}),
          Check("fact", "id", "unique"), Check("fact", "id", "not_null"),
          Check("fact", "parent", "relationships", {"to": "parents", "field": "key"}),
          Check("fact", "status", "accepted_values", {"values": ["a", "b"]}),
          Check("fact", "mark", "accepted_range", {"min": 0, "max": 100}),
          Check("fact", "mark", "check", {"expr": "mark <> 7"})]


def _rows(rng, n):
    pick = lambda *v: rng.choice(v)
    return [(pick(None, *range(40)), rng.randrange(4), pick(None, "p1", "p2", "p3", "late", "never"), pick(None, "a", "b", "x", "y"),
             pick(None, -1.0, 7.0, 50.0, 101.0)) for _ in range(n)]


def _as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_report_equals_the_whole_suite_after_each_load(spark):
    rng = random.Random(4)
    journal, fact, entries = [], [], None
    for load in range(4):
        new = _rows(rng, [60, 8, 0, 25][load])
        parents = spark.createDataFrame([(k,) for k in ("p1", "p2", "p3", *(["late"] if load > 1 else []))], "key string")
        journal = journal + new
        if load == 0:  # an id twice: the unique check has something to find, later a load of one row repairs it
            new = new + [(41, 0, "p1", "x", -1.0), (41, 0, "p1", "y", -1.0)]
        if load == 3:
            new = [r for r in new if r[0] != 41] + [(41, 0, "p1", "a", 1.0)]
        ids = {r[0] for r in new if r[0] is not None}
        fact = [r for r in fact if r[0] not in ids] + new
        tables = {"journal": spark.createDataFrame(journal, JOURNAL), "fact": spark.createDataFrame(fact, JOURNAL), "parents": parents}
        delta = spark.createDataFrame(new, JOURNAL)
        journal_delta = spark.createDataFrame(journal[len(journal) - [60, 8, 0, 25][load]:], JOURNAL)
        loads = {"journal": dq_carry.Load(tables["journal"], journal_delta, None, load == 0), "fact": dq_carry.Load(tables["fact"], delta, "id", load == 0)}
        entries = materialize(dq_carry.carry(spark, loads, CHECKS, entries, tables.get))
        got, want = _as_set(dq_carry.report(entries, CHECKS)), _as_set(dq.run_suite(tables.get, CHECKS).select("model", "column_name", "test", "failures"))
        assert got == want, (load, [x for x in zip(got, want) if x[0] != x[1]])
    assert {c for _, _, c, n in want if n} == {"unique_combination", "not_null", "relationships", "accepted_values", "accepted_range", "unique", "check"}


def test_a_load_reads_the_other_rows_by_their_keys_alone(spark):
    from coursemart.session import scratch_path
    path = scratch_path(spark, "dq_fact")
    spark.range(100).select("id", F.lit(1).alias("at"), F.lit("p1").alias("parent"), F.lit("a").alias("status"), F.lit(1.0).alias("mark")).write.parquet(path)
    rows = spark.read.parquet(path)
    new = materialize(rows.filter("id < 5"))
    parents = spark.createDataFrame([("p1",)], "key string")
    entries = dq_carry.failing(dq_carry.Load(rows, new, "id", False), [c for c in CHECKS if c.model == "fact"], spark.createDataFrame([], dq_carry.ENTRY),
                               {"parents": parents}.get)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        scans = entries._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    of_fact = [x for x in scans.splitlines() if "FileScan" in x and path.rsplit("/", 1)[1] in x]
    assert len(of_fact) == 1 and "ReadSchema: struct<id:bigint>" in of_fact[0], scans
