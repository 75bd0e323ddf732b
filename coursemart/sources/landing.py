"""Landing into the raw layer: full reloads, keyed incremental appends, insert-if-absent.

The raw layer is an append-only journal of Parquet tables. Every landed row carries the
run's ``_ingested_at``. The watermark is ``max(cursor)`` of the target; each load notes the one it reached in a
small table beside the data (``_watermark``), after the data is complete. A note that a failed run did not
get to write only makes the next run pull more rows again: re-pulled rows are dropped by an anti join on
(pk, cursor).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.exprs import ts_lit
from coursemart.session import path_exists, table_exists
from coursemart.sources.staging import SchemaDrift


@dataclass
class LandResult:
    table: str
    mode: str            # "full", "incremental", "skipped", "insert_if_absent"
    rows: int            # rows written by this run (exact, observed while writing)
    watermark: object = None


INGEST_DATE = "_ingest_date"


WATERMARKS = "_watermark"


def _write(df: DataFrame, path: str, mode: str, name: str, by_ingest_date: bool = False, cursor: str | None = None) -> int:
    """Write and return the exact row count observed while writing. Journals are partitioned
    by ingest date, so incremental reads prune the files of earlier runs. With a ``cursor`` its maximum, observed
    as well, is noted beside the data."""
    obs = Observation(f"land_{name}")
    top = F.max(cursor) if cursor else F.max(F.lit(None).cast("string"))
    w = df.observe(obs, F.count(F.lit(1)).alias("rows"), top.cast("string").alias("top"))
    if by_ingest_date:
        w = w.withColumn(INGEST_DATE, F.to_date("_ingested_at"))
        w.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(INGEST_DATE).parquet(path)
    else:
        w.write.mode(mode).parquet(path)
    if cursor and obs.get["top"] is not None:
        note = df.sparkSession.createDataFrame([(obs.get["top"],)], "top string")
        note.select(F.col("top").cast(df.schema[cursor].dataType).alias("top")).coalesce(1).write.mode("append").parquet(f"{path}/{WATERMARKS}")
    return int(obs.get["rows"])


def target_exists(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, path)


def land_full(spark: SparkSession, src: DataFrame, target: str, run_ts: str, name: str = "table",
              by_ingest_date: bool = False, cursor: str | None = None) -> LandResult:
    """Replace ``target`` with ``src`` + ``_ingested_at``. An empty source never wipes a
    non-empty target (the guard costs a ``limit 1`` probe on each side, not a count)."""
    if src.isEmpty() and target_exists(spark, target) and not spark.read.parquet(target).isEmpty():
        return LandResult(name, "skipped", 0)
    rows = _write(src.withColumn("_ingested_at", ts_lit(run_ts)), target, "overwrite", name, by_ingest_date, cursor)
    return LandResult(name, "full", rows)


def watermark(spark: SparkSession, target: str, cursor: str):
    """max(cursor) already landed; None when the target is missing or empty. Answered from the loads' notes; only
    a table landed without them is scanned."""
    if not target_exists(spark, target):
        return None
    if path_exists(spark, f"{target}/{WATERMARKS}/_SUCCESS"):
        return spark.read.parquet(f"{target}/{WATERMARKS}").agg(F.max("top")).first()[0]
    return spark.read.parquet(target).agg(F.max(cursor)).first()[0]


def _ts_text(v) -> str:
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def land_incremental(spark: SparkSession, src: DataFrame, target: str, cursor: str, pk: str, run_ts: str,
                     lookback_minutes: int = 10, force_full: bool = False, name: str = "table",
                     by_ingest_date: bool = False) -> LandResult:
    """Append source rows with ``cursor > watermark - lookback`` that are not already landed
    with the same (pk, cursor). No watermark (or ``force_full``) → full reload.

    The bound is a literal, so it is pushed to the source scan; the anti join reads only
    the target rows above the same bound. A source whose columns or types differ from the target's raises
    ``SchemaDrift``.
    """
    wm = None if force_full else watermark(spark, target, cursor)
    if wm is None:
        res = land_full(spark, src, target, run_ts, name, by_ingest_date, cursor)
        res.watermark = None
        return res
    rows = append_unseen(spark, src, target, cursor, pk, run_ts, wm, lookback_minutes, name, by_ingest_date)
    return LandResult(name, "incremental", rows, wm)


def check_landed_schema(src: DataFrame, landed: DataFrame) -> None:
    """The source must have the landed table's columns and types, in any order (``SchemaDrift`` otherwise)."""
    have = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in landed.schema.fields if f.name not in (INGEST_DATE, "_ingested_at")}
    if have != want:
        changed = sorted(set(have.items()) ^ set(want.items()))
        raise SchemaDrift(f"source differs from the landed table: {changed}")


def append_unseen(spark: SparkSession, src: DataFrame, target: str, cursor: str, pk: str, run_ts: str, wm,
                  lookback_minutes: int, name: str = "table", by_ingest_date: bool = False) -> int:
    """Append the source rows above ``wm`` - lookback (all rows where ``wm`` is None) whose (pk, cursor) is not
    landed yet; returns how many."""
    landed = spark.read.parquet(target)
    check_landed_schema(src, landed)
    cols = [c for c in landed.columns if c != INGEST_DATE]
    seen = landed.select(pk, cursor)
    if wm is not None:
        bound = ts_lit(_ts_text(wm)) - F.expr(f"INTERVAL {int(lookback_minutes)} MINUTES")
        src, seen = src.filter(F.col(cursor) > bound), seen.filter(F.col(cursor) > bound)
    batch = src.join(seen, [pk, cursor], "left_anti").withColumn("_ingested_at", ts_lit(run_ts))
    return _write(batch.select(*cols), target, "append", name, by_ingest_date, cursor)


def insert_if_absent(spark: SparkSession, batch: DataFrame, target: str, key: list[str], order=None,
                     name: str = "table") -> LandResult:
    """INSERT … ON CONFLICT (key) DO NOTHING as a set operation: the batch is reduced to one
    row per key (the highest by ``order`` when given), keys already in the target are dropped
    by an anti join, the rest is appended."""
    from coursemart.operators.facts import dedup_latest

    if order:
        one = dedup_latest(batch, key[0] if len(key) == 1 else key, order)
    else:
        one = batch.dropDuplicates(key)
    if target_exists(spark, target):
        one = one.join(spark.read.parquet(target).select(*key), key, "left_anti")
        mode = "append"
    else:
        mode = "overwrite"
    rows = _write(one, target, mode, name)
    return LandResult(name, "insert_if_absent", rows)
