"""Landing and upsert as Structured Streaming jobs over a directory of Parquet drops.

* ``land_stream``: the lookback rule as a stateful operator. The watermark trails the newest event time by the lookback; a
  (pk, cursor) is kept in the state store until the watermark has passed it, so what is delivered again within the lookback
  lands once, and rows older than the watermark are not taken (the batch rule does not pull rows below its bound
  either). The Parquet sink commits each micro-batch in its log, so a restart from the checkpoint adds nothing.
* ``upsert_stream``: each micro-batch is reduced to the latest version per key and merged into the touched buckets of the
  table; the epoch is noted beside them afterwards, so an epoch that is delivered again changes nothing.
Both run with ``trigger(availableNow=True)``: process what is there, then stop.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.functions.exprs import ts_lit
from coursemart.operators.facts import ARRIVAL_ORDER
from coursemart.sources.lake import Lake


EVENT_TIME = "_event_time"


def _drops(spark: SparkSession, source_dir: str, schema: T.StructType, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def seen_once(rows: DataFrame, cursor: str, pk: str, lookback_minutes: int) -> DataFrame:
    """Each (pk, cursor) once, as long as it comes again within the lookback; rows behind the watermark are left out.
    State: the (pk, cursor) of the lookback, in the state store by key."""
    timed = rows.withColumn(EVENT_TIME, F.col(cursor).cast("timestamp"))  # a watermark takes no other type
    return timed.withWatermark(EVENT_TIME, f"{int(lookback_minutes)} minutes").dropDuplicatesWithinWatermark([pk, cursor]).drop(EVENT_TIME)


def land_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: str, checkpoint: str,
                cursor: str, pk: str, run_ts: str, lookback_minutes: int = 10,
                max_files_per_trigger: int | None = None) -> None:
    rows = seen_once(_drops(spark, source_dir, schema, max_files_per_trigger), cursor, pk, lookback_minutes)
    q = (rows.withColumn("_ingested_at", ts_lit(run_ts)).writeStream.format("parquet").outputMode("append")
         .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's id as its checkpoint keeps it: a new checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType, lake: Lake, layer: str, table: str, checkpoint: str,
                  pk: str, max_files_per_trigger: int | None = None) -> None:
    if not any(c in schema.fieldNames() for c in ARRIVAL_ORDER):
        raise ValueError(f"one of {ARRIVAL_ORDER} is needed")

    def merge(batch: DataFrame, epoch: int) -> None:
        lake.upsert_latest(batch, layer, table, pk, epoch=f"{stream_id(spark, checkpoint)}-{epoch}")

    q = (_drops(spark, source_dir, schema, max_files_per_trigger).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(merge).trigger(availableNow=True).start())
    q.awaitTermination()
