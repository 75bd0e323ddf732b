"""Named tables of the layers: ordinary catalog tables over Parquet folders, one database a layer.

    <root>/<layer>/<table>/v000003                    a rebuilt table (dims, history, wide tables, reports)
    <root>/<layer>/<table>/v000001-64-program_key     a fact, bucketed by a key into 64 partitions

* **Rebuilt tables** are written into a new folder and the catalog entry is then pointed to it. A query that is running keeps
  the folder that it reads; the folder before the current one stays, older ones go.
* **Facts** are partitioned by ``_bucket``, which is the bucket number that Spark gives the row for its key, and bucketed by
  that key into as many buckets: a partition is one bucket. Joins and groupings on the key need no exchange, and a
  delete+insert reads and overwrites the touched buckets alone (``PartitionFilters`` and dynamic partition overwrite).
* What a load has reached (``_loaded``) and which stream epochs are in (``_epochs``) is noted beside the data, after the data.
  A load that dies half-way through its buckets notes nothing, so the next run loads the same rows again, which
  changes nothing where they were in already.

Overwriting buckets is not atomic across buckets, and a query that reads a bucket while it is replaced may fail: facts
have one writer at a time and readers between loads; dashboards read the rebuilt tables.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.operators.facts import ARRIVAL_ORDER, dedup_latest
from coursemart.session import delete_path, list_folder, make_folder, materialize, path_exists
from coursemart.sources.staging import check_same_schema

BUCKET = "_bucket"
LAYERS = ("raw", "staging", "snapshots", "warehouse", "obt", "dq")


def database(layer: str, prefix: str = "") -> str:
    """The layer's database: its own name, after the prefix where several lakes share a catalog."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, one of {LAYERS}")
    return prefix + layer


DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
#: a task keeps that many partitions' files open instead of sorting its rows by partition first
CONCURRENT_WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "24"}


@contextmanager
def _set(spark: SparkSession, conf: dict[str, str]):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


class Lake:
    """The tables under ``root``. With a catalog that outlives the session (a metastore) they are known by name to every
    session; one that starts with an empty catalog finds them again with ``attach``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int = 16):
        self.spark, self.root, self.prefix, self.buckets = spark, root.rstrip("/"), prefix, buckets
        # a join on (key, id) of tables bucketed by the key is still one within buckets
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        for layer in LAYERS:
            db, place = database(layer, prefix), f"{self.root}/{layer}"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{place}'")
            have = spark.catalog.getDatabase(db).locationUri
            if have.split(":", 1)[-1].replace("//", "/").rstrip("/") != place.split(":", 1)[-1].replace("//", "/"):
                raise ValueError(f"database {db} lies at {have}, not at {place}: give this lake a prefix of its own")

    # names and folders -----------------------------------------------------------------
    def name(self, layer: str, table: str) -> str:
        return f"`{database(layer, self.prefix)}`.`{table}`"

    def _home(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _versions(self, layer: str, table: str, complete: bool = True) -> list[str]:
        home = self._home(layer, table)
        found = [v for v in list_folder(self.spark, home) if v.startswith("v")]
        return [v for v in found if not complete or path_exists(self.spark, f"{home}/{v}/_SUCCESS")]

    def _next(self, layer: str, table: str) -> str:
        used = [int(v[1:7]) for v in self._versions(layer, table, complete=False)]  # also what an unfinished run left
        return f"v{max(used, default=0) + 1:06d}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def folder(self, layer: str, table: str) -> str:
        """The folder that the table reads now."""
        return f"{self._home(layer, table)}/{self._versions(layer, table)[-1]}"

    def table(self, layer: str, table: str) -> DataFrame:
        """The table by its name, without the storage column."""
        return self.spark.table(self.name(layer, table)).drop(BUCKET)

    def attach(self) -> list[str]:
        """Register the tables found under ``root`` that the catalog does not know; their names."""
        out = []
        for layer in LAYERS:
            for table in list_folder(self.spark, f"{self.root}/{layer}"):
                versions = self._versions(layer, table)
                if not versions or self.exists(layer, table):
                    continue
                folder = f"{self._home(layer, table)}/{versions[-1]}"
                schema = self.spark.read.parquet(folder).schema
                parts = [d.split("=")[0] for d in list_folder(self.spark, folder) if "=" in d][:1]
                _, _, spec = versions[-1].partition("-")
                count, _, by = spec.partition("-")
                self._register(layer, table, folder, schema, parts, by or None, int(count or 0))
                out.append(self.name(layer, table))
        return out

    def _register(self, layer: str, table: str, folder: str, schema: T.StructType, partition_by: list[str], by: str | None = None,
                  buckets: int = 0) -> None:
        name = self.name(layer, table)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        sql = f"CREATE TABLE {name} ({cols}) USING parquet"
        if partition_by:
            sql += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
        if by:
            sql += f" CLUSTERED BY (`{by}`) INTO {buckets} BUCKETS"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its folder stays
        self.spark.sql(f"{sql} LOCATION '{folder}'")
        if partition_by and path_exists(self.spark, folder):
            self.spark.catalog.recoverPartitions(name)

    def _forget_old(self, layer: str, table: str) -> None:
        keep = self._versions(layer, table)[-2:]
        for v in self._versions(layer, table, complete=False):
            if v < keep[-1] and v not in keep:
                delete_path(self.spark, f"{self._home(layer, table)}/{v}")

    # rebuilt tables --------------------------------------------------------------------
    def rebuild(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` as the whole table and return it as read back by name, its row count remembered for size checks.
        ``partition_by``: columns whose values readers filter by; they come last in the table."""
        parts = list(partition_by or [])
        folder = f"{self._home(layer, table)}/{self._next(layer, table)}"
        obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
        writer = df.observe(obs, F.count(F.lit(1)).alias("n")).write
        with _set(self.spark, CONCURRENT_WRITERS):
            (writer.partitionBy(*parts) if parts else writer).parquet(folder)
        self._register(layer, table, folder, df.schema, parts)
        self._forget_old(layer, table)
        out = self.table(layer, table)
        out._materialized_rows = int(obs.get["n"])
        return out

    def view(self, layer: str, table: str, select: str) -> DataFrame:
        """(Re)define a view by its SELECT over named tables; readers see the old or the new definition."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} AS {select}")
        return self.table(layer, table)

    def overwrite_partitions(self, df: DataFrame, layer: str, table: str, column: str, values: set) -> DataFrame:
        """Replace the partitions of a rebuilt table whose ``column`` is one of ``values`` by ``df``, which holds no others."""
        name, obs = self.name(layer, table), Observation(f"parts_{uuid.uuid4().hex[:12]}")
        rows = df.select(*self.spark.table(name).columns).observe(obs, F.collect_set(F.col(column).cast("string")).alias("held"),
                                                                  F.count(F.when(F.col(column).isNull(), 1)).alias("nulls"))
        with _set(self.spark, {**DYNAMIC, **CONCURRENT_WRITERS}):
            rows.write.mode("overwrite").insertInto(name)
        held = {*obs.get["held"], *([None] if obs.get["nulls"] else [])}
        for v in {None if v is None else str(v) for v in values} - held:  # nothing is left of it
            quoted = "NULL" if v is None else "'" + v.replace("'", "\\'") + "'"
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = {quoted})")
            delete_path(self.spark, f"{self.folder(layer, table)}/{column}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}")
        return self.table(layer, table)

    def note_inputs(self, layer: str, table: str, inputs: dict[str, str]) -> None:
        """Note what a finished refresh was made from."""
        home = f"{self.folder(layer, table)}/_inputs"
        used = [int(n[:6]) for n in list_folder(self.spark, home)]
        text = ";".join(f"{k}={v}" for k, v in inputs.items()).replace(" ", "T").replace(":", ".")
        make_folder(self.spark, f"{home}/{max(used, default=0) + 1:06d};{text}")

    def inputs(self, layer: str, table: str) -> dict[str, str]:
        """What the table's last finished refresh was made from ({} if it has none)."""
        notes = list_folder(self.spark, f"{self.folder(layer, table)}/_inputs") if self.exists(layer, table) else []
        return dict(x.split("=", 1) for x in max(notes).split(";")[1:]) if notes else {}

    def analyze(self, layer: str, table: str, columns: list[str]) -> None:
        """Row count and column statistics for the optimizer (one scan of the columns)."""
        self.spark.sql(f"ANALYZE TABLE {self.name(layer, table)} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")

    # facts -----------------------------------------------------------------------------
    def _placed(self, df: DataFrame, by: str, buckets: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.hash(by), F.lit(buckets)))

    def _layout(self, layer: str, table: str) -> tuple[str, int]:
        _, count, by = self._versions(layer, table)[-1].split("-", 2)
        return by, int(count)

    def _first_load(self, batch: DataFrame, layer: str, table: str, by: str) -> DataFrame:
        """The batch is the whole table, in a new folder: the old one serves until this one is complete."""
        version = f"{self._next(layer, table)}-{self.buckets}-{by}"
        folder = f"{self._home(layer, table)}/{version}"
        rows = self._placed(batch, by, self.buckets)
        stage = f"{table}__{version[:7]}"
        self._register(layer, stage, folder, rows.schema, [BUCKET], by, self.buckets)
        try:
            loaded = self._write(rows, self.name(layer, stage), self.buckets)[1]
            if not path_exists(self.spark, f"{folder}/_SUCCESS"):
                make_folder(self.spark, f"{folder}/_SUCCESS")
            self._register(layer, table, folder, rows.schema, [BUCKET], by, self.buckets)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, stage)}")
        self._note(folder, loaded)
        self._forget_old(layer, table)
        return self.table(layer, table)

    def _write(self, rows: DataFrame, name: str, touched: int) -> tuple[set[int], object]:
        """Overwrite the buckets that ``rows`` holds; which they were, and the rows' latest ``_loaded_at``."""
        obs = Observation(f"buckets_{uuid.uuid4().hex[:12]}")
        loaded = F.max("_loaded_at") if "_loaded_at" in rows.columns else F.max(F.lit(None).cast("timestamp_ntz"))
        rows = rows.observe(obs, F.collect_set(BUCKET).alias("buckets"), loaded.cast("string").alias("loaded"))
        with _set(self.spark, DYNAMIC):
            rows.repartition(max(1, touched), BUCKET).write.mode("overwrite").insertInto(name)
        return set(obs.get["buckets"]), obs.get["loaded"]

    def _note(self, folder: str, loaded) -> None:
        if loaded is not None:
            make_folder(self.spark, f"{folder}/_loaded/{str(loaded).replace(' ', 'T').replace(':', '.')}")

    def loaded_at(self, layer: str, table: str) -> str | None:
        """The latest ``_loaded_at`` of the fact's finished loads; None when there is none (then the run is a first load)."""
        if not self.exists(layer, table):
            return None
        notes = list_folder(self.spark, f"{self.folder(layer, table)}/_loaded")
        if not notes:
            return None
        date, _, time = max(notes).partition("T")
        h, m, s = time.split(".", 2)
        return f"{date} {h}:{m}:{s}"

    def _merge(self, batch: DataFrame, layer: str, table: str, key: list[str], stays: bool, solve) -> DataFrame:
        """Replace the touched buckets by ``solve(their rows, batch, the batch's keys)``. ``stays``: a key never
        changes its bucket; otherwise the buckets that hold the batch's keys now are looked up (key columns only)."""
        name, folder = self.name(layer, table), self.folder(layer, table)
        by, buckets = self._layout(layer, table)
        check_same_schema(batch, self.table(layer, table))
        new = materialize(self._placed(batch, by, buckets), f"{table}_batch")
        now = self.spark.table(name)
        keys = new.select(*key).na.drop().distinct()
        touched = {r[0] for r in new.select(BUCKET).distinct().collect()}  # at most ``buckets`` numbers
        if not touched:
            return self.table(layer, table)
        if not stays:
            touched |= {r[0] for r in now.select(*key, BUCKET).join(keys, key, "left_semi").select(BUCKET).distinct().collect()}
        old = now.filter(F.col(BUCKET).isin(sorted(touched)))
        kept, loaded = self._write(solve(old, new, keys).select(*now.columns), name, len(touched))
        for b in sorted(touched - kept):  # all rows of it have moved to other buckets
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET} = {b})")
            delete_path(self.spark, f"{folder}/{BUCKET}={b}")
        self._note(folder, loaded)
        return self.table(layer, table)

    def upsert_delete_insert(self, batch: DataFrame, layer: str, table: str, key: str | list[str], by: str | None = None,
                             stays: bool = True, full_refresh: bool = False) -> DataFrame:
        """Delete the rows whose ``key`` is in the batch, insert the batch; returns the table.

        ``by``: the column whose buckets a new table gets (the first of ``key`` by default); ``stays``: rows of one key always
        have one value of it. A missing table or ``full_refresh`` makes the batch the whole table. Rows with a null in
        the key are never deleted. Loading a batch again changes nothing (but null keys add up). A batch
        whose columns or types differ from the table's raises ``SchemaDrift``."""
        key = [key] if isinstance(key, str) else list(key)
        if full_refresh or not self.exists(layer, table):
            return self._first_load(batch, layer, table, by or key[0])
        return self._merge(batch, layer, table, key, stays,
                           lambda old, new, keys: old.join(keys, key, "left_anti").select(*new.columns).unionByName(new))

    def upsert_latest(self, batch: DataFrame, layer: str, table: str, key: str, epoch: str | None = None) -> DataFrame:
        """Merge by key keeping, per key, the newest row by arrival order (table or batch): an older replayed row
        never replaces a newer one. An ``epoch`` that is noted already is left out, one that was not is noted after its rows."""
        if self.exists(layer, table) and epoch and path_exists(self.spark, f"{self.folder(layer, table)}/_epochs/{epoch}"):
            return self.table(layer, table)

        def newest(rows: DataFrame) -> DataFrame:
            known = F.col(key).isNotNull()
            return dedup_latest(rows.filter(known), key).unionByName(rows.filter(~known))

        order = [c for c in ARRIVAL_ORDER if c in batch.columns]
        if not order:
            raise ValueError(f"one of {ARRIVAL_ORDER} is needed")
        if self.exists(layer, table):
            out = self._merge(batch, layer, table, [key], True, lambda old, new, keys: newest(old.select(*new.columns).unionByName(new)))
        else:
            out = self._first_load(newest(batch), layer, table, key)
        if epoch:
            make_folder(self.spark, f"{self.folder(layer, table)}/_epochs/{epoch}")
        return out


__all__ = ["BUCKET", "LAYERS", "Lake", "database"]
