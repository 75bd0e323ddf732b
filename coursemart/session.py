"""Spark session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the jobs are written for. On a cluster these belong in the
# submit config; ``build_session`` applies them for local runs and tests.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",  # tables bucketed by one of a join's keys are co-partitioned
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "coursemart", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``. Only in a local session (tests) that has none a fresh
    local folder is made and registered as the checkpoint dir, so that ``DataFrame.checkpoint()`` and our
    written tables agree on one place; with executors elsewhere its absence is an error.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="coursemart-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared work folder."""
    root = work_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when something exists at ``path`` on its file system (any Hadoop-compatible store).

    Asks the Hadoop FileSystem of the path; where the JVM is not reachable from Python
    (Spark Connect) it falls back to probing a Parquet read."""
    jvm = getattr(spark.sparkContext, "_jvm", None) if hasattr(spark, "sparkContext") else None
    if jvm is not None:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if it is missing)."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a complete table is at ``path``: the job committer's ``_SUCCESS`` marker. What a failed or
    running write has left does not count."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def write_and_read(df, path: str, mode: str = "overwrite"):
    """Write ``df`` as Parquet at ``path`` and return the table as read back, with the row count
    observed while writing remembered for size checks (``known_rows``)."""
    def write(counted):
        counted.write.mode(mode).parquet(path)
        return df.sparkSession.read.parquet(path)
    return _counted(df, write)


def _counted(df, write):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
    out = write(df.observe(obs, F.count(F.lit(1)).alias("n")))
    try:
        out._materialized_rows = int(obs.get["n"])
    except AttributeError:  # a DataFrame class without instance attributes: checks count instead
        pass
    return out


def materialize(df, name: str = "intermediate"):
    """Cut lineage: write ``df`` once as a Parquet table under the shared work folder and
    return the table as read back (one computation; an eager RDD checkpoint counts and then
    recomputes to write). The read-back scan carries real size statistics for the planner,
    and its row count, observed while writing, is remembered for size checks."""
    return write_and_read(df, scratch_path(df.sparkSession, name))


BUCKET_ROWS = 500_000


def buckets_for(rows: int) -> int:
    return max(8, -(-rows // BUCKET_ROWS))


def materialize_in_buckets(df, name: str, by: str, n: int):
    """``materialize`` into ``n`` buckets of a column: windows, groups and joins by that column read the table where it lies, one
    bucket a task, instead of shuffling it each time. Rows that are dealt in this way already are not moved."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = f"{name}_{uuid.uuid4().hex[:12]}"

    def write(counted):
        counted.write.format("parquet").bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(table)
        return spark.table(table)
    return _counted(df.repartition(n, by), write)


def known_rows(df) -> int | None:
    """Row count of a table returned by ``materialize`` (None for other DataFrames)."""
    return getattr(df, "_materialized_rows", None)


MAX_WAVES = 8


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Submit-time settings for a run over ``input_bytes`` of Parquet.

    * scan splits of ``target_partition_bytes / 2`` (compressed Parquet inflates ~2x in memory);
    * initial shuffle partitions so each holds about ``target_partition_bytes`` of the largest
      input, at least 2 and at most ``MAX_WAVES`` waves of all cores: map outputs times partitions is what the
      driver tracks, so beyond it partitions grow instead; AQE coalesces small ones and splits
      skewed ones (``advisoryPartitionSizeInBytes`` = the same target, skew = 4x the median and > 1 GB);
    * automatic broadcast off at plan time beyond 64 MB: dimensions are broadcast explicitly
      after a size check, facts never.
    E.g. 100 TB on 1,000 executors × 8 cores → 64,000 shuffle partitions of ~1.6 GB.
    """
    cores = executors * cores_per_executor
    shuffle = min(max(2 * cores, input_bytes // target_partition_bytes), MAX_WAVES * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
