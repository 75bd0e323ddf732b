"""Ordered window operators that stay distributed when one group is huge.

``row_number`` and ``lag`` over (partition by g order by o) put each group in one task. Groups
here are small by construction (a student's attempts at a subject, the results of one
subject enrollment), but one key — e.g. the NULL group of rows whose parent has not arrived
— may hold a large share of all rows. Such hot groups are found on a seeded sample and
handled apart:

1. hot rows are range-partitioned on (g, o) and written once with their partition id, so
   every later read sees the same ranges (partition ids ascend with the order);
2. per (g, partition) counts / last values form a small table; a window over it gives each
   partition's offset (for row_number) or the last value before it (for lag);
3. the within-partition window runs on bounded partitions and is corrected by (2).

Cold groups use the plain window. The result equals the plain window for every row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.session import known_rows, materialize

HOT_GROUP_ROWS = 5_000_000   # a group above this many rows is numbered across partitions
HOT_PARTITION_ROWS = 2_000_000
HOT_SAMPLE_FRACTION = 0.001  # detection sample; a group of HOT_GROUP_ROWS shows ~5,000 sampled rows
BROADCAST_BYTES = 64 * 1024 * 1024


def _ns_join_cond(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def split_hot(df: DataFrame, part: list[str], threshold: int, fraction: float = HOT_SAMPLE_FRACTION,
              detect_on: DataFrame | None = None):
    """(cold rows, hot rows, number of hot groups, estimated hot rows).

    Hot groups are found on a seeded sample: a group with more than ``threshold`` rows shows
    about ``threshold * fraction`` sampled rows; groups with half of that are flagged. A
    missed or an extra flag changes only the speed, never the result (both paths are exact).
    At most rows/threshold groups can be hot, so the key list is small and broadcast.
    ``detect_on``: a narrower input with the same rows per group (e.g. the fact before its
    dimension joins) to sample instead of ``df``; a sample is not pushed below joins."""
    src = df if detect_on is None else detect_on
    sample = src if fraction >= 1.0 else src.sample(fraction=fraction, seed=17)
    hot_keys = (sample.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > max(1.0, threshold * fraction / 2))
                .withColumn("_hot", F.lit(True)))
    if hot_keys.isEmpty():  # the usual case: one small sampled job, nothing written
        return df, None, 0, 0
    hot_keys = materialize(hot_keys, "hot_groups")
    n_hot = known_rows(hot_keys)
    hot_rows = int(hot_keys.agg(F.sum("_n")).first()[0] / min(1.0, fraction))  # estimated hot rows
    hk = hot_keys.drop("_n")
    # at most 2 * rows / threshold keys; broadcast under the budget, else a shuffle join
    if n_hot * 64 * (len(part) + 1) <= BROADCAST_BYTES:
        hk = F.broadcast(hk)
    marked = df.join(hk, _ns_join_cond(df, hk, part), "left")
    for c in part:
        marked = marked.drop(hk[c])
    cold = marked.filter(F.col("_hot").isNull()).drop("_hot")
    hot = marked.filter(F.col("_hot")).drop("_hot")
    return cold, hot, n_hot, hot_rows


def _side(df: DataFrame, name: str) -> DataFrame:
    """A per-range table (groups + ranges rows), written once; broadcast when its counted rows are few."""
    t = materialize(df, name)
    return F.broadcast(t) if known_rows(t) * 64 * len(t.columns) <= BROADCAST_BYTES else t


def _ranged(hot: DataFrame, part: list[str], order: list[Column], n_rows_hint: int) -> DataFrame:
    """Hot rows range-partitioned on (group, order) into ~HOT_PARTITION_ROWS-row partitions.
    Groups are contiguous in range order, so (group, partition) pairs number at most
    groups + partitions: the offset tables below stay small."""
    n = max(1, n_rows_hint // HOT_PARTITION_ROWS + 1)
    ranged = hot.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in part], *order) \
        .withColumn("_pid", F.spark_partition_id())
    return materialize(ranged, "hot_ranged")


def row_number(df: DataFrame, part: list[str], order: list[Column], out: str,
               threshold: int = HOT_GROUP_ROWS, fraction: float = HOT_SAMPLE_FRACTION,
               detect_on: DataFrame | None = None) -> DataFrame:
    """``row_number() over (partition by part order by order)`` as BIGINT; ``order`` must be a
    total order within each group (end it with a unique column)."""
    w = Window.partitionBy(*part).orderBy(*order)
    cold, hot, n_hot, hot_rows = split_hot(df, part, threshold, fraction, detect_on)
    cold = cold.withColumn(out, F.row_number().over(w).cast("bigint"))
    if hot is None:
        return cold
    r = _ranged(hot, part, order, max(hot_rows, threshold * n_hot))
    counts = r.groupBy(*part, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, "_pid", F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"))
    local = r.withColumn("_rn", F.row_number().over(Window.partitionBy(*part, "_pid").orderBy(*order)))
    o = _side(offsets, "hot_offsets")
    j = local.join(o, _ns_join_cond(local, o, part + ["_pid"]), "left")
    for c in part + ["_pid"]:
        j = j.drop(o[c])
    hot_out = j.withColumn(out, (F.col("_off") + F.col("_rn")).cast("bigint")).drop("_off", "_rn", "_pid")
    return cold.unionByName(hot_out)


def lag(df: DataFrame, part: list[str], order: list[Column], value: str, out: str,
        threshold: int = HOT_GROUP_ROWS, fraction: float = HOT_SAMPLE_FRACTION,
        detect_on: DataFrame | None = None) -> DataFrame:
    """``lag(value) over (partition by part order by order)``; ``order`` a total order per group."""
    w = Window.partitionBy(*part).orderBy(*order)
    cold, hot, n_hot, hot_rows = split_hot(df, part, threshold, fraction, detect_on)
    cold = cold.withColumn(out, F.lag(value).over(w))
    if hot is None:
        return cold
    r = _ranged(hot, part, order, max(hot_rows, threshold * n_hot))
    wl = Window.partitionBy(*part, "_pid").orderBy(*order)
    local = (r.withColumn("_rn", F.row_number().over(wl))
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*part, "_pid")))
             .withColumn(out, F.lag(value).over(wl)))
    # last value of each partition, then the last value of the previous non-empty partition
    last = local.filter(F.col("_rn") == F.col("_cnt")).select(*part, "_pid", F.col(value).alias("_last"))
    wp = Window.partitionBy(*part).orderBy("_pid")
    before = last.select(*part, "_pid", F.lag("_last").over(wp).alias("_prev_last"))
    b = _side(before, "hot_before")
    j = local.join(b, _ns_join_cond(local, b, part + ["_pid"]), "left")
    for c in part + ["_pid"]:
        j = j.drop(b[c])
    hot_out = (j.withColumn(out, F.when(F.col("_rn") == 1, F.col("_prev_last")).otherwise(F.col(out)))
               .drop("_rn", "_cnt", "_prev_last", "_pid"))
    return cold.unionByName(hot_out)
