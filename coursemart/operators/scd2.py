"""Type-2 history by the check strategy: a full outer join of open versions and the current rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursemart.functions.exprs import ts_lit
from coursemart.params import Params

SCD_COLS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
PROGRAM_KEY = "program_id"
PROGRAM_CHECK_COLS = ["program_name", "department", "degree_level", "total_credit_points_required"]


def program_snapshot_source(stg_programs: DataFrame, p: Params) -> DataFrame:
    return stg_programs.select("program_id", *PROGRAM_CHECK_COLS, ts_lit(p.run_ts).alias("_loaded_at"))


def scd_id(key_col: str, ts_col: str):
    """md5 of the key and the version timestamp, '|'-joined (NULLs as empty text)."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key_col).cast("string"), F.lit("")),
                             F.coalesce(F.col(ts_col).cast("string"), F.lit(""))))


def _opened(cols, run_ts):
    return [F.col(c) for c in cols] + [ts_lit(run_ts).alias("dbt_updated_at"), ts_lit(run_ts).alias("dbt_valid_from"),
                                       F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to")]


def scd2_snapshot(current: DataFrame, history: DataFrame | None, key: str, check_cols: list[str],
                  run_ts: str) -> DataFrame:
    """Next version of a type-2 snapshot.

    * new key → open row (valid_from = run_ts, valid_to NULL)
    * a check column changed (NULL-safe) → old open row closed at run_ts, new row opened
    * unchanged, or key missing from ``current`` (hard deletes are ignored) → kept
    * closed rows are kept as they are
    A replay with the same ``run_ts`` and input is a no-op.
    """
    cols = current.columns
    if history is None:
        out = current.select(*_opened(cols, run_ts))
        return out.select(scd_id(key, "dbt_valid_from").alias("dbt_scd_id"), *cols, *SCD_COLS[1:])

    hist_cols = cols + SCD_COLS
    closed = history.filter(F.col("dbt_valid_to").isNotNull()).select(*hist_cols)
    open_ = history.filter(F.col("dbt_valid_to").isNull())

    h = open_.select(*[F.col(c).alias(f"h_{c}") for c in hist_cols])
    c = current.select(*[F.col(x).alias(f"c_{x}") for x in cols])
    j = h.join(c, F.col(f"h_{key}") == F.col(f"c_{key}"), "full_outer")

    has_h = F.col(f"h_{key}").isNotNull()
    has_c = F.col(f"c_{key}").isNotNull()
    changed = has_h & has_c & reduce(lambda a, b: a | b,
                                     [~F.col(f"h_{x}").eqNullSafe(F.col(f"c_{x}")) for x in check_cols])
    ts = ts_lit(run_ts)
    null_ts = F.lit(None).cast("timestamp_ntz")

    def version(prefix, valid_from, valid_to, updated_at, scd):
        fields = [F.col(f"{prefix}{x}").alias(x) for x in cols]
        return F.struct(scd.alias("dbt_scd_id"), *fields, updated_at.alias("dbt_updated_at"),
                        valid_from.alias("dbt_valid_from"), valid_to.alias("dbt_valid_to"))

    new_scd = F.md5(F.concat_ws("|", F.coalesce(F.col(f"c_{key}").cast("string"), F.lit("")), ts.cast("string")))
    kept = version("h_", F.col("h_dbt_valid_from"), F.col("h_dbt_valid_to"), F.col("h_dbt_updated_at"),
                   F.col("h_dbt_scd_id"))
    closing = version("h_", F.col("h_dbt_valid_from"), ts, F.col("h_dbt_updated_at"), F.col("h_dbt_scd_id"))
    opening = version("c_", ts, null_ts, ts, new_scd)

    actions = (F.when(changed, F.array(closing, opening))
               .when(~has_h, F.array(opening))
               .otherwise(F.array(kept)))
    moved = j.select(F.explode(actions).alias("v")).select("v.*")
    return closed.unionByName(moved.select(*hist_cols)).select("dbt_scd_id", *cols, *SCD_COLS[1:])


def scd2_current(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter(F.col("dbt_valid_to").isNull())


def scd2_history(snapshot: DataFrame, key: str = PROGRAM_KEY) -> DataFrame:
    """All versions with their number, 1 for the first of its key (a key has a handful of versions)."""
    w = Window.partitionBy(key).orderBy("dbt_valid_from")
    return snapshot.withColumn("version", F.row_number().over(w).cast("bigint"))
