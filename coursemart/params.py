"""Run parameters: the model variables plus the clock of one run."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # Model variables and their defaults (must equal the reference's).
    pass_threshold_pct: float = 0.5
    score_band_excellent_pct: float = 0.85
    score_band_satisfactory_pct: float = 0.65
    retake_heavy_threshold: int = 3
    good_standing_gpa: float = 70.0
    at_risk_gpa: float = 50.0
    at_risk_inactivity_days: int = 60
    # Subject pass mark; hard-coded in the subject model, kept apart from pass_threshold_pct.
    subject_pass_mark: float = 50.0
    # Landing lookback for late commits.
    lookback_minutes: int = 10

    # The clock. ``as_of`` replaces current_date, ``run_ts`` replaces current_timestamp
    # (both literals so that a run is reproducible and the oracle can see the same values).
    as_of: str = "2001-08-01"
    run_ts: str = "2001-08-01 00:00:00"

    # Surrogate keys: "xxhash64" (fast, JVM-native) or "md5" (portable: equal to
    # ('0x' || substr(md5(k), 1, 15))::bigint in DuckDB, used for oracle comparisons).
    key_mode: str = "xxhash64"

    # A dimension is broadcast only when its checked row count times its estimated
    # row width stays under this many bytes; beyond it the join is left to a shuffle.
    broadcast_max_bytes: int = 64 * 1024 * 1024

    # Facts are stored in this many buckets of their key; choose it so that a bucket of the largest fact holds
    # 1-2 GB of Parquet (e.g. 65,536 for 100 TB).
    fact_buckets: int = 16

    # Ordered windows (attempts, trend): a group above ``hot_group_rows`` rows is numbered
    # across range partitions instead of in one task; found on a sample of this fraction.
    hot_group_rows: int = 5_000_000
    hot_sample_fraction: float = 0.001

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Parameters used by ``queries()`` and the oracle SQL.
ORACLE_PARAMS = Params(key_mode="md5")
