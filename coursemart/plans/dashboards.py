"""Dashboard aggregates over the programme-enrollment wide table (all are partial/final
aggregates: one small row per group, no wide shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.exprs import round_half_away, safe_div


def _active(obt_pe: DataFrame) -> DataFrame:
    return obt_pe.filter(F.col("status") == "Active")


def _risk_counts(df: DataFrame, by: list) -> DataFrame:
    risk = F.col("is_at_risk")
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("active_enrollments"),
                            F.count(F.when(risk, 1)).alias("at_risk"),
                            F.count(F.when(~risk, 1)).alias("on_track"))
    return g.withColumn("at_risk_rate", round_half_away(safe_div("at_risk", "active_enrollments"), 4))


def dash_active_summary(obt_pe: DataFrame) -> DataFrame:
    """Active enrollments split on-track / at-risk."""
    return _active(obt_pe).groupBy("is_at_risk").agg(F.count(F.lit(1)).alias("enrollments"))


def dash_graduation_trend(obt_pe: DataFrame) -> DataFrame:
    """Graduations per completion month."""
    g = obt_pe.filter(F.col("status") == "Graduated")
    return (g.groupBy(F.trunc("completion_date", "month").alias("completion_month"))
            .agg(F.count(F.lit(1)).alias("graduations")))


def dash_by_department(obt_pe: DataFrame) -> DataFrame:
    return _risk_counts(_active(obt_pe), ["department"])


def dash_by_level(obt_pe: DataFrame) -> DataFrame:
    return _risk_counts(_active(obt_pe), ["degree_level"])


def dash_by_grad_month(obt_pe: DataFrame) -> DataFrame:
    """Active enrollments by expected graduation month."""
    return (_active(obt_pe)
            .groupBy(F.date_trunc("month", "expected_graduation_date").cast("date").alias("expected_graduation_month"))
            .agg(F.count(F.lit(1)).alias("active_enrollments")))
