"""Robust seasonal anomalies: relative deviation from the weekly profile, scaled by the MAD, per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridpulse.functions.calendar import slot_of_day, weekday

# MAD-to-sigma factor, share of the typical level used as denominator floor, its minimum.
MAD_SCALE = 1.4826
FLOOR_SHARE = 0.05
FLOOR_MIN = 1e-6


def _with_slot(series: DataFrame, step_minutes: int) -> DataFrame:
    return series.where(F.col("value").isNotNull()).select(
        "area_id", "ts", "value",
        weekday(F.col("ts")).alias("dow"),
        slot_of_day(F.col("ts"), step_minutes).alias("slot"),
    )


def weekly_profile(series: DataFrame, step_minutes: int = 10) -> DataFrame:
    """Exact median per area, weekday and slot of day (one value per week in each group)."""
    return _with_slot(series, step_minutes).groupBy("area_id", "dow", "slot").agg(
        F.percentile("value", 0.5).alias("expected")
    )


def scores(series: DataFrame, step_minutes: int = 10) -> DataFrame:
    """Every row with its expected value and robust z.

    The four medians are windows inside one partitioning by ``area_id``: the plan has a single
    shuffle (none on a dense series) and no join back.
    """
    area = Window.partitionBy("area_id")
    group = Window.partitionBy("area_id", "dow", "slot")
    out = _with_slot(series, step_minutes).withColumn("expected", F.percentile("value", 0.5).over(group))
    out = out.withColumn("typical", F.percentile("expected", 0.5).over(area))
    floor = F.greatest(F.col("typical") * FLOOR_SHARE, F.lit(FLOOR_MIN))
    out = out.withColumn("rel", (F.col("value") - F.col("expected")) / F.greatest("expected", floor))
    out = out.withColumn("dev", F.col("rel") - F.percentile("rel", 0.5).over(area))
    mad = F.percentile(F.abs("dev"), 0.5).over(area) * MAD_SCALE
    out = out.withColumn("mad", mad)
    scale = F.when(F.col("mad") > 0, F.col("mad")).otherwise(F.lit(1.0))
    return out.select("area_id", "ts", "value", "expected", (F.col("dev") / scale).alias("robust_z"))


def anomalies(series: DataFrame, threshold: float = 4.0, step_minutes: int = 10) -> DataFrame:
    """Rows whose robust z exceeds the threshold in absolute value."""
    return scores(series, step_minutes).where(F.abs("robust_z") > threshold).withColumnRenamed("ts", "timestamp")


def strongest(flagged: DataFrame, limit: int = 50) -> DataFrame:
    """The report of the ``limit`` strongest anomalies over all areas."""
    return flagged.orderBy(F.desc(F.abs("robust_z")), "timestamp", "area_id").limit(limit)


def strongest_per_area(flagged: DataFrame, limit: int = 50) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("area_id").orderBy(F.desc(F.abs("robust_z")), "timestamp"))
    return flagged.withColumn("place", place).where(F.col("place") <= limit)


def counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("area_id").agg(F.count("*").alias("anomalies"))
