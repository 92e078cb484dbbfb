"""Measurement records over the given tables, and raw files that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.functions.calendar import bucket_start
from gridpulse.operators.series import clip_to_dates
from gridpulse.session import scratch_path

# Event types in alphabetical order; their position is the area id.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
STEP_MINUTES = 60
PERIOD = 24
STUDY = ("2024-01-02", "2024-01-29")
FIRST_WEEKS = ("2024-01-02", "2024-01-15")
TEST_WEEK = ("2024-01-22", "2024-01-28")

_raw_folders: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def type_id(event_type: str = "event_type"):
    """Area id of an event type; the job fails for a type that is not listed."""
    place = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col(event_type)).cast("int")
    return F.when(place > 0, place).otherwise(F.raise_error(F.concat(F.lit("unknown event type "), F.coalesce(F.col(event_type), F.lit("null")))).cast("int"))


def by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Five areas with very many records each."""
    return table(spark, folder, "events").select(
        type_id().alias("area_id"), bucket_start("ts", "1 hour").alias("ts"), "value"
    )


def by_user(spark: SparkSession, folder: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Many areas with sparse records. A date range is applied to the stored column, so that it reaches the scan."""
    events = table(spark, folder, "events")
    if days:
        events = clip_to_dates(events, *days)
    return events.select(
        (F.col("user_id") + 1).cast("int").alias("area_id"), bucket_start("ts", "1 hour").alias("ts"), "value"
    )


def by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """Long daily series."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_suppkey") + 1).cast("int").alias("area_id"), F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("value"),
    )


def part_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of many areas, for distribution and grid."""
    return table(spark, folder, "lineitem").groupBy((F.col("l_partkey") + 1).cast("int").alias("area_id")).agg(
        F.sum("l_quantity").alias("total_traffic")
    )


def raw_folder(spark: SparkSession, folder: str) -> str:
    """The events as raw daily text, one folder per UTC day, written once per application.

    One hour before local time, blanks for the unused columns, the event type as country code.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _raw_folders:
        path = scratch_path(spark, "raw")
        stamped = table(spark, folder, "events").select(
            "*", F.expr("window(ts, '1 hour').start - INTERVAL 1 HOUR").alias("utc")
        )
        fields = [
            (F.col("user_id") + 1).cast("string"),
            F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', utc)").cast("string"),
            type_id().cast("string"),
            *[F.lit("")] * 4,
            F.col("value").cast("string"),
        ]
        lines = stamped.select(F.concat_ws("\t", *fields).alias("line"), F.to_date("utc").alias("day"))
        lines.hint("rebalance", "day").write.partitionBy("day").text(path)  # files by size, not one per task and day
        _raw_folders[key] = path
    return _raw_folders[key]
