"""Roll-up, densification and selection of area series.

A record is ``(area_id, ts, value)`` with any number of rows per cell (one per country, say); a
dense series has exactly one row per area and seen timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from gridpulse.functions.calendar import within_dates
from gridpulse.functions.scalars import area_label, no_activity_as_zero
from gridpulse.session import broadcast_if_small, materialize, spread


def by_time() -> WindowSpec:
    return Window.partitionBy("area_id").orderBy("ts")


def whole_series(*keys: str) -> WindowSpec:
    """All rows of a series. It keeps the time order, so that one sort serves this and the running frames."""
    in_time = Window.partitionBy(*(keys or ("area_id",))).orderBy("ts")
    return in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def rollup(records: DataFrame, *keys: str) -> DataFrame:
    """Total per area and interval; missing activity counts as 0. Map-side combine absorbs hot areas."""
    keys = keys or ("area_id", "ts")
    return records.groupBy(*keys).agg(F.sum(no_activity_as_zero(F.col("value"))).alias("value"))


# A time axis is numbered in one task. So many timestamps are seconds of four months, or ten-minute steps of two centuries.
LONGEST_AXIS = 10_000_000


def time_axis(records: DataFrame, study: tuple[str, str] | None = None, source: str | None = None) -> DataFrame:
    """Seen timestamps with their 1-based position ``slot``, materialised.

    The axis is as long as the calendar allows (8,784 rows for two months of 10-minute steps)
    however many records there are, so numbering it in one task is safe; stamps so fine that there are more than ``LONGEST_AXIS``
    of them fail the job (put them in intervals first). With ``source`` the first
    file (by name) that has a timestamp is its ``owner``.
    """
    seen = records.where(F.col("ts").isNotNull())
    if study:
        seen = seen.where(within_dates(F.col("ts"), *study))
    axis = seen.groupBy("ts").agg(F.min(source).alias("owner")) if source else seen.select("ts").distinct()
    place = F.row_number().over(Window.orderBy("ts"))
    too_long = F.raise_error(F.lit(f"more than {LONGEST_AXIS} timestamps: put them in intervals first")).cast("int")
    return materialize(axis.withColumn("slot", F.when(place <= LONGEST_AXIS, place).otherwise(too_long)))


def dense_series(records: DataFrame, study: tuple[str, str] | None = None, source: str | None = None,
                 duplicates: str = "first") -> DataFrame:
    """One row per area and seen timestamp; cells without a record hold 0.

    Areas come from all records, timestamps only from the study window: an area seen only outside
    it stays as a zero series. When several files carry one timestamp, ``duplicates="first"`` keeps
    the rows of the file with the lowest name and ``"sum"`` adds them up.

    Records are combined by cell first, in one scan, and kept; the time axis and the filling are taken from the cells, so
    no raw record meets a join. Instead of pairing every area with every timestamp, each area's own cells are put in time
    order and only the gaps between neighbours are generated. The result stays partitioned by ``area_id`` for the window
    operators that follow.
    """
    if duplicates not in ("first", "sum"):
        raise ValueError("duplicates must be 'first' or 'sum'")
    owned = bool(source) and duplicates == "first"
    # A time of NULL gathers everything outside the window: it only proves that the area exists.
    ts = F.when(within_dates(F.col("ts"), *study), F.col("ts")) if study else F.col("ts")
    keys = ["area_id", "ts", *([source] if owned else [])]
    cells = materialize(records.withColumn("ts", ts).groupBy(*keys).agg(F.sum(no_activity_as_zero(F.col("value"))).alias("value")))
    axis = time_axis(cells, source=source if owned else None)
    slots = axis.count()
    lookup = broadcast_if_small(axis)

    placed = cells.join(lookup, "ts", "left").withColumn("slot", F.coalesce("slot", F.lit(0)))
    if owned:
        value = F.when((F.col(source) == F.col("owner")) & (F.col("slot") > 0), F.col("value")).otherwise(F.lit(0.0))
        placed = placed.groupBy("area_id", "slot").agg(F.sum(value).alias("value"))
    cells = placed.select("area_id", "slot", "value")
    in_order = Window.partitionBy("area_id").orderBy("slot")
    first = F.when(F.lag("slot").over(in_order).isNull(), F.lit(1)).otherwise(F.col("slot"))
    last = F.coalesce(F.lead("slot").over(in_order), F.lit(slots + 1)) - 1
    runs = spread(cells, "area_id").select("area_id", "slot", "value", first.alias("first"), last.alias("last"))
    filled = runs.where("first <= last").select(
        "area_id", F.explode(F.sequence("first", "last")).alias("at"), "slot", "value"
    )
    return (
        filled.join(lookup.select(F.col("slot").alias("at"), "ts"), "at")
        .select("area_id", "ts", F.when(F.col("at") == F.col("slot"), F.col("value")).otherwise(F.lit(0.0)).alias("value"))
    )


def keep_first_file(records: DataFrame, source: str) -> DataFrame:
    """Rows whose timestamp is not already present in a file with a lower name."""
    axis = broadcast_if_small(time_axis(records, source=source))
    return records.join(axis.select("ts", "owner"), "ts").where(F.col(source) == F.col("owner")).drop("owner")


def clip_to_dates(series: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Rows within the inclusive date range; a plain range predicate that reaches the Parquet scan."""
    return series.where(within_dates(F.col("ts"), first_day, last_day))


def one_area(series: DataFrame, area_id: int) -> DataFrame:
    """One area's series with its label; an error if the area is absent."""
    found = series.where(F.col("area_id") == area_id)
    if found.select("area_id").isEmpty():
        raise KeyError(f"area {area_id} is not in the series table")
    return found.withColumn("series", area_label(F.col("area_id")))


def of_targets(series: DataFrame, targets: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """The labelled target areas within the date range; targets without rows are skipped."""
    return clip_to_dates(series, first_day, last_day).join(
        broadcast_if_small(targets), "area_id"
    ).select("label", "area_id", "ts", "value")


def shape(series: DataFrame) -> DataFrame:
    """Number of time steps and of areas."""
    return series.agg(F.count_distinct("ts").alias("steps"), F.count_distinct("area_id").alias("areas"))


def wide_matrix(records: DataFrame, areas: Sequence[int]) -> DataFrame:
    """Summed values with one column per listed area; the list must be explicit and short."""
    if not areas:
        raise ValueError("name the areas to pivot")
    wide = records.where(F.col("area_id").isin(list(areas))).groupBy("ts").pivot("area_id", list(areas)).agg(F.sum("value"))
    return wide.select("ts", *[F.col(str(a)).alias(f"area_{a}") for a in areas])


def append_days(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Stack wide frames whose columns differ; a column missing on one side becomes NULL."""
    stacked = first
    for frame in more:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def in_time_order(series: DataFrame) -> DataFrame:
    return series.orderBy("area_id", "ts")


def narrowed(series: DataFrame) -> DataFrame:
    """Storage types: 32-bit id and 32-bit float."""
    return series.select(F.col("area_id").cast("int"), "ts", F.col("value").cast("float"))
