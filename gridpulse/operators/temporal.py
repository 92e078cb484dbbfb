"""Window operators over each area's series: rolling statistics, lags and seasonal differences.

All of them partition by ``area_id``, so on the output of ``dense_series`` none adds a shuffle. A
partition holds one value per seen timestamp, a bound set by the calendar and not by the raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridpulse.operators.series import by_time


LONG_WINDOW = 32  # from here on the block form is faster than walking the frame for every row


def _rolling_by_frame(series: DataFrame, window: int) -> DataFrame:
    frame = by_time().rowsBetween(1 - window, 0)
    full = F.count("value").over(frame) == window
    return series.select(
        "area_id", "ts", "value",
        F.when(full, F.avg("value").over(frame)).alias("rolling_mean"),
        F.when(full, F.stddev_samp("value").over(frame)).alias("rolling_std"),
    )


def _rolling_by_blocks(series: DataFrame, window: int) -> DataFrame:
    """Same result with a cost per row that does not depend on the window.

    Rows are cut into blocks of ``window`` rows. Every frame is the tail of one block and the head
    of the next, so running moments from both ends of the blocks are merged pairwise, which loses
    no precision.
    """
    place = (F.row_number().over(by_time()) - 1).cast("int")
    cut = series.select("area_id", "ts", "value", place.alias("place")).select(
        "area_id", "ts", "value", "place", F.floor(F.col("place") / F.lit(window)).cast("int").alias("block")
    )

    def moments(order: Column) -> Column:
        run = Window.partitionBy("area_id", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return F.struct(
            F.count("value").over(run).cast("double").alias("n"), F.avg("value").over(run).alias("mean"),
            F.var_pop("value").over(run).alias("var"),
        )

    ends = cut.withColumn("tail", moments(F.col("place").desc()))
    ends = ends.withColumn("head", moments(F.col("place").asc()))
    earlier = F.lag("tail", window - 1).over(Window.partitionBy("area_id").orderBy("place"))
    ends = ends.select(
        "area_id", "ts", "value", "head",
        F.when(F.col("place") % F.lit(window) != window - 1, earlier).alias("tail"),
    )
    n, m = F.coalesce("tail.n", F.lit(0.0)), F.col("head.n")
    mean, var = F.coalesce("tail.mean", F.lit(0.0)), F.coalesce("tail.var", F.lit(0.0))
    gap = F.col("head.mean") - mean
    full = (n + m) == window
    squares = n * var + m * F.col("head.var") + gap * gap * n * m / window
    return ends.select(
        "area_id", "ts", "value",
        F.when(full, mean + gap * m / window).alias("rolling_mean"),
        F.when(full, F.sqrt(squares / (window - 1))).alias("rolling_std"),
    )


def rolling(series: DataFrame, window: int) -> DataFrame:
    """Mean and sample standard deviation over the last ``window`` rows; NULL until the frame is full."""
    if window < 1:
        raise ValueError("window must be positive")
    return (_rolling_by_blocks if window >= LONG_WINDOW else _rolling_by_frame)(series, window)


def with_lag(series: DataFrame, period: int, name: str = "lagged", order: list[str] | None = None) -> DataFrame:
    """Each value beside the one ``period`` rows earlier in ``order`` (time order by default)."""
    if period < 1:
        raise ValueError("period must be positive")
    in_order = Window.partitionBy("area_id").orderBy(*(order or ["ts"]))
    return series.withColumn(name, F.lag("value", period).over(in_order))


def seasonal_difference(series: DataFrame, period: int, times: int = 1, order: list[str] | None = None) -> DataFrame:
    """``x_t - x_(t-period)`` applied ``times`` times as column ``diff``; rows without a full history are dropped."""
    if period < 1 or times < 0:
        raise ValueError("period must be positive and times must not be negative")
    in_order = Window.partitionBy("area_id").orderBy(*(order or ["ts"]))
    out = series.withColumn("diff", F.col("value"))
    for _ in range(times):
        out = out.withColumn("diff", F.col("diff") - F.lag("diff", period).over(in_order))
    return out.where(F.col("diff").isNotNull())


def undo_seasonal_difference(prediction: Column, lagged: Column, times: int = 1) -> Column:
    """Prediction on the original scale. Only 0 and 1 differences can be undone with one lag."""
    if times not in (0, 1):
        raise ValueError("only 0 or 1 seasonal differences can be inverted")
    return prediction + lagged if times else prediction


def recent(series: DataFrame, rows: int) -> DataFrame:
    """The last ``rows`` rows of every area."""
    if rows < 1:
        raise ValueError("rows must be positive")
    place = F.row_number().over(Window.partitionBy("area_id").orderBy(F.desc("ts")))
    return series.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")
