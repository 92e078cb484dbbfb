"""From dense series to scaled, labelled, windowed training data, for all areas in one lineage."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from gridpulse.functions.calendar import ntz, within_dates
from gridpulse.operators.series import by_time, whole_series

SCALERS = ("minmax", "standard", "log-minmax")


class Split(NamedTuple):
    """The held-out week (inclusive dates) and which of the other rows may be trained on.

    ``before`` uses only rows earlier than the test week; ``outside`` uses every row not in it.
    """

    first_day: str
    last_day: str
    scope: str = "before"

    def is_test(self, ts: Column) -> Column:
        return within_dates(ts, self.first_day, self.last_day)

    def is_train(self, ts: Column) -> Column:
        if self.scope == "before":
            return ts < ntz(self.first_day)
        if self.scope == "outside":
            return ~self.is_test(ts)
        raise ValueError("scope must be 'before' or 'outside'")

    def order(self) -> list[str]:
        """Ordering in which test rows directly follow the training rows."""
        return ["ts"] if self.scope == "before" else ["is_test", "ts"]


def split_rows(series: DataFrame, split: Split) -> DataFrame:
    """Adds ``is_test`` and drops rows that are neither test nor training rows."""
    ts = F.col("ts")
    return series.where(split.is_test(ts) | split.is_train(ts)).withColumn("is_test", split.is_test(ts))


def _checked(kind: str) -> str:
    if kind not in SCALERS:
        raise ValueError(f"unknown scaler: {kind}")
    return kind


def _on_scale(value: Column, kind: str) -> Column:
    return F.log1p(value) if kind == "log-minmax" else value


def _offset_and_range(kind: str, value: Column, group: WindowSpec | None = None) -> tuple[Column, Column]:
    def over(aggregate: Column) -> Column:
        return aggregate if group is None else aggregate.over(group)

    if kind == "standard":
        return over(F.avg(value)), over(F.stddev_pop(value))
    return over(F.min(value)), over(F.max(value)) - over(F.min(value))


def fit_scaler(series: DataFrame, kind: str, split: Split) -> DataFrame:
    """``area_id, kind, offset, scale`` from the training rows; a constant series gets scale 1."""
    x = _on_scale(F.col("value"), _checked(kind))
    offset, spread = _offset_and_range(kind, x)
    fitted = series.where(split.is_train(F.col("ts"))).groupBy("area_id").agg(offset.alias("offset"), spread.alias("spread"))
    return fitted.select(
        "area_id", F.lit(kind).alias("kind"), "offset",
        F.when(F.col("spread") > 0, F.col("spread")).otherwise(F.lit(1.0)).alias("scale"),
    )


def fit_scalers(series: DataFrame, split: Split) -> DataFrame:
    """``fit_scaler`` for every kind at once, from one pass over the training rows."""
    x, y = F.col("value"), F.log1p("value")
    fitted = series.where(split.is_train(F.col("ts"))).groupBy("area_id").agg(F.array(*[
        F.struct(F.lit(kind).alias("kind"), offset.alias("offset"), spread.alias("spread"))
        for kind, value in (("minmax", x), ("standard", x), ("log-minmax", y)) for offset, spread in [_offset_and_range(kind, value)]
    ]).alias("fits"))
    return fitted.select("area_id", F.inline("fits")).select(
        "area_id", "kind", "offset", F.when(F.col("spread") > 0, F.col("spread")).otherwise(F.lit(1.0)).alias("scale"))


def scaled_series(series: DataFrame, kind: str, split: Split) -> DataFrame:
    """Fit and ``transform`` in one lineage, as windows over the series; an area without training rows is left out."""
    group = whole_series()
    train_value = F.when(split.is_train(F.col("ts")), _on_scale(F.col("value"), _checked(kind)))
    offset, spread = _offset_and_range(kind, train_value, group)
    rows = series.select("*", offset.alias("offset"), spread.alias("_spread")).where(F.col("offset").isNotNull())
    return rows.withColumn("scale", F.when(F.col("_spread") > 0, F.col("_spread")).otherwise(F.lit(1.0))).drop("_spread").withColumn(
        "scaled", scaled(F.col("value"), kind))


def scaled(value: Column, kind: str) -> Column:
    """``value`` on the scale given by columns ``offset`` and ``scale``."""
    return (_on_scale(value, _checked(kind)) - F.col("offset")) / F.col("scale")


def unscaled(value: Column, kind: str) -> Column:
    back = value * F.col("scale") + F.col("offset")
    return F.expm1(back) if _checked(kind) == "log-minmax" else back


def transform(series: DataFrame, params: DataFrame, kind: str) -> DataFrame:
    """Joins previously fitted parameters and adds ``scaled``; an area without parameters is left out."""
    return series.join(params.drop("kind"), "area_id").withColumn("scaled", scaled(F.col("value"), kind))


def inverse_transform(scaled_series: DataFrame, kind: str) -> DataFrame:
    return scaled_series.withColumn("restored", unscaled(F.col("scaled"), kind))


def sliding_windows(series: DataFrame, lookback: int, value: str = "value") -> DataFrame:
    """The previous ``lookback`` values as array ``x`` and the current one as target ``y``.

    The job fails for an area with no more than ``lookback`` values.
    """
    if lookback < 1:
        raise ValueError("lookback must be positive")
    past = by_time().rowsBetween(-lookback, -1)
    out = series.select("*", F.collect_list(value).over(past).alias("x"), F.count(value).over(whole_series()).alias("_n"))
    enough = F.when(F.col("_n") > lookback, F.size("x") == lookback).otherwise(
        F.raise_error(F.lit(f"a series is not longer than the lookback of {lookback}")).cast("boolean")
    )
    return out.where(enough).withColumn("y", F.col(value)).drop("_n")


def labelled(series: DataFrame, split: Split, lookback: Column | int, val_fraction: float = 0.15,
             kind: str = "minmax", keys: Sequence[str] = ("area_id",)) -> DataFrame:
    """Every row with scaler parameters, ``scaled`` value and the ``split`` its window belongs to.

    ``split`` is ``train``, ``val`` or ``test``, or NULL for rows that only serve as history. The
    last ``max(1, round(n * val_fraction))`` training windows are for validation. ``lookback`` may
    be a column, so that several look-backs go through one job.
    """
    _checked(kind)
    if not 0 <= val_fraction < 1:
        raise ValueError("val_fraction must be at least 0 and below 1")
    lookback = F.lit(lookback) if isinstance(lookback, int) else lookback
    group = whole_series(*keys)
    in_time = Window.partitionBy(*keys).orderBy("ts")
    ts = F.col("ts")

    train_value = F.when(split.is_train(ts), _on_scale(F.col("value"), kind))
    offset, spread = _offset_and_range(kind, train_value, group)
    rows = series.where(split.is_test(ts) | split.is_train(ts))
    out = rows.select(
        *series.columns,
        offset.alias("offset"), spread.alias("_spread"),
        split.is_test(ts).alias("_test"), split.is_train(ts).alias("_train"),
        (F.row_number().over(in_time) > lookback).alias("_full"),
    )
    pool = F.col("_full") & F.col("_train")
    out = out.select(
        *series.columns, "offset",
        F.when(F.col("_spread") > 0, F.col("_spread")).otherwise(F.lit(1.0)).alias("scale"),
        (F.col("_full") & F.col("_test")).alias("_test"), pool.alias("_pool"),
        F.count_if(F.col("_test")).over(group).alias("_tests"),
        F.count_if(pool).over(group).alias("_pools"),
        F.count_if(pool).over(in_time.rowsBetween(Window.unboundedPreceding, 0)).alias("_place"),
    )
    n_val = F.greatest(F.lit(1), F.bround(F.col("_pools") * F.lit(val_fraction), 0).cast("int"))
    label = (
        F.when(F.col("_tests") == 0, F.raise_error(F.lit("no row falls in the test week")).cast("string"))
        .when(F.col("_pools") == 0, F.raise_error(F.lit("no training window: series not longer than the lookback")).cast("string"))
        .when(F.col("_test"), "test")
        .when(F.col("_pool") & (F.col("_place") > F.col("_pools") - n_val), "val")
        .when(F.col("_pool"), "train")
    )
    return out.select(*series.columns, "offset", "scale", scaled(F.col("value"), kind).alias("scaled"), label.alias("split"))


def forecasting_data(series: DataFrame, split: Split, lookback: int = 12, val_fraction: float = 0.15,
                     kind: str = "minmax") -> DataFrame:
    """``area_id, ts, x, y, y_actual, split``: the windows of all areas, routed by target date."""
    rows = labelled(series, split, lookback, val_fraction, kind)
    windows = sliding_windows(rows, lookback, "scaled").where(F.col("split").isNotNull())
    return windows.select("area_id", "ts", "x", "y", unscaled(F.col("y"), kind).alias("y_actual"), "split")


def split_sizes(windows: DataFrame) -> DataFrame:
    return windows.groupBy("area_id").agg(
        *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")]
    )
