"""Hyper-parameter searches: every candidate on every area in one job, ranked by its criterion."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from gridpulse.functions.scalars import order_text
from gridpulse.operators import arma, scoring
from gridpulse.operators.preparation import Split
from gridpulse.session import materialize

# Candidate orders and grids of the published searches.
ORDERS: tuple[arma.Order, ...] = ((1, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 1))
LOOKBACKS = (12, 72, 144, 288)
UNITS = (32, 64, 128)


def candidate_grid(areas: DataFrame, **values: Sequence[int]) -> DataFrame:
    """Every area with all combinations of the named values, generated row by row."""
    grid = areas
    for name, options in values.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in options])))
    return grid


def order_search(series: DataFrame, split: Split, orders: Sequence[arma.Order] = ORDERS, period: int = 144,
                 seasonal_diff: int = 1, maxiter: int = 50) -> DataFrame:
    """ARIMA orders ranked by AIC, with their error on the test week; failed candidates come last as NaN."""
    fits = materialize(arma.fit_orders(series, split, orders, period, seasonal_diff, maxiter=maxiter))
    scores = scoring.evaluate(arma.predictions(fits, seasonal_diff), "area_id", "order")
    seasonal = f"(0, {seasonal_diff}, 0, {period})"
    table = fits.withColumn("order", order_text(F.col("p"), F.col("d"), F.col("q"))).join(
        scores, ["area_id", "order"]
    ).select(
        "area_id", "order", F.lit(seasonal).alias("seasonal_order"),
        F.coalesce("aic", F.lit(float("nan"))).alias("AIC"), F.coalesce("bic", F.lit(float("nan"))).alias("BIC"),
        F.col("MAE").alias("test_MAE"), F.col("RMSE").alias("test_RMSE"), F.col("MAPE").alias("test_MAPE"), "train_time_s",
    )
    return scoring.ranked_by_error(table, "AIC", "area_id", "order")


class Search(NamedTuple):
    """Candidates by criterion, and how long they took where Python fitted them."""

    ranked: DataFrame
    times: DataFrame


def search_with_times(series: DataFrame, split: Split, orders: Sequence[arma.Order] = ORDERS, period: int = 144,
                      seasonal_diff: int = 1, maxiter: int = 50) -> Search:
    """:func:`order_search` with the wall times in a table of their own, so that the first table is the same in every run."""
    table = materialize(order_search(series, split, orders, period, seasonal_diff, maxiter))
    return Search(scoring.ranked_by_error(table.drop("train_time_s"), "AIC", "area_id", "order"),
                  table.select("area_id", "order", "train_time_s"))


AR_ORDERS = (1, 2, 3)


def ar_order_search(series: DataFrame, split: Split, orders: Sequence[int] = AR_ORDERS, period: int = 144, seasonal_diff: int = 1,
                    tail_rows: int | None = None) -> DataFrame:
    """The order search among pure autoregressions, in closed form and without Python; columns as of :func:`order_search` but no time.

    The rows of every area are kept once: fits and predictions read them, partitioned by area. ``tail_rows`` trains on the last rows only.
    """
    rows = materialize(arma.with_lags(series, split, max(orders), period, seasonal_diff, tail_rows))
    fits = materialize(arma.ar_fits(rows, orders))
    scores = scoring.evaluate(arma.ar_predictions(rows, fits, seasonal_diff), "area_id", "order")
    table = fits.withColumn("order", order_text(F.col("p"), F.lit(0), F.lit(0))).join(scores, ["area_id", "order"]).select(
        "area_id", "order", F.lit(f"(0, {seasonal_diff}, 0, {period})").alias("seasonal_order"), F.col("aic").alias("AIC"), F.col("bic").alias("BIC"),
        F.col("MAE").alias("test_MAE"), F.col("RMSE").alias("test_RMSE"), F.col("MAPE").alias("test_MAPE"))
    return scoring.ranked_by_error(table, "AIC", "area_id", "order")


def ar_validation_search(series: DataFrame, split: Split, orders: Sequence[int] = AR_ORDERS, period: int = 144, seasonal_diff: int = 1,
                         val_fraction: float = 0.15) -> DataFrame:
    """The same candidates ranked by their error on the validation rows, the last ``val_fraction`` of the training rows; the test week plays no part.

    Candidates are fitted on the rows before the validation rows and predict those one step ahead. Columns ``val_MAE, val_RMSE, val_MAPE``.
    """
    if not 0 < val_fraction < 1:
        raise ValueError("val_fraction lies between 0 and 1")
    pool = arma.with_lags(series, split, max(orders), period, seasonal_diff).where(~F.col("is_test"))
    n = F.count("*").over(Window.partitionBy("area_id"))
    place = F.row_number().over(Window.partitionBy("area_id").orderBy("place"))
    rows = materialize(pool.withColumn("is_test", place > n - F.greatest(F.lit(1), F.bround(n * F.lit(val_fraction), 0))))
    fits = materialize(arma.ar_fits(rows, orders))
    scores = scoring.evaluate(arma.ar_predictions(rows, fits, seasonal_diff), "area_id", "order")
    return scoring.ranked_by_error(scores.select(
        "area_id", "order", F.col("MAE").alias("val_MAE"), F.col("RMSE").alias("val_RMSE"), F.col("MAPE").alias("val_MAPE"), F.col("n").alias("n_val")),
        "val_RMSE", "area_id", "order")
