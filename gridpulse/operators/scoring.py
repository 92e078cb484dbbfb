"""Alignment of truth and prediction, error metrics and per-model summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.functions.scalars import require

EPS = 1e-8  # fixed value: smallest denominator of the percentage errors
NEAR_ZERO = 1.0  # fixed value: truths below this make MAPE unreliable


def align(truth: DataFrame, prediction: DataFrame, keys: Sequence[str] = ("area_id", "ts")) -> DataFrame:
    """Truth (``y_true``) and prediction (``y_pred``) side by side; the job fails where one has no partner."""
    both = truth.join(prediction, list(keys), "full_outer")
    return both.select(
        *[c for c in both.columns if c not in ("y_true", "y_pred")],
        *[require(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull(),
                  "truth and prediction do not cover the same rows", F.col(c)).alias(c) for c in ("y_true", "y_pred")],
    )


def _error() -> Column:
    return F.abs(require(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull(),
                         "a truth or prediction is missing", F.col("y_true") - F.col("y_pred")))


def mae() -> Column:
    return F.avg(_error())


def rmse() -> Column:
    return F.sqrt(F.avg(_error() * _error()))


def mape() -> Column:
    return F.avg(_error() / F.greatest(F.abs("y_true"), F.lit(EPS))) * 100.0


def smape() -> Column:
    return F.avg(_error() / F.greatest((F.abs("y_true") + F.abs("y_pred")) / 2.0, F.lit(EPS))) * 100.0


def evaluate(predictions: DataFrame, *keys: str) -> DataFrame:
    """One row of metrics per group (per model by default), all from one aggregation."""
    keys = keys or ("model",)
    return predictions.groupBy(*keys).agg(
        mae().alias("MAE"), rmse().alias("RMSE"), mape().alias("MAPE"), smape().alias("sMAPE"),
        F.count("*").alias("n"), F.count_if(F.abs("y_true") < NEAR_ZERO).alias("n_near_zero"),
    )


def mean_by(table: DataFrame, key: str, *columns: str, digits: int = 3) -> DataFrame:
    """Mean of each column per key, rounded: the timing and accuracy summaries."""
    return table.groupBy(key).agg(*[F.round(F.avg(c), digits).alias(c) for c in columns])


def absolute_errors(predictions: DataFrame) -> DataFrame:
    return predictions.select("area_id", "model", "ts", F.abs(F.col("y_true") - F.col("y_pred")).alias("abs_error"))


def side_by_side(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per area and timestamp with a truth and a prediction column per model.

    Conditional aggregates over the listed models need one shuffle where a pivot needs two.
    """
    return predictions.groupBy("area_id", "ts").agg(*[
        F.first(F.when(F.col("model") == m, F.col(c)), ignorenulls=True).alias(f"{m}_{c}")
        for m in models for c in ("y_true", "y_pred")
    ])


def error_order(column: str = "val_RMSE", *ties: str) -> list[Column]:
    """Sort keys: best first; failed candidates (NaN or NULL) last."""
    return [F.col(column).asc_nulls_last(), *[F.col(tie).asc() for tie in ties]]


def ranked_by_error(table: DataFrame, column: str = "val_RMSE", *ties: str) -> DataFrame:
    """Best first; failed candidates (NaN or NULL) last."""
    return table.orderBy(*error_order(column, *ties))
