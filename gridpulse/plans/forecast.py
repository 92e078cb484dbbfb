"""A full forecasting run: every area by every model, with metric, timing and summary tables, and its stored results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.operators import arma, scoring, temporal
from gridpulse.operators.preparation import Split
from gridpulse.session import materialize
from gridpulse.sources import manifest, tables

SARIMA = "SARIMA"


class Run(NamedTuple):
    predictions: DataFrame
    metrics: DataFrame
    timing: DataFrame
    timing_summary: DataFrame
    metric_summary: DataFrame


def naive_predictions(series: DataFrame, split: Split, lags: dict[str, int]) -> DataFrame:
    """Test-week predictions of seasonal naive models: the value of so many rows before."""
    lagged = series
    for name, period in lags.items():
        lagged = temporal.with_lag(lagged, period, name)
    test = lagged.where(split.is_test(F.col("ts"))).withColumnRenamed("value", "y_true")
    return test.unpivot(["area_id", "ts", "y_true"], list(lags), "model", "y_pred")


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Mean error per model over the areas that were fitted, and how many were not."""
    fitted = ~F.isnan("MAE")
    return metrics.groupBy("model").agg(
        *[F.round(F.avg(F.when(fitted, F.col(c))), 3).alias(c) for c in ("MAE", "RMSE", "MAPE")],
        F.count_if(~fitted).alias("failed"),
    )


def forecast_run(series: DataFrame, split: Split, order: arma.Order = (2, 0, 2), period: int = 144,
                 lags: dict[str, int] | None = None, tail_rows: int | None = None, maxiter: int = 50) -> Run:
    """SARIMA and seasonal naive models. The fits are materialised, because every result table reads them."""
    sarima = materialize(arma.fit_orders(series, split, (order,), period, 1, tail_rows, maxiter))
    columns = ("area_id", "model", "ts", "y_true", "y_pred")
    predictions = arma.predictions(sarima).select(*columns)
    if lags:
        predictions = predictions.unionByName(naive_predictions(series, split, lags).select(*columns))
    timing = sarima.select("area_id", F.lit(SARIMA).alias("model"), "train_time_s", "predict_time_s")
    metrics = scoring.evaluate(predictions, "area_id", "model")
    measured = timing.groupBy("model").agg(F.format_string("mean of %d areas", F.count("*")).alias("measured_over"))
    return Run(
        predictions, metrics, timing,
        scoring.mean_by(timing, "model", "train_time_s", "predict_time_s").join(measured, "model"),
        metric_summary(metrics),
    )


TABLES = ("predictions", "metrics", "timing", "timing_summary", "metric_summary")


def store_run(run: Run, path: str) -> str:
    """The result files of a run: predictions side by side, metrics, timing in detail and summed up, metric summary. Returns its name.

    Every table of a run lies in ``<table>/run=<name>``. The run counts from the instant its manifest appears, after the last table, so a driver
    lost in between leaves the run before it whole. Runs older than that one are removed.
    """
    spark, name = run.metrics.sparkSession, uuid.uuid4().hex
    models = sorted(r["model"] for r in run.metric_summary.select("model").collect())  # one row per model
    before = manifest.latest(spark, path)
    for table in TABLES:
        frame = scoring.side_by_side(run.predictions, models) if table == "predictions" else getattr(run, table)
        tables.write_log(frame, f"{path}/{table}/run={name}")
    manifest.publish(spark, path, before["version"] + 1 if before else 0, {"run": name, "before": before["run"] if before else None})
    kept = {f"run={name}", f"run={before['run']}" if before else None}
    for table in TABLES:
        for other in set(manifest.children(spark, f"{path}/{table}")) - kept:
            manifest.remove(spark, f"{path}/{table}/{other}")
    return name


def read_run(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """One table of the newest whole run."""
    now = manifest.latest(spark, path)
    if now is None:
        raise FileNotFoundError(f"{path} holds no finished run")
    return tables.read_report(spark, f"{path}/{table}/run={now['run']}", schema)


def sample_run(spark: SparkSession, path: str, fixed: Sequence[int], split: Split, order: arma.Order = (2, 0, 2), period: int = 144,
               lags: dict[str, int] | None = None) -> DataFrame:
    """The run from a small stored sample of area series instead of the whole matrix: metrics per label, area and model.

    An area that carries two labels is fitted once.
    """
    labelled = materialize(tables.read_sample(spark, path, fixed))
    run = forecast_run(labelled.select("area_id", "ts", "value").distinct(), split, order, period, lags)
    return labelled.select("label", "area_id").distinct().join(run.metrics, "area_id").select("label", *run.metrics.columns)
