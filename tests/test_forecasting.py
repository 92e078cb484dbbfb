import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import column
from pyspark.sql import functions as F

from gridpulse.operators import arma, experiments, preparation, scoring
from gridpulse.operators.preparation import Split
from gridpulse.plans.forecast import forecast_run, metric_summary, store_run

HOUR = timedelta(hours=1)


def simulate(n, ar, ma, c=0.3, seed=0):
    e, w = np.random.default_rng(seed).standard_normal(n), np.zeros(n)
    for t in range(n):
        w[t] = c + e[t] + sum(a * w[t - i] for i, a in enumerate(ar, 1) if t >= i) + sum(b * e[t - i] for i, b in enumerate(ma, 1) if t >= i)
    return w, e


# --- split and scaling -------------------------------------------------------------------------

def test_split_scopes(daily):
    frame = daily({1: range(1, 11)})
    before, outside = Split("2024-01-05", "2024-01-06"), Split("2024-01-05", "2024-01-06", "outside")
    assert [r.value for r in preparation.split_rows(frame, before).where("NOT is_test").orderBy("ts").collect()] == [1, 2, 3, 4]
    assert [r.value for r in preparation.split_rows(frame, outside).where("NOT is_test").orderBy("ts").collect()] == [1, 2, 3, 4, 7, 8, 9, 10]
    lag = {s.scope: arma._with_history(frame, s, 2, 1, None).where("is_test").orderBy("ts").first().lagged for s in (before, outside)}
    assert lag == {"before": 3.0, "outside": 9.0}
    with pytest.raises(ValueError):
        frame.where(Split("2024-01-05", "2024-01-06", "after").is_train(F.col("ts")))


def test_scalers(daily):
    frame, split = daily({1: [0, 10, 20, 30], 2: [4, 4, 4, 4]}), Split("2024-01-04", "2024-01-04")
    want = {"minmax": 1.5, "standard": 2.449490, "log-minmax": math.log1p(30) / math.log1p(20)}
    for kind, value in want.items():
        out = preparation.transform(frame, preparation.fit_scaler(frame, kind, split), kind)
        assert math.isclose(column(out.where("area_id = 1"), "scaled")[3], value, abs_tol=1e-6)
        assert column(out.where("area_id = 2"), "scaled") == [0.0] * 4
        assert np.allclose(column(preparation.inverse_transform(out, kind), "restored"), [0, 10, 20, 30, 4, 4, 4, 4])
    log = preparation.transform(frame, preparation.fit_scaler(frame, "log-minmax", split), "log-minmax")
    assert math.isclose(column(log.where("area_id = 1"), "scaled")[1], 0.787610, abs_tol=1e-6)
    with pytest.raises(ValueError):
        preparation.fit_scaler(frame, "robust", split)


def test_sliding_windows(daily):
    out = preparation.sliding_windows(daily({1: [1, 2, 4, 8]}), 2).orderBy("ts").collect()
    assert [(r.x, r.y) for r in out] == [([1.0, 2.0], 4.0), ([2.0, 4.0], 8.0)]
    with pytest.raises(Exception, match="not longer than the lookback"):
        preparation.sliding_windows(daily({1: [1, 2]}), 2).collect()
    with pytest.raises(ValueError):
        preparation.sliding_windows(daily({1: [1, 2]}), 0)


@pytest.mark.parametrize("n, n_val", [(3, 1), (10, 2), (30, 4), (50, 8)])
def test_validation_size_rounds_half_to_even(daily, n, n_val):
    frame = daily({1: range(n + 3)})
    day = (datetime(2024, 1, 1) + timedelta(days=n + 2)).date().isoformat()
    sizes = preparation.split_sizes(preparation.forecasting_data(frame, Split(day, day), 2)).first()
    assert (sizes.n_train, sizes.n_val, sizes.n_test) == (n - n_val, n_val, 1)


def test_no_test_rows_fails(daily):
    with pytest.raises(Exception, match="no row falls in the test week"):
        preparation.forecasting_data(daily({1: range(9)}), Split("2025-01-01", "2025-01-02"), 2).collect()


# --- scoring -----------------------------------------------------------------------------------

def predictions(spark, truth, guess):
    rows = [(1, "m", i, t, p) for i, (t, p) in enumerate(zip(truth, guess))]
    return spark.createDataFrame(rows, "area_id int, model string, ts int, y_true double, y_pred double")


def test_metrics(spark):
    got = scoring.evaluate(predictions(spark, [0.0, 1.0, 2.0, 4.0], [0.5, 1.0, 1.0, 5.0])).first()
    assert (got.MAE, got.RMSE, got.n, got.n_near_zero) == (0.625, 0.75, 4, 1)
    assert math.isclose(got.MAPE, 1250000018.75) and math.isclose(got.sMAPE, 72.222222, abs_tol=1e-6)
    with pytest.raises(Exception, match="missing"):
        scoring.evaluate(predictions(spark, [1.0], [None])).collect()


def test_alignment(spark):
    frame = predictions(spark, [1.0, 2.0], [1.0, 2.0])
    truth, guess = frame.select("area_id", "ts", "y_true"), frame.select("area_id", "ts", "y_pred")
    assert scoring.align(truth, guess).count() == 2
    with pytest.raises(Exception, match="same rows"):
        scoring.align(truth, guess.where("ts = 0")).collect()


def test_published_means(spark):
    mae = {"SARIMA": (101.2463, 19.4068, 34.2331), "LSTM": (87.0861, 16.0312, 27.9113), "GRU": (86.7439, 16.3202, 28.1160)}
    frame = spark.createDataFrame([(m, v) for m, vs in mae.items() for v in vs], "model string, MAE double")
    got = {r.model: r.MAE for r in scoring.mean_by(frame, "model", "MAE", digits=4).collect()}
    assert got == {"SARIMA": 51.6287, "LSTM": 43.6762, "GRU": 43.7267}


def test_failed_candidates_come_last(spark):
    frame = spark.createDataFrame([(10.0,), (float("nan"),), (5.0,)], "AIC double")
    got = [r.AIC for r in scoring.ranked_by_error(frame, "AIC").collect()]
    assert got[:2] == [5.0, 10.0] and math.isnan(got[2])


def test_side_by_side(spark):
    frame = predictions(spark, [1.0], [2.0]).union(predictions(spark, [1.0], [3.0]).withColumn("model", F.lit("k")))
    row = scoring.side_by_side(frame, ["m", "k"]).first()
    assert (row.m_y_true, row.m_y_pred, row.k_y_true, row.k_y_pred) == (1.0, 2.0, 1.0, 3.0)
    assert {r.abs_error for r in scoring.absolute_errors(frame).collect()} == {1.0, 2.0}


# --- ARIMA -------------------------------------------------------------------------------------

def test_innovations_against_recursion():
    w, _ = simulate(300, [0.5, -0.2], [0.4, 0.3])
    e = np.zeros(300)
    for t in range(2, 300):
        e[t] = w[t] - 0.3 - 0.5 * w[t - 1] + 0.2 * w[t - 2] - 0.4 * e[t - 1] - 0.3 * e[t - 2]
    got = arma.innovations(w, 0.3, np.array([0.5, -0.2]), np.array([0.4, 0.3]))
    assert np.allclose(got, e[2:])


@pytest.mark.parametrize("ar, ma", [([0.7], []), ([0.6, -0.3], [0.5]), ([], [0.6])])
def test_parameters_are_recovered(ar, ma):
    w, _ = simulate(8000, ar, ma, seed=3)
    fit = arma.fit_arma(w, len(ar), len(ma))
    assert fit.converged and math.isclose(fit.intercept, 0.3, abs_tol=0.05)
    assert np.allclose(fit.ar, ar, atol=0.05) and np.allclose(fit.ma, ma, atol=0.05)


def test_information_criteria():
    w, _ = simulate(7632, [0.5, 0.2], [0.3, 0.2], seed=1)
    fit = arma.fit_arma(w, 2, 2)
    assert fit.rows == 7629 and math.isclose(fit.bic - fit.aic, 6 * (math.log(7629) - 2))
    assert arma.fit_arma(w, 1, 0).rows == 7631


def seasonal_series(n=24 * 12):
    t, (noise, _) = np.arange(n), simulate(n, [0.6], [], seed=5)
    return 50 + 20 * np.sin(2 * np.pi * t / 24) + noise


SPLIT = Split("2024-01-10", "2024-01-11")


def test_sql_and_fitted_ar1_agree(daily):
    frame = daily({1: seasonal_series(), 2: seasonal_series() * 2}, step=HOUR)
    fitted = arma.predictions(arma.fit_orders(frame, SPLIT, [(1, 0, 0)], 24))
    sql = arma.ar1_predictions(frame, SPLIT, 24)
    assert fitted.count() == 96
    assert np.allclose(column(fitted, "y_pred"), column(sql, "y_pred"))
    fit, plain = arma.fit_orders(frame, SPLIT, [(1, 0, 0)], 24).orderBy("area_id").first(), arma.ar1_fits(frame, SPLIT, 24).orderBy("area_id").first()
    assert math.isclose(fit.aic, plain.aic) and math.isclose(fit.bic, plain.bic)


def test_one_step_ahead_with_differencing(daily):
    frame = daily({1: seasonal_series()}, step=HOUR)
    for order in ((1, 1, 1), (0, 0, 1), (2, 0, 2)):
        out = arma.predictions(arma.fit_orders(frame, SPLIT, [order], 24))
        score = scoring.evaluate(out).first()
        assert score.n == 48 and score.MAE < 3, order
    plain = arma.predictions(arma.fit_orders(frame, SPLIT, [(2, 0, 1)], 24, seasonal_diff=0), seasonal_diff=0)
    assert scoring.evaluate(plain).first().MAE < 3
    tail = arma.fit_orders(frame, SPLIT, [(1, 0, 0)], 24, tail_rows=72).first()
    assert tail.n_fit == 72 - 24 - 1


def test_order_search_keeps_failures(daily):
    frame = daily({1: seasonal_series(), 2: [1.0] * 288}, step=HOUR)
    table = experiments.order_search(frame, SPLIT, orders=((1, 0, 0), (60, 0, 60)), period=24).collect()
    assert len(table) == 4
    assert {r.order for r in table if math.isnan(r.AIC)} == {"(60, 0, 60)"} and math.isnan(table[-1].AIC)


def test_too_short_series_fails(daily):
    with pytest.raises(Exception, match="too short"):
        arma.fit_orders(daily({1: range(30)}, step=HOUR), Split("2024-01-02", "2024-01-02"), [(1, 0, 0)], 25).collect()
    with pytest.raises(ValueError):
        arma.fit_orders(daily({1: range(30)}), SPLIT, [(1, 0, 0)], 2, seasonal_diff=2)


# --- the full run ------------------------------------------------------------------------------

def test_forecast_run_and_its_files(spark, daily, tmp_path):
    frame = daily({1: seasonal_series(), 2: seasonal_series() + 5}, step=HOUR)
    run = forecast_run(frame, SPLIT, (1, 0, 0), 24, {"lag24": 24})
    assert {r.model for r in run.metrics.collect()} == {"SARIMA", "lag24"}
    assert run.predictions.count() == 2 * 2 * 48 and run.timing.count() == 2
    assert {r.measured_over for r in run.timing_summary.collect()} == {"mean of 2 areas"}
    assert {r.failed for r in run.metric_summary.collect()} == {0}
    store_run(run, str(tmp_path))
    stored = spark.read.option("header", "true").csv(f"{tmp_path}/predictions")
    assert stored.count() == 2 * 48 and "lag24_y_pred" in stored.columns
    assert spark.read.option("header", "true").csv(f"{tmp_path}/timing_summary").count() == 1


def test_summary_leaves_out_failed_fits(spark):
    metrics = spark.createDataFrame(
        [(1, "SARIMA", 2.0, 3.0, 4.0), (2, "SARIMA", float("nan"), float("nan"), float("nan"))],
        "area_id int, model string, MAE double, RMSE double, MAPE double")
    row = metric_summary(metrics).first()
    assert (row.MAE, row.RMSE, row.MAPE, row.failed) == (2.0, 3.0, 4.0, 1)


def test_candidates_for_every_area(spark):
    areas = spark.createDataFrame([(1,), (2,)], "area_id int")
    assert experiments.candidate_grid(areas, lookback=(1, 2), units=(3,)).count() == 4


def test_scalers_in_one_pass_agree_with_single_ones(daily):
    frame = daily({1: seasonal_series(), 2: [4.0] * len(seasonal_series())}, step=HOUR)
    at_once = {(r.area_id, r.kind): r for r in preparation.fit_scalers(frame, SPLIT).collect()}
    for kind in preparation.SCALERS:
        for r in preparation.fit_scaler(frame, kind, SPLIT).collect():
            assert at_once[r.area_id, kind] == r
        joined = preparation.transform(frame, preparation.fit_scaler(frame, kind, SPLIT), kind)
        windowed = preparation.scaled_series(frame, kind, SPLIT)
        pick = lambda df: sorted((r.area_id, r.ts, round(r.scaled, 9)) for r in df.collect())
        assert pick(joined) == pick(windowed)


def test_zero_rows_are_an_error(daily):
    from gridpulse.operators import temporal

    with pytest.raises(ValueError):
        arma.fit_orders(daily({1: seasonal_series()}, step=HOUR), SPLIT, [(1, 0, 0)], 24, tail_rows=0)
    with pytest.raises(ValueError):
        temporal.recent(daily({1: [1.0]}), 0)
