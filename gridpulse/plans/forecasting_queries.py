"""Queries on forecasting data, models, scores and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridpulse.functions.scalars import clip_at_zero, rounded
from gridpulse.operators import arma, experiments, preparation, scoring, temporal
from gridpulse.plans import views
from gridpulse.plans.consolidation_queries import supplier_series, target_ids, type_series, user_series
from gridpulse.plans.exploration_queries import _rounded
from gridpulse.plans.forecast import Run, forecast_run, naive_predictions, read_run, store_run
from gridpulse.plans.oracle_views import BEFORE_TEST, BY_TYPE, IN_TEST, TYPE_DENSE, USER_DENSE
from gridpulse.plans.registry import query
from gridpulse.session import materialize, scratch_path
from gridpulse.sources import tables

LOOKBACK = 12
BEFORE = preparation.Split(*views.TEST_WEEK)
OUTSIDE = preparation.Split(*views.TEST_WEEK, scope="outside")
NAIVE_LAGS = {"lag24": views.PERIOD, "lag168": 7 * views.PERIOD}


# --- split, scaling, windows -------------------------------------------------------------------

@query(f"""{USER_DENSE} SELECT area_id, ts, {IN_TEST} AS is_test, round(value, 6) AS value FROM dense WHERE {BEFORE_TEST} OR {IN_TEST}""")
def split_before(spark: SparkSession, sf: str) -> DataFrame:
    rows = preparation.split_rows(user_series(spark, sf), BEFORE)
    return rows.select("area_id", "ts", "is_test", rounded(F.col("value")).alias("value"))


@query(f"""{USER_DENSE} SELECT area_id, ts, {IN_TEST} AS is_test, round(value, 6) AS value,
CAST(row_number() OVER (PARTITION BY area_id ORDER BY {IN_TEST}, ts) AS INT) AS place FROM dense""")
def split_outside(spark: SparkSession, sf: str) -> DataFrame:
    """Everything outside the test week, then the test week: one ordering key instead of a union."""
    rows = preparation.split_rows(user_series(spark, sf), OUTSIDE)
    place = F.row_number().over(Window.partitionBy("area_id").orderBy(*OUTSIDE.order()))
    return rows.select("area_id", "ts", "is_test", rounded(F.col("value")).alias("value"), place.alias("place"))


def _train(split: preparation.Split) -> str:
    return BEFORE_TEST if split.scope == "before" else f"NOT ({IN_TEST})"


def _scaler_cte(kind: str, split: preparation.Split) -> str:
    x = "ln(1 + value)" if kind == "log-minmax" else "value"
    offset, spread = ("avg(x)", "stddev_pop(x)") if kind == "standard" else ("min(x)", "max(x) - min(x)")
    return f"""fit AS (SELECT area_id, {offset} AS "offset", CASE WHEN {spread} > 0 THEN {spread} ELSE 1 END AS scale
FROM (SELECT area_id, {x} AS x FROM dense WHERE {_train(split)}) GROUP BY area_id)"""


_ALL_SCALERS = " UNION ALL ".join(
    f"""(SELECT area_id, '{kind}' AS kind, round("offset", 8) AS "offset", round(scale, 8) AS scale FROM ({USER_DENSE}, {_scaler_cte(kind, BEFORE)} SELECT * FROM fit))"""
    for kind in preparation.SCALERS
)


@query(_ALL_SCALERS)
def scaler_parameters(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(preparation.fit_scalers(user_series(spark, sf), BEFORE), "offset", "scale", digits=8)


def _scaled_query(kind: str, split: preparation.Split) -> str:
    x = "ln(1 + value)" if kind == "log-minmax" else "value"
    return f"""{USER_DENSE}, {_scaler_cte(kind, split)} SELECT d.area_id, ts, round(({x} - "offset") / scale, 8) + 0 AS scaled,
round(value, 4) + 0 AS restored FROM dense d JOIN fit f ON f.area_id = d.area_id"""


def _scaled(spark: SparkSession, sf: str, kind: str, split: preparation.Split) -> DataFrame:
    out = preparation.inverse_transform(preparation.scaled_series(user_series(spark, sf), kind, split), kind)
    return out.select("area_id", "ts", rounded(F.col("scaled"), 8).alias("scaled"), rounded(F.col("restored"), 4).alias("restored"))


@query(_scaled_query("minmax", BEFORE))
def scale_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "minmax", BEFORE)


@query(_scaled_query("standard", BEFORE))
def scale_standard(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "standard", BEFORE)


@query(_scaled_query("log-minmax", OUTSIDE))
def scale_log_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "log-minmax", OUTSIDE)


@query(f"""{TYPE_DENSE}, r AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY ts) AS i FROM dense)
SELECT t.area_id, t.ts, CAST(p.i - t.i + {LOOKBACK} AS INT) AS pos, round(p.value, 6) AS x, round(t.value, 6) AS y
FROM r t JOIN r p ON p.area_id = t.area_id AND p.i BETWEEN t.i - {LOOKBACK} AND t.i - 1 WHERE t.i > {LOOKBACK}""")
def sliding_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = preparation.sliding_windows(type_series(spark, sf), LOOKBACK)
    return _rounded(out.select("area_id", "ts", F.posexplode("x").alias("pos", "x"), "y"), "x", "y")


def _labelled_cte(split: preparation.Split, dense: str = TYPE_DENSE) -> str:
    return f"""{dense}, {_scaler_cte("minmax", split)},
rows AS (SELECT area_id, ts, value, row_number() OVER (PARTITION BY area_id ORDER BY ts) AS i,
  {IN_TEST} AS test, {_train(split)} AS train FROM dense WHERE ({IN_TEST}) OR ({_train(split)})),
pool AS (SELECT area_id, ts, row_number() OVER (PARTITION BY area_id ORDER BY ts) AS place, count(*) OVER (PARTITION BY area_id) AS n
  FROM rows WHERE train AND i > {LOOKBACK}),
labelled AS (SELECT r.area_id, r.ts, r.value, r.i, (r.value - f."offset") / f.scale AS scaled,
  CASE WHEN r.test AND i > {LOOKBACK} THEN 'test' WHEN place > n - greatest(1, round_even(n * 0.15, 0)) THEN 'val' WHEN place IS NOT NULL THEN 'train' END AS split
  FROM rows r JOIN fit f ON f.area_id = r.area_id LEFT JOIN pool p ON p.area_id = r.area_id AND p.ts = r.ts)"""


def _windows_sql(split: preparation.Split) -> str:
    return f"""{_labelled_cte(split)} SELECT t.area_id, t.ts, t.split, CAST(p.i - t.i + {LOOKBACK} AS INT) AS pos, round(p.scaled, 8) AS x,
round(t.scaled, 8) AS y, round(t.value, 4) AS y_actual
FROM labelled t JOIN labelled p ON p.area_id = t.area_id AND p.i BETWEEN t.i - {LOOKBACK} AND t.i - 1 WHERE t.split IS NOT NULL"""


def _windows(spark: SparkSession, sf: str, split: preparation.Split) -> DataFrame:
    out = preparation.forecasting_data(type_series(spark, sf), split, LOOKBACK)
    out = out.select("area_id", "ts", "split", F.posexplode("x").alias("pos", "x"), "y", "y_actual")
    return _rounded(_rounded(out, "x", "y", digits=8), "y_actual", digits=4)


@query(_windows_sql(BEFORE))
def forecasting_data_before(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, BEFORE)


@query(_windows_sql(OUTSIDE))
def forecasting_data_outside(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, OUTSIDE)


@query(f"{_labelled_cte(BEFORE, USER_DENSE)} SELECT area_id, ts, split FROM labelled WHERE split IS NOT NULL")
def train_validation_cut(spark: SparkSession, sf: str) -> DataFrame:
    out = preparation.labelled(user_series(spark, sf), BEFORE, LOOKBACK)
    return out.where(F.col("split").isNotNull()).select("area_id", "ts", "split")


@query(f"""{_labelled_cte(BEFORE, USER_DENSE)} SELECT area_id, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
count(*) FILTER (split = 'test') AS n_test FROM labelled GROUP BY area_id""")
def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return preparation.split_sizes(preparation.labelled(user_series(spark, sf), BEFORE, LOOKBACK))


# --- scoring, with lagged values as predictions ------------------------------------------------

def _naive(spark: SparkSession, sf: str) -> DataFrame:
    """Test-week predictions of two seasonal naive models for every area."""
    return naive_predictions(user_series(spark, sf), BEFORE, NAIVE_LAGS)


_LAGS = ", ".join(f"lag(value, {p}) OVER (PARTITION BY area_id ORDER BY ts) AS {n}" for n, p in NAIVE_LAGS.items())
_NAIVE = f"""{USER_DENSE}, l AS (SELECT area_id, ts, value AS y_true, {_LAGS} FROM dense),
pred AS ({" UNION ALL ".join(f"SELECT area_id, ts, y_true, '{n}' AS model, {n} AS y_pred FROM l WHERE {IN_TEST}" for n in NAIVE_LAGS)}),
err AS (SELECT *, abs(y_true - y_pred) AS e FROM pred)"""
_METRICS = """round(avg(e), 6) AS "MAE", round(sqrt(avg(e * e)), 4) AS "RMSE", round(avg(e / greatest(abs(y_true), 1e-8)) * 100 / 1e6, 3) AS "MAPE",
round(avg(e / greatest((abs(y_true) + abs(y_pred)) / 2, 1e-8)) * 100, 4) AS "sMAPE", count(*) AS n, count(*) FILTER (abs(y_true) < 1) AS n_near_zero"""


def _shown_metrics(table: DataFrame) -> DataFrame:
    """Rounded; the areas are sparse, so MAPE is huge and shown in millions."""
    table = table.withColumn("MAPE", F.round(F.col("MAPE") / 1e6, 3))
    return _rounded(_rounded(table, "MAE"), "RMSE", "sMAPE", digits=4)


@query(f"{_NAIVE} SELECT model, area_id, {_METRICS} FROM err GROUP BY model, area_id")
def metrics_per_area(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_metrics(scoring.evaluate(_naive(spark, sf), "model", "area_id"))


@query(f"{_NAIVE} SELECT model, {_METRICS} FROM err GROUP BY model")
def metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_metrics(scoring.evaluate(_naive(spark, sf)))


@query(f"""{_NAIVE}, m AS (SELECT model, area_id, avg(e) AS mae, sqrt(avg(e * e)) AS rmse FROM err GROUP BY model, area_id)
SELECT model, round(avg(mae), 3) AS "MAE", round(avg(rmse), 3) AS "RMSE" FROM m GROUP BY model""")
def metrics_mean_over_areas(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.mean_by(scoring.evaluate(_naive(spark, sf), "model", "area_id"), "model", "MAE", "RMSE")


@query("""SELECT o_orderpriority AS model, round(avg(o_totalprice), 3) AS train_time_s, round(avg(o_totalprice / 7), 3) AS predict_time_s
FROM orders GROUP BY 1""")
def timing_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Mean per group, rounded to 3 decimals, with order prices in the place of seconds."""
    timing = views.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model"), F.col("o_totalprice").alias("train_time_s"),
        (F.col("o_totalprice") / 7).alias("predict_time_s"),
    )
    return scoring.mean_by(timing, "model", "train_time_s", "predict_time_s")


@query(f"{_NAIVE} SELECT area_id, model, ts, round(e, 6) AS abs_error FROM err")
def error_over_time(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(scoring.absolute_errors(_naive(spark, sf)), "abs_error")


@query(f"""{_NAIVE} SELECT area_id, ts, {", ".join(
    f'round(max(y_true) FILTER (model = {m!r}), 6) AS "{m}_y_true", round(max(y_pred) FILTER (model = {m!r}), 6) AS "{m}_y_pred"' for m in NAIVE_LAGS)}
FROM pred GROUP BY area_id, ts""")
def predictions_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    wide = scoring.side_by_side(_naive(spark, sf), list(NAIVE_LAGS))
    return _rounded(wide, *[f"{m}_{c}" for m in NAIVE_LAGS for c in ("y_true", "y_pred")])


@query(f"{_NAIVE} SELECT area_id, ts, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred FROM pred WHERE model = 'lag24'")
def aligned_truth(spark: SparkSession, sf: str) -> DataFrame:
    """Truth and prediction from separate tables, joined with the coverage check."""
    dense = materialize(user_series(spark, sf))
    in_test = BEFORE.is_test(F.col("ts"))
    truth = dense.where(in_test).select("area_id", "ts", F.col("value").alias("y_true"))
    prediction = temporal.with_lag(dense, views.PERIOD).where(in_test).select("area_id", "ts", F.col("lagged").alias("y_pred"))
    return _rounded(scoring.align(truth, prediction), "y_true", "y_pred")


@query(f"""{USER_DENSE}, l AS (SELECT area_id, ts, value, lag(value, 1) OVER w AS a, lag(value, 2) OVER w AS b FROM dense WINDOW w AS (PARTITION BY area_id ORDER BY ts))
SELECT area_id, ts, round(greatest(2 * a - b, 0), 6) + 0 AS y_pred FROM l WHERE a IS NOT NULL AND b IS NOT NULL""")
def clipped_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """A straight-line forecast that often falls below zero, clipped."""
    lagged = temporal.with_lag(temporal.with_lag(user_series(spark, sf), 1, "a"), 2, "b")
    ahead = clip_at_zero(2 * F.col("a") - F.col("b"))
    return lagged.where(F.col("b").isNotNull()).select("area_id", "ts", rounded(ahead).alias("y_pred"))


# --- ARIMA -------------------------------------------------------------------------------------

def _ar1_cte(split: preparation.Split) -> str:
    order = "ts" if split.scope == "before" else f"{IN_TEST}, ts"
    return f"""{TYPE_DENSE}, s AS (SELECT area_id, ts, value, {IN_TEST} AS test FROM dense WHERE ({_train(split)}) OR ({IN_TEST})),
l AS (SELECT *, lag(value, {views.PERIOD}) OVER (PARTITION BY area_id ORDER BY {order}) AS lagged,
  row_number() OVER (PARTITION BY area_id ORDER BY {order}) AS place FROM s),
d AS (SELECT *, value - lagged AS diff FROM l WHERE lagged IS NOT NULL),
p AS (SELECT *, lag(diff) OVER (PARTITION BY area_id ORDER BY place) AS previous FROM d),
fit AS (SELECT area_id, count(*) AS n, regr_slope(diff, previous) AS slope, regr_intercept(diff, previous) AS intercept,
  regr_syy(diff, previous) - pow(regr_sxy(diff, previous), 2) / regr_sxx(diff, previous) AS sse
  FROM p WHERE NOT test AND previous IS NOT NULL GROUP BY area_id)"""


def _ar1_sql(split: preparation.Split) -> str:
    return f"""{_ar1_cte(split)} SELECT p.area_id, 'SARIMA' AS model, ts, round(value, 6) AS y_true,
round(greatest(intercept + slope * previous + lagged, 0), 4) + 0 AS y_pred FROM p JOIN fit ON fit.area_id = p.area_id WHERE test"""


@query(_ar1_sql(BEFORE))
def arima_100_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Order (1,0,0)(0,1,0) in SQL only."""
    out = arma.ar1_predictions(type_series(spark, sf), BEFORE, views.PERIOD)
    return _rounded(_rounded(out, "y_true"), "y_pred", digits=4)


def _arima(spark: SparkSession, sf: str, split: preparation.Split) -> DataFrame:
    fits = arma.fit_orders(type_series(spark, sf), split, [(1, 0, 0)], views.PERIOD)
    out = arma.predictions(fits).drop("order")
    return _rounded(_rounded(out, "y_true"), "y_pred", digits=4)


@query(_ar1_sql(BEFORE))
def arima_100_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """The general fit at order (1,0,0) must agree with the regression."""
    return _arima(spark, sf, BEFORE)


@query(_ar1_sql(OUTSIDE))
def arima_100_outside(spark: SparkSession, sf: str) -> DataFrame:
    """Trained on everything outside the test week, across the seam."""
    return _arima(spark, sf, OUTSIDE)


@query(f"""{_ar1_cte(BEFORE)}, a AS (SELECT area_id, n, n * (ln(2 * pi() * sse / n) + 1) AS deviance FROM fit)
SELECT area_id, n AS n_fit, round(deviance + 6, 4) AS aic, round(deviance + 3 * ln(n), 4) AS bic,
row_number() OVER (ORDER BY deviance, area_id) - 1 AS rank FROM a""")
def arima_100_ranked_by_aic(spark: SparkSession, sf: str) -> DataFrame:
    from gridpulse.functions.ranking import rank_rows

    fits = arma.ar1_fits(type_series(spark, sf), BEFORE, views.PERIOD)
    ranked = rank_rows(fits, F.asc_nulls_last("aic"), F.asc("area_id"))
    return _rounded(ranked.select("area_id", "n_fit", "aic", "bic", "rank"), "aic", "bic", digits=4)


@query()
def arima_forecast(spark: SparkSession, sf: str) -> DataFrame:
    fits = arma.fit_orders(type_series(spark, sf), BEFORE, [(2, 0, 2)], views.PERIOD)
    return arma.predictions(fits)


@query()
def arima_forecast_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Quick variant: only the last seven days before the test week, fewer iterations."""
    fits = arma.fit_orders(type_series(spark, sf), BEFORE, [(2, 0, 2)], views.PERIOD, tail_rows=7 * views.PERIOD, maxiter=15)
    return arma.predictions(fits)


@query()
def arima_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """Years of daily values: one fit of about 2,300 points per supplier."""
    split = preparation.Split("2001-06-04", "2001-06-10")
    return arma.predictions(arma.fit_orders(supplier_series(spark, sf), split, [(2, 0, 2)], period=7))


@query()
def arima_order_search(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.order_search(type_series(spark, sf), BEFORE, period=views.PERIOD)


@query()
def experiment_log(spark: SparkSession, sf: str) -> DataFrame:
    """The order search written as a CSV log and read back."""
    path = scratch_path(spark, "experiments")
    table = experiments.order_search(type_series(spark, sf), OUTSIDE, period=views.PERIOD)
    tables.write_log(table, path)
    return scoring.ranked_by_error(tables.read_report(spark, path, table.schema), "AIC")


@query(f"""SELECT area_id, CAST(p.v AS INT) AS lookback, CAST(q.v AS INT) AS units FROM (SELECT DISTINCT area_id FROM ({BY_TYPE}))
CROSS JOIN (SELECT unnest([12, 72, 144, 288]) AS v) p CROSS JOIN (SELECT unnest([32, 64, 128]) AS v) q""")
def candidate_grid(spark: SparkSession, sf: str) -> DataFrame:
    """All published candidates for every area in the data."""
    areas = views.by_type(spark, sf).select("area_id").distinct()
    return experiments.candidate_grid(areas, lookback=experiments.LOOKBACKS, units=experiments.UNITS)


# --- the full run ------------------------------------------------------------------------------

def _run(spark: SparkSession, sf: str) -> Run:
    return forecast_run(materialize(type_series(spark, sf)), BEFORE, (1, 0, 0), views.PERIOD, NAIVE_LAGS)


_RUN = f"""{_ar1_cte(BEFORE)}, naive AS (SELECT area_id, ts, value AS y_true, {_LAGS} FROM dense),
pred AS (SELECT p.area_id, 'SARIMA' AS model, ts, value AS y_true, greatest(intercept + slope * previous + lagged, 0) AS y_pred
  FROM p JOIN fit ON fit.area_id = p.area_id WHERE test
  {" ".join(f"UNION ALL SELECT area_id, '{n}', ts, y_true, {n} FROM naive WHERE {IN_TEST}" for n in NAIVE_LAGS)}),
err AS (SELECT *, abs(y_true - y_pred) AS e FROM pred),
m AS (SELECT area_id, model, avg(e) AS mae, sqrt(avg(e * e)) AS rmse, avg(e / greatest(abs(y_true), 1e-8)) * 100 AS mape,
  avg(e / greatest((abs(y_true) + abs(y_pred)) / 2, 1e-8)) * 100 AS smape, count(*) AS n, count(*) FILTER (abs(y_true) < 1) AS n_near_zero
  FROM err GROUP BY area_id, model)"""
_MODELS = ("SARIMA", *NAIVE_LAGS)


@query(f"""{_RUN} SELECT area_id, model, round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(mape, 1) AS "MAPE", round(smape, 4) AS "sMAPE",
n, n_near_zero FROM m""")
def forecast_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Every area by three models, scored, on series that are never near zero."""
    return _rounded(_rounded(_run(spark, sf).metrics, "MAE", "RMSE", "sMAPE", digits=4), "MAPE", digits=1)


@query(f"""{_RUN} SELECT model, round(avg(mae), 2) AS "MAE", round(avg(rmse), 2) AS "RMSE", round(avg(mape), 2) AS "MAPE", 0::BIGINT AS failed,
CASE WHEN model = 'SARIMA' THEN 'mean of ' || count(*) || ' areas' END AS measured_over FROM m GROUP BY model""")
def forecast_run_stored_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Metric and timing summaries as stored by the run and read back; the seconds themselves are left out."""
    path = scratch_path(spark, "run")
    store_run(_run(spark, sf), path)
    means = read_run(spark, path, "metric_summary", "model string, MAE double, RMSE double, MAPE double, failed long")
    timing = read_run(spark, path, "timing_summary", "model string, train_time_s double, predict_time_s double, measured_over string")
    return _rounded(means, "MAE", "RMSE", "MAPE", digits=2).join(timing.select("model", "measured_over"), "model", "left")


@query(f"""{_RUN} SELECT area_id, ts, {", ".join(
    f'round(max(y_true) FILTER (model = {m!r}), 4) AS "{m}_y_true", round(max(y_pred) FILTER (model = {m!r}), 4) + 0 AS "{m}_y_pred"' for m in _MODELS)}
FROM pred GROUP BY area_id, ts""")
def forecast_run_stored_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The predictions of all models side by side, as stored by the run and read back."""
    path = scratch_path(spark, "run")
    store_run(_run(spark, sf), path)
    columns = [f"{m}_{c}" for m in sorted(_MODELS) for c in ("y_true", "y_pred")]
    kinds = ", ".join(f"{c} double" for c in columns)
    return _rounded(read_run(spark, path, "predictions", f"area_id int, ts timestamp_ntz, {kinds}"), *columns, digits=4)


@query()
def forecast_targets_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The busiest and the two fixed areas: mean error per model over them."""
    targets = materialize(target_ids(spark, sf))
    chosen = user_series(spark, sf).join(F.broadcast(targets.select("area_id").distinct()), "area_id", "left_semi")
    return forecast_run(materialize(chosen), BEFORE, period=views.PERIOD, lags=NAIVE_LAGS).metric_summary
