"""Queries whose SQL works the models out anew: order search, unit-root test with lags, given ARMA parameters, local regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridpulse.functions.ranking import rank_rows
from gridpulse.functions.scalars import rounded
from gridpulse.operators import arma, decomposition, experiments, scoring, series, stationarity
from gridpulse.operators.preparation import Split
from gridpulse.plans import views
from gridpulse.plans.consolidation_queries import _TARGETS, FIXED, SAMPLE_AREAS, supplier_series, target_ids, type_series, user_series
from gridpulse.plans.exploration_queries import _rounded
from gridpulse.plans.forecast import forecast_run, read_run, sample_run, store_run
from gridpulse.plans.forecasting_queries import BEFORE, NAIVE_LAGS, OUTSIDE, _ar1_cte, _train
from gridpulse.plans.oracle_views import IN_TEST, SUPPLIER_DENSE, TYPE_DENSE, USER_DENSE
from gridpulse.plans.registry import query
from gridpulse.session import materialize, scratch_path
from gridpulse.sources import tables


def recursive(ctes: str) -> str:
    return ctes.replace("WITH ", "WITH RECURSIVE ", 1)


def _differences(dense: str, split: Split, period: int, tail: int | None = None) -> str:
    """CTE ``d``: seasonally differenced rows in training-then-test order, of the last ``tail`` training rows only if given."""
    order = "ts" if split.scope == "before" else "test, ts"
    test = IN_TEST if split == BEFORE or split == OUTSIDE else f"ts >= TIMESTAMP '{split.first_day}' AND ts < TIMESTAMP '{split.last_day}' + INTERVAL 1 DAY"
    train = _train(split) if split == BEFORE or split == OUTSIDE else f"ts < TIMESTAMP '{split.first_day}'"
    kept = f"WHERE test OR back <= {tail}" if tail else ""
    return f"""{recursive(dense)}, rows_ AS (SELECT *, row_number() OVER (PARTITION BY area_id, test ORDER BY ts DESC) AS back
  FROM (SELECT area_id, ts, value, {test} AS test FROM dense) WHERE test OR ({train})),
l AS (SELECT area_id, ts, value, test, lag(value, {period}) OVER (PARTITION BY area_id ORDER BY {order}) AS lagged,
  row_number() OVER (PARTITION BY area_id ORDER BY {order}) AS place FROM rows_ {kept}),
d AS (SELECT *, value - lagged AS diff FROM l WHERE lagged IS NOT NULL)"""


def sweep(name: str, products: str, keys: str, pivots: str) -> str:
    """Recursive CTE: the matrix rows ``i, j, a`` of ``products`` after each of the first ``pivots`` rows was swept, as ``step``."""
    return f"""{name} AS (SELECT *, 0 AS step FROM {products} UNION ALL
  SELECT * EXCLUDE (a, step, piv, r, c), CASE WHEN i = step AND j = step THEN 1 / piv WHEN i = step THEN a / piv
    WHEN j = step THEN -a / piv ELSE a - r * c / piv END, step + 1 FROM (
    SELECT *, max(CASE WHEN i = step AND j = step THEN a END) OVER (PARTITION BY {keys}) AS piv,
      max(CASE WHEN i = step THEN a END) OVER (PARTITION BY {keys}, j) AS r, max(CASE WHEN j = step THEN a END) OVER (PARTITION BY {keys}, i) AS c
    FROM {name} WHERE step < {pivots})
)"""


# --- order search ------------------------------------------------------------------------------

def _search_sql(split: Split, tail: int | None = None, val_fraction: float | None = None) -> str:
    """The candidates ``r`` with their criteria; with ``val_fraction`` scored on the last training rows and not on the test week."""
    lagged = f"""SELECT * EXCLUDE (test), row_number() OVER (PARTITION BY area_id ORDER BY place)
  > count(*) OVER (PARTITION BY area_id) - greatest(1, round_even(count(*) OVER (PARTITION BY area_id) * {val_fraction}, 0)) AS test FROM b_ WHERE NOT test""" \
        if val_fraction else "SELECT * FROM b_"
    return f"""{_differences(TYPE_DENSE, split, views.PERIOD, tail)},
b_ AS (SELECT *, lag(diff, 1) OVER w AS l1, lag(diff, 2) OVER w AS l2, lag(diff, 3) OVER w AS l3 FROM d WINDOW w AS (PARTITION BY area_id ORDER BY place)),
b AS ({lagged}),
x AS (SELECT area_id, p, test, ts, value, lagged, CASE p WHEN 1 THEN [1, l1, diff] WHEN 2 THEN [1, l1, l2, diff] ELSE [1, l1, l2, l3, diff] END AS v
  FROM b CROSS JOIN (SELECT unnest([1, 2, 3]) AS p) WHERE CASE p WHEN 1 THEN l1 WHEN 2 THEN l2 ELSE l3 END IS NOT NULL),
g AS (SELECT area_id, p, count(*) AS n, i, j, sum(v[i + 1] * v[j + 1]) AS a FROM x
  JOIN (SELECT unnest(range(0, 5)) AS i) ON i < p + 2 JOIN (SELECT unnest(range(0, 5)) AS j) ON j < p + 2 WHERE NOT test GROUP BY area_id, p, i, j),
{sweep("sw", "g", "area_id, p", "p + 1")},
fit AS (SELECT area_id, p, n, n <= 2 * (p + 2) + 10 AS failed, max(a) FILTER (i = p + 1 AND j = p + 1) AS sse,
  list(a ORDER BY i) FILTER (i <= p AND j = p + 1) AS c FROM sw WHERE step = p + 1 GROUP BY area_id, p, n),
err AS (SELECT x.area_id, x.p, value AS y_true, greatest(list_inner_product(c, v[1:x.p + 1]) + lagged, 0) AS y_pred FROM x
  JOIN fit ON fit.area_id = x.area_id AND fit.p = x.p WHERE test),
m AS (SELECT area_id, p, count(*) AS scored, avg(abs(y_true - y_pred)) AS mae, sqrt(avg(pow(y_true - y_pred, 2))) AS rmse,
  avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100 AS mape FROM err GROUP BY area_id, p),
r AS (SELECT fit.*, '(' || fit.p || ', 0, 0)' AS "order", n * (ln(2 * pi() * sse / n) + 1) AS deviance, mae, rmse, mape, scored
  FROM fit JOIN m ON m.area_id = fit.area_id AND m.p = fit.p)"""


def _criteria_sql(split: Split, tail: int | None = None) -> str:
    return f"""{_search_sql(split, tail)}
SELECT area_id, "order", '(0, 1, 0, {views.PERIOD})' AS seasonal_order, CASE WHEN NOT failed THEN round(deviance + 2 * (p + 2), 4) END AS "AIC",
CASE WHEN NOT failed THEN round(deviance + ln(n) * (p + 2), 4) END AS "BIC", CASE WHEN NOT failed THEN round(mae, 4) END AS "test_MAE",
CASE WHEN NOT failed THEN round(rmse, 4) END AS "test_RMSE", CASE WHEN NOT failed THEN round(mape, 1) END AS "test_MAPE" """


_RANK = """, row_number() OVER (ORDER BY CASE WHEN failed THEN 'inf'::DOUBLE ELSE deviance + 2 * (p + 2) END, area_id, "order") - 1 AS rank FROM r"""
_CRITERIA = {"AIC": 4, "BIC": 4, "test_MAE": 4, "test_RMSE": 4, "test_MAPE": 1}


def _shown(table: DataFrame) -> DataFrame:
    """Rounded; criteria of failed candidates are shown as null."""
    shown = [F.nullif(rounded(F.col(c), _CRITERIA[c]), F.lit(float("nan"))).alias(c) if c in _CRITERIA else F.col(f"`{c}`") for c in table.columns]
    return table.select(*shown)


def _ranked(table: DataFrame) -> DataFrame:
    return _shown(rank_rows(table, *scoring.error_order("AIC", "area_id", "order")).drop("n"))


@query(_criteria_sql(BEFORE) + _RANK)
def ar_order_search(spark: SparkSession, sf: str) -> DataFrame:
    """Orders (1,0,0) to (3,0,0) on every area, with their rank by AIC."""
    return _ranked(experiments.ar_order_search(type_series(spark, sf), BEFORE, period=views.PERIOD))


# A training week so short that only the smallest order has enough rows.
SHORT_TAIL = views.PERIOD + 20


@query(_criteria_sql(BEFORE, SHORT_TAIL) + _RANK)
def ar_order_search_short(spark: SparkSession, sf: str) -> DataFrame:
    """The search on the last rows before the test week: candidates that fail rank last."""
    return _ranked(experiments.ar_order_search(type_series(spark, sf), BEFORE, period=views.PERIOD, tail_rows=SHORT_TAIL))


@query(_criteria_sql(OUTSIDE) + " FROM r")
def ar_experiment_log(spark: SparkSession, sf: str) -> DataFrame:
    """The order search across the seam, written as a CSV log, read back and ranked again."""
    path = scratch_path(spark, "experiments")
    table = experiments.ar_order_search(type_series(spark, sf), OUTSIDE, period=views.PERIOD)
    tables.write_log(table, path)
    return _shown(scoring.ranked_by_error(tables.read_report(spark, path, table.schema), "AIC", "area_id", "order"))


@query(f"""{_search_sql(BEFORE, val_fraction=0.15)} SELECT area_id, "order", round(mae, 4) AS "val_MAE", round(rmse, 4) AS "val_RMSE", scored AS n_val,
row_number() OVER (ORDER BY rmse, area_id, "order") - 1 AS rank FROM r""")
def ar_validation_search(spark: SparkSession, sf: str) -> DataFrame:
    """The candidates fitted before the validation rows and ranked by their error there."""
    table = experiments.ar_validation_search(type_series(spark, sf), BEFORE, period=views.PERIOD).drop("val_MAPE")
    return _rounded(rank_rows(table, *scoring.error_order("val_RMSE", "area_id", "order")).drop("n"), "val_MAE", "val_RMSE", digits=4)


# --- ARMA with given parameters ----------------------------------------------------------------

GIVEN = {"intercept": 1.5, "ar": [0.55], "ma": [0.3]}
GIVEN_DAILY = {"intercept": 12.0, "ar": [0.4, -0.2], "ma": [0.25, 0.1]}
SUPPLIER_WEEK = Split("2001-06-04", "2001-06-10")


def _parameters(records: DataFrame, given: dict) -> DataFrame:
    """One row per area, from the records: their areas are those of the dense series, which need not be computed again."""
    doubles = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<double>")
    return records.select("area_id").distinct().select(
        "area_id", F.lit(given["intercept"]).alias("intercept"), doubles(given["ar"]).alias("ar"), doubles(given["ma"]).alias("ma"))


def _errors_sql(dense: str, split: Split, period: int, given: dict) -> str:
    """Recursion over rows: each carries the last differences and errors, latest first."""
    p, q = len(given["ar"]), len(given["ma"])
    ahead = " + ".join([str(given["intercept"]), *[f"{a} * e.w[{i}]" for i, a in enumerate(given["ar"], 1)], *[f"{m} * e.u[{j}]" for j, m in enumerate(given["ma"], 1)]])
    return f"""{_differences(dense, split, period)}, o AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY place) AS i FROM d),
e(area_id, i, ts, test, value, lagged, error, w, u) AS (
  SELECT area_id, i, ts, test, value, lagged, NULL::DOUBLE, list_concat([diff], list_resize([]::DOUBLE[], {max(p - 1, 0)}, 0.0)),
    list_resize([]::DOUBLE[], {q}, 0.0) FROM o WHERE i = 1
  UNION ALL SELECT area_id, i, ts, test, value, lagged, error, list_concat([diff], w)[1:{max(p, 1)}], list_concat([coalesce(error, 0)], u)[1:{q}] FROM (
    SELECT o.*, e.w, e.u, CASE WHEN o.i > {p} THEN o.diff - ({ahead}) END AS error FROM e JOIN o ON o.area_id = e.area_id AND o.i = e.i + 1))"""


@query(f"{_errors_sql(TYPE_DENSE, BEFORE, views.PERIOD, GIVEN)} SELECT area_id, ts, round(error, 5) + 0 AS error FROM e WHERE error IS NOT NULL")
def arma_given_errors(spark: SparkSession, sf: str) -> DataFrame:
    """One-step errors of (1,0,1)(0,1,0) at given parameters."""
    dense = type_series(spark, sf)
    errors = arma.one_step_errors(arma.with_lags(dense, BEFORE, 1, views.PERIOD), _parameters(views.by_type(spark, sf), GIVEN))
    return _rounded(errors.select("area_id", "ts", "error"), "error", digits=5)


_FORECAST = """ SELECT area_id, 'SARIMA' AS model, ts, round(value, 6) AS y_true, round(greatest(value - error, 0), 5) + 0 AS y_pred FROM e WHERE test"""


@query(_errors_sql(TYPE_DENSE, OUTSIDE, views.PERIOD, GIVEN) + _FORECAST)
def arma_given_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """The test week under (1,0,1)(0,1,0) at given parameters, one step ahead, across the seam."""
    dense = type_series(spark, sf)
    out = arma.given_predictions(dense, OUTSIDE, _parameters(views.by_type(spark, sf), GIVEN), views.PERIOD)
    return _rounded(_rounded(out, "y_true"), "y_pred", digits=5)


@query(_errors_sql(SUPPLIER_DENSE, SUPPLIER_WEEK, 7, GIVEN_DAILY) + _FORECAST)
def arma_given_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """The same for (2,0,2)(0,1,0) on years of daily values."""
    dense = supplier_series(spark, sf)
    out = arma.given_predictions(dense, SUPPLIER_WEEK, _parameters(views.by_supplier(spark, sf), GIVEN_DAILY), 7)
    return _rounded(_rounded(out, "y_true"), "y_pred", digits=5)


# --- unit-root test ----------------------------------------------------------------------------

def _adf_design(name: str, source: str, lag: str) -> str:
    """CTE: cross products ``i, j, a`` of constant, level, ``lag`` lagged differences and the difference, per area."""
    return f"""{name}_c AS (
  SELECT area_id, n, {lag} AS m, 0 AS k, [e - e + 1 for e in s[{lag} + 1:n - 1]] AS v FROM {source}
  UNION ALL SELECT area_id, n, {lag}, 1, x[{lag} + 1:n - 1] FROM {source}
  UNION ALL SELECT area_id, n, {lag}, 1 + q, s[{lag} - q + 1:n - 1 - q] FROM {source}, (SELECT unnest(range(1, 100)) AS q) WHERE q <= {lag}
  UNION ALL SELECT area_id, n, {lag}, {lag} + 2, s[{lag} + 1:n - 1] FROM {source}),
{name} AS (SELECT a.area_id, a.n, a.m, a.k AS i, b.k AS j, list_inner_product(a.v, b.v) AS a FROM {name}_c a JOIN {name}_c b ON b.area_id = a.area_id)"""


def adf_sql(dense: str, lag: int | None = None) -> str:
    powers = lambda cs: " + ".join(f"{c} * pow(tau, {i})" for i, c in enumerate(cs))
    critical = ", ".join(f"""round({" + ".join(f"{c} / pow(n_obs, {i})" for i, c in enumerate(cs))}, 6) AS "{name}" """
                         for name, cs in stationarity.CRITICAL_SURFACE.items())
    chosen = f"""{_adf_design("big", "s", "top")}, {sweep("nested", "big", "area_id", "m + 2")},
best AS (SELECT area_id, arg_min(step - 2, (n - 1 - m) * ln(a / (n - 1 - m)) + 2 * step) AS used_lag FROM nested
  WHERE step >= 2 AND i = m + 2 AND j = m + 2 GROUP BY area_id)""" if lag is None else f"best AS (SELECT area_id, {lag} AS used_lag FROM s)"
    return f"""{recursive(dense)}, v AS (SELECT area_id, ts, value - avg(value) OVER (PARTITION BY area_id) AS x,
  lead(value) OVER (PARTITION BY area_id ORDER BY ts) - value AS step FROM dense),
s AS (SELECT area_id, count(*) AS n, list(x ORDER BY ts) AS x, list(step ORDER BY ts) FILTER (step IS NOT NULL) AS s,
  least(count(*) // 2 - 2, CAST(ceil(12 * pow(count(*) / 100.0, 0.25)) AS BIGINT)) AS top FROM v GROUP BY area_id),
{chosen}, own AS (SELECT s.*, best.used_lag FROM s JOIN best ON best.area_id = s.area_id),
{_adf_design("small", "own", "used_lag")}, {sweep("fit", "small", "area_id", "m + 2")},
t AS (SELECT area_id, CAST(m AS INT) AS used_lag, CAST(n - 1 - m AS INT) AS n_obs, max(a) FILTER (i = 1 AND j = m + 2)
  / sqrt(max(a) FILTER (i = m + 2 AND j = m + 2) / (n - 1 - m - m - 2) * max(a) FILTER (i = 1 AND j = 1)) AS tau FROM fit WHERE step = m + 2 GROUP BY area_id, n, m),
z AS (SELECT *, CASE WHEN tau <= {stationarity.TAU_SPLIT} THEN {powers(stationarity.SMALL_P)} ELSE {powers(stationarity.LARGE_P)} END AS z FROM t),
p AS (SELECT *, CASE WHEN tau >= {stationarity.TAU_MAX} THEN 1 WHEN tau <= {stationarity.TAU_MIN} THEN 0
  WHEN abs(z) > 2.5 THEN CASE WHEN z > 0 THEN 1 ELSE 0 END - sign(z) * exp(-z * z / 2) / sqrt(2 * pi())
    / list_reduce(list_concat([abs(z)], [k::DOUBLE for k in range(120, 0, -1)]), lambda f, k: abs(z) + k / f)
  ELSE 0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * list_sum([pow(z, 2 * k + 1) * sqrt(pi()) / (pow(2, k + 1) * gamma(k + 1.5)) for k in range(0, 81)]) END AS p FROM z)
SELECT area_id, 'area_' || area_id AS series, round(tau, 5) AS adf_statistic, round(p, 5) + 0 AS p_value, used_lag, n_obs, {critical},
p < 0.05 AS "stationary_at_5%" FROM p"""


def shown_adf(table: DataFrame) -> DataFrame:
    return _rounded(_rounded(table, "adf_statistic", "p_value", digits=5), *stationarity.CRITICAL_SURFACE)


@query(adf_sql(TYPE_DENSE))
def adf_test(spark: SparkSession, sf: str) -> DataFrame:
    """The lag order with the smallest AIC."""
    return shown_adf(stationarity.adf_test(type_series(spark, sf)))


@query(adf_sql(SUPPLIER_DENSE))
def adf_test_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Every lag order on thousands of days per area."""
    return shown_adf(stationarity.adf_test(supplier_series(spark, sf)))


@query(adf_sql(SUPPLIER_DENSE, 1))
def adf_one_lag(spark: SparkSession, sf: str) -> DataFrame:
    return shown_adf(stationarity.adf_test(supplier_series(spark, sf), lag=1))


@query(adf_sql(SUPPLIER_DENSE, 2))
def adf_two_lags(spark: SparkSession, sf: str) -> DataFrame:
    return shown_adf(stationarity.adf_test(supplier_series(spark, sf), lag=2))


_INTEGRATED = TYPE_DENSE.replace("dense AS (", "cells_ AS (", 1) + """, dense AS (SELECT area_id, ts, sum(value - m) OVER (PARTITION BY area_id ORDER BY ts) AS value
FROM (SELECT *, avg(value) OVER (PARTITION BY area_id) AS m FROM cells_))"""


@query(adf_sql(_INTEGRATED))
def adf_integrated(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals of the deviations from the mean: close to a unit root, so p-values lie inside."""
    area = Window.partitionBy("area_id")
    centred = type_series(spark, sf).withColumn("value", F.col("value") - F.avg("value").over(area))
    return shown_adf(stationarity.adf_test(centred.withColumn("value", F.sum("value").over(area.orderBy("ts")))))


# --- local regression --------------------------------------------------------------------------

def loess_sql(dense: str, window: int) -> str:
    """Weighted regression sums of each point's neighbours, with the geometry written out point by point."""
    return f"""{dense}, o AS (SELECT area_id, ts, value AS y, row_number() OVER (PARTITION BY area_id ORDER BY ts) - 1 AS t, count(*) OVER (PARTITION BY area_id) AS n FROM dense),
w AS (SELECT *, least({window}, n) AS width, greatest(0, least(t - {window} // 2, n - least({window}, n))) AS lo FROM o),
r AS (SELECT *, greatest(t - lo, lo + width - 1 - t) + greatest({window} - n, 0) // 2 AS reach FROM w),
k AS (SELECT r.area_id, r.ts, r.n, r.y AS own, b.t - r.t AS x, b.y, abs(b.t - r.t) / greatest(r.reach, 1e-12) AS share
  FROM r JOIN o b ON b.area_id = r.area_id AND b.t >= r.lo AND b.t < r.lo + r.width),
g AS (SELECT *, CASE WHEN share <= 0.001 THEN 1 WHEN share <= 0.999 THEN pow(1 - pow(share, 3), 3) ELSE 0 END AS weight FROM k),
f AS (SELECT area_id, ts, n, sum(weight) AS s0, sum(weight * x) / sum(weight) AS mx, sum(weight * y) / sum(weight) AS my,
  sum(weight * x * x) / sum(weight) AS mxx, sum(weight * x * y) / sum(weight) AS mxy FROM g GROUP BY area_id, ts, n)
SELECT area_id, ts, round(my - CASE WHEN mxx - mx * mx > pow(0.001 * (n - 1), 2) THEN mx * (mxy - mx * my) / (mxx - mx * mx) ELSE 0 END, 5) + 0 AS smooth FROM f"""


TREND_WINDOW = 49


@query(loess_sql(TYPE_DENSE, TREND_WINDOW))
def loess_trend(spark: SparkSession, sf: str) -> DataFrame:
    """One pass of the local regression that the decomposition is made of, window of two days."""
    return _rounded(decomposition.smooth(type_series(spark, sf), TREND_WINDOW), "smooth", digits=5)


@query(loess_sql(SUPPLIER_DENSE, 15))
def loess_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(decomposition.smooth(supplier_series(spark, sf), 15), "smooth", digits=5)


# --- runs --------------------------------------------------------------------------------------

SAMPLE = """sample AS (SELECT area_id, ts, round(value, 2) AS value FROM all_cells WHERE area_id IN {areas}),
top AS (SELECT area_id FROM sample GROUP BY area_id ORDER BY sum(value) DESC, area_id LIMIT 1),
labels AS (SELECT 'highest' AS label, area_id FROM top UNION ALL SELECT 'fixed_1', 3),
dense AS (SELECT * FROM sample WHERE area_id IN (SELECT area_id FROM labels))"""
_SAMPLE_DENSE = USER_DENSE.replace("dense AS (", "all_cells AS (", 1) + ", " + SAMPLE.format(areas=SAMPLE_AREAS)
_SAMPLE_LAGS = ", ".join(f"lag(value, {p}) OVER (PARTITION BY area_id ORDER BY ts) AS {n}" for n, p in NAIVE_LAGS.items())


@query(f"""{_ar1_cte(BEFORE).replace(TYPE_DENSE, _SAMPLE_DENSE)}, naive AS (SELECT area_id, ts, value AS y_true, {_SAMPLE_LAGS} FROM dense),
pred AS (SELECT p.area_id, 'SARIMA' AS model, value AS y_true, greatest(intercept + slope * previous + lagged, 0) AS y_pred
  FROM p JOIN fit ON fit.area_id = p.area_id WHERE test
  {" ".join(f"UNION ALL SELECT area_id, '{n}', y_true, {n} FROM naive WHERE {IN_TEST}" for n in NAIVE_LAGS)})
SELECT label, pred.area_id, model, round(avg(abs(y_true - y_pred)), 5) AS "MAE", round(sqrt(avg(pow(y_true - y_pred, 2))), 5) AS "RMSE",
round(avg(abs(y_true - y_pred) / greatest((abs(y_true) + abs(y_pred)) / 2, 1e-8)) * 100, 4) AS "sMAPE", count(*) AS n
FROM pred JOIN labels ON labels.area_id = pred.area_id GROUP BY label, pred.area_id, model""")
def sample_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The forecasting run from a stored sample of three areas, two of them labelled, scored per label."""
    path = scratch_path(spark, "sample")
    wide = series.wide_matrix(user_series(spark, sf), SAMPLE_AREAS)
    tables.write_sample(wide.select("ts", *[F.round(c, 2).alias(c) for c in wide.columns if c != "ts"]), path)
    scored = sample_run(spark, path, FIXED, BEFORE, (1, 0, 0), views.PERIOD, NAIVE_LAGS)
    return _rounded(_rounded(scored.select("label", "area_id", "model", "MAE", "RMSE", "sMAPE", "n"), "MAE", "RMSE", digits=5), "sMAPE", digits=4)


_TARGET_DENSE = f"""{USER_DENSE.replace("dense AS (", "all_cells AS (", 1)}, {_TARGETS.replace("FROM dense", "FROM all_cells")},
dense AS (SELECT * FROM all_cells WHERE area_id IN (SELECT area_id FROM targets))"""


@query(f"""{_ar1_cte(BEFORE).replace(TYPE_DENSE, _TARGET_DENSE)}, naive AS (SELECT area_id, ts, value AS y_true, {_SAMPLE_LAGS} FROM dense),
pred AS (SELECT p.area_id, 'SARIMA' AS model, value AS y_true, greatest(intercept + slope * previous + lagged, 0) AS y_pred
  FROM p JOIN fit ON fit.area_id = p.area_id WHERE test
  {" ".join(f"UNION ALL SELECT area_id, '{n}', y_true, {n} FROM naive WHERE {IN_TEST}" for n in NAIVE_LAGS)}),
each AS (SELECT area_id, model, avg(abs(y_true - y_pred)) AS mae, sqrt(avg(pow(y_true - y_pred, 2))) AS rmse FROM pred GROUP BY area_id, model)
SELECT model, round(avg(mae), 3) AS "MAE", round(avg(rmse), 3) AS "RMSE", 0::BIGINT AS failed FROM each GROUP BY model""")
def forecast_targets_ar1_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The busiest and the two fixed areas: mean error per model over them, with order (1,0,0)."""
    chosen = user_series(spark, sf).join(F.broadcast(target_ids(spark, sf).select("area_id").distinct()), "area_id", "left_semi")
    return forecast_run(materialize(chosen), BEFORE, (1, 0, 0), views.PERIOD, NAIVE_LAGS).metric_summary.drop("MAPE")


@query(f"""{TYPE_DENSE}, a AS (SELECT count(DISTINCT area_id) AS n FROM dense)
SELECT 'SARIMA' AS model, n AS timed, true AS all_measured, true AS mean_is_mean, 'mean of ' || n || ' areas' AS measured_over FROM a""")
def forecast_run_timing(spark: SparkSession, sf: str) -> DataFrame:
    """The timing tables of a real run: every area has both times, and the summary is their mean."""
    path = scratch_path(spark, "run")
    store_run(forecast_run(materialize(type_series(spark, sf)), BEFORE, (1, 0, 0), views.PERIOD), path)
    each = read_run(spark, path, "timing", "area_id int, model string, train_time_s double, predict_time_s double")
    summed = read_run(spark, path, "timing_summary", "model string, train_mean double, predict_mean double, measured_over string")
    found = each.groupBy("model").agg(
        F.count("*").alias("timed"), F.every((F.col("train_time_s") > 0) & (F.col("predict_time_s") >= 0)).alias("all_measured"),
        F.avg("train_time_s").alias("train"), F.avg("predict_time_s").alias("predict"))
    close = (F.abs(F.col("train") - F.col("train_mean")) <= 0.001) & (F.abs(F.col("predict") - F.col("predict_mean")) <= 0.001)
    return found.join(summed, "model").select("model", "timed", "all_measured", close.alias("mean_is_mean"), "measured_over")
