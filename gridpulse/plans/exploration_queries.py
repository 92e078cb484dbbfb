"""Queries on distribution, spatial grid, rolling statistics, anomalies and time-series diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.functions.scalars import rounded
from gridpulse.operators import anomaly, correlation, decomposition, distribution, stationarity, temporal
from gridpulse.plans import views
from gridpulse.plans.consolidation_queries import supplier_series, type_series, user_series
from gridpulse.plans.oracle_views import PART_TOTALS, SUPPLIER_DENSE, TYPE_DENSE, USER_DENSE
from gridpulse.plans.registry import query

WEEK_DAYS = 7


def _rounded(table: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """``table`` with the named double columns rounded."""
    return table.select(*[rounded(F.col(f"`{c}`"), digits).alias(c) if c in columns else F.col(f"`{c}`") for c in table.columns])


# --- distribution ------------------------------------------------------------------------------

@query(f"""WITH t AS ({PART_TOTALS}), c AS (SELECT avg(total_traffic) AS m FROM t),
s AS (SELECT count(*)::DOUBLE AS n_areas, avg(total_traffic) AS mean, quantile_cont(total_traffic, 0.5) AS median,
  stddev_pop(total_traffic) AS std, min(total_traffic) AS min, max(total_traffic) AS max,
  avg(pow(total_traffic - m, 3)) / pow(avg(pow(total_traffic - m, 2)), 1.5) AS skewness,
  avg(pow(total_traffic - m, 4)) / pow(avg(pow(total_traffic - m, 2)), 2) - 3 AS kurtosis,
  quantile_cont(total_traffic, 0.95) / greatest(quantile_cont(total_traffic, 0.5), 1e-9) AS ratio FROM t, c)
SELECT unnest(['n_areas', 'mean', 'median', 'std', 'min', 'max', 'skewness', 'kurtosis', 'p95 / median ratio']) AS metric,
  unnest([round(n_areas, 6), round(mean, 6), round(median, 6), round(std, 6), round(min, 6), round(max, 6),
  round(skewness, 6), round(kurtosis, 6), round(ratio, 6)]) AS value FROM s""")
def distribution_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distribution.summary(views.part_totals(spark, sf)), "value")


def _histogram_sql(totals: str, log: bool) -> str:
    x, back = ("log10(total_traffic)", "pow(10, {})") if log else ("total_traffic", "{}")
    return f"""WITH t AS ({totals}), v AS (SELECT {x} AS x FROM t {"WHERE total_traffic > 0" if log else ""}),
b AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
c AS (SELECT least(CAST(floor(80 * (x - lo) / (hi - lo)) AS INT) + 1, 80) AS bin, count(*) AS k FROM v, b GROUP BY 1)
SELECT CAST(g.bin AS INT) AS bin, round({back.format("lo + (hi - lo) * (g.bin - 1) * (1.0::DOUBLE / 80)")}, 4) AS lo,
  round({back.format("lo + (hi - lo) * g.bin * (1.0::DOUBLE / 80)")}, 4) AS hi, coalesce(k, 0) AS count
FROM (SELECT unnest(range(1, 81)) AS bin) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin"""


_SUPPLIER_TOTALS = f"{SUPPLIER_DENSE} SELECT area_id, round(sum(value), 2) AS total_traffic FROM dense GROUP BY area_id"


def _supplier_totals(spark: SparkSession, sf: str) -> DataFrame:
    from gridpulse.operators import areas

    return areas.totals(views.by_supplier(spark, sf)).withColumn("total_traffic", F.round("total_traffic", 2))


@query(_histogram_sql(PART_TOTALS, False))
def linear_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distribution.histogram(views.part_totals(spark, sf)), "lo", "hi", digits=4)


@query(_histogram_sql(_SUPPLIER_TOTALS, True))
def log_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distribution.histogram(_supplier_totals(spark, sf), log_scale=True), "lo", "hi", digits=4)


def _density_sql(log: bool) -> str:
    x, back = ("log10(total_traffic)", "pow(10, {})") if log else ("total_traffic", "{}")
    return f"""WITH v AS (SELECT {x} AS x FROM ({PART_TOTALS}) {"WHERE total_traffic > 0" if log else ""}),
f AS (SELECT min(x) AS lo, max(x) AS hi, count(*)::DOUBLE AS n, stddev_samp(x) * pow(count(*)::DOUBLE, -0.2) AS h FROM v),
g AS (SELECT CAST(p AS INT) AS point, lo + p * (hi - lo) / 199 AS x, n, h, lo, hi FROM f, (SELECT unnest(range(0, 200)) AS p))
SELECT g.point, round({back.format("any_value(g.x)")}, 4) AS x,
  round(sum(exp(-0.5 * pow((g.x - v.x) / h, 2))) / any_value(n * h * 2.5066282746310002), 8) AS density,
  round(sum(exp(-0.5 * pow((g.x - v.x) / h, 2))) / any_value(h * 2.5066282746310002) * any_value(hi - lo) / 80, 6) AS expected_count
FROM g CROSS JOIN v GROUP BY g.point"""


def _shown_curve(curve: DataFrame) -> DataFrame:
    return curve.select("point", rounded(F.col("x"), 4).alias("x"), rounded(F.col("density"), 8).alias("density"),
                        rounded(F.col("expected_count")).alias("expected_count"))


@query(_density_sql(False))
def density_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = distribution.density(views.part_totals(spark, sf))
    return _shown_curve(curve)


@query(_density_sql(True))
def log_density_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = distribution.density(views.part_totals(spark, sf), log_scale=True)
    return _shown_curve(curve)


@query(f"""WITH t AS ({PART_TOTALS}), g AS (SELECT CAST(ceil(sqrt(max(area_id))) AS INT) AS side FROM t),
c AS (SELECT CAST(unnest(range(1, side * side + 1)) AS INT) AS area_id, side FROM g)
SELECT c.area_id, CAST((c.area_id - 1) // side AS INT) AS grid_row, CAST((c.area_id - 1) % side AS INT) AS grid_col,
  coalesce(total_traffic, 0) AS total, round(ln(1 + coalesce(total_traffic, 0)), 6) AS log1p_total
FROM c LEFT JOIN t ON t.area_id = c.area_id""")
def spatial_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distribution.spatial_grid(views.part_totals(spark, sf)), "log1p_total")


@query(f"SELECT CAST(ceil(sqrt(max(area_id))) AS INT) AS side FROM ({PART_TOTALS})")
def grid_side(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.grid_side(views.part_totals(spark, sf))


# --- rolling and seasonal windows --------------------------------------------------------------

def _rolling_sql(dense: str, window: int) -> str:
    return f"""{dense} SELECT area_id, ts, round(value, 6) AS value,
  CASE WHEN count(*) OVER w = {window} THEN round(avg(value) OVER w, 6) END AS rolling_mean,
  CASE WHEN count(*) OVER w = {window} THEN round(stddev_samp(value) OVER w, 4) END AS rolling_std
FROM dense WINDOW w AS (PARTITION BY area_id ORDER BY ts ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"""


@query(_rolling_sql(USER_DENSE, views.PERIOD))
def rolling_statistics(spark: SparkSession, sf: str) -> DataFrame:
    out = temporal.rolling(user_series(spark, sf), views.PERIOD)
    return _rounded(_rounded(out, "value", "rolling_mean"), "rolling_std", digits=4)


@query(_rolling_sql(USER_DENSE, 7 * views.PERIOD))
def rolling_statistics_week(spark: SparkSession, sf: str) -> DataFrame:
    """A long window: merged block moments instead of a walk over the frame."""
    out = temporal.rolling(user_series(spark, sf), 7 * views.PERIOD)
    return _rounded(_rounded(out, "value", "rolling_mean"), "rolling_std", digits=4)


@query(_rolling_sql(SUPPLIER_DENSE, WEEK_DAYS))
def rolling_statistics_daily(spark: SparkSession, sf: str) -> DataFrame:
    out = temporal.rolling(supplier_series(spark, sf), WEEK_DAYS)
    return _rounded(_rounded(out, "value", "rolling_mean"), "rolling_std", digits=4)


@query(f"""{USER_DENSE}, l AS (SELECT area_id, ts, value, lag(value, {views.PERIOD}) OVER (PARTITION BY area_id ORDER BY ts) AS lagged FROM dense)
SELECT area_id, ts, round(value, 6) AS value, round(lagged, 6) AS lagged FROM l""")
def seasonal_lag(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(temporal.with_lag(user_series(spark, sf), views.PERIOD), "value", "lagged")


@query(f"""{USER_DENSE}, l AS (SELECT area_id, ts, value - lag(value, {views.PERIOD}) OVER (PARTITION BY area_id ORDER BY ts) AS diff FROM dense)
SELECT area_id, ts, round(diff, 6) + 0 AS diff FROM l WHERE diff IS NOT NULL""")
def seasonal_difference(spark: SparkSession, sf: str) -> DataFrame:
    out = temporal.seasonal_difference(user_series(spark, sf), views.PERIOD)
    return _rounded(out.select("area_id", "ts", "diff"), "diff")


@query(f"""{SUPPLIER_DENSE}, l AS (SELECT area_id, ts, value - lag(value, 7) OVER (PARTITION BY area_id ORDER BY ts) AS diff FROM dense),
m AS (SELECT area_id, ts, diff - lag(diff, 7) OVER (PARTITION BY area_id ORDER BY ts) AS diff FROM l)
SELECT area_id, ts, round(diff, 4) + 0 AS diff FROM m WHERE diff IS NOT NULL""")
def seasonal_difference_twice(spark: SparkSession, sf: str) -> DataFrame:
    out = temporal.seasonal_difference(supplier_series(spark, sf), WEEK_DAYS, times=2)
    return _rounded(out.select("area_id", "ts", "diff"), "diff", digits=4)


@query(f"""{USER_DENSE}, l AS (SELECT area_id, ts, value, lag(value, {views.PERIOD}) OVER (PARTITION BY area_id ORDER BY ts) AS lagged FROM dense)
SELECT area_id, ts, round((value - lagged) + lagged, 6) AS restored FROM l WHERE lagged IS NOT NULL""")
def seasonal_restore(spark: SparkSession, sf: str) -> DataFrame:
    """Differencing undone: the original values come back."""
    out = temporal.seasonal_difference(temporal.with_lag(user_series(spark, sf), views.PERIOD), views.PERIOD)
    restored = temporal.undo_seasonal_difference(F.col("diff"), F.col("lagged"))
    return out.select("area_id", "ts", rounded(restored).alias("restored"))


@query(f"""{USER_DENSE}, r AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY ts DESC) AS place FROM dense)
SELECT area_id, ts, round(value, 6) AS value FROM r WHERE place <= 168""")
def recent_tail(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(temporal.recent(user_series(spark, sf), 7 * views.PERIOD), "value")


# --- anomalies ---------------------------------------------------------------------------------

def _scores_sql(dense: str) -> str:
    return f"""{dense}, g AS (SELECT area_id, ts, value, CAST(isodow(ts) - 1 AS INT) AS dow, CAST(hour(ts) AS INT) AS slot FROM dense),
e AS (SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY area_id, dow, slot) AS expected FROM g),
f AS (SELECT *, greatest(quantile_cont(expected, 0.5) OVER (PARTITION BY area_id) * 0.05, 1e-6) AS base FROM e),
r AS (SELECT *, (value - expected) / greatest(expected, base) AS rel FROM f),
d AS (SELECT *, rel - quantile_cont(rel, 0.5) OVER (PARTITION BY area_id) AS dev FROM r),
m AS (SELECT *, quantile_cont(abs(dev), 0.5) OVER (PARTITION BY area_id) * 1.4826 AS mad FROM d),
z AS (SELECT area_id, ts AS timestamp, value, expected, dev / CASE WHEN mad > 0 THEN mad ELSE 1 END AS robust_z FROM m)"""


@query(f"""{USER_DENSE}, g AS (SELECT area_id, CAST(isodow(ts) - 1 AS INT) AS dow, CAST(hour(ts) AS INT) AS slot, value FROM dense)
SELECT area_id, dow, slot, round(quantile_cont(value, 0.5), 6) AS expected FROM g GROUP BY 1, 2, 3""")
def weekly_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(anomaly.weekly_profile(user_series(spark, sf), views.STEP_MINUTES), "expected")


def _type_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.anomalies(type_series(spark, sf), 4.0, views.STEP_MINUTES)


@query(f"""{_scores_sql(TYPE_DENSE)} SELECT area_id, timestamp, round(value, 6) AS value, round(expected, 6) AS expected,
round(robust_z, 4) + 0 AS robust_z FROM z""")
def anomaly_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = anomaly.scores(type_series(spark, sf), views.STEP_MINUTES).withColumnRenamed("ts", "timestamp")
    return _rounded(_rounded(scored, "value", "expected"), "robust_z", digits=4)


@query(f"""{_scores_sql(TYPE_DENSE)} SELECT area_id, timestamp, round(value, 6) AS value, round(expected, 6) AS expected,
round(robust_z, 4) + 0 AS robust_z FROM z WHERE abs(robust_z) > 4""")
def anomalies_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_rounded(_type_anomalies(spark, sf), "value", "expected"), "robust_z", digits=4)


@query(f"{_scores_sql(USER_DENSE)} SELECT area_id, count(*) AS anomalies FROM z WHERE abs(robust_z) > 4 GROUP BY area_id")
def anomaly_counts_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.counts(anomaly.anomalies(user_series(spark, sf), 4.0, views.STEP_MINUTES))


@query(f"""{_scores_sql(TYPE_DENSE)} SELECT area_id, timestamp, round(value, 6) AS value, round(expected, 6) AS expected,
round(robust_z, 4) + 0 AS robust_z FROM z WHERE abs(robust_z) > 4 ORDER BY abs(z.robust_z) DESC, timestamp, area_id LIMIT 50""")
def strongest_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_rounded(anomaly.strongest(_type_anomalies(spark, sf)), "value", "expected"), "robust_z", digits=4)


@query(f"""{_scores_sql(TYPE_DENSE)}, p AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY abs(robust_z) DESC, timestamp) AS place
FROM z WHERE abs(robust_z) > 4)
SELECT area_id, timestamp, round(value, 6) AS value, round(expected, 6) AS expected, round(robust_z, 4) + 0 AS robust_z,
CAST(place AS INT) AS place FROM p WHERE place <= 10""")
def strongest_anomalies_per_area(spark: SparkSession, sf: str) -> DataFrame:
    top = anomaly.strongest_per_area(_type_anomalies(spark, sf), 10)
    return _rounded(_rounded(top, "value", "expected"), "robust_z", digits=4)


# --- autocorrelation, stationarity, decomposition ----------------------------------------------

def _acf_sql(dense: str, lags: int) -> str:
    return f"""{dense}, c AS (SELECT area_id, row_number() OVER (PARTITION BY area_id ORDER BY ts) AS i,
  value - avg(value) OVER (PARTITION BY area_id) AS x FROM dense),
k AS (SELECT unnest(range(0, {lags + 1})) AS lag),
s AS (SELECT a.area_id, k.lag, sum(a.x * b.x) AS v FROM c a CROSS JOIN k JOIN c b ON b.area_id = a.area_id AND b.i = a.i - k.lag GROUP BY 1, 2),
n AS (SELECT area_id, count(*) AS n FROM c GROUP BY area_id),
r AS (SELECT s.area_id, CAST(s.lag AS INT) AS lag, s.v / z.v AS acf, n.n FROM s JOIN s z ON z.area_id = s.area_id AND z.lag = 0 JOIN n ON n.area_id = s.area_id)"""


_BAND = """SELECT area_id, lag, round(acf, 6) + 0 AS acf, CASE WHEN lag = 0 THEN 0 ELSE round(1.959963984540054 * sqrt((1 + 2 *
  coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END) OVER (PARTITION BY area_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n), 6) END AS band FROM r"""


@query(f"{_acf_sql(TYPE_DENSE, 24)} {_BAND}")
def autocorrelation(spark: SparkSession, sf: str) -> DataFrame:
    """Up to 24 lags: lag columns and sums, all in SQL."""
    return _rounded(correlation.acf(type_series(spark, sf), views.PERIOD), "acf", "band")


@query(f"{_acf_sql(USER_DENSE, 24)} {_BAND}")
def autocorrelation_by_user(spark: SparkSession, sf: str) -> DataFrame:
    """The same for many areas."""
    return _rounded(correlation.acf(user_series(spark, sf), views.PERIOD), "acf", "band")


@query(f"{_acf_sql(TYPE_DENSE, 48)} {_BAND}")
def autocorrelation_two_days(spark: SparkSession, sf: str) -> DataFrame:
    """Twice the season, as the published analysis has it: a grouped map over the power spectrum."""
    return _rounded(correlation.acf(type_series(spark, sf), 2 * views.PERIOD), "acf", "band")


@query(f"""{_acf_sql(SUPPLIER_DENSE, 3)}, w AS (SELECT area_id, any_value(n) AS n, max(acf) FILTER (lag = 1) AS r1,
  max(acf) FILTER (lag = 2) AS r2, max(acf) FILTER (lag = 3) AS r3 FROM r GROUP BY area_id),
q AS (SELECT *, (r2 - r1 * r1) / (1 - r1 * r1) AS f22, r1 * (1 - r2) / (1 - r1 * r1) AS f21 FROM w),
p AS (SELECT area_id, n, unnest(range(0, 4)) AS lag, unnest([1, r1, f22, (r3 - f21 * r2 - f22 * r1) / (1 - f21 * r1 - f22 * r2)]) AS pacf FROM q)
SELECT area_id, CAST(lag AS INT) AS lag, round(pacf, 6) + 0 AS pacf, CASE WHEN lag = 0 THEN 0 ELSE round(1.959963984540054 / sqrt(n), 6) END AS band FROM p""")
def partial_autocorrelation_low(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(correlation.pacf(supplier_series(spark, sf), 3), "pacf", "band")


# Durbin-Levinson: the coefficients of each order from those of the order before.
_PACF_SQL = f"""{_acf_sql(TYPE_DENSE, 2 * views.PERIOD).replace("WITH ", "WITH RECURSIVE ", 1)},
w AS (SELECT area_id, any_value(n) AS n, list(acf ORDER BY lag) AS a FROM r GROUP BY area_id),
lev(area_id, n, a, k, phi, t) AS (
  SELECT area_id, n, a, 1, [a[2]], a[2] FROM w UNION ALL
  SELECT area_id, n, a, k + 1, list_append([phi[j] - s * phi[k + 1 - j] for j in range(1, k + 1)], s), s FROM (
    SELECT *, (a[k + 2] - list_sum([phi[j] * a[k + 2 - j] for j in range(1, k + 1)]))
      / (1 - list_sum([phi[j] * a[j + 1] for j in range(1, k + 1)])) AS s FROM lev WHERE k < {2 * views.PERIOD}))
SELECT area_id, CAST(k AS INT) AS lag, round(t, 6) + 0 AS pacf, round(1.959963984540054 / sqrt(n), 6) AS band FROM lev
UNION ALL SELECT area_id, 0, 1, 0 FROM w"""


@query(_PACF_SQL)
def partial_autocorrelation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(correlation.pacf(type_series(spark, sf), 2 * views.PERIOD), "pacf", "band")


@query(f"""{SUPPLIER_DENSE}, p AS (SELECT area_id, lag(value) OVER w AS x, value - lag(value) OVER w AS y FROM dense
WINDOW w AS (PARTITION BY area_id ORDER BY ts)),
f AS (SELECT area_id, count(*) AS n_obs, regr_slope(y, x) AS b, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
FROM p WHERE x IS NOT NULL GROUP BY area_id)
SELECT area_id, n_obs, round(b / sqrt((syy - sxy * sxy / sxx) / (n_obs - 2) / sxx), 4) AS adf_statistic FROM f WHERE sxx > 0""")
def dickey_fuller_lag0(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stationarity.dickey_fuller_lag0(supplier_series(spark, sf)), "adf_statistic", digits=4)


@query()
def seasonal_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    return decomposition.decompose(type_series(spark, sf), views.PERIOD)


@query(f"{TYPE_DENSE} SELECT area_id, ts, round(value, 6) AS observed, round(value, 6) AS rebuilt FROM dense")
def decomposition_adds_up(spark: SparkSession, sf: str) -> DataFrame:
    """Trend, seasonal and residual of the robust decomposition add up to the observed value."""
    parts = decomposition.decompose(type_series(spark, sf), views.PERIOD)
    return parts.select("area_id", "ts", rounded(F.col("observed")).alias("observed"),
                        rounded(F.col("trend") + F.col("seasonal") + F.col("resid")).alias("rebuilt"))
