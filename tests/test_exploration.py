import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import column
from pyspark.sql import functions as F

from gridpulse.operators import anomaly, correlation, decomposition, distribution, stationarity, temporal


def totals(spark, values):
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(values)], "area_id int, total_traffic double")


def test_summary_matches_moments(spark):
    x = np.random.default_rng(1).lognormal(3, 1, 501)
    got = {r.metric: r.value for r in distribution.summary(totals(spark, [*x, np.nan, np.inf])).collect()}
    d = x - x.mean()
    want = {
        "n_areas": 501, "mean": x.mean(), "median": np.median(x), "std": x.std(), "min": x.min(), "max": x.max(),
        "skewness": (d ** 3).mean() / x.std() ** 3, "kurtosis": (d ** 4).mean() / x.var() ** 2 - 3,
        "p95 / median ratio": np.percentile(x, 95) / np.median(x),
    }
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_histogram_edges(spark):
    bins = {r.bin: r for r in distribution.histogram(totals(spark, [0, 79.5, 80])).collect()}
    assert len(bins) == 80 and sum(b["count"] for b in bins.values()) == 3
    assert (bins[1]["count"], bins[80]["count"], bins[2]["count"]) == (1, 2, 0)
    assert (bins[1].lo, bins[80].hi) == (0.0, 80.0)
    same = distribution.histogram(totals(spark, [5, 5]))
    assert same.agg(F.sum("count"), F.min("lo"), F.max("hi")).first()[:] == (2, 4.5, 5.5)


def test_log_histogram_matches_numpy(spark):
    x = np.random.default_rng(2).lognormal(3, 2, 400)
    got = distribution.histogram(totals(spark, [*x, 0.0, -1.0]), log_scale=True).orderBy("bin").collect()
    counts, edges = np.histogram(np.log10(x), 80)
    assert [r["count"] for r in got] == counts.tolist()
    assert np.allclose([r.lo for r in got], 10 ** edges[:-1])


def test_density_matches_direct_sum(spark):
    x = np.random.default_rng(3).lognormal(3, 2, 300)
    got = distribution.density(totals(spark, x)).orderBy("point").collect()
    h, grid = x.std(ddof=1) * 300 ** -0.2, np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (300 * h * math.sqrt(2 * math.pi))
    assert np.allclose([r.density for r in got], want, rtol=1e-9, atol=1e-15)
    assert distribution.density(totals(spark, [4, 4])).where("density IS NOT NULL").isEmpty()


def test_grid(spark):
    for largest, side in ((1, 1), (90, 10), (100, 10), (101, 11)):
        assert distribution.grid_side(spark.createDataFrame([(largest, 1.0)], "area_id int, total_traffic double")).first()["side"] == side
    frame = spark.createDataFrame([(0, 5.0), (2, 7.0), (10, 9.0)], "area_id int, total_traffic double")
    grid = distribution.spatial_grid(frame, 3).orderBy("area_id").collect()
    assert [r.total for r in grid] == [0, 7, 0, 0, 0, 0, 0, 0, 0]
    spot = distribution.spatial_grid(frame, 100).where("area_id = 5161").first()
    assert (spot.grid_row, spot.grid_col) == (51, 60)


def test_rolling(daily):
    out = temporal.rolling(daily({1: [1, 2, 4, 8], 2: [1, None, 2, 2]}), 3)
    mean, std = column(out, "rolling_mean"), column(out, "rolling_std")
    assert mean[:2] == [None, None] and np.allclose(mean[2:4], [7 / 3, 14 / 3])
    assert np.allclose(std[2:4], [1.527525, 3.055050], atol=1e-6)
    assert mean[4:] == [None] * 4


@pytest.mark.parametrize("window", [2, 5, 40])
def test_rolling_by_blocks_equals_frames(daily, window):
    x = np.random.default_rng(9).lognormal(5, 2, (3, 103))
    frame = daily({1: x[0], 2: [None if i == 50 else v for i, v in enumerate(x[1])], 3: [0.0] * 60 + list(x[2]), 4: [1.0] * 3})
    by_frame, by_blocks = (f(frame, window) for f in (temporal._rolling_by_frame, temporal._rolling_by_blocks))
    for name in ("rolling_mean", "rolling_std"):
        a, b = column(by_frame, name), column(by_blocks, name)
        assert [v is None for v in a] == [v is None for v in b]
        assert np.allclose([v for v in a if v is not None], [v for v in b if v is not None], rtol=1e-12, atol=1e-9)
    exact = by_blocks.where("area_id = 3 AND rolling_std IS NOT NULL").orderBy("ts").first()
    assert exact.rolling_std == 0.0


def test_seasonal_difference_and_restore(daily):
    frame = temporal.with_lag(daily({1: [1, 2, 4, 8]}), 2)
    diff = temporal.seasonal_difference(frame, 2)
    assert column(diff, "diff") == [3.0, 6.0]
    restored = diff.select("area_id", "ts", temporal.undo_seasonal_difference(F.col("diff"), F.col("lagged")).alias("v"))
    assert column(restored, "v") == [4.0, 8.0]
    assert column(temporal.seasonal_difference(daily({1: [1, 2, 4, 8]}), 1, times=2), "diff") == [1.0, 2.0]
    with pytest.raises(ValueError):
        temporal.undo_seasonal_difference(F.col("diff"), F.col("lagged"), 2)


def test_calendar(daily):
    frame = daily({1: [1, 1]}, start=datetime(2013, 11, 3, 23, 50))
    scored = anomaly.weekly_profile(frame).orderBy("dow").collect()
    assert [(r.dow, r.slot) for r in scored] == [(0, 143), (6, 143)]


def test_anomaly_of_one_group(daily):
    week = timedelta(days=7)
    values = [10, 11, 9, 10, 12, 8, 10, 11, 9, 60]
    frame = daily({1: values, 2: [5] * 10, 3: [0] * 10}, step=week)
    rows = anomaly.scores(frame).where("area_id = 1").orderBy("ts").collect()
    assert all(r.expected == 10 for r in rows)
    assert math.isclose(rows[-1].robust_z, 33.7245, abs_tol=1e-4)
    assert all(abs(r.robust_z) <= 1.35 for r in rows[:-1])
    flagged = anomaly.anomalies(frame)
    assert [(r.area_id, r.value) for r in flagged.collect()] == [(1, 60.0)]
    assert anomaly.scores(frame).where("area_id > 1 AND robust_z <> 0").isEmpty()


def test_acf_pacf_small(daily):
    frame = daily({1: [1, 2, 3, 4]})
    assert np.allclose(column(correlation.acf(frame, 3), "acf", ("lag",)), [1, 0.25, -0.3, -0.45])
    assert math.isclose(column(correlation.pacf(frame, 2), "pacf", ("lag",))[2], -0.386667, abs_tol=1e-6)


def test_acf_both_ways_and_pacf_by_toeplitz(daily):
    x = np.cumsum(np.random.default_rng(4).standard_normal((2, 200)), axis=1)
    frame = daily({1: x[0], 2: x[1], 3: [7] * 200})
    few, many = correlation.acf(frame, 20), correlation.acf(frame, 30)
    a, b = (np.array(column(f.where("lag <= 20 AND area_id < 3"), "acf", ("area_id", "lag"))) for f in (few, many))
    assert np.allclose(a, b) and np.allclose(a[[0, 21]], 1)
    r = b[:21]
    got = column(correlation.pacf(frame, 10).where("area_id = 1"), "pacf", ("lag",))
    want = [np.linalg.solve(r[np.abs(np.subtract.outer(range(k), range(k)))], r[1:k + 1])[-1] for k in range(1, 11)]
    assert np.allclose(got[1:], want)
    bands = column(few.where("area_id = 1"), "band", ("lag",))
    assert np.allclose(bands[1:3], 1.959964 * np.sqrt([1 / 200, (1 + 2 * r[1] ** 2) / 200]))


def test_adf_critical_values_and_p():
    crit = {k: sum(c / 8747 ** i for i, c in enumerate(cs)) for k, cs in stationarity.CRITICAL_SURFACE.items()}
    assert [round(v, 4) for v in crit.values()] == [-3.4311, -2.8619, -2.5669]
    assert math.isclose(stationarity.p_value(-2.86), 0.05, abs_tol=0.002)
    assert math.isclose(stationarity.p_value(-3.43), 0.01, abs_tol=0.002)
    assert stationarity.p_value(-19.1307) == 0.0 and stationarity.p_value(3.0) == 1.0


def test_adf_against_separate_regressions(daily):
    rng = np.random.default_rng(5)
    walk, shocks = np.cumsum(rng.standard_normal(400)), rng.standard_normal(400)
    ar = np.zeros(400)
    for t in range(2, 400):
        ar[t] = 0.9 * ar[t - 1] - 0.4 * ar[t - 2] + shocks[t]
    got = {r.area_id: r for r in stationarity.adf_test(daily({1: walk, 2: ar, 3: [1.0] * 400})).collect()}
    for area, x in ((1, walk), (2, ar)):
        step, top = np.diff(x), math.ceil(12 * (400 / 100) ** 0.25)

        def fit(lag, start):
            y = step[start:]
            design = np.column_stack([np.ones(len(y)), x[start:-1], *[step[start - j:-j] for j in range(1, lag + 1)]])
            beta, *_ = np.linalg.lstsq(design, y, rcond=None)
            sse = np.sum((y - design @ beta) ** 2)
            return design, beta, sse, len(y)

        def aic(lag):
            design, _, sse, n = fit(lag, top)
            return n * np.log(sse / n) + 2 * design.shape[1]

        lag = min(range(top + 1), key=aic)
        design, beta, sse, n = fit(lag, lag)
        tau = beta[1] / math.sqrt(sse / (n - design.shape[1]) * np.linalg.inv(design.T @ design)[1, 1])
        assert (got[area].used_lag, got[area].n_obs) == (lag, n) and math.isclose(got[area].adf_statistic, tau, rel_tol=1e-8)
    assert not got[1]["stationary_at_5%"] and got[2]["stationary_at_5%"]
    assert got[3].adf_statistic is None


def test_lag0_in_sql_equals_the_general_regression(daily):
    x = np.cumsum(np.random.default_rng(6).standard_normal(100))
    step = np.diff(x)
    design = np.column_stack([np.ones(99), x[:-1]])
    beta, sse, *_ = np.linalg.lstsq(design, step, rcond=None)
    tau = beta[1] / math.sqrt(sse[0] / 97 * np.linalg.inv(design.T @ design)[1, 1])
    assert math.isclose(stationarity.dickey_fuller_lag0(daily({1: x})).first().adf_statistic, tau, rel_tol=1e-8)


def slow_loess(y, at, window, trust):
    """Straight from the definition: weighted line through the nearest points."""
    n = len(y)
    width = min(window, n)
    left = min(max(at - window // 2, 0), n - width)
    near = np.arange(left, left + width)
    reach = max(abs(near[0] - at), abs(near[-1] - at)) + max(window - n, 0) // 2
    share = np.abs(near - at) / reach
    w = np.where(share <= 0.001, 1, np.where(share <= 0.999, (1 - share ** 3) ** 3, 0)) * trust[near]
    line = np.polyfit(near - at, y[near], 1, w=np.sqrt(w))
    return line[1]


@pytest.mark.parametrize("window", [7, 31, 75])
def test_loess_against_weighted_lines(window):
    rng = np.random.default_rng(7)
    y, trust = rng.standard_normal(60), rng.uniform(0.1, 1, 60)
    near = decomposition.neighbours(60, window, extend=True)
    got = decomposition.loess(y[None], near, trust[None])[0]
    assert np.allclose(got, [slow_loess(y, at, window, trust) for at in range(-1, 61)])


def test_stl_parts(daily):
    t = np.arange(24 * 14 + 5)
    season, trend = 10 * np.sin(2 * np.pi * t / 24), 0.05 * t
    y = 50 + trend + season + np.random.default_rng(8).normal(0, 0.1, len(t))
    y[100] += 80
    rows = decomposition.decompose(daily({1: y}, step=timedelta(hours=1)), 24).orderBy("ts").collect()
    got = {c: np.array([r[c] for r in rows]) for c in ("observed", "trend", "seasonal", "resid")}
    assert np.allclose(got["trend"] + got["seasonal"] + got["resid"], y) and np.allclose(got["observed"], y)
    assert np.abs(got["seasonal"] - season).max() < 0.8 and np.abs(got["trend"] - 50 - trend).max() < 0.8
    assert got["resid"][100] > 75
    with pytest.raises(ValueError):
        decomposition.stl(y[:40], 24)
