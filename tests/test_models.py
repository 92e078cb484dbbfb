"""Closed-form searches, unit-root test, given ARMA parameters, selection by rank, stores and runs that change at one instant."""

import math
import time
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.functions.ranking import pick_ranked
from gridpulse.operators import areas, arma, decomposition, distribution, experiments, regression, scoring, stationarity
from gridpulse.operators.preparation import Split
from gridpulse.plans import forecast
from gridpulse.sources import manifest, tables
from gridpulse.streaming import ingest

HOUR = timedelta(hours=1)
SPLIT = Split("2024-01-11", "2024-01-12")


def noisy(seed, n=288):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    for t in range(2, n):
        x[t] = 0.5 * x[t - 1] - 0.3 * x[t - 2] + rng.standard_normal()
    return 50 + 10 * np.sin(np.arange(n) * 2 * np.pi / 24) + x


# --- regression on cross products --------------------------------------------------------------

def test_sweep_solves_least_squares(spark):
    rng = np.random.default_rng(1)
    design, y = rng.normal(size=(60, 4)), rng.normal(size=60)
    every = np.column_stack([design, y])
    frame = spark.createDataFrame([((every.T @ every).ravel().tolist(),)], "m array<double>")
    row = frame.select(regression.swept("m", "5", "4").alias("s"), regression.swept("m", "5", "2").alias("two")).first()
    beta, sse, *_ = np.linalg.lstsq(design, y, rcond=None)
    got = np.array(row.s.a).reshape(5, 5)
    assert np.allclose(got[:4, 4], beta) and math.isclose(got[4, 4], sse[0]) and np.allclose(got[:4, :4], np.linalg.inv(design.T @ design))
    nested = [np.linalg.lstsq(design[:, :k], y, rcond=None)[1][0] for k in range(1, 5)]
    assert np.allclose(row.s.rss, nested) and np.allclose(row.two.rss, nested[:2]) and np.allclose(regression.nested_residuals(every.T @ every), nested)


def test_collinear_columns(spark):
    a, y = np.arange(10.0), np.arange(10.0) ** 2
    every = np.column_stack([np.ones(10), a, 2 * a, y])
    frame = spark.createDataFrame([((every.T @ every).ravel().tolist(),)], "m array<double>")
    row = frame.select(regression.swept("m", "4", "3").alias("skip"), regression.swept("m", "4", "3", skip_collinear=False).alias("fail")).first()
    assert math.isclose(row.skip.rss[1], row.skip.rss[2]) and np.allclose(regression.nested_residuals(every.T @ every), row.skip.rss) and all(map(math.isnan, row.fail.a)) and math.isnan(row.fail.rss[2])


@pytest.mark.parametrize("z", [-9.0, -3.0, -2.51, -2.5, -1.0, 0.0, 0.7, 2.49, 2.6, 8.0])
def test_normal_distribution(spark, z):
    got = spark.range(1).select(F.lit(z).alias("z")).select(F.expr(regression.normal_cdf("z")).alias("p")).first().p
    assert math.isclose(got, 0.5 * math.erfc(-z / math.sqrt(2)), rel_tol=1e-10)


# --- order search ------------------------------------------------------------------------------

def test_closed_form_equals_the_general_fit(daily):
    frame = daily({1: noisy(1), 2: noisy(2)}, step=HOUR)
    general = {(r.area_id, r.p): r for r in arma.fit_orders(frame, SPLIT, [(p, 0, 0) for p in (1, 2, 3)], 24).collect()}
    rows = arma.with_lags(frame, SPLIT, 3, 24)
    for r in arma.ar_fits(rows, (1, 2, 3)).collect():
        other = general[r.area_id, r.p]
        assert r.n_fit == other.n_fit and math.isclose(r.aic, other.aic, rel_tol=1e-10) and math.isclose(r.bic, other.bic, rel_tol=1e-10)
        assert np.allclose(r.coefficients, [other.intercept, *other.ar])


def test_failed_candidates_rank_last(daily):
    """A constant series has collinear lags; its candidates have no criteria and come last, whatever their area."""
    frame = daily({1: [3.0] * 288, 2: noisy(2)}, step=HOUR)
    table = experiments.ar_order_search(frame, SPLIT, period=24).collect()
    assert [r.area_id for r in table] == [2, 2, 2, 1, 1, 1] and all(math.isnan(r.AIC) and math.isnan(r.test_RMSE) for r in table[3:])
    assert [r.AIC for r in table[:3]] == sorted(r.AIC for r in table[:3]) and [r.order for r in table[3:]] == ["(1, 0, 0)", "(2, 0, 0)", "(3, 0, 0)"]
    with pytest.raises(ValueError):
        arma.ar_fits(frame, (0,))


def test_search_keeps_times_apart(daily):
    search = experiments.search_with_times(daily({1: noisy(1)}, step=HOUR), SPLIT, orders=((1, 0, 0), (1, 0, 1)), period=24)
    assert "train_time_s" not in search.ranked.columns and search.times.columns == ["area_id", "order", "train_time_s"]
    assert search.ranked.count() == search.times.count() == 2


def test_validation_search_leaves_the_test_week_alone(daily):
    x = noisy(1)
    changed = x.copy()
    changed[240:] += 1000
    tables_ = [experiments.ar_validation_search(daily({1: v, 2: noisy(2)}, step=HOUR), SPLIT, period=24).collect() for v in (x, changed)]
    assert tables_[0] == tables_[1] and [r.val_RMSE for r in tables_[0]] == sorted(r.val_RMSE for r in tables_[0]) and {r.n_val for r in tables_[0]} == {32}
    with pytest.raises(ValueError):
        experiments.ar_validation_search(daily({1: x}, step=HOUR), SPLIT, val_fraction=1.5)


# --- given parameters --------------------------------------------------------------------------

def test_fold_equals_the_recursion(daily, spark):
    frame = daily({1: noisy(1), 2: noisy(2)}, step=HOUR)
    c, ar, ma = 0.3, [0.5, -0.2], [0.4, 0.1, -0.2]
    parameters = spark.createDataFrame([(1, c, ar, ma), (2, 0.0, [], [])], "area_id int, intercept double, ar array<double>, ma array<double>")
    rows = arma.with_lags(frame, SPLIT, 1, 24)
    got = arma.one_step_errors(rows, parameters).orderBy("place").collect()
    w = np.array([r["diff"] for r in rows.where("area_id = 1").orderBy("place").collect()])
    errors = np.zeros(len(w))
    for t in range(2, len(w)):
        errors[t] = w[t] - c - sum(a * w[t - i] for i, a in enumerate(ar, 1)) - sum(m * errors[t - j] for j, m in enumerate(ma, 1) if t >= j)
    assert np.allclose([r.error for r in got if r.area_id == 1], errors[2:])
    assert all(math.isclose(r.error, r["diff"]) for r in got if r.area_id == 2)


def test_fold_gives_the_fitted_predictions(daily):
    frame = daily({1: noisy(1), 2: noisy(2)}, step=HOUR)
    fits = arma.fit_orders(frame, SPLIT, [(2, 0, 1)], 24)
    want = {(r.area_id, r.ts): r.y_pred for r in arma.predictions(fits).collect()}
    got = {(r.area_id, r.ts): r.y_pred for r in arma.given_predictions(frame, SPLIT, fits.select("area_id", "intercept", "ar", "ma"), 24).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)


def test_fit_gets_one_row_per_area(daily):
    """An area goes to Python as arrays; its rows are neither shuffled again nor sent one by one."""
    frame = daily({1: noisy(1), 2: noisy(2), None: noisy(3)}, step=HOUR)
    fits = arma.fit_orders(frame, SPLIT, [(1, 0, 0), (2, 0, 2)], 24)
    plan = fits._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    rows = fits.collect()
    assert sorted((r.area_id or 0, r.p) for r in rows) == [(a, p) for a in (0, 1, 2) for p in (1, 2)]
    assert all(len(r.ts) == len(r.y_true) == len(r.lagged) == len(r.step_ahead) == 48 and r.ts == sorted(r.ts) for r in rows)


@pytest.mark.parametrize("n", [1, 31, 32, 33, 64, 65, 1000])
@pytest.mark.parametrize("ma", [[0.5], [-0.9], [0.4, 0.3], [0.4, 0.1, -0.2]])
def test_filter_by_blocks_equals_the_recursion(n, ma):
    x = np.random.default_rng(n).normal(size=(3, n))
    want = x.copy()
    for t in range(n):
        for j, m in enumerate(ma, 1):
            if t >= j:
                want[:, t] -= m * want[:, t - j]
    assert np.allclose(arma._apply_inverse_ma(np.array(ma), x), want, rtol=1e-11, atol=1e-11)


@pytest.mark.parametrize("ma", [[0.99], [-1.0], [1.2], [0.4, 0.3], [1.9, 0.95], [-1.9, 0.95], [0.5, -0.6], [0.1, 1.01], [0.0, -1.1]])
def test_invertible_without_roots(ma):
    assert arma._invertible(np.array(ma)) == bool(np.all(np.abs(np.roots([1.0, *ma])) < 1.0))


def test_fold_takes_linear_time(spark):
    """A step that copies all errors before it takes minutes here."""
    rows = spark.range(60_000).select(
        F.lit(1).alias("area_id"), F.lit(None).cast("timestamp_ntz").alias("ts"), (F.col("id") + 1).alias("place"), F.lit(False).alias("is_test"),
        F.lit(0.0).alias("value"), F.lit(0.0).alias("lagged"), F.sin("id").alias("diff"))
    parameters = spark.createDataFrame([(1, 0.1, [0.4], [0.3, 0.1])], "area_id int, intercept double, ar array<double>, ma array<double>")
    begin = time.perf_counter()
    got = arma.one_step_errors(rows, parameters).agg(F.count("*"), F.sum("error")).first()
    assert got[0] == 59_999 and time.perf_counter() - begin < 40
    w = np.sin(np.arange(60_000))
    assert math.isclose(got[1], arma.innovations(w, 0.1, np.array([0.4]), np.array([0.3, 0.1])).sum(), rel_tol=1e-9)


# --- unit-root test ----------------------------------------------------------------------------

def test_fixed_lags_and_short_series(daily):
    x = np.cumsum(np.random.default_rng(3).standard_normal(120))
    for lag in (0, 1, 5):
        step = np.diff(x)
        y = step[lag:]
        design = np.column_stack([np.ones(len(y)), x[lag:-1], *[step[lag - j:-j] for j in range(1, lag + 1)]])
        beta, sse, *_ = np.linalg.lstsq(design, y, rcond=None)
        tau = beta[1] / math.sqrt(sse[0] / (len(y) - lag - 2) * np.linalg.inv(design.T @ design)[1, 1])
        got = stationarity.adf_test(daily({1: x}), lag=lag).first()
        assert (got.used_lag, got.n_obs) == (lag, len(y)) and math.isclose(got.adf_statistic, tau, rel_tol=1e-9)
        assert math.isclose(got.p_value, stationarity.p_value(tau), rel_tol=1e-8)
    for short in ([1.0], [1.0, 2.0], [1.0, 2.0, 4.0], [5.0] * 50):
        assert stationarity.adf_test(daily({1: short})).first().adf_statistic is None


# --- local regression --------------------------------------------------------------------------

@pytest.mark.parametrize("window", [2, 7, 8, 59, 60, 61, 90])
def test_strided_sums_equal_weighted_lines(window):
    rng = np.random.default_rng(window)
    y, trust = rng.normal(size=60), rng.uniform(0, 1, 60)
    near = decomposition.neighbours(60, window)
    for weights in (None, trust):
        got = decomposition.loess(y[None], near, None if weights is None else weights[None])[0]
        for at in range(60):
            width = min(window, 60)
            low = min(max(at - window // 2, 0), 60 - width)
            x = np.arange(low, low + width) - at
            reach = max(-x[0], x[-1]) + max(window - 60, 0) // 2
            share = np.abs(x) / max(reach, 1e-12)
            w = np.where(share <= 0.001, 1, np.where(share <= 0.999, (1 - share ** 3) ** 3, 0)) * (1 if weights is None else weights[low:low + width])
            if w.sum() == 0:
                want = y[at]
            else:
                mx, my = (w @ x) / w.sum(), (w @ y[low:low + width]) / w.sum()
                var = (w @ x ** 2) / w.sum() - mx ** 2
                want = my - (mx * ((w @ (x * y[low:low + width])) / w.sum() - mx * my) / var if var > (0.001 * 59) ** 2 else 0)
            assert math.isclose(got[at], want, rel_tol=1e-8, abs_tol=1e-8)


def test_smoothing_memory_is_linear():
    near = decomposition.neighbours(50_000, 401)
    assert near.weight.size <= 401 * 401 and near.weights.shape == (401,)


# --- selection by rank -------------------------------------------------------------------------

@pytest.mark.parametrize("few", [10, 10_000])
def test_selection_equals_sorting(spark, monkeypatch, few):
    monkeypatch.setattr("gridpulse.functions.ranking.FEW_ROWS", few)  # small tables take the way of large ones too
    shares = ((0, 1), (1, 3), (99, 100))
    for seed, values in enumerate(([2.0] * 5000, [float(i % 7) for i in range(4000)], np.random.default_rng(2).pareto(0.3, 5000).tolist(),
                                   [None] * 3 + [float("-inf"), 1e300] + [0.0] * 3000 + [float(i) for i in range(900)])):
        rows = [((i * 7919) % 100_003, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, "id int, v double")
        order = sorted(rows, key=lambda r: (-(r[1] if r[1] is not None else -math.inf), r[0]))
        assert pick_ranked(frame, "v", "id", shares) == [order[a * len(rows) // b][0] for a, b in shares], seed
    assert pick_ranked(spark.createDataFrame([], "id int, v double"), "v", "id", shares) == []


def test_targets_need_no_sort_of_all_areas(spark, monkeypatch):
    from gridpulse.functions import ranking
    from gridpulse.operators import series

    totals = areas.totals(spark.range(5000).selectExpr("CAST(id + 1 AS INT) AS area_id", "CAST(id % 37 AS DOUBLE) AS value"))

    def sorted_or_kept(*_):
        raise AssertionError("the totals are sorted or checkpointed")

    monkeypatch.setattr(ranking, "materialize", sorted_or_kept)
    monkeypatch.setattr(series, "materialize", sorted_or_kept)
    chosen = {r.label: r.area_id for r in areas.target_areas(totals, (3, 99_999)).collect()}
    want = sorted(range(1, 5001), key=lambda a: (-((a - 1) % 37), a))
    assert chosen == {"highest": want[0], "fixed_1": 3, "fixed_2": want[5000 // 3]}
    assert not totals.is_cached


def test_grid_is_planned_without_a_job(spark):
    frame = spark.createDataFrame([(1, 2.0), (7, 3.0)], "area_id int, total_traffic double")
    grid = distribution.spatial_grid(frame).orderBy("area_id").collect()
    assert [(r.area_id, r.grid_row, r.grid_col, r.total) for r in grid][6] == (7, 2, 0, 3.0) and len(grid) == 9
    assert distribution.spatial_grid(frame.where("area_id < 0")).count() == 0
    with pytest.raises(ValueError):
        distribution.spatial_grid(frame, 0)


# --- stores that change at one instant ---------------------------------------------------------

def cells(frame):
    return {(r.area_id, r.ts): round(r.value, 9) for r in frame.collect()}


def raw_day(folder, day):
    (folder / f"day{day}.txt").write_text("".join(
        f"{square}\t{1383260400000 + day * 86400000 + i * 600000}\t39\t\t\t\t\t{square + i / 10}\n" for square in (1, 2) for i in range(4)))


def test_compaction_keeps_the_sums(spark, tmp_path, monkeypatch):
    folder, store, checkpoint = tmp_path / "raw", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    folder.mkdir()
    assert not ingest.compact(spark, store, checkpoint)
    for day in range(6):
        raw_day(folder, day)
        ingest.ingest_new_files(spark, str(folder), store, checkpoint)
    before = cells(ingest.read_ingested(spark, store))
    files = len(ingest.read_ingested(spark, store).inputFiles())
    assert ingest.compact(spark, store, checkpoint) and not ingest.compact(spark, store, checkpoint)
    assert cells(ingest.read_ingested(spark, store)) == before and len(before) == 48
    assert len(ingest.read_ingested(spark, store).inputFiles()) < files  # the batches are not read any more
    # The last batch is replayed, as after a driver lost before it was noted: it is merged already, nothing doubles.
    commits = tmp_path / "checkpoint" / "commits"
    for note in (commits / "5", commits / ".5.crc"):
        note.unlink()
    ingest.ingest_new_files(spark, str(folder), store, checkpoint)
    assert (commits / "5").exists() and cells(ingest.read_ingested(spark, store)) == before
    # New batches go on beside the merged table, and a driver lost while merging them changes nothing.
    raw_day(folder, 6)
    ingest.ingest_new_files(spark, str(folder), store, checkpoint)
    after = cells(ingest.read_ingested(spark, store))
    assert len(after) == 56

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(manifest, "publish", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            ingest.compact(spark, store, checkpoint)
    assert cells(ingest.read_ingested(spark, store)) == after
    assert ingest.compact(spark, store, checkpoint) and cells(ingest.read_ingested(spark, store)) == after
    assert not [name for name in manifest.children(spark, store) if name.startswith("batch=") and name != "batch=6"]
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.ingest_new_files(spark, str(folder), store, str(tmp_path / "other"))


def test_unfinished_batches_are_not_read(spark, tmp_path):
    folder, store, checkpoint = tmp_path / "raw", tmp_path / "store", str(tmp_path / "checkpoint")
    folder.mkdir()
    raw_day(folder, 0)
    ingest.ingest_new_files(spark, str(folder), str(store), checkpoint)
    (store / "batch=1").mkdir()
    assert len(cells(ingest.read_ingested(spark, str(store)))) == 8
    with pytest.raises(FileNotFoundError):
        ingest.read_ingested(spark, str(tmp_path / "nothing"))


def test_a_manifest_version_is_taken_once(spark, tmp_path):
    manifest.publish(spark, str(tmp_path), 0, {"a": 1})
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.publish(spark, str(tmp_path), 0, {"a": 2})
    assert manifest.latest(spark, str(tmp_path)) == {"a": 1, "version": 0}


SUMMARY = "model string, MAE double, RMSE double, MAPE double, failed long"


def test_a_lost_driver_leaves_the_older_run_whole(spark, daily, tmp_path, monkeypatch):
    path = str(tmp_path / "run")
    with pytest.raises(FileNotFoundError):
        forecast.read_run(spark, path, "metric_summary", SUMMARY)
    run = forecast.forecast_run(daily({1: noisy(1)}, step=HOUR), SPLIT, (1, 0, 0), 24, {"lag24": 24})
    forecast.store_run(run, path)
    before = forecast.read_run(spark, path, "metric_summary", SUMMARY).collect()
    other = forecast.forecast_run(daily({1: noisy(5)}, step=HOUR), SPLIT, (1, 0, 0), 24, {"lag48": 48})
    write, written = tables.write_log, []

    def fails(table, name):
        if len(written) == 3:
            raise RuntimeError("driver lost")
        written.append(name)
        write(table, name)

    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_log", fails)
        with pytest.raises(RuntimeError, match="driver lost"):
            forecast.store_run(other, path)
    assert forecast.read_run(spark, path, "metric_summary", SUMMARY).collect() == before
    forecast.store_run(other, path)
    assert {r.model for r in forecast.read_run(spark, path, "metric_summary", SUMMARY).collect()} == {"SARIMA", "lag48"}
    forecast.store_run(run, path)
    assert len(manifest.children(spark, f"{path}/predictions")) == 2  # the newest run and the one before


def test_run_from_a_sample(spark, daily, tmp_path):
    frame = daily({3: noisy(3) + 100, 5: noisy(5)}, step=HOUR)
    wide = frame.groupBy("ts").pivot("area_id", [3, 5]).agg(F.first("value")).withColumnsRenamed({"3": "area_3", "5": "area_5"})
    tables.write_sample(wide, str(tmp_path / "sample"))
    scored = forecast.sample_run(spark, str(tmp_path / "sample"), (3, 5, 9), SPLIT, (1, 0, 0), 24, {"lag24": 24}).collect()
    assert sorted((r.label, r.area_id, r.model) for r in scored) == sorted(
        (label, area, model) for label, area in (("highest", 3), ("fixed_1", 3), ("fixed_2", 5)) for model in ("SARIMA", "lag24"))
    alone = scoring.evaluate(arma.predictions(arma.fit_orders(frame, SPLIT, [(1, 0, 0)], 24)), "area_id").collect()
    assert all(math.isclose(a.MAE, s.MAE, rel_tol=1e-9) for a in alone for s in scored if s.area_id == a.area_id and s.model == "SARIMA")
