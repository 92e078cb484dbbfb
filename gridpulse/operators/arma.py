"""ARIMA on seasonally differenced series: differencing, lag restore and clipping in SQL, the fit per area.

A fit returns one row per area and order with its test points as arrays; ``predictions`` unfolds
them and undoes the differencing.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import mul
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridpulse.functions.scalars import clip_at_zero, order_text
from gridpulse.operators import regression
from gridpulse.operators.preparation import Split, split_rows
from gridpulse.operators.temporal import undo_seasonal_difference
from gridpulse.session import ship_package, spread

Order = tuple[int, int, int]

FITS = (
    "area_id int, p int, d int, q int, aic double, bic double, n_fit int, converged boolean, "
    "intercept double, ar array<double>, ma array<double>, "
    "train_time_s double, predict_time_s double, "
    "ts array<timestamp_ntz>, y_true array<double>, lagged array<double>, step_ahead array<double>"
)


class Fit(NamedTuple):
    intercept: float
    ar: np.ndarray
    ma: np.ndarray
    aic: float
    bic: float
    rows: int
    converged: bool


def _invertible(ma: np.ndarray) -> bool:
    if not np.isfinite(ma).all():
        return False
    if len(ma) == 1:
        return bool(abs(ma[0]) < 1.0)
    if len(ma) == 2:  # the triangle in which both roots are inside the unit circle
        return bool(abs(ma[1]) < 1.0 and abs(ma[0]) < 1.0 + ma[1])
    return bool(np.all(np.abs(np.roots([1.0, *ma])) < 1.0))


@lru_cache(maxsize=8)
def _places(size: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries of a block's matrix stand in ``size`` zeros and the response, and those of its carry in the padded weights."""
    at = np.arange(size)
    return np.subtract.outer(at, at) + size, np.add.outer(at, np.arange(q))


def _apply_inverse_ma(ma: np.ndarray, series: np.ndarray) -> np.ndarray:
    """Every row of ``series`` filtered by 1 / (1 + ma B + ...), a block of its values at a time.

    Within a block the filter is one triangular matrix; only the last few outputs pass from block to block, by doubling.
    """
    q, (width, n) = len(ma), series.shape
    if q == 0:
        return series
    size = max(32, q)
    weights, response = ma[::-1].tolist(), [0.0] * (q - 1) + [1.0]
    for k in range(size - 1):
        response.append(-sum(map(mul, weights, response[k:])))
    diagonals, carried = _places(size, q)
    inside = np.concatenate([np.zeros(size), response[q - 1:]])[diagonals]
    carry = inside @ np.concatenate([-ma, np.zeros(size + q)])[carried]
    count = -(-n // size)
    blocks = np.zeros((width, count * size))
    blocks[:, :n] = series
    out = (blocks.reshape(width * count, size) @ inside.T).reshape(width, count, size)
    last = size - 1 - np.arange(q)
    ends, step, reach = out[:, :, last], carry[last].T, 1
    while reach < count:
        ends[:, reach:] += ends[:, :-reach] @ step
        step, reach = step @ step, 2 * reach
    out[:, 1:] += ends[:, :-1] @ carry.T
    return out.reshape(width, count * size)[:, :n]


def _lags(x: np.ndarray, count: int, start: int) -> np.ndarray:
    return np.column_stack([x[start - i: len(x) - i] for i in range(1, count + 1)]) if count else np.empty((len(x) - start, 0))


def innovations(w: np.ndarray, intercept: float, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """One-step-ahead errors from row ``len(ar)`` on, taking earlier errors as 0."""
    p = len(ar)
    gap = w[p:] - intercept - _lags(w, p, p) @ ar
    return _apply_inverse_ma(ma, gap[None])[0]


def _start(w: np.ndarray, p: int, q: int) -> np.ndarray:
    """Hannan-Rissanen: errors of a long autoregression stand in for the unknown innovations."""
    if q == 0:
        design = np.column_stack([np.ones(len(w) - p), _lags(w, p, p)])
        return np.linalg.lstsq(design, w[p:], rcond=None)[0]
    long = min(max(p, q) + int(10 * np.log10(len(w))), len(w) // 4)
    design = np.column_stack([np.ones(len(w) - long), _lags(w, long, long)])
    errors = w[long:] - design @ np.linalg.lstsq(design, w[long:], rcond=None)[0]
    kept, first = w[long:], max(p, q)
    design = np.column_stack([np.ones(len(kept) - first), _lags(kept, p, first), _lags(errors, q, first)])
    beta = np.linalg.lstsq(design, kept[first:], rcond=None)[0]
    while not _invertible(beta[1 + p:]):
        beta[1 + p:] *= 0.8 ** np.arange(1, q + 1)
    return beta


def fit_arma(w: np.ndarray, p: int, q: int, maxiter: int = 50) -> Fit:
    """Conditional least squares by damped Gauss-Newton steps."""
    burn = max(p, q + 1)
    rows, k = len(w) - burn, p + q + 2
    if rows <= 2 * k + 10:
        raise ValueError("series too short for the order")
    beta = _start(w, p, q)

    def split(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        return b[0], b[1: 1 + p], b[1 + p:]

    slopes = np.zeros((1 + p + q, len(w) - p))
    slopes[0], slopes[1: 1 + p] = 1.0, _lags(w, p, p).T

    def loss(b: np.ndarray) -> tuple[float, np.ndarray | None]:
        if not _invertible(b[1 + p:]):
            return np.inf, None
        gap = w[p:] - b[0] - b[1: 1 + p] @ slopes[1: 1 + p]
        e = _apply_inverse_ma(b[1 + p:], gap[None])[0]
        return float(np.sum(e[burn - p:] ** 2)), e

    if not np.isfinite(beta).all():
        raise ValueError("no starting point")
    best, errors = loss(beta)
    damping, converged = 1e-3, q == 0
    for _ in range(0 if q == 0 else maxiter):
        for j in range(1, q + 1):
            slopes[p + j, j:] = errors[:-j]
        jac = _apply_inverse_ma(split(beta)[2], slopes)[:, burn - p:]
        gram, pull = jac @ jac.T, jac @ errors[burn - p:]
        scale = np.diag(np.maximum(np.diag(gram), 1e-12))
        gain = 0.0
        while damping < 1e10:
            step = np.linalg.solve(gram + damping * scale, pull)
            trial, trial_errors = loss(beta + step)
            if trial < best:
                gain, best, errors, beta = (best - trial) / best, trial, trial_errors, beta + step
                damping = max(damping / 10.0, 1e-12)
                break
            damping *= 10.0
        if gain < 1e-9:
            converged = True
            break
    variance = max(best / rows, np.finfo(float).tiny)
    deviance = rows * (np.log(2.0 * np.pi * variance) + 1.0)
    intercept, ar, ma = split(beta)
    return Fit(float(intercept), ar, ma, deviance + 2.0 * k, deviance + np.log(rows) * k, rows, converged)


def _with_history(series: DataFrame, split: Split, period: int, times: int, tail_rows: int | None) -> DataFrame:
    """Labelled rows with ``lagged`` and the seasonally differenced ``diff``, in training-then-test order."""
    if times not in (0, 1) or period < 1:
        raise ValueError("only 0 or 1 seasonal differences of a positive period are supported")
    if tail_rows is not None and tail_rows < 1:
        raise ValueError("tail_rows must be positive")
    rows = split_rows(series.where(F.col("value").isNotNull()), split)
    area = Window.partitionBy("area_id")
    order = area.orderBy(*split.order())
    if tail_rows is not None:
        back = F.row_number().over(Window.partitionBy("area_id", "is_test").orderBy(F.desc("ts")))
        rows = rows.withColumn("_back", back).where(F.col("is_test") | (F.col("_back") <= tail_rows)).drop("_back")
    lagged = F.lag("value", period).over(order) if times else F.lit(0.0)
    rows = rows.withColumn("lagged", lagged).withColumn("place", F.row_number().over(order))
    usable = F.when(
        F.col("is_test") & F.col("lagged").isNull(),
        F.raise_error(F.lit("series too short: no training rows one season before the test week")).cast("boolean"),
    ).otherwise(F.col("lagged").isNotNull())
    return rows.where(usable).withColumn("diff", F.col("value") - F.col("lagged"))


def fit_orders(series: DataFrame, split: Split, orders: Sequence[Order] = ((2, 0, 2),), period: int = 144,
               seasonal_diff: int = 1, tail_rows: int | None = None, maxiter: int = 50) -> DataFrame:
    """Fit every order to every area: one row per area, whose series is an array and sent once. A failed fit has NULL criteria.

    Seasonal AR and MA terms are not estimated. Fitting happens once; the test week is then
    predicted one step ahead with the fitted parameters and the actual past.
    """
    for _, d, _ in orders:
        if d < 0:
            raise ValueError("d must not be negative")
    ship_package(series.sparkSession)
    rows = _with_history(series, split, period, seasonal_diff, tail_rows)
    each = rows.groupBy("area_id").agg(F.sort_array(F.collect_list(F.struct("place", "diff", "is_test"))).alias("points"),
                                       F.sort_array(F.collect_list(F.when(F.col("is_test"), F.struct("place", "ts", "value", "lagged")))).alias("week"))
    areas = each.select("area_id", F.col("points.diff").alias("diff"), F.col("points.is_test").alias("is_test"), F.col("week.ts").alias("ts"),
                        F.col("week.value").alias("y_true"), F.col("week.lagged").alias("lagged"))

    def of_order(y: np.ndarray, test: np.ndarray, p: int, d: int, q: int) -> dict:
        ahead = np.full(test.sum(), np.nan)
        fit, begin = None, time.perf_counter()
        try:
            fit = fit_arma(np.diff(y[~test], d), p, q, maxiter)
            trained = time.perf_counter()
            errors = innovations(np.diff(y, d), fit.intercept, fit.ar, fit.ma)
            ahead = (y[d + p:] - errors)[test[d + p:]]
            predicted = time.perf_counter()
        except (ValueError, np.linalg.LinAlgError):
            trained = predicted = time.perf_counter()
        return {
            "p": p, "d": d, "q": q,
            "aic": fit.aic if fit else np.nan, "bic": fit.bic if fit else np.nan,
            "n_fit": fit.rows if fit else 0, "converged": bool(fit and fit.converged),
            "intercept": fit.intercept if fit else np.nan, "ar": list(fit.ar) if fit else None, "ma": list(fit.ma) if fit else None,
            "train_time_s": trained - begin if fit else np.nan,
            "predict_time_s": predicted - trained if fit else np.nan,
            "step_ahead": ahead,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fits = [of_order(y.values.to_numpy(zero_copy_only=False), test.values.to_numpy(zero_copy_only=False), *order)
                        for y, test in zip(part.column("diff"), part.column("is_test")) for order in orders]
                source = part.take(pa.array(np.repeat(np.arange(part.num_rows), len(orders))))
                yield pa.RecordBatch.from_arrays([
                    pa.array([fit[f.name] for fit in fits], f.type, from_pandas=True) if f.name in fits[0] else source.column(f.name) for f in kinds
                ], schema=kinds)

    orders = [tuple(order) for order in orders]
    kinds = to_arrow_schema(T._parse_datatype_string(FITS))
    return spread(areas, "area_id", per_core=4).mapInArrow(run, FITS)


def predictions(fits: DataFrame, seasonal_diff: int = 1, model: str = "SARIMA") -> DataFrame:
    """``area_id, model, order, ts, y_true, y_pred`` on the original scale, never negative; NaN where the fit failed."""
    points = fits.select(
        "area_id", F.col("aic").isNull().alias("failed"), order_text(F.col("p"), F.col("d"), F.col("q")).alias("order"),
        F.inline(F.arrays_zip("ts", "y_true", "lagged", "step_ahead")),
    )
    restored = undo_seasonal_difference(F.col("step_ahead"), F.col("lagged"), seasonal_diff)
    return points.select("area_id", F.lit(model).alias("model"), "order", "ts", "y_true",
                         F.when(F.col("failed"), F.lit(float("nan"))).otherwise(clip_at_zero(restored)).alias("y_pred"))


def _with_previous(series: DataFrame, split: Split, period: int) -> DataFrame:
    rows = _with_history(series, split, period, 1, None)
    previous = F.lag("diff").over(Window.partitionBy("area_id").orderBy("place"))
    return rows.withColumn("previous", previous)


def ar1_fits(series: DataFrame, split: Split, period: int = 144) -> DataFrame:
    """Order (1,0,0) without any Python: conditional least squares is a regression on the previous value."""
    train = _with_previous(series, split, period).where(~F.col("is_test") & F.col("previous").isNotNull())
    sxy = F.regr_sxy("diff", "previous")
    fit = train.groupBy("area_id").agg(
        F.count("*").alias("n_fit"), F.regr_slope("diff", "previous").alias("slope"),
        F.regr_intercept("diff", "previous").alias("intercept"),
        (F.regr_syy("diff", "previous") - F.try_divide(sxy * sxy, F.regr_sxx("diff", "previous"))).alias("sse"),
    )
    deviance = F.col("n_fit") * (F.log(F.lit(2.0 * np.pi) * F.col("sse") / F.col("n_fit")) + 1.0)
    return fit.select(
        "area_id", "n_fit", "slope", "intercept", (deviance + 6.0).alias("aic"),
        (deviance + 3.0 * F.log("n_fit")).alias("bic"),
    )


def ar1_predictions(series: DataFrame, split: Split, period: int = 144) -> DataFrame:
    """The test week of every area under order (1,0,0), in SQL only.

    The regression runs as a window over each area's training rows, so fit and prediction share one
    partitioning and the series is computed once.
    """
    whole = Window.partitionBy("area_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    known = F.when(~F.col("is_test"), F.col("diff"))
    fitted = _with_previous(series, split, period).select(
        "area_id", "ts", "value", "lagged", "previous", "is_test",
        F.regr_slope(known, F.col("previous")).over(whole).alias("slope"),
        F.regr_intercept(known, F.col("previous")).over(whole).alias("intercept"),
    )
    ahead = F.col("intercept") + F.col("slope") * F.col("previous") + F.col("lagged")
    return fitted.where("is_test").select(
        "area_id", F.lit("SARIMA").alias("model"), "ts", F.col("value").alias("y_true"),
        clip_at_zero(ahead).alias("y_pred"),
    )


# Above so many lags the cross products of one area are too many columns for one aggregate.
MAX_CLOSED_ORDER = 8
NOT_A_NUMBER = float("nan")


def with_lags(series: DataFrame, split: Split, lags: int, period: int, seasonal_diff: int = 1, tail_rows: int | None = None) -> DataFrame:
    """Labelled, seasonally differenced rows with ``before``: the ``lags`` differences before each row, latest first (NULL before the first)."""
    rows = _with_history(series, split, period, seasonal_diff, tail_rows)
    order = Window.partitionBy("area_id").orderBy("place")
    return rows.withColumn("before", F.array(*[F.lag("diff", i).over(order) for i in range(1, lags + 1)]))


def ar_fits(rows: DataFrame, orders: Sequence[int]) -> DataFrame:
    """Autoregressions (p,0,0) of all ``orders`` at once: ``area_id, p, n_fit, failed, coefficients, sse, aic, bic``.

    ``rows`` as from :func:`with_lags`. Conditional least squares without moving-average terms is a regression, so the cross products of all
    lags are one aggregate per area and the coefficients (intercept first) come from sweeps on arrays; no Python. A candidate with too few
    rows or with collinear lags (a constant series) fails: its criteria are NaN.
    """
    if not orders or min(orders) < 1 or max(orders) > MAX_CLOSED_ORDER:
        raise ValueError(f"orders must be between 1 and {MAX_CLOSED_ORDER}")
    lags = [F.col("before")[i] for i in range(max(orders))]

    def products(p: int) -> Column:
        used = ~F.col("is_test") & lags[p - 1].isNotNull()
        columns = [F.lit(1.0), *lags[:p], F.col("diff")]
        return F.struct(F.lit(p).alias("p"), F.count_if(used).alias("n_fit"), regression.cross_products(columns, used).alias("products"))

    each = rows.groupBy("area_id").agg(F.array(*[products(p) for p in orders]).alias("candidates")).select("area_id", F.inline("candidates"))
    solved = each.withColumn("solved", regression.swept("products", "(p + 2)", "(p + 1)", skip_collinear=False))
    sse = F.col("solved.a")[(F.col("p") + 2) * (F.col("p") + 2) - 1]
    too_few = F.col("n_fit") <= 2 * (F.col("p") + 2) + 10
    out = solved.select("area_id", "p", "n_fit", regression.coefficients("solved.a", "(p + 2)", "(p + 1)").alias("coefficients"), sse.alias("sse"),
                        (too_few | F.isnan(sse)).alias("failed"))
    parameters = F.col("p") + 2
    deviance = F.col("n_fit") * (F.log(F.lit(2.0 * np.pi) * F.greatest("sse", F.lit(np.finfo(float).tiny)) / F.col("n_fit")) + 1.0)
    return out.select(
        "area_id", "p", "n_fit", "failed", "coefficients", "sse",
        F.when(F.col("failed"), F.lit(NOT_A_NUMBER)).otherwise(deviance + 2.0 * parameters).alias("aic"),
        F.when(F.col("failed"), F.lit(NOT_A_NUMBER)).otherwise(deviance + F.log("n_fit") * parameters).alias("bic"))


def ar_predictions(rows: DataFrame, fits: DataFrame, seasonal_diff: int = 1, model: str = "SARIMA") -> DataFrame:
    """The test week under every fitted autoregression: ``area_id, model, order, ts, y_true, y_pred``; NaN where the fit failed."""
    ahead = F.expr("aggregate(sequence(1, p), coefficients[0], (s, i) -> s + coefficients[i] * before[i - 1])")
    restored = clip_at_zero(undo_seasonal_difference(ahead, F.col("lagged"), seasonal_diff))
    return rows.where("is_test").join(fits, "area_id").select(
        "area_id", F.lit(model).alias("model"), order_text(F.col("p"), F.lit(0), F.lit(0)).alias("order"), "ts", F.col("value").alias("y_true"),
        F.when(F.col("failed"), F.lit(NOT_A_NUMBER)).otherwise(restored).alias("y_pred"))


# Errors that one array grows by before the fold begins the next.
FOLD_ROWS = 32


def one_step_errors(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """``area_id, ts, place, is_test, value, lagged, diff, error``: innovations of an ARMA model with given parameters, without Python.

    ``rows`` as from :func:`with_lags` (any number of lags), ``parameters`` one row per area: ``area_id, intercept, ar, ma`` (arrays). An error
    is what the model, knowing all values and errors before, does not foresee; errors before the first foreseeable row count as 0. Errors
    depend on one another in time order, so an area's rows become one ordered array (its length is set by the calendar) and a fold. The fold grows
    an array of ``FOLD_ROWS`` errors at a time and hands on the latest ``len(ma)``, so that a step does not copy all errors before it.
    """
    whole = rows.groupBy("area_id").agg(F.sort_array(F.collect_list(
        F.struct("place", "ts", "is_test", "value", "lagged", "diff"))).alias("points"))
    step = """if(t < size(ar), null, x.w[t] - intercept
        - aggregate(x.back, 0D, (s, i) -> s + ar[i - 1] * x.w[t - i])
        - aggregate(x.behind, 0D, (s, j) -> s + if(t < j, 0D, ma[j - 1] * coalesce(e[size(e) - j], 0D))))"""
    block = f"aggregate(sequence({FOLD_ROWS} * b, least({FOLD_ROWS} * (b + 1), size(x.w)) - 1), f.latest, (e, t) -> concat(e, array({step})))"
    fold = f"""transform(array(named_struct('w', points.diff, 'back', if(size(ar) > 0, sequence(1, size(ar)), array()),
            'behind', if(size(ma) > 0, sequence(1, size(ma)), array()))), x -> aggregate(sequence(0, (size(x.w) - 1) div {FOLD_ROWS}),
        named_struct('blocks', cast(array() as array<array<double>>), 'latest', cast(array() as array<double>)),
        (f, b) -> transform(array({block}), e -> named_struct('blocks', concat(f.blocks, array(slice(e, size(f.latest) + 1, {FOLD_ROWS}))),
            'latest', slice(e, greatest(size(e) - size(ma), 0) + 1, size(ma))))[0], f -> flatten(f.blocks)))[0]"""
    known = whole.join(parameters.hint("shuffle_hash"), "area_id").withColumn("errors", F.expr(fold))
    return known.select("area_id", F.inline(F.arrays_zip("points", "errors"))).select("area_id", "points.*", F.col("errors").alias("error")).select(
        "area_id", "ts", "place", "is_test", "value", "lagged", "diff", "error").where(F.col("error").isNotNull())


def given_predictions(series: DataFrame, split: Split, parameters: DataFrame, period: int = 144, seasonal_diff: int = 1,
                      model: str = "SARIMA") -> DataFrame:
    """The test week one step ahead under given parameters (:func:`one_step_errors`): ``area_id, model, ts, y_true, y_pred``."""
    errors = one_step_errors(_with_history(series, split, period, seasonal_diff, None), parameters).where("is_test")
    restored = undo_seasonal_difference(F.col("diff") - F.col("error"), F.col("lagged"), seasonal_diff)
    return errors.select("area_id", F.lit(model).alias("model"), "ts", F.col("value").alias("y_true"), clip_at_zero(restored).alias("y_pred"))
