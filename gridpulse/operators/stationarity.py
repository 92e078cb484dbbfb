"""Augmented Dickey-Fuller test with constant, lag order chosen by AIC: cross products per area, all else as expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.functions.scalars import area_label
from gridpulse.operators import regression
from gridpulse.operators.series import by_time
from gridpulse.session import ship_package, spread

# MacKinnon (2010) response surfaces for the constant-only case, powers of 1/T from 0 to 3.
CRITICAL_SURFACE = {
    "crit_1%": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5%": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10%": (-2.56677, -1.5384, -2.809, 0.0),
}
# MacKinnon (1994) p-value polynomials for the constant-only case, powers from 0, and their ranges.
TAU_MIN, TAU_SPLIT, TAU_MAX = -18.83, -1.61, 2.74
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)

# What the test needs of a series: its length, the largest lag, the first values, the cross products of the largest model and the
# residual sums of all smaller ones.
PRODUCTS = "area_id int, series string, n int, top int, head array<double>, products array<double>, rss array<double>"


def p_value(tau: float) -> float:
    if tau >= TAU_MAX:
        return 1.0
    if tau <= TAU_MIN:
        return 0.0
    powers = SMALL_P if tau <= TAU_SPLIT else LARGE_P
    z = sum(c * tau ** i for i, c in enumerate(powers))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def largest_lag(n: int) -> int:
    """The most lags that are tried on ``n`` values."""
    return min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25))


def lagged_products(series: DataFrame, lag: int | None = None) -> DataFrame:
    """Cross products of the regression with the most lags (or with ``lag``), one row per area.

    Regressors are a constant, the level and the lagged differences, the response is the difference. The level is centred, which the
    constant takes up again. No products for a constant series or one too short. A group is one area's series: as long as the calendar.
    """
    ship_package(series.sparkSession)

    def of_area(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows.sort_values("ts")["value"].to_numpy()
        n, top, products, rss = len(x), largest_lag(len(x)) if lag is None else lag, None, None
        x = x - x.mean()
        if 0 <= top < n - 1 and np.ptp(x) > 0:
            step = np.diff(x)
            design = np.column_stack([np.ones(len(step) - top), x[top:-1], *[step[top - j: len(step) - j] for j in range(1, top + 1)], step[top:]])
            products = design.T @ design
            rss = regression.nested_residuals(products)[1:]
        return pd.DataFrame([{
            "area_id": rows["area_id"].iloc[0], "series": rows["series"].iloc[0], "n": n, "top": max(top, 0),
            "head": x[:max(top, 0) + 1], "products": None if products is None else products.ravel(), "rss": rss,
        }])

    clean = series.where(F.col("value").isNotNull()).select(
        "area_id", "ts", "value", area_label(F.col("area_id")).alias("series")
    )
    return spread(clean, "area_id", per_core=4).groupBy("area_id").applyInPandas(of_area, PRODUCTS)


def _variable(i: str) -> str:
    """SQL: variable i (constant, level, lagged differences, the difference) of the model with ``used_lag`` lags in row t, from the head."""
    back = f"if({i} = used_lag + 2, 0, {i} - 1)"
    return f"(case {i} when 0 then 1D when 1 then head[t] else head[t - {back} + 1] - head[t - {back}] end)"


def adf_test(series: DataFrame, lag: int | None = None) -> DataFrame:
    """One row per area; a constant series has no statistic (NULL). The lag order is the one with the smallest AIC, or ``lag``.

    The models of all lag orders are nested, so one elimination over the cross products of the largest gives the residual sums of all of them. The
    chosen model is then fitted on all rows it can use: those that the largest one lacks are added to its cross products.
    """
    known = lagged_products(series, lag).withColumn("usable", F.col("products").isNotNull() & (F.col("n") - 1 - F.col("top") > 0))
    if lag is None:
        nested = known.withColumn("aic", F.when(F.col("usable"), F.expr(f"""transform(rss, (r, i) ->
            (n - 1 - top) * ln(greatest(r, {np.finfo(float).tiny}D) / (n - 1 - top)) + 2 * (i + 2))""")))
        chosen = nested.withColumn("used_lag", F.coalesce(F.expr("int(array_position(aic, array_min(aic)) - 1)"), F.lit(0)))
    else:
        chosen = known.withColumn("used_lag", F.lit(lag))
    # Cell x of the chosen model's matrix: the same cell of the largest one's, and the rows before its first.
    row, at = "(x div (used_lag + 3))", "(x % (used_lag + 3))"
    first, second = (f"if({i} = used_lag + 2, top + 2, {i})" for i in (row, at))
    own = F.expr(f"""transform(sequence(0, (used_lag + 3) * (used_lag + 3) - 1), x -> products[int({first} * (top + 3) + {second})]
        + aggregate(if(used_lag < top, sequence(used_lag, top - 1), array()), 0D, (s, t) -> s + {_variable(row)} * {_variable(at)}))""")
    fitted = chosen.withColumn("n_obs", F.expr("greatest(n - 1 - used_lag, 0)")).withColumn("own", F.when(F.col("usable"), own)).withColumn(
        "fit", regression.swept("own", "(used_lag + 3)", "(used_lag + 2)")["a"])
    # Its coefficient of the level over the standard error.
    noise = "fit[size(fit) - 1] / (n_obs - used_lag - 2) * fit[used_lag + 4]"
    tested = fitted.withColumn("adf_statistic", F.expr(
        f"if(n_obs > used_lag + 2 and {noise} > 0, fit[2 * used_lag + 5] / sqrt({noise}), null)")).withColumn("p_value", _p_of("adf_statistic"))
    critical = [sum((F.try_divide(F.lit(c), F.pow("n_obs", F.lit(i))) for i, c in enumerate(powers)), F.lit(0.0)).alias(name)
                for name, powers in CRITICAL_SURFACE.items()]
    return tested.select("area_id", "series", "adf_statistic", "p_value", "used_lag", "n_obs", *critical,
                         F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("stationary_at_5%"))


def _p_of(tau: str) -> Column:
    """:func:`p_value` of a column, as an expression."""

    def z(powers: tuple[float, ...]) -> str:
        return " + ".join(f"{c}D * pow({tau}, {i})" for i, c in enumerate(powers))

    inside = f"case when {tau} <= {TAU_SPLIT}D then {z(SMALL_P)} else {z(LARGE_P)} end"
    return F.expr(f"""case when {tau} >= {TAU_MAX}D then 1D when {tau} <= {TAU_MIN}D then 0D
        when {tau} is not null then transform(array({inside}), z -> {regression.normal_cdf("z")})[0] end""")


def dickey_fuller_lag0(series: DataFrame) -> DataFrame:
    """The unaugmented test (lag 0) in plain SQL: slope and standard error from regression aggregates."""
    pairs = series.where(F.col("value").isNotNull()).select(
        "area_id", F.lag("value").over(by_time()).alias("x"),
        (F.col("value") - F.lag("value").over(by_time())).alias("y"),
    ).where(F.col("x").isNotNull())
    fit = pairs.groupBy("area_id").agg(
        F.count("*").alias("n_obs"), F.regr_slope("y", "x").alias("slope"),
        F.regr_sxx("y", "x").alias("sxx"), F.regr_syy("y", "x").alias("syy"), F.regr_sxy("y", "x").alias("sxy"),
    )
    noise = (F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")) / (F.col("n_obs") - 2)
    return fit.where((F.col("sxx") > 0) & (F.col("n_obs") > 2)).select(
        "area_id", "n_obs", F.try_divide(F.col("slope"), F.sqrt(noise / F.col("sxx"))).alias("adf_statistic")
    )
