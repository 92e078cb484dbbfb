"""Autocorrelation and partial autocorrelation per area, with confidence bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from gridpulse.operators.series import by_time, whole_series
from gridpulse.session import ship_package

MAX_LAG_COLUMNS = 24  # wider projections of lag columns cost more than a grouped map
NORMAL_975 = 1.959963984540054  # fixed value: 97.5 % point of the standard normal


def _acf_by_lag_columns(series: DataFrame, lags: int) -> DataFrame:
    centred = series.select(
        "area_id", "ts", (F.col("value") - F.avg("value").over(whole_series())).alias("x")
    )
    shifted = centred.select(
        "area_id", "x", *[F.lag("x", k).over(by_time()).alias(f"x{k}") for k in range(1, lags + 1)]
    )
    total = F.sum(F.col("x") * F.col("x"))
    sums = shifted.groupBy("area_id").agg(
        F.count("x").alias("n"), F.array(total, *[F.sum(F.col("x") * F.col(f"x{k}")) for k in range(1, lags + 1)]).alias("c")
    )
    return sums.select("area_id", "n", F.expr("transform(c, v -> try_divide(v, c[0]))").alias("acf"))


def autocorrelations(x: np.ndarray, lags: int) -> np.ndarray:
    """Biased autocorrelations of lags 0..lags through the power spectrum."""
    centred = x - x.mean()
    size = 1 << (2 * len(x) - 1).bit_length()
    power = np.abs(np.fft.rfft(centred, size)) ** 2
    cov = np.fft.irfft(power, size)[: lags + 1]
    cov[0] = centred @ centred
    return cov / cov[0] if cov[0] > 0 else np.full(lags + 1, np.nan)


def acf_arrays(series: DataFrame, lags: int) -> DataFrame:
    """``area_id, n, acf`` with the autocorrelations of lags 0..lags in one array."""
    values = series.where(F.col("value").isNotNull())
    if lags <= MAX_LAG_COLUMNS:
        return _acf_by_lag_columns(values, lags)
    ship_package(series.sparkSession)

    def of_area(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows.sort_values("ts")["value"].to_numpy()
        r = np.full(lags + 1, np.nan)
        top = min(lags, len(x) - 1)
        r[: top + 1] = autocorrelations(x, top)
        return pd.DataFrame({"area_id": rows["area_id"].iloc[:1].to_numpy(), "n": [len(x)], "acf": [r]})

    columns = values.select("area_id", "ts", "value")
    return columns.groupBy("area_id").applyInPandas(of_area, "area_id int, n long, acf array<double>")


def acf(series: DataFrame, lags: int = 288) -> DataFrame:
    """``area_id, lag, acf, band``: the band is Bartlett's half-width around 0 at 95 %."""
    rows = acf_arrays(series, lags).select("area_id", "n", F.posexplode("acf").alias("lag", "acf"))
    before = Window.partitionBy("area_id").orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(before), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        F.lit(NORMAL_975) * F.sqrt((F.lit(1.0) + F.lit(2.0) * earlier) / F.col("n"))
    )
    return rows.select("area_id", "lag", "acf", band.alias("band"))


def partial_from_acf(r: np.ndarray) -> np.ndarray:
    """Durbin-Levinson recursion on all rows of ``r`` (areas x lags) at once."""
    areas, width = r.shape
    out = np.full((areas, width), np.nan)
    out[:, 0] = 1.0
    phi = np.zeros((areas, width))
    with np.errstate(invalid="ignore", divide="ignore"):
        for k in range(1, width):
            held = phi[:, 1:k]
            top = r[:, k] - np.einsum("ij,ij->i", held, r[:, k - 1:0:-1])
            bottom = 1.0 - np.einsum("ij,ij->i", held, r[:, 1:k])
            last = top / bottom
            phi[:, 1:k] = held - last[:, None] * held[:, ::-1]
            phi[:, k] = last
            out[:, k] = last
    return out


def pacf(series: DataFrame, lags: int = 60) -> DataFrame:
    """``area_id, lag, pacf, band`` from the Yule-Walker equations."""
    arrays = acf_arrays(series, lags)
    ship_package(series.sparkSession)

    @F.pandas_udf("array<double>")
    def levinson(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            r = np.array([np.asarray(a, dtype=float) for a in batch])
            yield pd.Series(list(partial_from_acf(r))) if len(batch) else pd.Series([], dtype=object)

    rows = arrays.select("area_id", "n", F.posexplode(levinson("acf")).alias("lag", "pacf"))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(NORMAL_975) / F.sqrt("n"))
    return rows.select("area_id", "lag", "pacf", band.alias("band"))
