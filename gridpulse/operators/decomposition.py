"""Robust seasonal-trend decomposition by LOESS (Cleveland et al., 1990), one group per area."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gridpulse.session import ship_package, spread

RESULT = "area_id int, ts timestamp_ntz, observed double, trend double, seasonal double, resid double"


class Neighbours(NamedTuple):
    """LOESS geometry: one weight row for all points with a whole window around them, full rows for those near an end."""

    inner: slice
    offsets: np.ndarray
    weights: np.ndarray
    outer: np.ndarray
    index: np.ndarray
    offset: np.ndarray
    weight: np.ndarray
    nearest: np.ndarray
    flat: float


def _tricube(distance: np.ndarray, reach: np.ndarray | float) -> np.ndarray:
    share = distance / np.maximum(reach, 1e-12)
    return np.where(share <= 0.001, 1.0, np.where(share <= 0.999, (1.0 - share ** 3) ** 3, 0.0))


def neighbours(n: int, window: int, extend: bool = False) -> Neighbours:
    """LOESS geometry on the points 0..n-1, evaluated there and, with ``extend``, one step beyond each end.

    Points are numbered as they are evaluated: with ``extend`` point 0 is the step before the series. Memory does not grow with
    ``n x window``: only the points near an end, at most as many as the window is wide, have rows of their own.
    """
    at = np.arange(-1, n + 1) if extend else np.arange(n)
    width, half = min(window, n), window // 2
    first, last = half, n - width + half  # the first and last point whose window is not pushed inwards
    whole = (at >= first) & (at <= last) & (window <= n)
    places = np.flatnonzero(whole)
    inner = slice(places[0], places[-1] + 1) if len(places) else slice(0, 0)
    offsets = np.arange(width, dtype=float) - half
    outer = np.flatnonzero(~whole)
    left = np.clip(at[outer] - half, 0, n - width)
    index = left[:, None] + np.arange(width)
    offset = (index - at[outer][:, None]).astype(float)
    distance = np.abs(offset)
    reach = distance[:, [0, -1]].max(axis=1, keepdims=True) + max(window - n, 0) // 2
    return Neighbours(inner, offsets, _tricube(np.abs(offsets), np.abs(offsets[[0, -1]]).max()), outer, index, offset, _tricube(distance, reach),
                      np.clip(at, 0, n - 1), 0.001 * (n - 1))


def _line(mass, first, second, level, cross, flat, fallback):  # noqa: ANN001, ANN202 - arrays of one shape
    """The weighted line's value at offset 0, from the weighted sums; ``fallback`` where nothing has weight."""
    known = mass > 0
    mass = np.where(known, mass, 1.0)
    centre, level = first / mass, level / mass
    spread = second / mass - centre ** 2
    tilted = spread > flat ** 2
    slope = np.where(tilted, (cross / mass - centre * level) / np.where(tilted, spread, 1.0), 0.0)
    return np.where(known, level - slope * centre, fallback)


def loess(y: np.ndarray, near: Neighbours, trust: np.ndarray | None = None) -> np.ndarray:
    """Local straight-line fit of every row of ``y`` (rows x points); ``trust`` holds robustness weights.

    Inside, every weighted sum is one product of a strided view of the series with the weight row, so no window is ever copied.
    """
    out = np.empty((len(y), len(near.nearest)))
    trusted = np.ones_like(y) if trust is None else trust
    if near.inner.stop > near.inner.start:
        width = len(near.weights)
        seen, mass = (np.lib.stride_tricks.sliding_window_view(a, width, axis=1) for a in (trusted * y, trusted))
        by_offset = near.weights * near.offsets
        out[:, near.inner] = _line(
            mass @ near.weights, mass @ by_offset, mass @ (by_offset * near.offsets), seen @ near.weights, seen @ by_offset,
            near.flat, y[:, near.nearest[near.inner]])
    if len(near.outer):
        weight = near.weight * trusted[:, near.index]
        seen, by_offset = y[:, near.index], weight * near.offset
        out[:, near.outer] = _line(
            weight.sum(axis=2), by_offset.sum(axis=2), (by_offset * near.offset).sum(axis=2), (weight * seen).sum(axis=2),
            (by_offset * seen).sum(axis=2), near.flat, y[:, near.nearest[near.outer]])
    return out


def _moving_average(x: np.ndarray, width: int) -> np.ndarray:
    total = np.cumsum(np.concatenate([[0.0], x]))
    return (total[width:] - total[:-width]) / width


def _next_odd(x: float) -> int:
    up = int(np.ceil(x))
    return up + (up % 2 == 0)


def stl(y: np.ndarray, period: int, seasonal: int = 7, robust: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal component; the remainder is what is left."""
    n = len(y)
    if n < 2 * period:
        raise ValueError(f"{n} values are fewer than two periods of {period}")
    inner, outer = (2, 15) if robust else (5, 0)
    trend_near = neighbours(n, _next_odd(1.5 * period / (1.0 - 1.5 / seasonal)))
    low_near = neighbours(n, _next_odd(period + 1))
    # Phases of the cycle fall into at most two groups of equal length.
    phases = [np.arange(p, n, period) for p in range(period)]
    groups = [np.array([p for p in phases if len(p) == m]) for m in sorted({len(p) for p in phases})]
    cycle_near = [neighbours(g.shape[1], seasonal, extend=True) for g in groups]

    trend, trust = np.zeros(n), None
    cycle, season = np.zeros(n + 2 * period), np.zeros(n)
    for _ in range(outer + 1):
        for _ in range(inner):
            detrended = y - trend
            for places, near in zip(groups, cycle_near):
                smooth = loess(detrended[places], near, None if trust is None else trust[places])
                wide = places[:, :1] + period * np.arange(places.shape[1] + 2)
                cycle[wide] = smooth
            low = _moving_average(_moving_average(_moving_average(cycle, period), period), 3)
            season = cycle[period: period + n] - loess(low[None], low_near)[0]
            trend = loess((y - season)[None], trend_near, None if trust is None else trust[None])[0]
        far = np.abs(y - season - trend)
        cut = 6.0 * np.median(far)
        share = far / cut if cut > 0 else np.zeros(n)
        trust = np.where(share <= 0.001, 1.0, np.where(share <= 0.999, (1.0 - share ** 2) ** 2, 0.0))
    return trend, season


def decompose(series: DataFrame, period: int = 144, seasonal: int = 7, robust: bool = True) -> DataFrame:
    """Observed, trend, seasonal and residual beside every ``(area_id, ts)``.

    A group is one area's rolled-up series. The job fails for a series shorter than two periods.
    """
    if period < 2 or seasonal < 3 or seasonal % 2 == 0:
        raise ValueError("period must be at least 2, and the seasonal window odd and at least 3")
    ship_package(series.sparkSession)

    def of_area(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ts")
        y = rows["value"].to_numpy()
        trend, season = stl(y, period, seasonal, robust)
        return pd.DataFrame({
            "area_id": rows["area_id"], "ts": rows["ts"], "observed": y,
            "trend": trend, "seasonal": season, "resid": y - trend - season,
        })

    clean = series.where(F.col("value").isNotNull()).select("area_id", "ts", "value")
    return spread(clean, "area_id", per_core=4).groupBy("area_id").applyInPandas(of_area, RESULT)


def smooth(series: DataFrame, window: int) -> DataFrame:
    """``area_id, ts, smooth``: one LOESS pass (straight lines, tricube weights) over every area's series; the building block of :func:`decompose`."""
    if window < 2:
        raise ValueError("a window has at least two points")
    ship_package(series.sparkSession)

    def of_area(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ts")
        y = rows["value"].to_numpy()
        return pd.DataFrame({"area_id": rows["area_id"], "ts": rows["ts"], "smooth": loess(y[None], neighbours(len(y), window))[0]})

    clean = series.where(F.col("value").isNotNull()).select("area_id", "ts", "value")
    return spread(clean, "area_id", per_core=4).groupBy("area_id").applyInPandas(of_area, "area_id int, ts timestamp_ntz, smooth double")
