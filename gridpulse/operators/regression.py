"""Least squares from cross products: one symmetric matrix per group as a flat array, solved by sweeps on arrays.

The matrix holds ``sum(x_i * x_j)`` of the regressors and, last, of the response. Sweeping the regressors one after another leaves
coefficients, the inverse and, after each step, the residual sum of the nested model with the regressors so far.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, functions as F

# A pivot below this share of its regressor's sum of squares adds nothing to those before it and is passed over.
COLLINEAR = 1e-10


def cross_products(columns: Sequence[Column], where: Column) -> Column:
    """Aggregate: the flat matrix of all cross products over the rows that meet the condition."""
    size = len(columns)
    sums = {(i, j): F.sum(F.when(where, columns[i] * columns[j])) for i in range(size) for j in range(i, size)}
    return F.array(*[F.coalesce(sums[min(i, j), max(i, j)], F.lit(0.0)) for i in range(size) for j in range(size)])


def _expression(text: str, **names: str) -> Column:
    for name, value in names.items():
        text = text.replace(f"${name}", value)
    return F.expr(text)


def swept(matrix: str, size: str, pivots: str, skip_collinear: bool = True) -> Column:
    """``a, rss`` of the flat matrix after its first ``pivots`` rows were swept (SQL expressions; size is the number of its rows).

    ``rss`` holds the residual sum of squares after each pivot. Collinear regressors get coefficient 0; with ``skip_collinear`` off
    they make everything NaN, which marks a failed fit.
    """
    singular = "s.a" if skip_collinear else "transform(s.a, v -> double('NaN'))"
    rss = "s.a[$size * $size - 1]" if skip_collinear else "double('NaN')"
    d, free = "s.a[k * $size + k]", f"s.a[k * $size + k] > {COLLINEAR}D * $matrix[k * $size + k]"
    return _expression(f"""
        aggregate(if($pivots > 0, sequence(0, $pivots - 1), array()), named_struct('a', $matrix, 'rss', cast(array() as array<double>)),
        (s, k) -> named_struct(
            'a', if({free}, transform(s.a, (v, x) ->
                if(x div $size = k, if(x % $size = k, 1 / {d}, v / {d}),
                if(x % $size = k, -v / {d}, v - s.a[int((x div $size) * $size + k)] * s.a[k * $size + x % $size] / {d}))), {singular}),
            'rss', concat(s.rss, array(if({free}, s.a[$size * $size - 1]
                - s.a[($size - 1) * $size + k] * s.a[k * $size + $size - 1] / {d}, {rss})))))""", matrix=matrix, size=size, pivots=pivots)


def nested_residuals(products: np.ndarray) -> np.ndarray:
    """Residual sums of the nested models with one regressor, two, ... to all, from the matrix of cross products (the response last).

    One elimination over the largest model's matrix gives all of them; collinear regressors change nothing.
    """
    left, own, out = products.copy(), np.diag(products).copy(), []
    for k in range(len(products) - 1):
        if left[k, k] > COLLINEAR * own[k]:
            left[k + 1:, k + 1:] -= np.outer(left[k + 1:, k], left[k, k + 1:]) / left[k, k]
        out.append(left[-1, -1])
    return np.array(out)


def coefficients(swept_matrix: str, size: str, pivots: str) -> Column:
    """The coefficients of the first ``pivots`` regressors (at least one) of a swept matrix."""
    return _expression("transform(sequence(0, $pivots - 1), k -> $a[k * $size + $size - 1])", a=swept_matrix, size=size, pivots=pivots)


def normal_cdf(z: str) -> str:
    """SQL: the standard normal distribution function of a name. A power series inside, the continued fraction of Mills' ratio in the tails."""
    bell = f"exp(-0.5D * {z} * {z}) / sqrt(2 * pi())"
    tail = f"{bell} / aggregate(sequence(120, 1, -1), abs({z}), (f, k) -> abs({z}) + k / f)"
    series = (f"0.5D + {bell} * aggregate(sequence(1, 80), named_struct('t', {z}, 's', {z}), "
              f"(a, k) -> named_struct('t', a.t * {z} * {z} / (2 * k + 1), 's', a.s + a.t * {z} * {z} / (2 * k + 1)), a -> a.s)")
    return f"(case when {z} < -2.5D then {tail} when {z} > 2.5D then 1 - {tail} else {series} end)"
