"""Whitening of embeddings by a covariance weighted with multiplicities.

Entries become whole numbers, identical vectors are grouped, and from there on every step works on distinct vectors: their counts (or
one each) are the weights of sums and of a centred covariance, each is projected once, and rows get their vector's result by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridpulse.llm.common import join_unique, stored
from gridpulse.session import ship_package

GRID = 64
SHIFT = 1_000_000
# Whole numbers up to here are exact as doubles; a vector with a larger one is not usable.
EXACT = 2**53


@dataclass
class Fit:
    """What the weighted fit list gives: its size, exact sums, eigenvalues (falling) and the components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        """Components with variance: eigenvalues above the rounding error of the largest."""
        if not len(self.values):
            return 0
        return int((self.values > len(self.sums) * np.finfo(float).eps * max(self.values[0], 0)).sum())


def usable(vector: str) -> Column:
    """The vector and all its entries are there, finite and small enough to be exact on the grid."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > float(EXACT // (2 * GRID))))
    return F.col(vector).isNotNull() & ~bad


def on_grid(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, x``: x holds ``floor(64 * c) + 1000000`` per entry as little-endian 64-bit numbers; vectors that cannot be used are gone.

    All vectors of a table need one length: the most frequent one counts (of equally frequent ones the longest), others are not usable.
    """
    kept = rows.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(usable("v"))
    best = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if best is None:
        return rows.sparkSession.createDataFrame([], kept.select("id").schema.add("x", "binary"))
    kept = kept.filter(F.size("v") == best["d"])
    ship_package(rows.sparkSession)
    kind = T.StructType([kept.schema["id"], T.StructField("x", T.BinaryType())])
    schema, width = to_arrow_schema(kind), int(best["d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            x = (np.floor(GRID * flat).astype(np.int64) + SHIFT).reshape(batch.num_rows, width)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(schema.field("id").type), pa.array([r.tobytes() for r in x], pa.binary())], schema=schema)

    return kept.mapInArrow(run, kind)


def _matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    """The rows of a column of packed vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _partials(distinct: DataFrame, rows: int, step: Callable[[pa.RecordBatch], np.ndarray], kind: str) -> list[list]:
    """The sum over all batches of ``step``, a matrix of ``rows`` rows: added up within a task, then over tasks by cell."""
    schema = to_arrow_schema(T._parse_datatype_string(f"row int, part array<{kind}>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = step(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), pa.array(total.tolist(), schema.field("part").type)], schema=schema)

    cells = distinct.mapInArrow(run, f"row int, part array<{kind}>").select("row", F.posexplode("part").alias("at", "value"))
    summed = cells.groupBy("row", "at").agg(F.sum("value").alias("value"))
    out = [[] for _ in range(rows)]
    for cell in sorted(summed.collect()):  # as many cells as the matrix has, whatever the number of rows
        out[cell["row"]].append(cell["value"])
    return out


LIMB = 1 << 31


def _sums(distinct: DataFrame, width: int) -> tuple[int, list[int]]:
    """The weights' sum and the weighted sums per dimension, exact: numbers are cut in limbs of 31 bits, which add up as longs per batch."""

    def step(batch: pa.RecordBatch) -> np.ndarray:
        w, x = np.asarray(batch.column("w")), _matrix(batch.column("x"), width)
        if int(w.astype(object).sum()) * (int(np.abs(x).max(initial=0)) + 1) >= 2**62:
            w, x = w.astype(object), x.astype(object)
        total = np.concatenate([[w.sum()], (x * w[:, None]).sum(0)]).astype(object)
        return np.array([total // LIMB // LIMB, total // LIMB % LIMB, total % LIMB], object)

    high, middle, low = _partials(distinct, 3, step, "decimal(38,0)")
    n, *sums = [(int(h) * LIMB + int(m)) * LIMB + int(s) for h, m, s in zip(high, middle, low)] or [0]
    return n, sums


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: as 64-bit numbers if they and the sum of their squares fit, else as Python's."""
    limit = max((n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)), 1)
    exact = x * np.int64(n) - np.array(sums, np.int64) if limit < 2**62 else x.astype(object) * n - np.array(sums, object)
    if exact.dtype != object and x.shape[1] * int(np.abs(exact).max(initial=0)) ** 2 >= 2**62:
        exact = exact.astype(object)
    return exact


def _covariance(distinct: DataFrame, width: int, centred: Callable[[pa.RecordBatch], np.ndarray], n: int) -> np.ndarray:
    """Weighted covariance of what ``centred`` gives per distinct vector: one matrix product per batch."""

    def step(batch: pa.RecordBatch) -> np.ndarray:
        z = centred(batch)
        return (z * np.asarray(batch.column("w"))[:, None]).T @ z

    total = np.array(_partials(distinct, width, step, "double"), float).reshape(-1, width)
    return (total + total.T) / (2 * n) if len(total) == width else np.zeros((width, width))


def fit(distinct: DataFrame, width: int) -> Fit:
    """Components of the fit list given by distinct vectors ``x`` (packed) and weights ``w``. The driver holds one width x width matrix."""
    n, sums = _sums(distinct, width)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _deviations(_matrix(batch.column("x"), width), n, sums).astype(float) / n

    cov = _covariance(distinct, width, centred, n) if width and n else np.zeros((width, width))
    values, vectors = np.linalg.eigh(cov) if width else (np.empty(0), np.empty((0, 0)))
    return Fit(n, sums, values[::-1].copy(), vectors[:, ::-1].copy(), float(np.trace(cov)))


def project(distinct: DataFrame, fitted: Fit, components: int) -> DataFrame:
    """``x, w, deviation, y``: each distinct vector whitened once; y holds the components with variance."""
    width, n, sums, rank = len(fitted.sums), fitted.n, fitted.sums, min(fitted.rank, components)
    scaled = fitted.vectors[:, :rank] / np.sqrt(fitted.values[:rank])
    kind = "x binary, w long, deviation decimal(38,0), y binary"
    schema = to_arrow_schema(T._parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = _deviations(_matrix(batch.column("x"), width), n, sums)
            squares = [int(s) for s in (exact * exact).sum(1)] if width else [0] * batch.num_rows
            y = (exact.astype(float) / n) @ scaled
            yield pa.RecordBatch.from_arrays([
                batch.column("x"), batch.column("w"), pa.array(squares, schema.field("deviation").type),
                pa.array([np.ascontiguousarray(r).tobytes() for r in y], pa.binary())], schema=schema)

    return distinct.mapInArrow(run, kind)


def identity_error(projected: DataFrame, rank: int, n: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; 0 without components."""
    if not rank:
        return 0.0

    def values(batch: pa.RecordBatch) -> np.ndarray:
        return _matrix(batch.column("y"), rank, np.float64)

    def total(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(batch.column("w"))[None, :].astype(float) @ values(batch)

    mean = np.array(_partials(projected, 1, total, "double")[0]) / n
    return float(np.abs(_covariance(projected, rank, lambda batch: values(batch) - mean, n) - np.eye(rank)).max())


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 32, counted: bool = True) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` per usable row and component, numbered from 1.

    x is ``floor(64 * c) + 1000000`` per entry. The fit list has each distinct x as often as it occurs (``counted``) or once. Its covariance
    has the divisor n and is centred before multiplying; components are its unit eigenvectors by falling eigenvalue. ``deviation`` is the sum
    of ``(n * x - S)^2``, exact. Nothing but sums over the dimensions reaches the driver; distinct vectors are stored in the shared folder.

    Null vectors and vectors with null, NaN, infinite or huge (over ``2**53 / 128``) entries or of another length than most give no rows; null ids and repeated
    rows are kept. A component without variance (constant or dependent dimensions, a single row) has null as ``whitened`` and does not
    count for ``identity_error``. Empty vectors and empty tables give no rows. Other columns are ignored, whatever their names.
    """
    grid = stored(on_grid(rows, id, vector), "grid")
    distinct = stored(grid.groupBy("x").agg(F.count("*").alias("copies")).withColumn("w", F.col("copies") if counted else F.lit(1).cast("long")), "distinct")
    some = grid.select(F.octet_length("x").alias("bytes")).first()
    width = some["bytes"] // 8 if some else 0
    fitted = fit(distinct, width)
    shown, rank = min(components, width), min(fitted.rank, components)
    projected = stored(project(distinct, fitted, components), "whitened")
    error = identity_error(projected, rank, fitted.n)
    each = join_unique(grid, projected.select("x", "deviation", "y"), ["x"], distinct.select("x", F.col("copies").alias("rows_of_key")))
    explained = [float(e / fitted.trace) if fitted.trace else 0.0 for e in fitted.values[:shown]]
    name = rows.schema[id].name
    kind = T._parse_datatype_string("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    kind = T.StructType([T.StructField(name, rows.schema[id].dataType), *kind])
    schema = to_arrow_schema(kind)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows_here = batch.num_rows
                y = np.full((rows_here, shown), np.nan)
                y[:, :rank] = _matrix(batch.column("y"), rank, np.float64) if rank else 0
                row = pa.array(np.repeat(np.arange(rows_here), shown))
                flat = y.ravel()
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(row).cast(schema.field(0).type),
                    pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), rows_here)),
                    pa.array(np.full(len(flat), fitted.n, np.int64)),
                    batch.column("deviation").take(row),
                    pa.array(flat, pa.float64(), mask=np.isnan(flat)),
                    pa.array(np.tile(np.array(explained), rows_here), pa.float64()),
                    pa.array(np.full(len(flat), error), pa.float64()),
                ], schema=schema)

    return each.select("id", "deviation", "y").mapInArrow(expand, kind)
