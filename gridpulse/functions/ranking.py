"""Exact global ranks and percentiles that never sort everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def rank_rows(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``rank`` (0-based place in the total order) and ``n`` (row count).

    A range sort spreads the rows, each task numbers its own slice, and the slice sizes (one
    row per task) become the offsets. End the order with a unique column so that long ties
    split over tasks too. The sorted rows are materialised once, because a second evaluation
    could draw other range bounds.
    """
    placed = materialize(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    placed = placed.select(
        *df.columns,
        F.shiftright("_row", _ROW_BITS).alias("_slice"),
        F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    )
    before = placed.groupBy("_slice").agg(F.count("*").alias("_size")).select(
        "_slice",
        F.expr("sum(_size) OVER (ORDER BY _slice) - _size").alias("_before"),
        F.expr("sum(_size) OVER ()").alias("n"),
    )
    return (
        placed.join(F.broadcast(before), "_slice")  # one row per sort task
        .select(*df.columns, (F.col("_before") + F.col("_place")).alias("rank"), "n")
    )


def percentile_of_ranked(value: str, p: float) -> Column:
    """Aggregate over ``rank_rows`` output sorted ascending by ``value``: linearly interpolated percentile."""
    place = F.lit(p) * (F.col("n") - 1)
    below = F.max(F.when(F.col("rank") == F.floor(place), F.col(value)))
    above = F.max(F.when(F.col("rank") == F.ceil(place), F.col(value)))
    return below + (above - below) * F.max(place - F.floor(place))


# Ranks from a quantile sketch are off by at most 1/ACCURACY of the rows; pivots are taken so far to both sides of the wanted rank.
ACCURACY, MARGIN = 10_000, 0.001
# So many rows or fewer are counted by value and brought to the driver.
FEW_ROWS = 10_000


def kth(rows: DataFrame, column: str, rank: int) -> tuple[object, int]:
    """The value at ``rank`` (from 0) of a column without nulls, smallest first, and the rank among its equals.

    A selection, not a sort: each round takes three values near the rank from a quantile sketch, counts the rows below, at and between them, and
    goes on with the rows between the two that enclose the rank, about a five-hundredth of those before. Every round is two aggregates
    with partial sums; the driver gets a handful of numbers, and at the end the counts of at most ``FEW_ROWS`` values.
    """
    x = F.col(column)
    size = rows.count()
    while size > FEW_ROWS:
        share = rank / size
        reach = [max(share - MARGIN, 0.0), share, min(share + MARGIN, 1.0)]
        pivots = sorted(set(rows.agg(F.percentile_approx(x, reach, ACCURACY)).first()[0]))
        below = rows.agg(*[F.count_if(x < p) for p in pivots], *[F.count_if(x <= p) for p in pivots]).first()
        less, upto = below[:len(pivots)], below[len(pivots):]
        for p, low, high in zip(pivots, less, upto):
            if low <= rank < high:
                return p, rank - low
        under = [i for i in range(len(pivots)) if upto[i] <= rank]
        over = [i for i in range(len(pivots)) if less[i] > rank]
        first, end = (upto[under[-1]] if under else 0), (less[over[0]] if over else size)
        rows = rows.where((x > pivots[under[-1]] if under else F.lit(True)) & (x < pivots[over[0]] if over else F.lit(True)))
        rank, size = rank - first, end - first
    for row in sorted(rows.groupBy(x.alias("x")).agg(F.count("*").alias("n")).collect()):
        if rank < row["n"]:
            return row["x"], rank
        rank -= row["n"]
    raise IndexError("the rank lies outside the rows")


def pick_ranked(df: DataFrame, value: str, id: str, shares: Sequence[tuple[int, int]]) -> list:
    """The ids at rank ``num * n // den`` by falling ``value``, then rising ``id``, one per ``(num, den)`` below 1; none without rows.

    Two selections each, first by value and then among the ids that have it. Nulls rank last; values are finite or null. ``df`` is read
    several times: persist it.
    """
    rows = df.select((-F.coalesce(F.col(value).cast("double"), F.lit(float("-inf")))).alias("v"), F.col(id).alias("id"))
    n, found = rows.count(), []
    for num, den in shares if n else ():
        top, place = kth(rows, "v", num * n // den)
        found.append(kth(rows.where(F.col("v") == F.lit(top)), "id", place)[0])
    return found
