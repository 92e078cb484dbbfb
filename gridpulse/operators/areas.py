"""Area totals, ranking and the choice of target areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from gridpulse.functions.calendar import within_dates
from gridpulse.functions.ranking import pick_ranked, rank_rows
from gridpulse.functions.scalars import no_activity_as_zero

SUBSTITUTE_SHARES = ((1, 3), (2, 3))  # fixed values: a third and two thirds down the ranking


def totals(series: DataFrame) -> DataFrame:
    return series.groupBy("area_id").agg(F.sum("value").alias("total_traffic"))


def totals_of_records(records: DataFrame, study: tuple[str, str] | None = None) -> DataFrame:
    """The totals of the dense series without building it: filled cells add nothing.

    Areas seen only outside the study window stay with total 0. One pass, combined on the map side.
    """
    value = no_activity_as_zero(F.col("value"))
    if study:
        value = F.when(within_dates(F.col("ts"), *study), value).otherwise(F.lit(0.0))
    return records.groupBy("area_id").agg(F.sum(value).alias("total_traffic"))


def by_total(area_totals: DataFrame) -> DataFrame:
    """Areas from busiest to quietest; ties by lowest id."""
    return area_totals.orderBy(F.desc("total_traffic"), "area_id")


def ranked_by_total(area_totals: DataFrame) -> DataFrame:
    """``by_total`` with the 0-based ``rank`` and the number of areas ``n``."""
    return rank_rows(area_totals, F.desc("total_traffic"), F.asc("area_id"))


def busiest(area_totals: DataFrame) -> DataFrame:
    return by_total(area_totals).limit(1)


def substitutes(area_totals: DataFrame) -> DataFrame:
    """The areas a third and two thirds down the ranking, as ``pick`` 0 and 1, selected without sorting all areas."""
    kept = area_totals.persist()
    try:
        picked = pick_ranked(kept, "total_traffic", "area_id", SUBSTITUTE_SHARES)
    finally:
        kept.unpersist()
    return area_totals.sparkSession.createDataFrame(list(enumerate(picked)), T.StructType([
        T.StructField("pick", T.IntegerType()), area_totals.schema["area_id"]]))


def present(area_totals: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(area_totals.select("area_id"), "area_id", "left_semi")


def absent(area_totals: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(area_totals.select("area_id"), "area_id", "left_anti")


def target_areas(area_totals: DataFrame, fixed: Sequence[int]) -> DataFrame:
    """``label, area_id`` for the busiest area and the fixed ids.

    A fixed id that is not in the data is replaced by the first substitute no label uses yet, then
    by the best-ranked unused area; an error if the grid is too small. The best few are a bounded heap per task, substitutes are
    selected by rank: nothing sorts all areas, and only a handful of ids reach the driver.
    """
    # The totals are needed a few times while choosing; a lost executor's part of them is computed again.
    kept = area_totals.persist()
    try:
        top = [r.area_id for r in by_total(kept).limit(len(fixed) + 3).collect()]
        known = {r.area_id for r in kept.where(F.col("area_id").isin(list(fixed))).select("area_id").collect()}
        in_turn = (pick_ranked(kept, "total_traffic", "area_id", SUBSTITUTE_SHARES) if known != set(fixed) else []) + top
    finally:
        kept.unpersist()
    if not top:
        raise ValueError("there are no areas to choose from")
    chosen = [("highest", top[0])]
    for i, area in enumerate(fixed, start=1):
        if area not in known:
            taken = {a for _, a in chosen}
            area = next((a for a in in_turn if a not in taken), None)
            if area is None:
                raise ValueError(f"no unused area is left to stand in for fixed_{i}")
        chosen.append((f"fixed_{i}", area))
    return area_totals.sparkSession.createDataFrame(chosen, "label string, area_id int")
