"""Distribution of per-area totals: summary statistics, histograms, density curves, spatial grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.functions.ranking import percentile_of_ranked, rank_rows
from gridpulse.functions.scalars import is_finite


def summary(area_totals: DataFrame) -> DataFrame:
    """``metric, value`` rows: moments in one pass, exact median and 95th percentile from global ranks."""
    finite = area_totals.where(is_finite(F.col("total_traffic")))
    ranked = rank_rows(finite, F.asc("total_traffic"), F.asc("area_id"))
    x = F.col("total_traffic")
    row = ranked.agg(
        F.count(x).cast("double").alias("n_areas"),
        F.avg(x).alias("mean"),
        percentile_of_ranked("total_traffic", 0.5).alias("median"),
        F.stddev_pop(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.skewness(x).alias("skewness"),
        F.kurtosis(x).alias("kurtosis"),
        percentile_of_ranked("total_traffic", 0.95).alias("p95"),
    )
    row = row.withColumn("p95 / median ratio", F.col("p95") / F.greatest("median", F.lit(1e-9))).drop("p95")
    return row.unpivot([], row.columns, "metric", "value")


def _bounds(values: DataFrame) -> Column:
    """Scalar (lo, hi) of column x, widened when all values are equal."""
    same = F.min("x") == F.max("x")
    return values.agg(F.struct(
        F.when(same, F.min("x") - 0.5).otherwise(F.min("x")).alias("lo"),
        F.when(same, F.max("x") + 0.5).otherwise(F.max("x")).alias("hi"),
    ).alias("bounds")).scalar()


def histogram(area_totals: DataFrame, bins: int = 80, log_scale: bool = False) -> DataFrame:
    """``bin, lo, hi, count`` with equal bins, the last one closed; empty bins are present.

    On the log scale the bins are equal in log10 over the positive totals, and edges are given in
    the original unit.
    """
    x = F.col("total_traffic")
    values = area_totals.where(is_finite(x))
    values = values.where(x > 0).select(F.log10(x).alias("x")) if log_scale else values.select(x.alias("x"))
    bounds = _bounds(values)
    lo, hi = bounds["lo"], bounds["hi"]
    place = F.floor(F.lit(bins) * (F.col("x") - lo) / (hi - lo)) + 1
    counts = values.select(F.least(place, F.lit(bins)).cast("int").alias("bin")).groupBy("bin").agg(
        F.count("*").alias("count")
    )
    step = F.lit(1.0) / F.lit(float(bins))
    edges = area_totals.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edge = [lo + (hi - lo) * (F.col("bin") - k) * step for k in (1, 0)]
    if log_scale:
        edge = [F.pow(F.lit(10.0), e) for e in edge]
    return edges.join(counts, "bin", "left").select(
        "bin", edge[0].alias("lo"), edge[1].alias("hi"), F.coalesce("count", F.lit(0)).alias("count")
    )


# exp(-u*u/2) is exactly 0.0 in double precision beyond this many bandwidths.
_KERNEL_REACH = 39.0


def density(area_totals: DataFrame, points: int = 200, log_scale: bool = False, bins: int = 80) -> DataFrame:
    """``point, x, density, expected_count``: Gaussian kernel density over the data range, bandwidth by Scott's rule.

    ``expected_count`` is the density on the scale of a histogram with ``bins`` bins; on the log
    scale both refer to log10.

    Every total contributes only to grid points its kernel can reach, and the sums per point are
    combined on the map side, so the shuffle carries ``points`` rows per task. Without spread the
    density is NULL.
    """
    x = F.col("total_traffic")
    values = area_totals.where(is_finite(x))
    values = values.where(x > 0).select(F.log10(x).alias("x")) if log_scale else values.select(x.alias("x"))
    frame = values.agg(F.struct(
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
        F.count("*").cast("double").alias("n"),
        (F.stddev_samp("x") * F.pow(F.count("*").cast("double"), F.lit(-0.2))).alias("h"),
    ).alias("frame")).scalar()
    step = (frame["hi"] - frame["lo"]) / F.lit(points - 1)
    reach = F.lit(_KERNEL_REACH) * frame["h"]
    offset = F.col("x") - frame["lo"]
    first = F.greatest(F.ceil((offset - reach) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((offset + reach) / step), F.lit(points - 1)).cast("int")
    spread = values.where(frame["h"] > 0).select("x", F.explode(F.sequence(first, last)).alias("point"))
    u = (frame["lo"] + F.col("point") * step - F.col("x")) / frame["h"]
    sums = spread.groupBy("point").agg(F.sum(F.exp(F.lit(-0.5) * u * u)).alias("mass"))
    grid = area_totals.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    norm = frame["n"] * frame["h"] * F.lit(2.5066282746310002)  # sqrt(2 pi)
    at = frame["lo"] + F.col("point") * step
    share = F.try_divide(F.coalesce("mass", F.lit(0.0)), norm)
    return grid.join(sums, "point", "left").select(
        "point",
        (F.pow(F.lit(10.0), at) if log_scale else at).alias("x"),
        share.alias("density"),
        (share * frame["n"] * (frame["hi"] - frame["lo"]) / F.lit(bins)).alias("expected_count"),
    )


def grid_side(area_totals: DataFrame) -> DataFrame:
    """``side`` of the smallest square grid that holds the largest id, one row; null without areas."""
    return area_totals.agg(F.ceil(F.sqrt(F.max("area_id").cast("double"))).cast("int").alias("side"))


def spatial_grid(area_totals: DataFrame, side: int | None = None) -> DataFrame:
    """Row-major square grid from id 1: absent cells hold 0, other ids are dropped. Without totals and ``side`` the grid is empty.

    A side that is not given is an aggregate of the same plan; nothing is computed while planning. Grid rows are generated first and
    spread, so a large grid's cells come from many tasks.
    """
    if side is not None and side < 1:
        raise ValueError("a grid has a positive side")
    spark = area_totals.sparkSession
    extent = grid_side(area_totals) if side is None else spark.range(1).select(F.lit(side).alias("side"))
    rows = extent.where("side >= 1").select("side", F.explode(F.sequence(F.lit(0), F.col("side") - 1)).alias("grid_row"))
    cells = rows.repartition("grid_row").select("side", "grid_row", F.explode(F.sequence(F.lit(0), F.col("side") - 1)).alias("grid_col"))
    cells = cells.withColumn("area_id", F.col("grid_row") * F.col("side") + F.col("grid_col") + 1)
    total = F.coalesce("total_traffic", F.lit(0.0))
    return cells.join(area_totals, "area_id", "left").select(
        "area_id", "grid_row", "grid_col", total.alias("total"), F.log1p(total).alias("log1p_total"))
