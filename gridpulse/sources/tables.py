"""Stored results: the dense matrix, totals, targets, sample series and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridpulse.functions.scalars import id_from_label
from gridpulse.operators.areas import totals


def write_matrix(series: DataFrame, path: str) -> None:
    """Snappy Parquet by day. Rebalancing sizes the files at run time: a large day is split, small days share a task."""
    by_day = series.withColumn("day", F.to_date("ts")).hint("rebalance", "day")
    by_day.sortWithinPartitions("day", "area_id", "ts").write.mode("overwrite").option(
        "compression", "snappy"
    ).partitionBy("day").parquet(path)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table written earlier; says what to do if it is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"{path} not found: run the consolidation first") from error


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """The dense series; filters on ``day`` prune folders, filters on ``area_id`` prune row groups."""
    return read_stored(spark, path).select("area_id", "ts", "value", "day")


def write_totals(area_totals: DataFrame, path: str) -> None:
    area_totals.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_targets(targets: DataFrame, path: str) -> None:
    targets.write.mode("overwrite").json(path)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("label string, area_id int").json(path)


def write_sample(wide: DataFrame, path: str) -> None:
    """``ts, area_<id>, …`` as CSV with a header."""
    wide.withColumnRenamed("ts", "timestamp").write.mode("overwrite").option("header", "true").csv(path)


def read_sample(spark: SparkSession, path: str, fixed: Sequence[int]) -> DataFrame:
    """``label, area_id, ts, value`` from the wide sample: the busiest column, then the fixed ids it has."""
    wide = spark.read.option("header", "true").csv(path)
    time, *areas = wide.columns
    long = wide.unpivot([time], areas, "series", "value").select(
        id_from_label(F.col("series")).alias("area_id"),
        F.col(time).cast("timestamp_ntz").alias("ts"),
        F.col("value").cast("double").alias("value"),
    )
    # One total per column of a file that holds a handful of columns.
    top = totals(long).orderBy(F.desc("total_traffic"), "area_id").limit(1).first()
    if top is None:
        raise ValueError(f"the sample at {path} has no rows")
    have = {f"area_{a}" for a in fixed} & set(areas)
    labels = [("highest", top.area_id), *[
        (f"fixed_{i}", a) for i, a in enumerate([a for a in fixed if f"area_{a}" in have], start=1)
    ]]
    labelled = spark.createDataFrame(labels, "label string, area_id int")
    return long.join(F.broadcast(labelled), "area_id").select("label", "area_id", "ts", "value")


def write_report(table: DataFrame, path: str, digits: int = 4) -> None:
    """A result table as CSV with a header; floating point columns get a fixed number of decimals and
    stay empty where undefined."""

    def shown(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind not in ("double", "float"):
            return column
        text = F.format_string(f"%.{digits}f", F.bround(column.cast("double"), digits))
        return F.when(column.isNotNull() & ~F.isnan(column), text).alias(name)

    columns = [shown(f.name, f.dataType.typeName()) for f in table.schema]
    table.select(*columns).write.mode("overwrite").option("header", "true").csv(path)


def write_log(table: DataFrame, path: str) -> None:
    """An experiment log as CSV with a header, at full precision."""
    table.write.mode("overwrite").option("header", "true").csv(path)


def read_report(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)
