"""Raw daily activity files: header-less tab-separated text with eight columns fixed by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gridpulse.functions.calendar import local_time

# Column order of the raw files.
RAW = T.StructType([
    T.StructField("square_id", T.IntegerType()),
    T.StructField("time_ms", T.LongType()),
    T.StructField("country_code", T.IntegerType()),
    T.StructField("sms_in", T.DoubleType()),
    T.StructField("sms_out", T.DoubleType()),
    T.StructField("call_in", T.DoubleType()),
    T.StructField("call_out", T.DoubleType()),
    T.StructField("internet", T.DoubleType()),
])
GLOB = "*.txt"


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length`` of every text file below the folder, by path; an error if there is none.

    Only file metadata is read, never the content.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", GLOB)
        .load(folder).select("path", "length")
    )
    if files.isEmpty():
        raise FileNotFoundError(f"no {GLOB} files below {folder}")
    return files.orderBy("path")


def total_bytes(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def source_of(path: Column, by: str = "file", root: str = "") -> Column:
    """What one day's delivery is called: the file, or its folder where a day comes as many part files.

    Cutting out the common ``root`` keeps the order and makes the key that travels with every cell short.
    """
    if by not in ("file", "folder"):
        raise ValueError("by must be 'file' or 'folder'")
    name = path if by == "file" else F.regexp_replace(path, "/[^/]*$", "")
    return F.replace(name, F.lit(root), F.lit("")) if root else name


def first_sources(files: DataFrame, count: int, by: str = "file") -> list[str]:
    """Paths of the first ``count`` deliveries in name order, for a trial run."""
    named = files.select(source_of(F.col("path"), by).alias("source")).distinct().orderBy("source").limit(count)
    return [r.source for r in named.collect()]


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """All eight columns; an empty field is NULL and a line that does not fit the schema fails the job."""
    return (
        spark.read.schema(RAW).option("sep", "\t").option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", GLOB).csv(list(paths))
    )


def activity(raw: DataFrame, offset_hours: int = 1, by: str = "file", root: str = "") -> DataFrame:
    """``area_id, ts, value, source``: the scan is pruned to three of the eight columns."""
    return raw.select(
        F.col("square_id").alias("area_id"),
        local_time("time_ms", offset_hours).alias("ts"),
        F.col("internet").alias("value"),
        source_of(F.col("_metadata.file_path"), by, root).alias("source"),
    )


# Bytes per row of the naive (8 x 8) and the pruned (2 + 8 + 4) layout, and the fixed index size.
NAIVE_ROW, PRUNED_ROW, INDEX_BYTES = 64, 14, 132


def volume_report(records: DataFrame) -> DataFrame:
    """Rows, columns and bytes before and after pruning and roll-up, from one aggregation."""
    from gridpulse.functions.scalars import human_bytes

    counted = records.groupBy("area_id", "ts").agg(F.count("*").alias("k")).agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("naive"), F.count("*").alias("optimised")
    )
    size = {
        "naive": F.col("naive") * NAIVE_ROW + INDEX_BYTES,
        "optimised": F.col("optimised") * PRUNED_ROW + INDEX_BYTES,
    }
    share = {name: size[name] * 100.0 / size["naive"] for name in size}
    variants = F.array(*[
        F.struct(F.lit(name).alias("variant"), F.col(name).alias("rows"), F.lit(columns).alias("columns"),
                 size[name].alias("memory_bytes"), human_bytes(size[name]).alias("memory_human"),
                 share[name].alias("pct_of_naive"), (F.lit(100.0) - share[name]).alias("reduction_pct"))
        for name, columns in (("naive", len(RAW)), ("optimised", 3))
    ])
    return counted.select(F.inline(variants))
