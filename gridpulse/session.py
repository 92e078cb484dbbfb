"""Session defaults, shared scratch folder and the two ways of cutting lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side is broadcast up to this size; anything larger is left to the planner.
BROADCAST_MAX_BYTES = 32 << 20
# What a Python worker gets at once, so that long texts do not fill its memory.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))


def build_session(app: str = "gridpulse", master: str | None = None, partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; all of them can be overridden."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes when nothing reads it any more
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` is not: its executors have folders of their own)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the cluster names none this is an error; only a local session gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = getattr(spark, "_gridpulse_dir", None) or tempfile.mkdtemp(prefix="gridpulse-")
        spark._gridpulse_dir = configured
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls get the same one. All of an application's go when it ends."""
    root = f"{shared_dir(spark).rstrip('/')}/gridpulse/{spark.sparkContext.applicationId}"
    if getattr(spark.sparkContext, "_gridpulse_scratch", None) != root:
        spark.sparkContext._gridpulse_scratch = root
        atexit.register(_remove, spark, root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    """Deletes a scratch folder, through the file system that Spark uses, if the session still runs."""
    if spark.sparkContext._jsc is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in reliable storage, so that losing an executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast only after measuring ``df`` (call it on materialised data); else leave the join to the planner."""
    wide = [F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    size = df.agg(sum(wide, F.count("*") * (16 * len(df.columns)))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_MAX_BYTES else df


def spread(df: DataFrame, *keys: str, per_core: int | None = None) -> DataFrame:
    """Hash partitions by ``keys`` in a number that adaptive execution leaves alone.

    Adaptive execution merges partitions by their bytes. It cannot know that rows are about to
    multiply or that a model fit takes a second, so the number is set here: the configured shuffle
    partitions, or with ``per_core`` at least that many per core, so that uneven groups balance.
    """
    spark = df.sparkSession
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if per_core:
        number = max(number, per_core * spark.sparkContext.defaultParallelism)
    return df.repartition(number, *keys)


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per session (same effect as ``--py-files``).

    Also bounds the bytes of a batch for them, unless the cluster says how many.
    """
    if not spark.sparkContext.getConf().contains(ARROW_BYTES[0]):
        spark.conf.set(*ARROW_BYTES)
    if getattr(spark.sparkContext, "_gridpulse_shipped", False):
        return
    root = Path(__file__).resolve().parent
    bundle = shutil.make_archive(f"{tempfile.mkdtemp(prefix='gridpulse-zip-')}/gridpulse", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(bundle)
    spark.sparkContext._gridpulse_shipped = True
