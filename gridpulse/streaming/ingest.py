"""Incremental ingest: every new raw file is pruned, rolled up and appended exactly once; merged batches keep reading cheap.

A store holds ``batch=<id>`` folders of partial sums and, once compacted, ``_merged/version=<v>``: all batches up to an id in one
table. A manifest names the version and that id. It appears at one instant, so readers see the batches or what they were merged
into, never both, and a batch that is replayed after it was merged changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from gridpulse.operators.series import rollup
from gridpulse.sources import manifest, raw
from gridpulse.sources.tables import read_stored

KEYS = ("area_id", "ts", "source")


def _stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a checkpoint gives its stream; None before the first run."""
    if not manifest.exists(spark, f"{checkpoint}/metadata"):
        return None
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def ingest_new_files(spark: SparkSession, folder: str, store: str, checkpoint: str, offset_hours: int = 1,
                     by: str = "file", files_per_batch: int = 1000) -> None:
    """Process the files that arrived since the last call, then stop.

    Each micro-batch writes partial sums below its own batch id and overwrites them when it is
    replayed, so a lost driver or executor leaves neither gaps nor duplicates. No watermark holds
    the newest interval back: a later batch may add to any cell, and the reader adds the parts up.
    A compacted store goes on with the checkpoint it was filled from; another one would count its batches anew, which is an error.
    """
    merged = manifest.latest(spark, store)
    if merged and merged["stream"] != _stream_id(spark, checkpoint):
        raise ValueError(f"{store} was compacted under another checkpoint than {checkpoint}")
    stream = (
        spark.readStream.schema(raw.RAW).option("sep", "\t").option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", raw.GLOB)
        .option("maxFilesPerTrigger", files_per_batch).csv(folder)
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        rollup(batch, *KEYS).write.mode("overwrite").parquet(f"{store}/batch={batch_id}")

    query = (
        raw.activity(stream, offset_hours, by, folder).writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _batches(spark: SparkSession, store: str, after: int) -> list[int]:
    """Ids of the finished batches that are not merged yet."""
    ids = (int(name.removeprefix("batch=")) for name in manifest.children(spark, store) if name.startswith("batch="))
    return [i for i in sorted(ids) if i > after and manifest.exists(spark, f"{store}/batch={i}/_SUCCESS")]


def _parts(spark: SparkSession, store: str) -> tuple[DataFrame | None, dict | None, list[int]]:
    """What is merged, with its manifest, and the ids of the batches beside it."""
    now = manifest.latest(spark, store)
    waiting = _batches(spark, store, now["through"] if now else -1)
    frames = [f"{store}/_merged/version={now['version']}"] if now else []
    parts = [read_stored(spark, path) for path in frames]
    if waiting:
        parts.append(spark.read.parquet(*[f"{store}/batch={i}" for i in waiting]).select(*KEYS, "value"))
    whole = None
    for part in parts:
        whole = part if whole is None else whole.unionByName(part)
    return whole, now, waiting


def compact(spark: SparkSession, store: str, checkpoint: str) -> bool:
    """Merges all finished batches into one table; False if there is nothing new.

    The table is written under the next version's name, then the manifest appears. A driver lost before that leaves the old state and a
    folder that the next attempt overwrites. What the version before had merged is removed only now, so readers of either version
    find their files.
    """
    whole, now, waiting = _parts(spark, store)
    if not waiting:
        return False
    version, through = (now["version"] + 1 if now else 0), waiting[-1]
    path = f"{store}/_merged/version={version}"
    rollup(whole, *KEYS).write.mode("overwrite").parquet(path)
    manifest.publish(spark, store, version, {"through": through, "stream": _stream_id(spark, checkpoint)})
    if now:
        for name in manifest.children(spark, store):
            if name.startswith("batch=") and int(name.removeprefix("batch=")) <= now["through"]:
                manifest.remove(spark, f"{store}/{name}")
        for name in manifest.children(spark, f"{store}/_merged"):
            if int(name.removeprefix("version=")) < now["version"]:
                manifest.remove(spark, f"{store}/_merged/{name}")
    return True


def read_ingested(spark: SparkSession, store: str, keep_source: bool = False) -> DataFrame:
    """Total per cell over all batches; equal to one batch roll-up of all files. Reads the merged table and the few batches since."""
    whole, _, _ = _parts(spark, store)
    if whole is None:
        raise FileNotFoundError(f"{store} holds no finished batch: run the ingest first")
    return rollup(whole, *(KEYS if keep_source else KEYS[:2]))
