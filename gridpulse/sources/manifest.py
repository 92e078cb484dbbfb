"""Numbered manifests: what a folder holds changes at one instant, by the appearance of one small file."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_manifest"


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, name: str):
    """The file system that Spark uses for a path."""
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    try:
        found = _files(spark, folder).listStatus(_path(spark, folder))
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return []
        raise
    return sorted(f.getPath().getName() for f in found)


def exists(spark: SparkSession, name: str) -> bool:
    return _files(spark, name).exists(_path(spark, name))


def remove(spark: SparkSession, name: str) -> None:
    _files(spark, name).delete(_path(spark, name), True)


def latest(spark: SparkSession, folder: str) -> dict | None:
    """The content of the newest manifest, with its ``version``; None before the first."""
    versions = [n for n in children(spark, f"{folder}/{FOLDER}") if n.endswith(".json")]
    if not versions:
        return None
    stream = _files(spark, folder).open(_path(spark, f"{folder}/{FOLDER}/{versions[-1]}"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {**json.loads(text), "version": int(versions[-1].removesuffix(".json"))}


def publish(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    """Makes ``content`` the manifest ``version``: written beside, then renamed. An error if another writer took the version first."""
    target, staged = f"{folder}/{FOLDER}/{version:012d}.json", f"{folder}/{FOLDER}/.{uuid.uuid4().hex}"
    files = _files(spark, folder)
    out = files.create(_path(spark, staged), False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if files.exists(_path(spark, target)) or not files.rename(_path(spark, staged), _path(spark, target)):
        files.delete(_path(spark, staged), False)
        raise RuntimeError(f"{target} was published by another writer")
