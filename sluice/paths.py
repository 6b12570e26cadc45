"""Paths as the cluster's file systems see them, through Hadoop's public API."""

from __future__ import annotations

from os.path import commonprefix

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store; a path without a scheme lies on the default one."""
    store, place = _located(spark, path)
    return store.makeQualified(place).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _located(spark, path)
    return store.exists(place)


def empty_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Data files without a byte among those that Spark lists at ``path``.

    Spark leaves them out of its scans. A scan of the files' names and lengths, which
    opens none, counts the others; only if some are missing are names compared.
    """
    files = spark.read.format("binaryFile").load(path).select(F.input_file_name().alias("file"))
    listed = files._jdf.inputFiles()
    if files.count() == len(listed):
        return []
    return sorted(set(files.inputFiles()) - {row.file for row in files.collect()})


def shared_start(spark: SparkSession, path: str | list[str]) -> str:
    """What the paths of all files at ``path`` begin with."""
    file = F.col("_metadata.file_path")
    names = spark.read.format("binaryFile").load(path).agg(F.min(file), F.max(file)).first()
    return commonprefix([name for name in names if name])


def tasks_for(spark: SparkSession, path: str | list[str], each: int = 16 << 20) -> int:
    """How many tasks take ``each`` bytes of the files at ``path``, by a scan of their lengths."""
    files = spark.read.format("binaryFile").load(path)
    return (files.agg(F.sum("length")).first()[0] or 0) // each + 1


def names_below(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder of few files; none if it is not there."""
    store, place = _located(spark, folder)
    return [found.getPath().getName() for found in store.listStatus(place)] if store.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    store, place = _located(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one of this name; says whether it did."""
    store, place = _located(spark, path)
    try:
        stream = store.create(place, False)
    except Py4JJavaError as refused:
        if "AlreadyExists" in refused.java_exception.getClass().getName():
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
