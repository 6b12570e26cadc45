"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job should start from. Adaptive execution sizes the reduce
# side from real shuffle statistics and splits partitions swollen by a hot key,
# so `spark.sql.shuffle.partitions` only has to be large enough (input bytes /
# 128 MB); it is left to the caller because it depends on the input.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}

_MADE: list[str] = []


def build_session(app_name: str, **conf: object) -> SparkSession:
    """Session with ``CLUSTER_CONF``; keyword settings (``__`` for ``.``) win."""
    settings = CLUSTER_CONF | {k.replace("__", "."): str(v) for k, v in conf.items()}
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path that every executor can reach.

    It lies below the folder named by ``spark.checkpoint.dir``. Only a local
    session, whose tasks share the driver's disk, may fall back to a temporary
    folder; a cluster session without the setting is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="sluice-")
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Deletes the folders that ``scratch_dir`` named in this process.

    For the end of a job: results that were not written elsewhere are still read
    from them until then.
    """
    while _MADE:
        place = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
