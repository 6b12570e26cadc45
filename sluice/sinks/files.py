"""File sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from sluice.paths import exists, qualified

Item = TypeVar("Item")
Result = TypeVar("Result")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Writes ``df`` and returns the written dataset for further use.

    Going on from the returned frame, rather than from ``df``, reads the source
    once and lets later plans prune columns and know the true size. Files are
    compressed with zstd, whatever the session's codec.
    """
    if mode == "overwrite":
        refuse_own_source(df, path)
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquets(frames: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Overwrites ``folder/name`` for each named frame, as concurrent jobs.

    The frames must not depend on each other's output. While the last tasks of
    one job run, those of another use the free cores.
    """
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    written = concurrently(
        spark, lambda item: write_parquet(item[1], f"{folder}/{item[0]}"), list(frames.items()), len(frames)
    )
    return dict(zip(frames, written, strict=True))


def concurrently(
    spark: SparkSession, job: Callable[[Item], Result], items: Sequence[Item], at_once: int
) -> list[Result]:
    """``job`` on each item, so many at a time, in the caller's job group and pool."""
    if at_once < 1:
        raise ValueError(f"at least one job at a time: {at_once}")
    # Each thread has local properties of its own, so each needs a target of its own.
    targets = [inheritable_thread_target(spark)(job) for _ in items]
    with ThreadPoolExecutor(max_workers=at_once) as jobs:
        return [x.result() for x in [jobs.submit(t, i) for t, i in zip(targets, items, strict=True)]]


def write_json_lines(
    df: DataFrame, path: str, stored_as: Mapping[str, str] | None = None
) -> None:
    """Writes JSON Lines; ``stored_as`` maps a column to another field name.

    NULL fields are written out, so every line has the same fields.
    """
    refuse_own_source(df, path)
    names = stored_as or {}
    stored = df.toDF(*[names.get(c, c) for c in df.columns])
    stored.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def refuse_own_source(df: DataFrame, path: str) -> None:
    """Raises if overwriting ``path`` would delete files that ``df`` reads.

    Spark empties the folder before its tasks read, so the data would be lost.
    The places compared are those that the plan's file scans were opened with,
    however many files lie there.
    """
    spark = df.sparkSession
    if not exists(spark, path):
        return
    target = _key(qualified(spark, path))
    for root in _source_roots(df):
        source = _key(qualified(spark, root))
        if source.startswith(target) or target.startswith(source):
            raise ValueError(f"refusing to overwrite {path}: the data is read from it")


def _source_roots(df: DataFrame) -> set[str]:
    """Paths of the file sources in the plan of ``df``."""
    leaves, roots = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("LogicalRelation") or leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                roots |= {paths.apply(j).toString() for j in range(paths.size())}
    return roots


def _key(place: str) -> str:
    """A form in which a folder is a prefix of what it holds, and of nothing else."""
    scheme, _, rest = place.partition(":")
    return f"{scheme}:/{rest.lstrip('/') if scheme == 'file' else rest}/"
