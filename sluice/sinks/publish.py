"""Publishing several datasets as tables, with a status row per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import conform, count_violations
from sluice.sinks.files import concurrently, write_parquet
from sluice.sources import scan_parquet

STATUS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """One dataset to publish: where it lies, and what the table declares.

    ``mode`` is ``append`` or ``overwrite``. ``schema`` conforms the dataset
    first; a column of a wider type fails the table unless ``narrow``. ``keys``
    and ``lengths`` state the table's key and text limits; both are checked in
    one aggregation before writing.
    """

    path: str
    table: str
    mode: str
    schema: T.StructType | None = None
    keys: Sequence[str] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)
    narrow: bool = False

    def __post_init__(self) -> None:
        if self.mode not in ("append", "overwrite"):
            raise ValueError(f"mode must be 'append' or 'overwrite': {self.mode!r}")


class Target(Protocol):
    def write(
        self, df: DataFrame, table: str, mode: str, lengths: Mapping[str, int] | None = None
    ) -> None: ...


@dataclass(frozen=True)
class ParquetTarget:
    """Tables as Parquet datasets below a folder."""

    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def write(
        self, df: DataFrame, table: str, mode: str, lengths: Mapping[str, int] | None = None
    ) -> None:
        write_parquet(df, self.path(table), mode)


class PublishFailed(RuntimeError):
    """At least one table was not published."""


def publish(
    spark: SparkSession, specs: Sequence[TableSpec], target: Target, *, at_once: int = 4
) -> DataFrame:
    """Publishes the tables, ``at_once`` at a time; a failing one does not stop the others.

    Returns ``(table_name, mode, n_rows, status, error)``, one row per spec. The
    tables are not published as one transaction: after a failure the status
    shows which are new and which are not. See ``raise_on_failure``.
    """
    statuses = concurrently(spark, lambda spec: _publish_one(spark, spec, target), specs, at_once)
    return spark.createDataFrame(statuses, STATUS)


def raise_on_failure(status: DataFrame) -> None:
    """Raises ``PublishFailed`` naming the tables that failed, if any did."""
    failed = status.filter("status = 'failed'").select("table_name", "error").collect()
    if failed:
        raise PublishFailed("; ".join(f"{row.table_name}: {row.error}" for row in failed))


def _publish_one(
    spark: SparkSession, spec: TableSpec, target: Target
) -> tuple[str, str, int | None, str, str | None]:
    try:
        df = scan_parquet(spark, spec.path)
        if spec.schema is not None:
            df = conform(df, spec.schema, narrow=spec.narrow)
        _check(df, spec)
        written = Observation()
        observed = df.observe(written, F.count(F.lit(1)).alias("n"))
        target.write(observed, spec.table, spec.mode, spec.lengths)
        return spec.table, spec.mode, written.get["n"], "ok", None
    except Exception as error:
        return spec.table, spec.mode, None, "failed", f"{type(error).__name__}: {error}"


def _check(df: DataFrame, spec: TableSpec) -> None:
    if not spec.keys and not spec.lengths:
        return
    found = count_violations(df, spec.keys, spec.lengths).first()
    if found["bad_keys"]:
        raise ValueError(f"key {list(spec.keys)} is repeated or NULL")
    if found["long_texts"]:
        raise ValueError(f"text is longer than declared: {dict(spec.lengths)}")
