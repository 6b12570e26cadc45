"""Several Parquet tables published as one set, seen by readers all at once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.paths import create_text, names_below, read_text
from sluice.sinks.publish import ParquetTarget, TableSpec, publish


class SetChanged(RuntimeError):
    """Another publish switched the set first."""


def publish_set(spark: SparkSession, specs: Sequence[TableSpec], folder: str, *, at_once: int = 4) -> DataFrame:
    """Publishes the tables below ``folder`` as one version; returns ``publish``'s status rows.

    All tables are written to a folder of their own. Only if every one succeeded is a
    manifest written that names the folders of each table; readers take the last
    manifest, so they see the old set or the new one. If a table fails, the set
    stays as it was and tables that were written have the status ``held``.
    ``overwrite`` replaces a table's folders, ``append`` adds one to them, and
    tables that are not among the specs stay. Of two publishes at one time the second
    to write its manifest raises ``SetChanged``. Old versions are not deleted.
    """
    names = [spec.table for spec in specs]
    if len(set(names)) < len(names):
        raise ValueError(f"a table is named twice: {names}")
    number, tables = _current(spark, folder)
    version = f"{folder}/versions/{uuid.uuid4().hex}"
    status = publish(spark, specs, ParquetTarget(version), at_once=at_once)
    if not status.filter("status <> 'ok'").isEmpty():
        held = F.when(F.col("status") == "ok", F.lit("held")).otherwise(F.col("status"))
        return status.withColumn("status", held)
    for spec in specs:
        earlier = tables.get(spec.table, []) if spec.mode == "append" else []
        tables[spec.table] = [*earlier, f"{version}/{spec.table}"]
    if not create_text(spark, _manifest(folder, number + 1), json.dumps({"tables": tables, "whole": True})):
        raise SetChanged(f"{folder} has a version {number + 1} by now")
    return status


def read_set(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the last version, by name; none before the first."""
    _, tables = _current(spark, folder)
    return {name: spark.read.parquet(*paths) for name, paths in tables.items()}


def _manifest(folder: str, number: int) -> str:
    return f"{folder}/manifests/{number:012d}.json"


def _current(spark: SparkSession, folder: str) -> tuple[int, dict[str, list[str]]]:
    """Number of the last manifest, and the tables of the last one that is whole.

    A manifest whose writer was lost half-way is passed over; its number is taken.
    """
    names = sorted(x for x in names_below(spark, f"{folder}/manifests") if x.endswith(".json"))
    last = int(names[-1].removesuffix(".json")) if names else 0
    for name in reversed(names):
        try:
            found = json.loads(read_text(spark, f"{folder}/manifests/{name}"))
        except ValueError:
            continue
        if found.get("whole"):
            return last, found["tables"]
    return last, {}
