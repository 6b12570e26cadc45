"""Parquet, JSON Lines and JDBC sinks, and the multi-table publish."""

from sluice.sinks.files import write_json_lines, write_parquet, write_parquets
from sluice.sinks.jdbc import JdbcTarget
from sluice.sinks.publish import (
    ParquetTarget,
    PublishFailed,
    TableSpec,
    publish,
    raise_on_failure,
)
from sluice.sinks.versions import SetChanged, publish_set, read_set

__all__ = [
    "JdbcTarget",
    "ParquetTarget",
    "PublishFailed",
    "SetChanged",
    "TableSpec",
    "publish",
    "publish_set",
    "raise_on_failure",
    "read_set",
    "write_json_lines",
    "write_parquet",
    "write_parquets",
]
