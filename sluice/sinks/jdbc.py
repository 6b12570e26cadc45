"""JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database, written by Spark's JDBC writer.

    Credentials come in ``properties``; nothing is built in. ``prefix`` keeps the
    tables of one job apart from another's.

    Each writing task holds one connection and commits on its own, so
    ``connections`` bounds the load on the database however many partitions the
    data has: Spark coalesces to that many tasks, which then also scan and conform
    the published dataset. A task lost after its commit is run again: append to a table
    without a key may then repeat rows, whereas a declared key refuses them.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    prefix: str = ""
    connections: int = 16
    batch_rows: int = 10_000
    truncate: bool = True

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str,
        lengths: Mapping[str, int] | None = None,
    ) -> None:
        """Appends or overwrites, matching columns by name.

        Overwrite empties an existing table and so keeps its declared keys and
        types; with ``truncate=False`` it drops and creates it anew. A created
        table gets ``VARCHAR`` columns of the given ``lengths``.
        """
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": self.prefix + table,
            "numPartitions": self.connections,
            "batchsize": self.batch_rows,
            "truncate": self.truncate,
        }
        if lengths:
            options["createTableColumnTypes"] = ", ".join(
                f"{column} VARCHAR({limit})" for column, limit in lengths.items()
            )
        df.write.format("jdbc").options(**options).mode(mode).save()
