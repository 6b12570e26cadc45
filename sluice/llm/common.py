"""Column helpers and written tables that the operators share."""

from __future__ import annotations

import functools
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_dir


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(name: str = "text") -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def valid_text(name: str = "text") -> Column:
    """``whole_text`` for Python tasks: bytes that are not valid UTF-8 become U+FFFD."""
    return F.make_valid_utf8(whole_text(name))


def whole_bytes(name: str = "text") -> Column:
    """The bytes of a text column, valid UTF-8 or not, with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b""))


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """The rows written to the shared folder, in folders of the columns ``by``, and read back.

    Cuts the lineage: a lost executor costs a read of these files, not the jobs
    before them.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, partitionBy=list(by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def on_plain_names(*needed: str):
    """For an operator on rows that pass through: columns it does not need may have any names.

    They have names of their own inside. A column that the operator adds replaces one
    of the same name, as ``withColumn`` does.
    """

    def wrap(operator):
        @functools.wraps(operator)
        def run(rows: DataFrame, *args, **more) -> DataFrame:
            plain = {c if c in needed else f"extra_{i}": c for i, c in enumerate(rows.columns)}
            out = operator(rows.toDF(*plain), *args, **more)
            added = set(out.columns) - set(plain)
            kept = [c for c in out.columns if plain.get(c) not in added]
            return out.select(*kept).toDF(*[plain.get(c, c) for c in kept])

        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small pieces, so that Python holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
