"""Projection, list columns and text normalisation. All narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import named, parse_list, title_case, upper_case


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns, in that order."""
    return df.select(*map(named, columns))


def parse_list_column(df: DataFrame, column: str, into: str) -> DataFrame:
    """Adds ``into``, the ``array<string>`` written as text in ``column``."""
    return df.withColumn(into, parse_list(named(column)))


def explode_list(df: DataFrame, column: str, into: str, *, outer: bool = False) -> DataFrame:
    """One row per element of the array ``column``, which ``into`` replaces.

    Repeated and NULL elements keep their rows. Rows with an empty or NULL array
    disappear, unless ``outer`` keeps them with a NULL element.
    """
    kept = [named(c) for c in df.columns if c != column]
    # The inner form would make Spark filter on the array first, and so compute it
    # again there; an outer one that drops rows without a place computes it once.
    found = df.select(*kept, F.posexplode_outer(named(column)).alias("_place", into))
    return (found if outer else found.filter("_place is not null")).drop("_place")


def edges(df: DataFrame, source: str, targets: str, into: str) -> DataFrame:
    """Edge table ``(source, into)`` from an adjacency list column."""
    return explode_list(project(df, [source, targets]), targets, into)


def bridge(
    df: DataFrame, columns: Iterable[str], list_text: str, into: str, *, outer: bool = False
) -> DataFrame:
    """``columns`` once per element of a list written as text."""
    parsed = df.select(*map(named, columns), parse_list(named(list_text)).alias("_list"))
    return explode_list(parsed, "_list", into, outer=outer)


def unlisted_rows(df: DataFrame, list_text: str) -> DataFrame:
    """Rows that ``bridge`` leaves out: their list is empty or does not parse."""
    size = F.coalesce(F.size(parse_list(named(list_text))), F.lit(0))
    return df.filter(size <= 0)


def normalize_text(
    df: DataFrame, *, title: Iterable[str] = (), upper: Iterable[str] = ()
) -> DataFrame:
    """Title-cases and upper-cases the named columns in place."""
    changed = {c: title_case(named(c)) for c in title}
    changed |= {c: upper_case(named(c)) for c in upper}
    return df.withColumns(changed)
