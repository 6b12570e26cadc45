"""Column expressions. All of them are Spark built-ins, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schemas import STRINGS


def quoted(name: str) -> str:
    """A column name as Spark reads it literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str, side: str | None = None) -> Column:
    """The column of that very name; ``side`` is the alias of a join's side."""
    return F.col(quoted(name) if side is None else f"{side}.{quoted(name)}")


def parse_list(text: Column) -> Column:
    """``array<string>`` from a JSON list or a single-quoted list literal.

    Text that does not begin with a list gives NULL, as does a list holding a
    bare ``None``. What follows the end of the list is not read: ``['a'] x`` is
    the list of ``a``.
    """
    return F.from_json(text, STRINGS)


def list_text(*items: Column) -> Column:
    """Single-quoted list literal of the items; NULL if any item is NULL."""
    parts = [F.lit("[")]
    for position, item in enumerate(items):
        opening = "'" if position == 0 else ", '"
        parts += [F.lit(opening), item.cast("string"), F.lit("'")]
    return F.concat(*parts, F.lit("]"))


def title_case(text: Column) -> Column:
    """First letter of each space-separated word upper, the others lower."""
    return F.initcap(text)


def upper_case(text: Column) -> Column:
    return F.upper(text)
