"""Key filters, deduplication and null handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import named, quoted


_ALIKE_IF_EQUAL = (
    T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(),
    T.BooleanType(), T.DateType(), T.TimestampType(),
)


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which no key column is NULL."""
    return df.filter(reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys]))


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    *,
    unique_order: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One whole row per key: the first by ``order_by``, NULLs last.

    Ties are settled by the remaining columns in schema order, so the survivor
    does not depend on how the input was partitioned. NULL keys form one group.
    ``unique_order`` states that ``order_by`` leaves no ties; the remaining
    columns then need not be read where only some of them are used later.
    ``keep`` names the columns wanted of the survivor. Rows that tie up to the last
    of them in that order agree in all of them, so what stands behind it is neither
    read nor shuffled.

    Spark limits each group to its first row before the shuffle as well as after
    it, so a key with very many rows sends one row per map task.
    """
    keys = list(keys)
    if unique_order and not order_by:
        raise ValueError("unique_order needs order_by")
    ties = [c for c in df.columns if c not in keys and c not in order_by and not unique_order]
    if keep is not None:
        order_by, ties = _up_to_last([*order_by, *ties], keys, keep, df.schema), []
        df = df.select(*map(named, dict.fromkeys([*keys, *order_by, *keep])))
    shown = df.columns if keep is None else keep
    if not ties and not order_by:
        return df.distinct().select(*map(named, shown))
    order = [named(c).asc_nulls_last() for c in (*order_by, *ties)]
    rank = F.row_number().over(Window.partitionBy(*map(named, keys)).orderBy(*order))
    return df.select("*", rank.alias("_rank")).filter("_rank = 1").select(*map(named, shown))


def _up_to_last(order: list[str], keys: Sequence[str], keep: Sequence[str], schema: T.StructType) -> list[str]:
    """The ordering up to its last kept column, if rows that tie there show the same.

    Zeros of either sign, and NaNs, tie and yet differ, as may texts under a collation:
    with such a column, or one outside the ordering, all of it stands.
    """
    alike = all(c in (*order, *keys) and schema[c].dataType in _ALIKE_IF_EQUAL for c in keep)
    return order[: max((order.index(c) + 1 for c in keep if c in order), default=0)] if alike else order


def fill_nulls(
    df: DataFrame, defaults: Mapping[str, object], text: str | None = None
) -> DataFrame:
    """Per-column defaults, then ``text`` in every string column still NULL.

    NaN counts as NULL in the columns of ``defaults``. Empty strings and columns
    of other types stay as they are.
    """
    filled = df.fillna({quoted(c): value for c, value in defaults.items()})
    return filled if text is None else filled.fillna(text)


def clean_entity(
    df: DataFrame,
    key: str,
    order_by: Sequence[str] = (),
    *,
    unique_order: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with a key, one per key."""
    return dedupe_by_key(require_key(df, key), [key], order_by, unique_order=unique_order, keep=keep)
