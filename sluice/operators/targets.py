"""Declared target tables: conformance and constraint checks as queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import named

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def conform(df: DataFrame, schema: T.StructType, *, narrow: bool = False) -> DataFrame:
    """``df`` with exactly the columns, order and types of ``schema``.

    Columns are matched by name. Columns ``df`` lacks become typed NULLs; a
    column the target does not declare is an error, and so is one whose type the
    declared type cannot hold, such as a fraction for a whole number. ``narrow``
    converts these too: ``conversion_violations`` shows the values that change.
    """
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns not declared by the target: {sorted(unknown)}")
    lossy = narrowed_columns(df, schema)
    if lossy and not narrow:
        raise ValueError(f"columns of a narrower type in the target: {sorted(lossy)}")
    return df.select(
        *[
            (_converted(f) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def _converted(field: T.StructField) -> Column:
    """The column as its declared type; NULL where that cannot hold a value at all."""
    return named(field.name).try_cast(field.dataType)


def narrowed_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns whose values the declared type may change or not hold."""
    declared = {f.name: f.dataType for f in schema.fields}
    return [
        f.name
        for f in df.schema.fields
        if f.name in declared and _narrower(f.dataType, declared[f.name])
    ]


def _narrower(have: T.DataType, want: T.DataType) -> bool:
    if have == want or isinstance(want, T.StringType):
        return False
    if isinstance(have, _WHOLE):
        digits = {T.FloatType: 7, T.DoubleType: 15}.get(type(want))
        room = want.precision - want.scale if isinstance(want, T.DecimalType) else digits
        if isinstance(want, _WHOLE):
            return _WHOLE.index(type(have)) > _WHOLE.index(type(want))
        return room is None or room < {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}[type(have)]
    if isinstance(have, T.FloatType):
        return not isinstance(want, T.DoubleType)
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return have.scale > want.scale or have.precision - have.scale > want.precision - want.scale
    return isinstance(have, (*_FRACTIONAL, T.StringType, T.TimestampType, T.BooleanType))


def conversion_violations(
    df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per value that its declared type changes or cannot hold."""
    checks = [
        F.struct(
            F.lit(name).alias("column_name"),
            named(name).cast("string").alias("value"),
            _converted(schema[name]).cast("string").alias("converted"),
            (~_converted(schema[name]).try_cast(df.schema[name].dataType).eqNullSafe(named(name))).alias("lossy"),
        )
        for name in narrowed_columns(df, schema)
    ]
    empty = "array<struct<column_name:string,value:string,converted:string,lossy:boolean>>"
    found = F.array(*checks) if checks else F.array().cast(empty)
    return df.select(*map(named, keep), F.inline(found)).filter("lossy").drop("lossy")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or hold a NULL, with their row count."""
    repeated = F.col("n_rows") > 1
    for key in keys:
        repeated |= named(key).isNull()
    return df.groupBy(*map(named, keys)).agg(F.count("*").alias("n_rows")).filter(repeated)


def length_violations(
    df: DataFrame, limits: Mapping[str, int], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per text longer than its column's limit, in one pass over ``df``."""
    checks = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.length(named(column)).alias("n_chars"),
                F.lit(limit).alias("max_chars"),
            )
            for column, limit in limits.items()
        ]
    )
    return df.select(*map(named, keep), F.inline(checks)).filter("n_chars > max_chars")


def count_violations(
    df: DataFrame, keys: Sequence[str] = (), limits: Mapping[str, int] | None = None
) -> DataFrame:
    """One row ``(bad_keys, long_texts)``, both counts from one aggregation over ``df``."""
    long = sum((F.coalesce((F.length(named(c)) > n).cast("int"), F.lit(0)) for c, n in (limits or {}).items()), F.lit(0))
    if not keys:
        return df.agg(F.lit(0).cast("long").alias("bad_keys"), F.coalesce(F.sum(long), F.lit(0)).alias("long_texts"))
    missing = F.lit(False)
    for key in keys:
        missing |= named(key).isNull()
    rows = df.groupBy(*map(named, keys)).agg(F.count("*").alias("n_rows"), F.sum(long).alias("n_long"))
    return rows.agg(
        F.count_if((F.col("n_rows") > 1) | missing).alias("bad_keys"),
        F.coalesce(F.sum("n_long"), F.lit(0)).alias("long_texts"),
    )
