"""Running values over groups of any size: sorted ranges of all rows instead of a task per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import written


def in_ranges(rows: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with ``range``, the task that got them, and ``place``, which grows in the order of keys and ``order``."""
    by = [*keys, *order, "equal"]
    dealt = rows.withColumn("equal", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    return written(dealt.drop("equal").withColumns({"range": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), label)


def running(rows: DataFrame, keys: list[str], name: str, value: Column, total: bool = False) -> DataFrame:
    """``rows`` with the last ``value`` that is not NULL among a group's rows so far, or the sum of the values.

    Each range is computed on its own; where a group goes on in the next range, what
    earlier ones found is joined to it: at most one row a range and group.
    """
    upto = Window.partitionBy(*keys, "range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("value_here", value)
    if total:
        held = rows.groupBy(*keys, "range").agg(F.sum("value_here").alias("held"))
        carried, own = F.sum("held").over(earlier), F.sum("value_here").over(upto)
    else:
        held = rows.groupBy(*keys, "range").agg(F.max_by("value_here", F.when(F.col("value_here").isNotNull(), F.col("place"))).alias("held"))
        carried, own = F.last("held", ignorenulls=True).over(earlier), F.last("value_here", ignorenulls=True).over(upto)
    before = held.withColumn("carried", carried).filter("carried is not null")
    before = written(before.select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col("range").alias("of_range"), "carried"), "carried")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys], F.col("range") == F.col("of_range"))
    found = rows.withColumn("own", own).join(before, same, "left")
    both = F.coalesce("own", F.lit(0)) + F.coalesce("carried", F.lit(0)) if total else F.coalesce("own", "carried")
    return found.withColumn(name, both).drop("own", "carried", "value_here", "of_range", *[f"of_{k}" for k in keys])
