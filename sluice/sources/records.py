"""CSV records with line breaks in fields, cut out of files by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.paths import tasks_for


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, record, is_header)``: the records of CSV files, one record a row.

    Files are read by blocks. A line break ends a record where the quotes before it
    in the file are even in number. A block counts its own quotes and finds where
    records start for both cases, even or odd before it; a running sum over the
    blocks of a file then says which case holds and which record a block starts
    in. Only lines of records with several lines are brought together. Both shuffles
    have as many tasks as the files' bytes need. A file that
    ends within quotes fails the job. Breaks of two characters (\\r\\n) become \\n. Blank lines between records are left out,
    and the first record of each file is its header.
    """
    text, tasks = spark.read.text(path, lineSep="\n"), tasks_for(spark, path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
        F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'))), F.lit(2)).alias("odd"),
    ).repartition(tasks, "file", "block")
    in_block = Window.partitionBy("file", "block").orderBy("id")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("quoted", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)

    def last_start(entered: int) -> Column:
        return F.max(F.when(F.col("quoted") == entered, F.col("id")))

    blocks = lines.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("parity"),
        last_start(0).alias("start_if_even"),
        last_start(1).alias("start_if_odd"),
        F.min(F.when(F.trim("value", F.lit(" \t\r﻿")) != "", F.col("id"))).alias("filled"),
    )
    whole, earlier = Window.partitionBy("file"), Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    unclosed = F.raise_error(F.concat(F.lit("a quoted field is not closed: "), "file")).cast("long")
    entered = F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2
    blocks = blocks.withColumns({"entered": entered, "header": F.min("filled").over(whole), "left_open": F.sum("parity").over(whole) % 2})
    blocks = blocks.withColumn("start", F.when(F.col("entered") == 0, F.col("start_if_even")).otherwise(F.col("start_if_odd")))
    blocks = blocks.select(
        "file", "block", "header",
        F.when(F.col("left_open") == 1, unclosed).otherwise(F.col("entered")).alias("entered"),
        F.last("start", ignorenulls=True).over(earlier).alias("carried"),
    )
    placed = lines.join(blocks, ["file", "block"])
    starts = F.col("quoted") == F.col("entered")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns(
        {
            "record_id": F.coalesce(F.last(F.when(starts, F.col("id")), ignorenulls=True).over(upto), "carried"),
            "alone": starts & F.coalesce(F.lead(starts).over(in_block), F.lit(False)),
        }
    ).select("file", "record_id", "id", "value", "alone", (F.col("record_id") == F.col("header")).alias("is_header"))
    joined = (
        placed.filter(~F.col("alone"))
        .repartition(tasks, "file", "record_id")
        .groupBy("file", "record_id", "is_header")
        .agg(F.array_sort(F.collect_list(F.struct("id", "value"))).alias("parts"))
        .select("file", F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("record"), "is_header")
    )
    records = placed.filter("alone").select("file", F.col("value").alias("record"), "is_header").unionByName(joined)
    return records.filter(F.trim("record", F.lit(" \t\r﻿")) != "").withColumn("record", F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", ""))


def parse_records(records: DataFrame, schema: T.StructType, options: dict, check_header: bool) -> DataFrame:
    """The columns of ``csv_records`` without headers, which have to name ``schema``'s columns."""
    corrupt = options.get("columnNameOfCorruptRecord")
    names = [f.name for f in schema.fields if f.name != corrupt]
    options = {k: str(v) for k, v in options.items()}
    if check_header:
        sensitive = records.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        as_text = ", ".join(f"c{i} string" for i in range(len(names))) + ", rest string"
        shown = F.from_csv(F.ltrim("record", F.lit("﻿")), as_text, options | {"columnNameOfCorruptRecord": "rest"})
        wanted = [n if sensitive else n.lower() for n in names]
        agrees = shown["rest"].isNull()
        for i, name in enumerate(wanted):
            cell = shown[f"c{i}"] if sensitive else F.lower(shown[f"c{i}"])
            agrees &= cell.eqNullSafe(F.lit(name))
        message = F.concat(F.lit("CSV header does not conform to the schema: "), "file")
        refused = F.when(F.col("is_header") & ~agrees, F.raise_error(message).cast("boolean")).otherwise(~F.col("is_header"))
        records = records.filter(refused)
    else:
        records = records.filter(~F.col("is_header"))
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("record", columns, options).alias("row")).select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
