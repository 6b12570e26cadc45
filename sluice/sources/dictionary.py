"""JSON dictionary documents ``{key: [value, ...], ...}`` as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.paths import empty_files, shared_start

# Values stay variants at first: one bad value cannot spoil its neighbours, a
# repeated key keeps all its entries, and a text that looks like a list stays a text.
_DOCUMENTS = "array<map<string,variant>>"
_STRICT = {"mode": "FAILFAST"}
_SPACE = " \t\r\n"


def scan_json_dict(
    spark: SparkSession,
    path: str | list[str],
    *,
    key: str = "id",
    values: str = "related_ids",
    splittable: bool = True,
) -> DataFrame:
    """One row per key with its list of strings; the last entry of a key wins.

    "Last" means later in the document, and for a key found in several files, in
    the file whose path sorts later. A value that is not a list gives NULL, and a
    number in a list its shortest text (``1.10`` is ``1.1``, ``1e3`` ``1000.0``).

    Splittable reading cuts the text at every ``]`` and parses each piece as a
    small document of its own, so a single document of any size is read by many
    tasks, once. It serves documents of flat lists. Where ``]`` also occurs
    inside a text or a nested list, a piece is malformed. ``splittable=False``
    takes any JSON object, but each file then is one row of one task and must
    stay below 2 GB. Either way, a file that is empty, malformed or breaks off at
    either end fails the job rather than return less.
    """
    if empty := empty_files(spark, path):
        raise ValueError(f"JSON document breaks off: {empty[0]}")
    if splittable:
        pieces = spark.read.text(path, lineSep="]")
    else:
        pieces = spark.read.text(path, wholetext=True)
    # Files are told apart by the rest of their paths, which the sorts below compare.
    start = shared_start(spark, path)
    file, block = F.expr(f"substring(_metadata.file_path, {len(start) + 1})"), F.col("_metadata.file_block_start")
    pieces = pieces.select(
        file.alias("file"),
        F.struct(block.alias("block"), F.monotonically_increasing_id().alias("id")).alias("place"),
        F.trim("value", F.lit(_SPACE)).alias("text"),
    )
    pieces = _cut_pieces(pieces, start) if splittable else _whole_documents(pieces)
    parsed = pieces.select(
        "file", "place", "opens", "closes",
        F.from_json("document", _DOCUMENTS, _STRICT).alias("found"),
    ).select("*", F.when(F.size("found") == 1, F.map_entries(F.get("found", F.lit(0)))).alias("entries"))

    # Each piece gives its entries and a row about itself, so that one pass and one
    # aggregation find the last entry of a key and whether files begin and end well.
    # An entry is sorted with what orders it alone: these rows are what the memory of
    # a task holds.
    about = F.struct(
        F.lit(None).cast("string").alias("key"), F.col("file"), F.lit(-1).alias("position"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    listed = F.transform(
        F.coalesce("entries", F.array().cast("array<struct<key:string,value:variant>>")),
        lambda entry, i: F.struct(
            entry["key"].alias("key"), F.lit(None).cast("string").alias("file"), i.alias("position"),
            F.try_variant_get(entry["value"], "$", "array<string>").alias("items"),
        ),
    )
    one = F.col("entries").isNotNull()
    rows = parsed.select(
        F.col("file").alias("place_file"), "place.*", "opens", "closes", one.alias("one"),
        F.explode(F.concat(F.array(about), listed)).alias("row"),
    )
    is_entry = F.col("row.file").isNull()
    rows = rows.select(
        "row.key", "row.file", "row.items",
        F.when(is_entry, F.struct("place_file", "block", "id", "row.position")).alias("order"),
        F.when(~is_entry, F.struct("block", "id", "opens", "closes")).alias("ends"),
        (~is_entry & F.col("opens")).alias("opens"), (~is_entry & F.col("closes")).alias("closes"), "one",
    )
    grouped = rows.groupBy("key", "file").agg(
        F.max_by("items", "order").alias(values),
        F.min("ends")["opens"].alias("opened"),
        F.max("ends")["closes"].alias("closed"),
        F.count_if("opens").alias("openings"),
        F.count_if("closes").alias("closings"),
        F.every("one").alias("sound"),
    )
    broken = ~(F.col("opened") & F.col("closed") & F.col("sound") & (F.col("openings") == 1) & (F.col("closings") == 1))
    checked = grouped.select(
        F.when(F.col("file").isNull(), F.col("key")).when(broken, _failure("JSON document breaks off: ", start)).alias(key), values
    )
    return checked.filter(F.col(key).isNotNull())


def _cut_pieces(pieces: DataFrame, start: str) -> DataFrame:
    """Pieces cut at ``]``, each completed to a list holding one JSON object.

    The first piece of a file opens the document with a brace, any other follows
    a list and a comma. The last one ends with the document's brace and has no
    open list; it may hold the brace alone.
    """
    closes = F.col("text").endswith("}")
    inner = F.trim(F.when(closes, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text")), F.lit(_SPACE))
    lead, rest = F.left("inner", F.lit(1)), F.trim(F.expr("substring(inner, 2)"), F.lit(_SPACE))
    sound = (lead == "{") | ((lead == ",") & (rest != "")) | ((F.col("inner") == "") & F.col("closes"))
    document = F.concat(F.lit("[{"), rest, F.when(F.col("closes"), "}]").otherwise("]}]"))
    return pieces.select("file", "place", closes.alias("closes"), inner.alias("inner")).select(
        "file", "place", "closes", (lead == "{").alias("opens"),
        F.when(sound, document).otherwise(_failure("not a JSON dictionary of lists: ", start)).alias("document"),
    )


def _whole_documents(pieces: DataFrame) -> DataFrame:
    """Inside an outer list the parser has to reach the closing bracket, so
    trailing text cannot be skipped, and it must find one document there."""
    return pieces.select(
        "file", "place", F.lit(True).alias("opens"), F.lit(True).alias("closes"),
        F.concat(F.lit("["), "text", F.lit("]")).alias("document"),
    )


def _failure(message: str, start: str) -> Column:
    """Fails the job, naming the file, whose path begins with ``start``, when it is computed.

    As part of the key it is computed by whatever filters or joins on the key.
    """
    return F.raise_error(F.concat(F.lit(message + start), "file")).cast("string")
