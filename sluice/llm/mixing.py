"""Mixing sources to target weights by Pareto order sampling.

A source whose target is ``r`` times its size takes ``floor(r)`` whole copies of
each document for certain. What is then missing, ``R`` words, comes from one more
copy of some documents, drawn without replacement with probability proportional
to size, documents that large enough being certain. Documents are ranked by the
odds of a random number over the odds of their inclusion, and taken in this order
until the words are there. Long documents stand early in the order, so that the
one at the border is short; it is passed over, and the words it leaves open are
filled by those after it that are short enough, in the same order, until no document
that is left would fit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import on_plain_names, whole_text, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
#: Running sums are cut into ranges of a source's order, so many for each factor of
#: e in the odds. The logarithm of the ranks spreads over a dozen such factors, and
#: none of the ranges holds more than a thousandth of a source.
RANGES = 256
#: Fillings in order before every second one leaves out documents of more than half the words left open.
FILLINGS = 4


def word_count(name: str = "text") -> Column:
    return F.regexp_count(whole_text(name), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources in code point order, NULL last, weigh ``WEIGHTS`` repeating. A target
    above ``max_epochs`` times its source's size stops there and the excess is
    shared by weight among the others until none is above: the level at which the
    capped sizes and ``weight * level`` add up to the whole. Reads one row per
    source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("place", F.row_number().over(ordered) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    ceiling = (F.col("source_size") * max_epochs).cast("double")
    sources = sources.withColumns({"weight": weight, "ceiling": ceiling})
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("ceiling") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumns(
        {
            "left": F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)),
            "weights": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # Sources in the order of their ceilings per weight: the first that its share does not fill sets the level.
    free = F.col("weight") * F.col("left") <= F.col("ceiling") * F.col("weights")
    level = F.min(F.when(free, F.struct(F.col("ceiling") / F.col("weight"), "place", F.col("left") / F.col("weights")).alias("x"))).over(whole)
    return sources.withColumn("level", level["col3"]).select(
        "source", "source_size", F.least(F.col("ceiling"), F.coalesce(F.col("weight") * F.col("level"), F.col("ceiling"))).alias("target")
    )


def uniform(seed: int) -> Column:
    """A number in (0, 1) fixed by seed and doc_id, without one by the row: 52 bits of a hash."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("row_key").cast("string")))))
    return (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def size_cutoffs(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, per_word, certain_from)`` for the extra copies.

    Documents of ``certain_from`` words or more are certain; a shorter one of
    ``s`` words is included with probability ``s * per_word``, and the expected
    words add up to what whole copies leave open. Works on the distinct sizes of
    a source, whose number is bounded by its longest document.
    """
    by_size = sizes.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    # Not larger ones, then all: what remains when every larger size is certain.
    larger = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    words, squares = F.col("n") * F.col("size"), (F.col("n") * F.col("size")).cast("double") * F.col("size")
    steps = by_size.withColumns(
        {"certain": F.coalesce(F.sum(words).over(larger), F.lit(0)), "squares": F.sum(squares).over(from_here), "above": F.min("size").over(larger)}
    )
    steps = steps.join(targets.filter("extra > 0"), steps["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    steps = steps.withColumn("per_word", (F.col("extra") - F.col("certain")) / F.col("squares"))
    # The first cut at which the largest size left has a probability of at most 1.
    fits = (F.col("per_word") > 0) & (F.col("per_word") * F.col("size") <= 1)
    chosen = steps.filter(fits).groupBy("source").agg(F.max(F.struct("size", "per_word", "above")).alias("cut"))
    return chosen.select("source", F.col("cut.per_word").alias("per_word"), F.col("cut.above").alias("certain_from"))


def mix_plan(docs: DataFrame, seed: int = 7, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken, row_key)``, a row per document.

    ``size`` counts the words of the whole text (NULL: 0), ``taken`` is copies
    times size. A source's words taken do not exceed its target, and what is left
    open is less than any document that it could still take. Documents without words are
    taken as often as their source is for certain. Repeated rows are documents of their own; those
    with one doc_id stand next to each other in the order, equal rows without one as well. No document has more
    than ``max_epochs`` copies. ``row_key`` finds the row in the input. Needs
    doc_id, text and source.
    """
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"), row_key().alias("row_key")]
    return plan_sizes(written(docs.select(*own), "sizes"), seed, share, max_epochs)


def row_key() -> Column:
    """A key that equal rows share, of doc_id, source and text."""
    return F.xxhash64(F.lit(5), F.col("doc_id").cast("long"), F.col("source").cast("string"), whole_text())


@on_plain_names("doc_id", "text", "source")
def mix(docs: DataFrame, seed: int = 7, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents as often as ``mix_plan`` takes them, with their own columns."""
    taken = mix_plan(docs, seed, share, max_epochs).groupBy("row_key").agg(F.sum("copies").alias("__copies")).filter("__copies > 0")
    keyed = docs.withColumn("__row_key", row_key())
    found = keyed.join(written(taken, "copies").withColumnRenamed("row_key", "__taken").hint("merge"), F.col("__row_key") == F.col("__taken"))
    # Equal rows stand for each other: one of them carries the copies of all.
    one = F.row_number().over(Window.partitionBy("__row_key").orderBy("__row_key"))
    found = found.withColumn("__no", one).filter("__no = 1")
    return found.withColumn("__copy", F.explode(F.expr("sequence(1L, __copies)"))).select(docs.columns)


def reduce_room(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """``rows`` with the words taken from their source off its ``room``."""
    spent = taken.groupBy("source").agg(F.sum("size").alias("spent")).withColumnRenamed("source", "spent_source")
    joined = rows.join(written(spent, "spent"), F.col("source").eqNullSafe(F.col("spent_source")), "left")
    return joined.withColumn("room", F.col("room") - F.coalesce("spent", F.lit(0))).drop("spent", "spent_source")


def fill(rows: DataFrame) -> DataFrame:
    """``rows`` with ``more``: 1 as long as the words up to here, in order, fit into the room.

    The running sum is one over ranges of the order, then one within each range.
    """
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("source").alias("part_source"), F.col("part").alias("part_no"), F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("start"))
    here = F.col("source").eqNullSafe(F.col("part_source")) & (F.col("part") == F.col("part_no"))
    inside = Window.partitionBy("source", "part").orderBy("rank", "doc_id", "size", "row_key").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(written(starts, "starts"), here).withColumn("upto", F.col("start") + F.sum("size").over(inside))
    return summed.withColumn("more", (F.col("upto") <= F.col("room")).cast("int")).drop("part_source", "part_no", "start", "upto")


def plan_sizes(sizes: DataFrame, seed: int, share: float, max_epochs: int) -> DataFrame:
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = source_targets(sizes, share, max_epochs).withColumn("whole", F.floor(ratio))
    targets = targets.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = written(targets, "targets")
    cuts = size_cutoffs(sizes, targets)
    known = targets.join(cuts.withColumnRenamed("source", "cut_source"), F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    known = written(known, "cutoffs")
    rows = sizes.join(known.withColumnRenamed("source", "known_source"), F.col("source").eqNullSafe(F.col("known_source")), "left").drop("known_source")
    chance = F.col("size") * F.col("per_word")
    certain = (F.col("certain_from").isNotNull() & (F.col("size") >= F.col("certain_from"))) | (chance >= 1)
    drawn = uniform(seed)
    odds = F.when(certain, F.lit(0.0)).when(chance > 0, drawn / (1 - drawn) / (chance / (1 - chance)))
    rows = written(rows.withColumns({"rank": odds, "room": F.col("extra"), "part": F.floor(F.log(F.when(odds > 0, odds)) * RANGES)}), "ranked")
    certain = rows.filter("extra > 0 and rank = 0")
    settled = [rows.filter("extra <= 0 or rank is null").withColumn("more", F.lit(0)), certain.withColumn("more", F.lit(1))]
    waiting = reduce_room(rows.filter("extra > 0 and rank > 0"), certain)
    turn = 0
    # From FILLINGS on, two turns halve the words left open at least: shorter documents
    # alone fill half of them or are all taken, then one longer document does.
    while not waiting.isEmpty():
        tried = F.col("size") * 2 <= F.col("room") if turn >= FILLINGS and turn % 2 else F.lit(True)
        filled = written(fill(waiting.filter(tried)), "filled")
        taken = filled.filter("more = 1")
        settled.append(taken)
        left = filled.filter("more = 0").unionByName(waiting.filter(~tried).withColumn("more", F.lit(0)))
        left = written(reduce_room(left, taken), "left")
        settled.append(left.filter("size > room"))
        waiting, turn = left.filter("size <= room").drop("more"), turn + 1
    columns = ["doc_id", "source", "size", "source_size", "target", "row_key"]
    out = reduce(DataFrame.unionByName, [x.select(*columns, "whole", "more") for x in settled])
    copies = (F.col("whole") + F.col("more")).cast("long")
    return out.select(*columns[:-1], copies.alias("copies"), (copies * F.col("size")).alias("taken"), "row_key")
