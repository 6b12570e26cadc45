"""Exact deduplication by a two-pass Bloom filter.

The filter is blocked: a text's hash sets two bits of one 64-bit word. Pass one
shuffles one number for a row, the word and its two bits, combined before the
shuffle, and keeps what two or more rows set. Pass two probes the filter: a hash
whose bits are not both kept cannot repeat, so its row goes straight to the
result. Of the rows with their hashes only the others, a few false ones among them,
are shuffled and grouped.

Only words with kept bits are stored, and they are broadcast in pieces of bounded
size, by ranges of the word's hash: rows are laid out by these ranges, without a
shuffle, and each range is probed with its own piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ascii_lower, whole_text, written

BITS_PER_ROW = 16
SEEDS = (101, 202)
#: Words of the filter that are broadcast at once: two numbers each.
PIECE_WORDS = 1 << 21


def text_sha256(name: str = "text") -> Column:
    """Hash of the text with A-Z lower-cased, NULL as empty."""
    return F.sha2(ascii_lower(whole_text(name)), 256)


def filter_entry(hash_column: Column, words: int) -> dict[str, Column]:
    """The word of the filter that a hash belongs to, and its two bits there."""
    place, bits = (F.xxhash64(F.lit(seed), hash_column) for seed in SEEDS)
    first = F.pmod(bits, F.lit(64))
    second = (first + 1 + F.pmod(F.shiftright(bits, 8), F.lit(63))) % 64
    shifts = [F.call_function("shiftleft", F.lit(1).cast("long"), x.cast("int")) for x in (first, second)]
    return {"word": F.pmod(place, F.lit(words)), "mask": shifts[0].bitwiseOR(shifts[1])}


def repeated_bits(hashes: DataFrame, words: int) -> DataFrame:
    """``(word, bits)``: what two or more rows set."""
    return (
        hashes.select(*[c.alias(k) for k, c in filter_entry(F.col("text_sha256"), words).items()])
        .groupBy("word", "mask")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("bits"))
    )


def possibly_repeated(hashes: DataFrame, kept: DataFrame, words: int) -> DataFrame:
    """``hashes`` with ``maybe``: whether both bits of a row are in ``kept(word, bits)``."""
    pieces = max(1, -(-kept.count() // PIECE_WORDS))
    piece = F.pmod(F.xxhash64("word"), F.lit(pieces)).cast("int").alias("piece")
    entry = [c.alias(k) for k, c in filter_entry(F.col("text_sha256"), words).items()]
    rows = hashes.select("*", *entry).select("*", piece)
    if pieces > 1:
        rows = written(rows, "hashes-by-piece", "piece")
    probed = None
    for i in range(pieces):
        side = F.broadcast(kept.filter(piece == i).withColumnRenamed("word", "of"))
        part = rows.filter(F.col("piece") == i).join(side, F.col("word") == F.col("of"), "left")
        part = part.select(*hashes.columns, (F.coalesce("bits", F.lit(0)).bitwiseAND(F.col("mask")) == F.col("mask")).alias("maybe"))
        probed = part if probed is None else probed.unionByName(part)
    return probed


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row per document.

    Texts are equal when identical after lower-casing A-Z. The row with the
    largest doc_id of a group stays. NULL text counts as empty. Rows repeated with
    one doc_id are rows of the group, of which one stays. A NULL doc_id stays only
    in a group without any other id. Needs columns doc_id and text; others are
    not read.
    """
    hashes = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_sha256().alias("text_sha256")), "hashes")
    words = 1 << max(10, (BITS_PER_ROW * hashes.count() // 64).bit_length())
    kept = written(repeated_bits(hashes, words), "repeated-bits")
    probed = possibly_repeated(hashes, kept, words)
    alone = probed.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    rows = written(probed.filter("maybe").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("copies")), "maybe-repeated")
    groups = written(
        rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups"
    )
    shuffled = (
        rows.join(groups, "text_sha256")
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    )
    return alone.unionByName(shuffled)
