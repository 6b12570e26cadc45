"""From raw documents to packed training sequences, stage by stage.

Every stage reads all that the one before kept, and its decisions take effect:
what it drops is gone, and changed texts are the next stage's input. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import langid, line_dedup, minhash, mixing, packing
from sluice.llm.common import table, written

#: A document stays if its most probable language has at least this probability.
MIN_LANGUAGE_SCORE = 0.3

#: Columns that stages read or change; others pass through under any names.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def on_documents(stage):
    """A stage that may be given columns of any names: inside, those that it does not know have names of their own."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in KNOWN else f"extra_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*plain), sf_dir).toDF(*docs.columns)

    return run


@on_documents
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learnt; texts without a letter go."""
    found = langid.identify(docs, langid.fit(docs))
    return found.filter((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= MIN_LANGUAGE_SCORE)).select(docs.columns)


@on_documents
def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them hold; all documents stay."""
    found = line_dedup.dedup_lines(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@on_documents
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; of repeated rows, one.

    Rows that share an id but not a text are documents of their own: each has a
    number made of both in place of its id. Rows without an id are never brought
    together, and all stay.
    """
    named = docs.filter("doc_id is not null")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    clashing = named.groupBy("doc_id").agg((F.min(text) < F.max(text)).alias("clashes")).filter("clashes")
    clashing = written(clashing.select(F.col("doc_id").alias("clashing")), "clashing-ids")
    marked = named.join(clashing, F.col("doc_id") == F.col("clashing"), "left")
    marked = marked.withColumn("number", F.when(F.col("clashing").isNull(), F.col("doc_id").cast("long")).otherwise(F.xxhash64("doc_id", text)))
    marked = written(marked.drop("clashing"), "numbered-documents")
    marks = minhash.near_duplicates(marked.select(F.col("number").alias("doc_id"), "text"))
    gone = marks.filter(~F.col("kept")).select(F.col("doc_id").alias("number")).distinct()
    rest = marked.join(gone, "number", "left_anti")
    first = F.row_number().over(Window.partitionBy("number").orderBy("source", "lang"))
    return rest.withColumn("first", first).filter("first = 1").select(docs.columns).unionByName(docs.filter("doc_id is null"))


@on_documents
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, their token ids and places in sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"), keep_ids=True)


STAGES = [
    ("language ID", known_language),
    ("line dedup", without_shared_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
