"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.llm import (
    ann,
    chat,
    exact_dedup,
    html_text,
    langid,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    packing,
    prefix_trie,
    simhash,
    spelling,
)
from sluice.llm.common import table


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    rows = docs.select("doc_id", (~langid.in_training()).alias("held_out"), "text")
    return langid.identify(rows, model).select("doc_id", "held_out", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def op2_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op4_chat_formatting(spark, sf_dir):
    """All conversations and one whose texts hold the template's own strings."""
    own = ["conv_id long", "turn long", "role string", "text string"]
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], ", ".join(own))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.chat_digests(chat.render_chats(chat.turn_events(turns)))


def op5_source_mixing(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op6_line_dedup(spark, sf_dir):
    lines = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lines.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256")
    )


def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("ids")


def op8_html_extraction(spark, sf_dir):
    return html_text.with_text(table(spark, sf_dir, "pages"))


def op9_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_simhash_dedup(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_nearest_neighbours,
        op3_license_scan,
        op4_chat_formatting,
        op5_source_mixing,
        op6_line_dedup,
        op7_best_fit_packing,
        op8_html_extraction,
        op9_minhash_dedup,
        op10_exact_dedup,
        op11_spelling_variants,
        op12_prefix_trie,
        op13_simhash_dedup,
    )
}
