"""Rows as they come: any column names, and bytes that are not valid UTF-8."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import chat, exact_dedup, html_text, langid, license_scan, line_dedup, minhash, mixing, packing

NAMES = ["a.b", "__lang", "__score", "__text", "__no", "__gone", "__row_key", "__n_lines", "__copies", "copies", "spread", "label", "extra_0", "weird `name`"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"the line of text number {i}\nshared by all", "en" if i % 2 else "de", f"s{i % 3}", 9) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    broken = F.expr("cast(concat(cast(text as binary), unhex('FF20C3')) as string)")
    df = df.withColumn("text", F.when(F.col("doc_id") == 5, broken).otherwise(F.col("text")))
    return df.select("*", *[F.lit(77 + i).alias(n) for i, n in enumerate(NAMES)])


def extras(df):
    return {tuple(r) for r in df.select(*[F.col("`" + n.replace("`", "``") + "`") for n in NAMES if n in df.columns]).collect()}


OPERATORS = {
    "language": lambda df: langid.identify(df, langid.fit(df)),
    "lines": line_dedup.dedup_lines,
    "near": minhash.near_duplicates,
    "mixing": mixing.mix,
    "plan": mixing.mix_plan,
    "packing": packing.pack_documents,
    "exact": exact_dedup.exact_groups,
    "licence": license_scan.scan_licenses,
    "html": lambda df: html_text.extract_text(df.withColumnRenamed("text", "html")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_any_names_and_bytes(spark, docs, name):
    out = OPERATORS[name](docs)
    assert len(set(out.columns)) == len(out.columns)
    rows = out.collect()
    assert len(rows) >= 20
    if set(NAMES) & set(out.columns) and name in ("language", "lines", "html", "mixing"):
        assert {77 + NAMES.index("a.b")} == {r["a.b"] for r in rows}


@pytest.mark.parametrize("at", range(5))
def test_stages_take_any_names_and_bytes(spark, docs, at):
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, docs, "")
    if at < 4:
        assert out.columns == docs.columns
        assert extras(out) == {tuple(77 + i for i in range(len(NAMES)))}
    assert out.count() > 0


def test_chats_take_any_bytes(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x", 1)], "conv_id long, turn long, role string, text string, `a.b` int")
    turns = turns.withColumn("text", F.expr("cast(unhex('FF61') as string)"))
    (row,) = chat.chat_digests(chat.render_chats(chat.turn_events(turns))).collect()
    assert row.n_turns == 1
