"""Exact and near duplicates, and lines that documents share."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sluice.llm import components, exact_dedup, line_dedup, minhash
from tests.llm import brute

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def words(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(text, seed, n):
    parts, rng = text.split(), random.Random(seed)
    for _ in range(n):
        parts[rng.randrange(len(parts))] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


class TestExact:
    def groups(self, df):
        return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect()), key=str)

    def test_nulls_case_ties_and_repeated_rows(self, spark):
        rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x"), (7, "x"), (None, "ab"), (None, "alone")]
        got = self.groups(frame(spark, rows))
        assert got == sorted(
            [(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True)]
            + [(7, 7, 2, True), (7, 7, 2, False), (None, None, 1, True)],
            key=str,
        )

    def test_a_full_filter_and_many_pieces_give_the_same(self, spark, monkeypatch):
        rows = [(i, f"t{i % 700}") for i in range(2000)]
        want = self.groups(frame(spark, rows))
        monkeypatch.setattr(exact_dedup, "PIECE_WORDS", 90)
        assert self.groups(frame(spark, rows)) == want
        monkeypatch.setattr(exact_dedup, "filter_entry", lambda *_: {"word": F.lit(1).cast("long"), "mask": F.lit(3).cast("long")})
        assert self.groups(frame(spark, rows)) == want
        assert sum(k for *_, k in want) == 700

    def test_rows_without_a_partner_are_not_shuffled(self, spark):
        hashes = frame(spark, [(i, str(i % 9900)) for i in range(10_000)]).selectExpr("doc_id", "sha2(text, 256) text_sha256")
        kept = exact_dedup.repeated_bits(hashes, 1 << 12)
        maybe = exact_dedup.possibly_repeated(hashes, kept, 1 << 12).filter("maybe")
        assert 200 <= maybe.count() <= 260
        assert maybe.filter("doc_id < 100 or doc_id >= 9900").count() == 200
        masks = hashes.select(exact_dedup.filter_entry(F.col("text_sha256"), 1 << 12)["mask"].alias("mask"))
        assert masks.filter("bit_count(mask) <> 2").isEmpty()

    def test_empty_and_clashing_columns(self, spark):
        assert self.groups(frame(spark, [])) == []
        df = frame(spark, [(1, "a", "k", 3, True)], "doc_id long, text string, text_sha256 string, copies int, kept boolean")
        assert self.groups(df) == [(1, 1, 1, True)]


class TestLines:
    def kept(self, df, **more):
        return line_dedup.dedup_lines(df, **more)

    def test_against_brute_force(self, spark):
        rng = random.Random(3)
        pool = [f" Line {i} " for i in range(30)] + ["", "  ", "\tLINE 1", "é", "É"]
        texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12))) for _ in range(80)] + [None, "", "\n", "a\r\nb"]
        df = frame(spark, list(enumerate(texts)))
        got = {r.doc_id: (r.text, r["__n_lines"], r["__n_lines"] - r["__n_dropped"]) for r in self.kept(df).collect()}
        want = brute.dedup_lines(texts)
        dropped_all = {i for i, t in enumerate(texts) if want[i] == "" and got[i][2] == 0}
        for i, text in enumerate(texts):
            assert got[i][0] == want[i]
            assert got[i][1] == len((text or "").split("\n"))
            assert i in dropped_all or got[i][2] == len(want[i].split("\n"))

    def test_repeated_rows_count_as_documents(self, spark):
        df = frame(spark, [(1, "same\nown")] * 10 + [(2, "same"), (3, "other")])
        got = sorted((r.doc_id, r.text) for r in self.kept(df).collect())
        assert got == [(1, "")] * 10 + [(2, ""), (3, "other")]

    def test_null_ids_other_columns_and_empty(self, spark):
        df = frame(spark, [(None, "a", 1, "x"), (1, None, 2, None)], "doc_id long, text string, gone int, row_key string")
        got = sorted((r.doc_id, r.text, r.gone, r.row_key) for r in self.kept(df, min_docs=2).collect() if r.doc_id)
        assert got == [(1, "", 2, None)]
        assert self.kept(frame(spark, [])).collect() == []

    def test_hot_shards_are_cut(self, spark, monkeypatch):
        df = frame(spark, [(i, f"shared\nown {i}") for i in range(300)])
        monkeypatch.setattr(line_dedup, "SHARD_PROBES", 50)
        monkeypatch.setattr(line_dedup, "SHARD_LINES", 100)
        assert {(r.doc_id, r.text) for r in self.kept(df).collect()} == {(i, f"own {i}") for i in range(300)}

    def test_a_minimal_perfect_hash(self):
        import numpy as np

        keys = np.random.default_rng(0).integers(0, 2**63, 20_000, dtype=np.uint64)
        levels = line_dedup.build_levels(keys)
        assert sorted(line_dedup.slots(keys, levels)) == list(range(20_000))
        assert sum(map(len, levels)) < 4 * 20_000


class TestNear:
    def result(self, df):
        return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}

    def test_against_brute_force(self, spark):
        texts, n = {}, 0
        for family in range(25):
            base = words(family, 200)
            for member in range(6):
                texts[n] = changed(base, n, member * 2)
                n += 1
        chain = words(99, 300)  # each close to the next only
        for step in range(8):
            texts[n] = chain = changed(chain, n, 6)
            n += 1
        passage = words(1000, 60)
        for i in range(40):
            texts[n] = f"{words(2000 + i, 90)} {passage} {words(3000 + i, 60)}"
            n += 1
        texts |= {n: "one two", n + 1: "ONE  two", n + 2: "", n + 3: None, n + 4: " \n", n + 5: "a", n + 6: "É a", n + 7: "é a"}
        assert self.result(frame(spark, list(texts.items()))) == brute.near_duplicates(texts)

    def test_a_large_group_whose_members_differ_from_each_other(self, spark):
        base = words(5, 400)
        texts = {i: changed(base, i, 12) for i in range(300)}
        assert self.result(frame(spark, list(texts.items()))) == brute.near_duplicates(texts)

    def test_blocks_of_a_bucket_find_all_links(self, spark, monkeypatch):
        monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 7)
        monkeypatch.setattr(minhash, "COLUMNS", 16)
        base = words(6, 300)
        texts = {i: changed(base, i, 12) for i in range(60)}
        assert self.result(frame(spark, list(texts.items()))) == brute.near_duplicates(texts)

    def test_nulls_repeated_rows_and_empty(self, spark):
        rows = [(None, "a b c"), (None, None), (5, "a b c"), (5, "a b c"), (9, "a b c"), (9, "other"), (3, "other")]
        got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect()), key=str)
        assert got == sorted([(None, None, True)] * 2 + [(5, 3, False)] * 2 + [(9, 3, False)] * 2 + [(3, 3, True)], key=str)
        assert self.result(frame(spark, [])) == {}

    def test_a_row_repeated_very_often(self, spark):
        base = words(8, 120)
        rows = [(7, base)] * 400 + [(9, changed(base, 1, 2)), (3, words(9, 120))]
        got = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect()]
        assert sorted(got) == sorted([(7, 7, True)] * 400 + [(9, 7, False), (3, 3, True)])

    def test_near_rows_that_are_each_repeated_have_one_set(self, spark, monkeypatch):
        base, seen, confirmed = words(10, 120), [], minhash.confirmed

        def spy(pairs, sets):
            seen.extend(r.node for r in sets.select("node").collect())
            assert len(seen) == len(set(seen))
            return confirmed(pairs, sets)

        monkeypatch.setattr(minhash, "confirmed", spy)
        rows = [(7, base)] * 3000 + [(9, changed(base, 1, 2))] * 3000 + [(3, words(9, 120))]
        got = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect()]
        assert sorted(got) == sorted([(7, 7, True)] * 3000 + [(9, 7, False)] * 3000 + [(3, 3, True)])
        assert sorted(seen) == [7, 9]

    def test_texts_that_share_an_id_each_find_their_copies(self, spark):
        one, two = words(11, 120), words(12, 120)
        rows = [(5, one)] * 3 + [(5, two), (5, two.upper())] + [(9, changed(one, 1, 2)), (10, changed(two, 2, 2)), (4, words(13, 120))]
        got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(frame(spark, rows)).collect()}
        assert got == {(5, 5), (9, 5), (10, 5), (4, 4)}

    def test_clashing_columns_and_long_text(self, spark):
        df = frame(spark, [(1, words(1, 60_000), "x", 2), (2, words(1, 60_000), "y", 3)], "doc_id long, text string, node string, label int")
        assert {k: v[1:] for k, v in self.result(df).items()} == {1: (1, True), 2: (1, False)}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(3, 2), (2, 3), (9, 7), (7, 8)]])
def test_components(spark, edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(find(k) == v for k, v in got.items())
    assert {k for k in parent if find(k) != k} <= set(got)


def test_blocks_hold_few_members_of_a_bucket_that_most_rows_share(spark, monkeypatch):
    """One component holds nearly all members of a bucket; each of the others still meets them all."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 50)
    rows = [(1, n, 10, [0, 0, 0, 0], 0 if n > 7 else n, n <= 7 and n > 0) for n in range(2000)]
    kinds = "bucket long, node long, n_shingles long, sketch array<long>, label long, outside boolean"
    outside, every = minhash.dealt(frame(spark, rows, kinds), shingles=False)
    key = ["bucket", "row", "column"]
    sizes = every.groupBy(*key).agg(F.count("*").alias("n")).join(outside.groupBy(*key).agg(F.count("*").alias("m")), key, "full").collect()
    assert sum(r.n for r in sizes) == 2000 and max(r.n for r in sizes) < 100 and all(r.m == 7 for r in sizes)
    met = outside.select("node", *key).join(every.select(F.col("node").alias("other"), *key), key)
    assert met.select("node", "other").distinct().count() == 7 * 2000
