"""Spelling variants, prefix tries and SimHash groups against plain versions."""

from __future__ import annotations

import random

import pytest
import xxhash

from sluice.llm import prefix_trie, simhash, spelling
from tests.llm import brute

DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class TestSpelling:
    def check(self, spark, rows, **more):
        want = sorted(brute.spelling_variants(rows, **more), key=str)
        assert rows_of(spelling.spelling_variants(frame(spark, rows), **more)) == want
        return want

    def texts(self, seed, n, alphabet="abé"):
        rng = random.Random(seed)
        return [(i, " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 8))) for _ in range(120))) for i in range(n)]

    def test_against_all_pairs(self, spark):
        chain = [(101, "mmmma " * 3 + "mmmmb " * 7 + "mmmcb " * 15)]
        want = self.check(spark, self.texts(1, 25) + chain)
        assert any(form for _, form, *_ in want) and any(root != form for _, form, root, *_ in want if form)

    def test_lists_cut_again_give_the_same(self, spark, monkeypatch):
        monkeypatch.setattr(spelling, "LIST", 3)
        monkeypatch.setattr(spelling, "TASK_ROWS", 200)
        self.check(spark, self.texts(2, 20, "abcd"), min_count=1)

    def test_a_small_table_of_counts_is_flushed(self, monkeypatch, spark):
        rows = self.texts(3, 10)
        monkeypatch.setattr(spelling, "FLUSH", 5)
        self.check(spark, rows)

    def test_nulls_ties_case_other_letters_and_long_texts(self, spark):
        rows = [(None, "aaaaa AAAAA aaaaa"), (None, None), (1, ""), (2, "aaaab aaaab aaaab baaaa baaaa baaaa aaaa\u00d7 aaaa\u00f7"), (3, "caf\u00c9s \u00c9t\u00e9s\u00df " * 9)]
        rows += [(4, "stra\u00dfe\u0161en stra\u00dfe1 \U0001f600stra\u00dfe " * 5), (5, "aaaab " * 20_000), (5, "aaaab " * 3), (6, "x" * 50_000)]
        want = self.check(spark, rows)
        assert {"caf\u00c9s", "stra\u00dfe"} <= {w for w, *_ in want}

    def test_near_words_in_a_sorted_list(self):
        rng = random.Random(4)
        for _ in range(300):
            words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(0, 6))) for _ in range(rng.randrange(1, 30))})
            want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if brute.one_edit(words[i], words[j])]
            assert sorted(spelling.near_in_list(words)) == want

    def test_broken_bytes_clashing_columns_and_empty(self, spark):
        assert rows_of(spelling.spelling_variants(frame(spark, []))) == []
        df = frame(spark, [(1, "w", 2, "k")], "doc_id long, text string, n int, `a.b` string, form string".replace(", form string", ""))
        df = df.selectExpr("doc_id", "cast(concat(unhex('66616C6C73FF'), cast('fells fells fells falls falls' as binary)) as string) text", "n", "`a.b`")
        assert rows_of(spelling.spelling_variants(df)) == sorted(brute.spelling_variants([(1, "falls fells fells fells falls falls")]), key=str)


class TestPrefixTrie:
    def check(self, spark, rows):
        want = sorted(brute.prefix_trie(rows), key=str)
        assert rows_of(prefix_trie.prefix_trie(frame(spark, rows, TURNS))) == want
        return want

    def turns(self, seed, n, longest=7):
        rng = random.Random(seed)
        return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "d  e\tf"])) for c in rng.sample(range(-60, 400), n) for t in range(rng.randrange(1, longest))]

    def test_against_a_plain_trie(self, spark):
        want = self.check(spark, self.turns(1, 150))
        assert max(x[4] for x in want) > 3 and any(x[6] for x in want)

    def test_paths_longer_than_a_block_and_many_shards(self, spark, monkeypatch):
        monkeypatch.setattr(prefix_trie, "BLOCK", 4)
        monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 50)
        same = [(c, t, "user", f"t{t % 3}") for c in (40, 41, 42, 777) for t in range(23)]
        self.check(spark, self.turns(2, 80, 14) + same)

    def test_one_conversation_holds_most_rows(self, spark, many_ranges):
        self.check(spark, [(20, t, "user", f"w{t % 7}") for t in range(2500)] + [(c, t, "user", "w0") for c in (20, 25, 39) for t in (-5, -4)])

    def test_nulls_ties_repeated_rows_and_absent_heads(self, spark):
        rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 0, "b", "x"), (1, 0, "a", "y"), (None, 1, "user", "none")]
        rows += [(41, 0, "user", "short"), (c := 57, 0, "user", "p"), (c, 1, "user", "q"), (60, 0, "u", "h"), (61, 5, "u", "h"), (61, 7, "u", "h" * 100_000)]
        want = self.check(spark, rows)
        assert (None in {x[2] for x in want}) and all(x[0] is not None for x in want)

    def test_one_conversation_repeated_often(self, spark):
        self.check(spark, [(c, t, "user", "hi there") for c in range(3000) for t in range(2)])

    def test_broken_bytes_clashing_columns_and_empty(self, spark):
        assert rows_of(prefix_trie.prefix_trie(frame(spark, [], TURNS))) == []
        rows = [(c, 0, "u", "ab"[c % 2]) for c in range(1, 14)]
        df = frame(spark, [(*x, 3, 4) for x in rows], f"{TURNS}, place int, `a.b` int")
        df = df.selectExpr("conv_id", "turn", "role", "cast(unhex(if(text = 'a', 'FF', 'FE')) as string) text", "place", "`a.b`")
        assert rows_of(prefix_trie.prefix_trie(df)) == sorted(brute.prefix_trie(rows), key=str)

    def test_two_prefixes_with_one_digest_are_found(self, spark):
        kinds = "conv_id long, place long, t1 long, t2 long, words long, d1 long, d2 long, u1 long, u2 long"
        paths = spark.createDataFrame([(1, 1, 5, 5, 1, 7, 7, 0, 0), (2, 1, 6, 6, 1, 7, 7, 0, 0)], kinds)
        with pytest.raises(Exception, match="one digest"):
            prefix_trie.distinct_nodes(paths).collect()


class TestSimHash:
    def result(self, df):
        return {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()}

    def texts(self, families=20, members=8):
        out, rng = {}, random.Random(5)
        for family in range(families):
            base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 2, 3, 40, 300]))]
            for _ in range(members):
                words = list(base)
                for _ in range(rng.randrange(3)):
                    words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
                out[len(out)] = rng.choice([" ", "\n"]).join(words)
        return out | {len(out): None, len(out) + 1: "", len(out) + 2: " \t", len(out) + 3: "One", len(out) + 4: "oNE \u00c9"}

    def test_against_all_pairs(self, spark):
        texts = self.texts()
        want = brute.simhash_groups(texts)
        assert self.result(frame(spark, list(texts.items()))) == want
        assert any(component != i for i, (_, component) in want.items())

    def test_fingerprints_of_blocks(self, monkeypatch):
        text = " ".join(f"w{i % 91}" for i in range(1000))
        monkeypatch.setattr(simhash, "BLOCK", 7)
        for n in (1, 2, 3, 4, 9, 10, 500):
            part = " ".join(text.split()[:n])
            assert simhash.fingerprint(part.encode()) == brute.simhash(part)

    def classes(self, prints):
        parent = {x: x for x in prints}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, x in enumerate(prints):
            for y in prints[i + 1 :]:
                if (x ^ y).bit_count() <= 2:
                    parent[find(x)] = find(y)
        return {x: find(x) for x in prints}

    @pytest.mark.parametrize("group", [8, 40, 10_000])
    def test_dense_groups_are_cut_and_lose_no_link(self, spark, monkeypatch, group):
        monkeypatch.setattr(simhash, "GROUP", group)
        monkeypatch.setattr(simhash, "CHUNK", 100)
        rng = random.Random(6)
        prints = {rng.getrandbits(64) for _ in range(200)}
        for base in rng.sample(sorted(prints), 6):
            prints |= {base ^ sum(1 << b for b in rng.sample(range(0, 64, 5), rng.randrange(5))) for _ in range(60)}
        prints = sorted(prints)
        signed = [x - (1 << 64) if x >> 63 else x for x in prints]
        links = simhash.fingerprint_links(frame(spark, [(x, i) for i, x in enumerate(signed)], "fp long, node long"))
        from sluice.llm.components import components

        label = {r.node: r.label for r in components(links).collect()}
        want = self.classes(prints)
        got = {x: label.get(i, i) for i, x in enumerate(prints)}
        assert len(set(zip(want.values(), got.values(), strict=False))) == len(set(want.values())) == len(set(got.values()))
        assert {(want[x], got[x]) for x in prints} == {(want[prints[got[x]]], got[x]) for x in prints}

    def test_nulls_repeated_rows_broken_bytes_and_empty(self, spark):
        assert self.result(frame(spark, [])) == {}
        rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "A  b c\nd"), (3, None), (4, "")]
        got = rows_of(simhash.simhash_groups(frame(spark, rows)))
        same = f"{brute.simhash('a b c d'):016x}"
        assert got == sorted([(None, same, None), (5, same, 5), (5, same, 5), (9, same, 5), (3, "0" * 16, 3), (4, "0" * 16, 3)], key=str)
        df = frame(spark, [(1, "x", 2, 3)], f"{DOCS}, fp int, `a.b` int").selectExpr("doc_id", "cast(unhex('FF20FE') as string) text", "fp", "`a.b`")
        assert self.result(df) == {1: (f"{xxhash.xxh64_intdigest(bytes([255, 32, 254]), seed=42):016x}", 1)}

    def test_a_very_long_text_and_a_text_repeated_often(self, spark):
        long = " ".join(f"w{i % 1000}" for i in range(250_000))
        got = self.result(frame(spark, [(1, long), (2, long.upper())] + [(i, "so often") for i in range(10, 3000)]))
        assert got[2] == got[1] == (f"{brute.simhash(long):016x}", 1)
        assert {got[i][1] for i in range(10, 3000)} == {10}
