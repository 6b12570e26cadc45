"""Nearest neighbours, mixing and packing."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import ann, mixing, packing
from sluice.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")
VECTORS = "vec_id long, embedding array<float>, part int"


def exact(rows, query, k=10):
    q = np.array(rows[query], dtype=np.float64)
    near = sorted((float(np.sqrt(((np.array(v, dtype=np.float64) - q) ** 2).sum())), i) for i, v in rows.items() if i != query)
    return near[:k]


class TestNeighbours:
    def found(self, spark, rows, every=10, k=10, schema=VECTORS):
        out = defaultdict(list)
        for r in ann.nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % every == 0, k).collect():
            out[r.query_id].append((r.rank, r.score, r.vec_id))
        for got in out.values():
            got.sort()
            assert [x[0] for x in got] == list(range(1, len(got) + 1))
            assert [x[1:] for x in got] == sorted(x[1:] for x in got)
        return {q: [x[1:] for x in got] for q, got in out.items()}

    def test_recall_on_random_and_clustered_vectors(self, spark):
        rng = np.random.default_rng(1)
        centres = rng.normal(size=(20, 32)) * 3
        for x in (rng.normal(size=(3000, 32)), centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 32))):
            rows = {i: v.astype(np.float32).tolist() for i, v in enumerate(x)}
            got = self.found(spark, [(i, v, 0) for i, v in rows.items()], 50)
            assert set(got) == set(range(0, 3000, 50))
            want = {q: exact(rows, q) for q in got}
            assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in got) >= 0.9 * 10 * len(got)
            assert all(d == pytest.approx(math.dist(rows[q], rows[i]), abs=1e-12) for q in got for d, i in got[q])

    def test_a_hot_vector_and_slices(self, spark, monkeypatch):
        monkeypatch.setattr(ann, "SLICE_ROWS", 40)
        monkeypatch.setattr(ann, "SLICE_QUERIES", 7)
        rng = np.random.default_rng(2)
        rows = {i: [1.0, 2.0, 3.0] if i % 3 else rng.normal(size=3).astype(np.float32).tolist() for i in range(900)}
        got = self.found(spark, [(i, v, 0) for i, v in rows.items()])
        hot = [q for q in got if q % 3]
        assert hot and all(got[q] == exact(rows, q) for q in hot)

    def test_large_parts_are_cut_again_at_any_size(self, spark, monkeypatch):
        monkeypatch.setattr(ann, "SAMPLE_ROWS", 512)
        monkeypatch.setattr(ann, "PART_MOST", 40)
        monkeypatch.setattr(ann, "PART_ROWS", 50)
        rng = np.random.default_rng(4)
        centres = rng.normal(size=(40, 16)) * 4
        for x in (rng.normal(size=(2000, 8)), centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16))):
            rows = {i: v.astype(np.float32).tolist() for i, v in enumerate(x)}
            df = spark.createDataFrame([(i, v, 0) for i, v in rows.items()], VECTORS)
            usable = ann.usable(df)
            index, models = ann.build_index(ann.written(usable.withColumn("part", F.lit(1).cast("long")), "t"), len(rows))
            sizes = [r.n for r in index.groupBy("part").agg(F.count("*").alias("n")).collect()]
            assert len(models) >= 3 and sum(sizes) == len(rows) and max(sizes) <= 40
            got = self.found(spark, [(i, v, 0) for i, v in rows.items()], 100)
            want = {q: exact(rows, q) for q in got}
            assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in got) >= 0.9 * 10 * len(got)
            assert "TakeOrderedAndProject" not in index._jdf.queryExecution().toString()

    def test_equal_vectors_are_indexed_by_their_smallest_ids(self, spark, monkeypatch):
        monkeypatch.setattr(ann, "PART_MOST", 5)
        monkeypatch.setattr(ann, "LEVELS", 2)
        rows = {i: [1.0, 1.0] if i < 190 else [1.0, float(i)] for i in range(200)}
        got = self.found(spark, [(i, v, 0) for i, v in rows.items()], 40)
        assert got == {q: exact(rows, q) for q in range(0, 200, 40)}

    def test_very_large_and_very_small_differences(self, spark):
        rows = [(i, [1e200 * (i + 1), -1e200], 0) for i in range(20)]
        got = self.found(spark, rows, schema=VECTORS.replace("float", "double"))
        assert {i for _, i in got[10][:2]} == {9, 11} and got[10][0][0] == pytest.approx(1e200) and len(got[0]) == 10
        d = ann.distances(np.array([[1e-200, 0.0], [1.7e308, 0.0], [3.0, 4.0]]), np.zeros(2))
        assert d == pytest.approx([1e-200, 1.7e308, 5.0], rel=1e-15)
        assert ann.distances(np.array([[0.9e308]]), np.array([-0.5e308])) == pytest.approx([1.4e308])

    def test_few_rows_bad_vectors_and_repeated_ids(self, spark):
        rows = [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1)]
        rows += [(6, [float("inf"), 1.0], 1), (7, [], 1), (8, [1.0], 1), (None, [1.0, 1.0], 1), (9, [1.0, 1.0], 1), (9, [1.0, 1.0], 1), (9, [5.0, 1.0], 1), (10, [1.0, 0.0], None), (10, [1.0, 0.0], 2)]
        assert self.found(spark, rows) == {0: [(0.0, 10), (1.0, 1), (1.0, 9)], 10: [(0.0, 0), (1.0, 1), (1.0, 9)]}

    def test_empty_and_alone(self, spark):
        assert self.found(spark, []) == {}
        assert self.found(spark, [(0, [1.0], 1)]) == {}
        assert self.found(spark, [(0, [0.0], 1)]) == {}

    def test_parts_are_balanced_and_cut_few_edges(self):
        rng = np.random.default_rng(3)
        x = rng.normal(size=(10, 8))[rng.integers(0, 10, 2000)] * 4 + rng.normal(size=(2000, 8))
        near = ann.neighbour_graph(x, 10)
        start = ann.first_parts(x, 16, np.random.default_rng(0))
        part = ann.balanced_parts(x, near, 16, np.random.default_rng(0))
        assert np.bincount(part, minlength=16).max() <= math.ceil(2000 / 16 * ann.IMBALANCE)
        assert (part[near] != part[:, None]).mean() < (start[near] != start[:, None]).mean()


class TestMixing:
    DOCS = "doc_id long, text string, source string, copies int, rank string"

    def test_targets(self, spark):
        sizes = {"a": 10, "b": 1000, "c": 40, "d": 300, None: 5}
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1], strict=True))
        want, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
        while free:  # the rule as it is stated
            level = left / sum(weights[s] for s in free)
            over = {s for s in free if weights[s] * level > 2 * sizes[s]}
            if not over:
                want |= {s: weights[s] * level for s in free}
                break
            want |= {s: 2.0 * sizes[s] for s in over}
            left -= sum(want[s] for s in over)
            free -= over
        assert got == pytest.approx(want)

    def test_words_taken(self, spark):
        rng = random.Random(4)
        rows = [(i, "w " * int(rng.paretovariate(1.2) * 20), rng.choice(["a", "a", "a", "b", "c", None]), 1, "x") for i in range(4000)]
        rows += [(5000, None, "a", 1, "x"), (5001, "", None, None, None), (None, "one two", "b", 1, "x")] + [(6000, "same words", "b", 1, "x")] * 3
        df = spark.createDataFrame(rows, self.DOCS)
        got = mixing.mix_plan(df).collect()
        assert len(got) == len(rows)
        assert sorted((r.doc_id, r.taken) for r in got if r.doc_id) == sorted((r.doc_id, r.taken) for r in mixing.mix_plan(df).collect() if r.doc_id)
        for source in ("a", "b", "c", None):
            own = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 0.01 * own[0].target + 20
            assert all(r.taken == r.copies * r.size and r.copies <= 2 for r in own)
            assert own[0].source_size == sum(r.size for r in own)
        mixed = mixing.mix(df)
        assert mixed.columns == df.columns
        assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in Counter(i for r in got for i in [r.doc_id] * r.copies).items()})

    @pytest.mark.parametrize("fillings", [0, 4])
    def test_goes_on_until_nothing_fits(self, spark, monkeypatch, fillings):
        monkeypatch.setattr(mixing, "FILLINGS", fillings)
        rng = random.Random(8)
        rows = [(i, "w " * rng.choice([1, 2, 3, 5, 40, 41, 43, 90, 350]), rng.choice("abc"), 1, "x") for i in range(700)]
        rows += [(None, "w " * n, "c", 1, "x") for n in range(30, 60)]
        got = mixing.mix_plan(spark.createDataFrame(rows, self.DOCS)).collect()
        for source in "abc":
            own = [r for r in got if r.source == source]
            left = own[0].target - sum(r.taken for r in own)
            whole = int(own[0].target // own[0].source_size)
            assert left >= 0 and all(r.size > left for r in own if r.copies == whole and whole < 2)
        assert len({r.copies for r in got if r.doc_id is None}) == 2

    def test_long_documents_are_certain(self, spark):
        rows = [(i, "w " * (500 if i < 3 else 2), s, 1, "x") for s in "ab" for i in range(300)]
        got = mixing.mix_plan(spark.createDataFrame([(i + 1000 * (s == "b"), t, s, c, r) for i, t, s, c, r in rows], self.DOCS)).collect()
        share = [r for r in got if r.source == "b"]
        assert abs(sum(r.taken for r in share) - share[0].target) <= 250

    def test_empty_and_wordless(self, spark):
        assert mixing.mix_plan(spark.createDataFrame([], self.DOCS)).collect() == []
        got = mixing.mix_plan(spark.createDataFrame([(1, None, None, 1, "x"), (2, " ", "a", 1, "x")], self.DOCS)).collect()
        assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


class TestPacking:
    def test_ids_are_the_tokenizers(self):
        path = packing.tokenizer_path()
        own, encode = Tokenizer.from_file(path), packing.encoder(path)
        rng = random.Random(5)
        texts = ["", " ", "a<|endoftext|>b", "it's 12345 naïve\n\n  x\t", "😀" * 5, "".join(chr(rng.randrange(1, 0xD800)) for _ in range(2000))]
        for text in texts:
            assert encode(text) == own.encode(text, add_special_tokens=False).ids

    def test_other_tokenizers_are_used_as_they_are(self):
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
        assert packing.encoder(path)("Hello there") == Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids

    @needs_tables
    def test_pieces_and_sequences_of_a_table(self, spark):
        own = Tokenizer.from_file(packing.tokenizer_path())
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        got, places = defaultdict(list), defaultdict(list)
        for r in QUERIES["op7_best_fit_packing"](spark, SF_DIR).collect():
            got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
            places[r.sequence_id].append((r.offset, r.length))
        for doc_id, text in texts.items():
            ids, at = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4"), 0
            for i, (piece, start, length, crc) in enumerate(sorted(got[doc_id])):
                assert (piece, start, crc) == (i, at, zlib.crc32(ids[at : at + length].tobytes()))
                assert length == 1024 or i == 0
                at += length
            assert at == len(ids)
        for place in places.values():
            assert [o for o, _ in sorted(place)] == list(np.cumsum([0, *(n for _, n in sorted(place))])[:-1])
            assert sum(n for _, n in place) <= 1024
        assert len(places) <= 1.02 * sum(n for x in places.values() for _, n in x) / 1024 + 1

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(1, 12), min_size=1, max_size=8), st.integers(0, 3))
    def test_fixed_sets_keep_an_optimum(self, lengths, _):
        def fewest(items, capacity=12):
            items, best = sorted(items, reverse=True), [len(items)]

            def place(i, rooms):
                if len(rooms) >= best[0]:
                    return
                if i == len(items):
                    best[0] = len(rooms)
                    return
                for r in sorted({r for r in rooms if r >= items[i]}):
                    rest = list(rooms)
                    rest.remove(r)
                    place(i + 1, [*rest, r - items[i]])
                place(i + 1, [*rooms, capacity - items[i]])

            best[0] += 1
            place(0, [])
            return best[0]

        counts = dict(Counter(lengths))
        fixed = packing.reduce_counts(counts, 12)
        used = sum(n for _, n in fixed)
        rest = [s for s, n in counts.items() for _ in range(n)]
        assert used + (fewest(rest) if rest else 0) == fewest(lengths)

    @settings(max_examples=100, deadline=None)
    @given(st.dictionaries(st.integers(1, 100), st.integers(1, 5000), min_size=1, max_size=40))
    def test_plans_hold_every_piece(self, counts):
        used = Counter()
        for pattern, times in packing.plan_sequences(counts, 100):
            assert times > 0 and sum(s * k for s, k in pattern) <= 100
            used.update({s: k * times for s, k in pattern})
        assert used == Counter(counts)

    def test_many_equal_lengths_nulls_and_empty(self, spark, monkeypatch):
        monkeypatch.setattr(packing, "CHUNK", 40)
        rows = [(i % 400, "same text here", "x", 1) for i in range(500)] + [(None, None, "y", 2), (7, "", None, None), (8, "word " * 300_000, "z", 3)]
        df = spark.createDataFrame(rows, "doc_id long, text string, chunk string, no int")
        got = packing.pack_documents(df, keep_ids=True).collect()
        assert sum(r.piece == 0 for r in got) == len(rows)
        assert all(len(r.ids) == r.length for r in got)
        places = defaultdict(list)
        for r in got:
            places[r.sequence_id].append((r.offset, r.length))
        assert all([o for o, _ in sorted(x)] == list(np.cumsum([0, *(n for _, n in sorted(x))])[:-1]) for x in places.values())
        assert packing.pack_documents(df.limit(0)).collect() == []
        assert packing.pack_documents(df.limit(0), keep_ids=True).collect() == []
        assert all(r.ids is None for r in packing.pack_documents(df.limit(3)).collect())

    def test_ids_of_large_vocabularies(self, spark, monkeypatch):
        df = spark.createDataFrame([(1, "same text here " * 900), (2, "")], "doc_id long, text string")

        def ids():
            return {(r.doc_id, r.piece): r.ids for r in packing.pack_documents(df, keep_ids=True).collect()}

        narrow = ids()
        assert packing.packed_type(packing.tokenizer_path()) == "<u2"
        monkeypatch.setattr(packing, "packed_type", lambda path: "<u4")
        assert ids() == narrow
        assert narrow[2, 0] == [2]
