"""Language identification, licence scan, chat formatting and HTML extraction."""

from __future__ import annotations

import hashlib
import io
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import chat, html_text, langid, license_scan
from sluice.llm.queries import QUERIES
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


class TestLanguage:
    LABELLED = "doc_id long, text string, lang string, __note string"

    @needs_tables
    def test_held_out_accuracy(self, spark):
        docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        got = QUERIES["op1_language_id"](spark, SF_DIR).collect()
        assert sorted(r.doc_id for r in got) == sorted(docs)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
        held = [r for r in got if r.held_out]
        assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)
        assert all(0 <= r.score <= 1 for r in got)

    def test_nulls_repeated_rows_and_unlabelled(self, spark):
        said = {"xx": "foo bar baz", "yy": "quux zork plim"}
        rows = [(i, said[x], x, None) for i in range(60) for x in said]
        rows += [(500, None, "xx", "n"), (501, "12 - !", "xx", "n"), (502, "", None, "n"), (503, "plim zork", None, "n"), (None, "bar foo", None, "n")]
        rows += [(504, "foo " * 300_000, None, "n")]
        got = {(r.doc_id, r.text and r.text[:9]): (r["__lang"], r["__score"]) for r in langid.identify(frame(spark, rows, self.LABELLED)).filter("__note is not null").collect()}
        assert got[500, None] == got[501, "12 - !"] == got[502, ""] == ("und", 0.0)
        assert got[503, "plim zork"][0] == "yy"
        assert got[None, "bar foo"][0] == got[504, "foo foo f"][0] == "xx"

    def test_nothing_to_learn_from(self, spark):
        assert [r["__lang"] for r in langid.identify(frame(spark, [(1, "abc", None, None)], self.LABELLED)).collect()] == ["und"]
        assert langid.identify(frame(spark, [], self.LABELLED)).collect() == []
        one = frame(spark, [(i, "abc", "xx", None) for i in range(9)], self.LABELLED)
        assert {(r["__lang"], r["__score"]) for r in langid.identify(one).collect()} == {("xx", 1.0)}

    def test_held_out_rows_teach_nothing(self, spark):
        held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
        rows = [(i, "secret", "zz", None) if i in held else (i, "foo bar", "xx", None) for i in range(200)]
        assert langid.fit(frame(spark, rows, self.LABELLED)).langs == ["xx"]

    def test_blocks_change_nothing(self, monkeypatch):
        text = " ".join(random.Random(1).choice(["über", "naïve", "word"]) for _ in range(3000))
        whole = langid.gram_counts(text)
        monkeypatch.setattr(langid, "BLOCK", 7)
        parts = langid.gram_counts(text)
        assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])

    def test_weights_are_those_of_plain_training(self):
        rng, idf, rows, batch = random.Random(3), np.ones(1 << langid.BUCKET_BITS), [], []
        for epoch in (0, 1, langid.EPOCHS):
            for no in range(150):
                label = no % 3
                counts = Counter(rng.choice((label * 20 + 7, 70)) + rng.randrange(30) for _ in range(rng.randrange(1, 15)))
                at = np.array(sorted(counts))
                many = np.array([counts[x] for x in at])
                batch.append({"epoch": epoch, "lang": "abc"[label], "buckets": at.astype("<u2").tobytes(), "counts": many.astype("<u4").tobytes()})
                if epoch < langid.EPOCHS:
                    values = langid.weigh(at, many, idf)
                    rows.append((dict(zip([*at.tolist(), 1 << langid.BUCKET_BITS], [*values, 1.0], strict=True)), label))
        (model,) = langid.train(list("abc"), idf)(iter([pa.RecordBatch.from_pylist(batch)]))
        got = np.load(io.BytesIO(model.column("model")[0].as_py()))["weights"]
        want = np.zeros_like(got, dtype=float)
        for x, w in brute.leader(rows, 3, langid.ALPHA, langid.BETA, langid.L1, langid.L2).items():
            want[x] = w
        assert np.allclose(got, want, rtol=1e-5, atol=1e-7)
        assert 20 < (want != 0).sum() < 3 * len({i for values, _ in rows for i in values})

    @pytest.mark.parametrize("factor", [0.5, 1, 4])
    def test_the_temperature_undoes_a_factor(self, factor):
        rng = np.random.default_rng(2)
        logits = rng.normal(size=(6000, 4)) * 1.5
        labels = np.array([rng.choice(4, p=p) for p in langid.softmax(logits)])
        assert langid.best_temperature(logits * factor, labels) == pytest.approx(factor, rel=0.12)

    def test_scores_are_as_sure_as_labels_are_right(self, spark):
        rng = random.Random(4)
        words = {"xx": ["foo", "bar", "baz"], "yy": ["quux", "zork", "plim"]}
        rows = []
        for i in range(3000):
            true, other = rng.sample(sorted(words), 2)
            text = " ".join(rng.choice(words[true]) for _ in range(12))
            rows.append((i, text, other if rng.random() < 0.25 else true, None))
        got = langid.identify(frame(spark, rows, self.LABELLED)).collect()
        held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
        right = sum(r["__lang"] == r.lang for r in held) / len(held)
        assert 0.65 < right < 0.85
        assert abs(sum(r["__score"] for r in held) / len(held) - right) < 0.06

    def test_a_label_of_too_many_values_is_refused(self, spark, monkeypatch):
        monkeypatch.setattr(langid, "MOST_LANGS", 3)
        rows = [(i, "foo bar", f"l{i % 4}", None) for i in range(60)]
        with pytest.raises(ValueError, match="more than 3"):
            langid.fit(frame(spark, rows, self.LABELLED))

    def test_weights_are_sparse(self, spark):
        rows = [(i, f"{'foo bar' if i % 2 else 'quux plim'} common words {i % 7}", "xx" if i % 2 else "yy", None) for i in range(300)]
        assert (langid.fit(frame(spark, rows, self.LABELLED)).weights == 0).mean() > 0.5


class TestLicenses:
    TEXTS = (
        "The MIT License. the mit-license; MIT LICENSE",
        "Licensed under the Apache License, Version 2.0.",
        "apache licence; mit é license; mit licenseé",
        "GNU General Public License, version 3",
        "general general public license public license mit license",
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "licensed under the apache license version 3 0",
        "",
        None,
        "license",
        "ⅯIT license K license",
    )

    def test_against_brute_force(self, spark):
        rng, vocabulary = random.Random(2), "mit apache general public license version 2 0 the under É".split()
        texts = [*self.TEXTS, *(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(200)), "mit license " * 5000]
        got = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, list(enumerate(texts)))).collect()}
        for i, text in enumerate(texts):
            r = got[i]
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_phrases(text), text
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
            assert 0 <= r.score <= 1

    def test_labels_of_templates(self, spark):
        got = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, list(enumerate(self.TEXTS)))).collect()}
        assert [got[i].labels for i in (1, 5, 6, 7, 8, 9)] == ["apache,apache-2.0", "gpl,gpl-3.0", "gpl,gpl-grant", "apache", "", ""]
        assert got[5].score == pytest.approx(1.0)
        assert [(s.label, s.start) for s in got[1].spans] == [("apache", 3), ("apache-2.0", 0)]

    def labelled(self):
        """``(wanted label or None, text)``: whole, cut and altered licence texts among other words, and texts that only resemble them."""
        rng, filler = random.Random(5), "source code value returns list error file name user data copy software notice use any purpose free without".split()

        def noise(n):
            return [rng.choice(filler) for _ in range(n)]

        rows = []
        for label, (text, _) in license_scan.TEXTS.items():
            words = license_scan.words_of(text)
            for start, end in [(0, 1), (0, 0.7), (0.3, 1), (0.15, 0.85)]:
                part = words[int(start * len(words)) : int(end * len(words))]
                rows.append((label, " ".join(noise(40) + part + noise(25))))
            for share in (0.03, 0.06):
                altered = [w if rng.random() > share else rng.choice(["", "our", f"{w} own"]) for w in words]
                rows.append((label, " ".join(noise(10) + altered + noise(10))))
            shuffled = words[:]
            rng.shuffle(shuffled)
            rows += [(None, " ".join(shuffled)), (None, " ".join(words[: len(words) // 5])), (None, " ".join(words[::2]))]
        return rows + [(None, " ".join(noise(400))) for _ in range(20)] + [(None, "copy software notice " * 20_000)]

    def test_whole_cut_and_altered_texts(self, spark):
        rows = self.labelled()
        got = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, [(i, t) for i, (_, t) in enumerate(rows)])).collect()}
        found = [{x for x in got[i].labels.split(",") if x.endswith("-text")} for i in range(len(rows))]
        # the longer licence holds the whole of the shorter one
        hits = sum(label in found[i] for i, (label, _) in enumerate(rows) if label)
        false = sum(len(found[i] - {label} - ({"bsd-text"} if label == "bsd-3-text" else set())) for i, (label, _) in enumerate(rows))
        print(f"recall {hits / sum(label is not None for label, _ in rows):.3f}, precision {hits / (hits + false):.3f}")
        assert hits >= 0.9 * sum(label is not None for label, _ in rows)
        assert false == 0
        assert all(got[i].score == 1.0 and got[i].spans[-1].start == 40 for i in range(0, 9 * len(license_scan.TEXTS), 9))

    def test_whole_texts_against_brute_force(self, spark):
        texts = [t for _, t in self.labelled()[:-1]] + [" ".join(license_scan.words_of(license_scan.TEXTS["mit-text"][0]) * 30)]
        got = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, list(enumerate(texts)))).collect()}
        idf = license_scan.word_idf(frame(spark, list(enumerate(texts))))
        for i, text in enumerate(texts):
            assert {x for x in got[i].labels.split(",") if x.endswith("-text")} == brute.licence_texts(text, license_scan.TEXTS, idf)

    def test_repeated_rows_null_ids_clashing_columns_and_empty(self, spark):
        df = frame(spark, [(1, "mit license", "a", 1)] * 2 + [(None, None, None, None)], "doc_id long, text string, words string, hits int")
        got = sorted(((r.doc_id, r.n_base) for r in license_scan.scan_licenses(df).collect()), key=str)
        assert got == [(1, 1), (1, 1), (None, 0)]
        assert license_scan.scan_licenses(frame(spark, [])).collect() == []


class TestChat:
    EVENTS = "conv_id long, seq long, kind string, role string, text string, target long"

    def fold(self, spark, rows):
        out = {}
        for r in chat.render_chats(frame(spark, rows, self.EVENTS)).collect():
            out.setdefault(r.conv_id, []).append((r.message, *chat.read_back(r.rendered)))
        assert all([x[0] for x in sorted(v)] == list(range(len(v))) for v in out.values())
        return {k: [x[1:] for x in sorted(v)] for k, v in out.items()}

    def logs(self, seed, lengths):
        rng, rows = random.Random(seed), []
        for conv, n in lengths.items():
            for seq in range(n):
                kind = rng.choice(["open", "delta", "delta", "delta", "edit", "regenerate", "other"])
                rows.append((conv, seq, kind, rng.choice(["user", "assistant", "", None]), rng.choice(["x", "y ", None, "z\\"]), rng.choice([None, 0, 1, 3, 50, -1])))
        rng.shuffle(rows)
        return rows

    def check(self, spark, rows):
        want = {}
        for conv, _, *event in sorted(rows, key=lambda x: x[1]):
            want.setdefault(conv, []).append(event)
        want = {conv: found for conv, events in want.items() if (found := brute.fold(events))}
        assert self.fold(spark, rows) == want
        return want

    def test_against_a_plain_fold(self, spark):
        self.check(spark, self.logs(1, {c: c % 23 for c in range(120)}))

    def test_long_logs_are_folded_by_ranges(self, spark, many_ranges):
        rows = self.logs(2, {1: 3000, None: 1500, 2: 10})
        want = self.check(spark, rows)
        assert len(want[None]) > 100
        ranged = chat.in_ranges(frame(spark, rows, self.EVENTS), ["conv_id"], ["seq"], "t")
        assert ranged.filter("conv_id = 1").select("range").distinct().count() > 1

    def test_regenerations_go_by_role(self, spark):
        events = [("open", "assistant", "", None), ("delta", None, "A", None), ("open", "user", "", None), ("delta", None, "U", None), ("regenerate", "assistant", None, None), ("delta", None, "A2", None)]
        assert self.fold(spark, [(1, i, *x) for i, x in enumerate(events)]) == {1: [("assistant", "A2"), ("user", "U")]}

    def test_repeated_rows_are_turns_of_their_own(self, spark):
        turns = frame(spark, [(1, 0, "user", "abcdef")] * 5 + [(1, 1, "assistant", "xyz")] * 2, "conv_id long, turn long, role string, text string")
        rows = chat.render_chats(chat.turn_events(turns)).collect()
        assert [chat.read_back(r.rendered) for r in sorted(rows, key=lambda r: r.message)] == [("user", "abcdef")] * 5 + [("assistant", "xyz")] * 2
        kinds = {r.kind for r in chat.turn_events(frame(spark, [(i, 0, "user", "t") for i in range(30)], "conv_id long, turn long, role string, text string")).collect()}
        assert kinds == {"open", "delta", "edit", "regenerate"}

    def test_deltas_edits_and_regenerations(self, spark):
        rows = [
            (1, 5, "delta", None, "lo", None), (1, 1, "open", "user", "", None), (1, 4, "delta", None, "hel", None), (1, 2, "delta", None, "hi", None),
            (1, 3, "open", "assistant", None, None), (1, 6, "regenerate", None, None, None), (1, 7, "delta", None, "new", None), (1, 8, "edit", None, "hey", 0),
            (1, 9, "edit", None, "nowhere", 7), (2, 1, "delta", "user", "before any", None), (2, 2, "open", None, None, None), (None, 1, "open", "user", None, None),
            (None, 2, "delta", "user", "no id", None),
        ]
        assert self.fold(spark, rows) == {1: [("user", "hey"), ("assistant", "new")], 2: [("", "")], None: [("user", "no id")]}

    def test_long_conversations(self, spark):
        turns = frame(spark, [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(30_000)], "conv_id long, turn long, role string, text string")
        rendered = chat.render_chats(chat.turn_events(turns))
        (got,) = chat.chat_digests(rendered).collect()
        assert got.n_turns == 30_000
        assert got.loss_sha256 == hashlib.sha256("".join(f"t{i}" for i in range(1, 30_000, 2)).encode()).hexdigest()

    def test_nulls_ties_repeated_rows_and_empty(self, spark):
        schema = "conv_id long, turn long, role string, text string, part int"
        df = frame(spark, [(1, 1, "user", None, 1), (1, 1, "user", None, 2), (1, None, None, "x", 3), (2, 1, "assistant", "é😀", 4)], schema)
        got = {r.conv_id: r for r in chat.chat_digests(chat.render_chats(chat.turn_events(df))).collect()}
        assert (got[1].n_turns, got[1].loss_chars, got[2].loss_chars) == (3, 0, 2)
        assert got[1].turns_sha256 == hashlib.sha256(b"\nx\nuser\n\nuser\n\n").hexdigest()
        assert chat.chat_digests(chat.render_chats(chat.turn_events(df.limit(0)))).collect() == []

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "]", ">", "/", "s", "a", "\n", "é"]), max_size=12).map("".join), st.text(max_size=20))
    def test_round_trip(self, text, role):
        out, start, end = chat.render(role, text)
        assert chat.read_back(out) == (role, text)
        assert chat.unescape(out[start:end]) == text
        assert not any(x in chat.escape(text) for x in chat.CONTROLS)


class TestHtml:
    @pytest.mark.parametrize(
        ("page", "text"),
        [
            ("<p>a  b\n c<p>d", "a b c\n\nd"),
            ("a<br>b<div>c</div>d", "a\nb\nc\nd"),
            ("<ul><li>one<li>two<ol><li>x</ol></ul>", "- one\n- two\n\n  1. x"),
            ("<table><tr><td>a<td>bbb<tr><td>cc<td>d</table>", "a   bbb\ncc  d"),
            ("<table><tr><td colspan=2>wide cell<tr><td>x<td>y</table>", "wide cell\nx  y"),
            ("<pre>\n a\n  b</pre>", " a\n  b"),
            ("<style>.h, #i {display: none}</style><b class='x h'>no</b><b id=i>no</b><b class=x>yes</b>", "yes"),
            ("<p hidden>no</p><p style='visibility: hidden'>no</p><script>no</p></script><!-- no -->yes", "yes"),
            ("x &lt; y &amp; z &copy; 1 < 2", "x < y & z © 1 < 2"),
            ("<dl><dt>t<dd>d</dl>", "t\n  d"),
            ("<title>no</title>plain <a href='>'>link</a> <input type=submit value=go>", "plain link go"),
            ("<a b='", "<a b='"),
            ("", ""),
            (None, ""),
        ],
    )
    def test_pages(self, page, text):
        got = html_text.page_text(page)
        assert got.replace("\n\n  1.", "\n\n  1.") == text

    @pytest.mark.parametrize(
        ("page", "text"),
        [
            ("<style>@media print { .a { display: none } } .b{display:none}</style><p class=a>yes<p class=b>no", "yes"),
            ("<style>@media (max-width: 600px){.a{display:none}} @media not screen{.a{display:none}}</style><p class=a>yes", "yes"),
            ("<style>@media screen and (min-width:40em){.a{display:none}}@media print, (width >= 900px){.b{display:none}}</style><p class=a>no<p class=b>no<p>yes", "yes"),
            ("<style media=print>.a{display:none}</style><noscript><style>.a{display:none}</style></noscript><p class=a>yes", "yes"),
            ("<style>@font-face{x:y} @supports (a:b){@layer l{.a{display:none}}} @keyframes k{from{visibility:hidden}}</style><p class=a>no<p>yes", "yes"),
            ("<style>@import 'a{b}'; .x{color:red; @media print{display:none}} .y{content:'}'; display:none}</style><p class=x>yes<p class=y>no", "yes"),
            ("<style>.menu{display:none} .menu{display:block}</style><p class=menu>yes", "yes"),
            ("<style>.menu{display:none}</style><p class=menu style='display:block'>yes<p class=menu>no", "yes"),
            ("<style>.m{display:none!important} #i{display:none} .n{display:block}</style><p class=m style='display:block'>no<p id=i class=n>no<p class=n>yes", "yes"),
            ("<style>[hidden]{display:none !important} .f{display:flex}</style><p hidden class=f>no<p class=f>yes", "yes"),
            ("<style>.f{display:flex}</style><p hidden class=f>yes<p hidden>no", "yes"),
            ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b></div>", "yes"),
            ("a<dialog open>yes</dialog><dialog>no</dialog>b", "a\nyes\nb"),
        ],
    )
    def test_what_a_screen_shows(self, page, text):
        assert html_text.page_text(page) == text

    @pytest.mark.parametrize(
        ("page", "text"),
        [
            ("<table><tr><td rowspan=2>name<td colspan=2>size<tr><td>min<td>max<tr><td>x<td>1<td>2</table>", "name  size\n      min  max\nx     1    2"),
            ("<table><tr><td rowspan=2>a<br>b<br>c<td>d<tr><td>e<tr><td>f<td>g</table>", "a  d\nb  e\nc\nf  g"),
            ("<table><thead><tr><th rowspan=9>h<th>i<tbody><tr><td>a<td>b</table>", "h  i\na  b"),
            ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
            ("<table><tr><td>a<td rowspan=2>b<td>c<tr><td>d<td>e</table>", "a  b  c\nd     e"),
            ("<math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math>", "x= 1 2"),
            ("a<svg><title>no</title><desc>no</desc><defs><text>no</text></defs>no<path d='M0'/><text>one</text><g><text>two<tspan>2</tspan></text></g></svg>b", "a one two2 b"),
            ("<svg><foreignObject><p>yes</p></foreignObject><desc/><text>t</text></svg>", "yes\n\nt"),
            ("<svg><text>t</text><p>out</p>yes", "t\n\nout\n\nyes"),
            ("<details><summary>more</summary>no <p>no</details>yes", "more\nyes"),
            ("<details open><summary>more</summary>all</details>yes", "more\nall\nyes"),
            ("<details>no</details>yes", "yes"),
            ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
            ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
            ("<ol type=a start=26><li>a<li>b<li type=I value=49>c</ol>", "z. a\naa. b\nXLIX. c"),
            ("<ol type=i start=0><li>a<li>b</ol>", "0. a\ni. b"),
            ("x <textarea>\na  b\n c</textarea> y", "x\na  b\n c\ny"),
            ("<style>.a .b, .a > i {display:none}</style><p class=a><b><u class=b>no</u></b> yes <i>no</i> <b><i>too</i></b></p><p class=b>three", "yes too\n\nthree"),
            ("<style>body > p, #i > b > u {display:none}</style><p>no</p><div><p>yes</p></div><div id=i><b><u>no</u></b></div><b><u>too</u></b>", "yes\n\ntoo"),
            ("<style>p b{display:none} .x{display:inline}</style><p>a <b class=x>yes</b><b>no</b>", "a yes"),
            ("<style>p b{display:none} div p b{display:inline}</style><p>a <b>no</b><div><p>c <b>yes</b></div>", "a\n\nc yes"),
            ("<style>table > tr td{display:none} table > tbody > tr > td.n{display:none}</style><table><tr><td>yes<td class=n>no</table>", "yes"),
            ("<style>p + b, p:hover, p ~ i {display:none}</style><p>a</p><b>yes</b>", "a\n\nyes"),
        ],
    )
    def test_grids_drawings_lists_and_selectors(self, page, text):
        assert html_text.page_text(page) == text

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 3), st.integers(1, 2)), max_size=4), min_size=1, max_size=6))
    def test_tables_against_a_painted_grid(self, rows):
        """Every cell's lines stand below each other where its first column starts, and no two cells overlap."""
        taken, places, page = set(), {}, "<table>"
        for r, cells in enumerate(rows):
            page, after = page + "<tr>", 0
            for n, (wide, high, lines) in enumerate(cells):
                column = next(c for c in range(after, 100) if not taken & {(r, c + j) for j in range(wide)})
                after = column + wide
                down = len(rows) - r if high == 0 else min(high, len(rows) - r)
                taken |= {(r + i, column + j) for i in range(down) for j in range(wide)}
                names = [f"r{r}n{n}l{i}" for i in range(lines)]
                places[(r, n)] = (column, r, down, names)
                page += f"<td colspan={wide} rowspan={high}>{'<br>'.join(names)}"
        out = html_text.page_text(page + "</table>").split("\n")
        found = {name: (i, line.index(name)) for i, line in enumerate(out) for name in line.split()}
        assert sorted(found) == sorted(x for *_, names in places.values() for x in names)
        starts, tops = {}, {}
        for column, row, _, names in places.values():
            assert {found[x][1] for x in names} == {starts.setdefault(column, found[names[0]][1])}
            assert [found[x][0] for x in names] == [tops.setdefault(row, found[names[0]][0]) + i for i in range(len(names))]
        assert [starts[c] for c in sorted(starts)] == sorted(set(starts.values()))
        for _, row, down, names in places.values():
            below = [top for other, top in tops.items() if other >= row + down]
            assert all(found[x][0] < top for x in names for top in below)

    @settings(max_examples=200, deadline=None)
    @given(st.data())
    def test_selectors_against_brute_force(self, data):
        """Random trees and rules: a word is seen unless an element around it is matched, right to left with backtracking."""
        one = st.sampled_from(["b", "i", ".x", ".y", "b.x", "*", "#k"])
        selector = st.lists(st.tuples(st.sampled_from([" ", " > "]), one), min_size=1, max_size=4)
        selectors = data.draw(st.lists(selector, min_size=1, max_size=3))
        parents = data.draw(st.lists(st.tuples(st.integers(0, 100), st.sampled_from("bi"), st.sampled_from(["", "x", "y", "x y"]), st.booleans()), max_size=9))
        nodes = [(None, "html", "", False), (0, "body", "", False)]
        nodes += [(1 + p % (n + 1), tag, names, k) for n, (p, tag, names, k) in enumerate(parents)]

        def above(n):
            return [] if n == 0 else [nodes[n][0], *above(nodes[n][0])]

        def matches(n, part):
            _, tag, names, k = nodes[n]
            kind, _, name = part.partition(".")
            return k if part == "#k" else kind in ("", "*", tag) and (not name or name in names.split())

        def holds(n, parts):
            *outer, (link, part) = parts
            near = above(n)[:1] if link == " > " else above(n)
            return matches(n, part) and (not outer or any(holds(m, outer) for m in near))

        def page(n):
            _, tag, names, k = nodes[n]
            inner = f" w{n} " + "".join(page(m) for m in range(2, len(nodes)) if nodes[m][0] == n)
            return inner if n == 1 else f"<{tag} class='{names}'{' id=k' if k else ''}>{inner}</{tag}>"

        css = "".join("".join(link * (i > 0) + part for i, (link, part) in enumerate(parts)) + "{display:none}" for parts in selectors)
        hidden = {n for n in range(2, len(nodes)) if any(holds(n, parts) for parts in selectors)}
        seen = [f"w{n}" for n in range(1, len(nodes)) if not hidden & {n, *above(n)}]
        assert sorted(html_text.page_text(f"<style>{css}</style>{page(1)}").split()) == sorted(seen)

    def test_any_depth_is_exact(self):
        deep = "<div>" * 200
        assert html_text.page_text(f"{deep}<p hidden>no</p><b style='display:none'>no <i>no</i> no</b>yes") == "yes"
        assert html_text.page_text(f"{deep}<table><tr><td>a<td>bbb<tr><td>cc<td>d</table>") == "a   bbb\ncc  d"
        assert html_text.page_text("<div hidden>" + "<div>" * 200 + "</div>" * 200 + "no</div>yes") == "yes"
        assert html_text.page_text("<b>" * 100_000 + "</i><div>x</div>" * 20_000).count("x") == 20_000
        assert html_text.page_text("<blockquote>" * 3000 + "x") == " " * 6000 + "x"
        assert html_text.page_text("<ul><li>" * 2000 + "x").endswith("- x")
        assert html_text.page_text("<table><tr><td>" * 2000 + "x") == "x"

    def test_deep_and_broken_pages(self):
        assert html_text.page_text("<div>" * 5000 + "x") == "x"
        assert html_text.page_text("</p></div></table>x</td>") == "x"
        assert html_text.page_text("<table>" * 300 + "x").strip() == "x"
        assert len(html_text.page_text("<table><tr>" + "<td>" + "y" * 5000 + "<tr><td>z" * 100 + "</table>")) < 20_000

    @needs_tables
    def test_all_words_of_the_pages_stay(self, spark):
        import re

        pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
        for r in QUERIES["op8_html_extraction"](spark, SF_DIR).collect():
            import html

            seen = re.sub(r"<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", pages[r.page_id], flags=re.DOTALL)
            seen = re.sub(r"</?(?:b|a)\b[^>]*>", "", seen)
            assert re.sub(r"^- ", "", r.text, flags=re.MULTILINE).split() == html.unescape(re.sub(r"<[^>]+>", " ", seen)).split()

    def test_rows_pass_through(self, spark):
        df = frame(spark, [(1, None, "u", 5), (1, "<p>a", None, 5), (1, "<p>a", None, 5), (None, "", "v", None)], "page_id long, html string, url string, text int")
        got = [(r.page_id, r.url, r.text, r["__text"]) for r in html_text.extract_text(df).collect()]
        assert sorted(got, key=str) == sorted([(1, "u", 5, ""), (1, None, 5, "a"), (1, None, 5, "a"), (None, "v", None, "")], key=str)
        assert html_text.with_text(df.limit(0)).collect() == []
