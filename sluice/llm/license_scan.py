"""Licence scan by a positional index of rare words.

For every licence template the index holds the positions of its rarest words, by
document frequency over the whole corpus. A file's words are looked up in it; each
hit says where the template would have to start, and a start is kept where the
postings of the template's rare words agree on it and a mandatory key phrase stands
word for word in its place. The short base phrases are found by their rarest word
and verified whole. Of whole licence texts half the words are in the index, and the
starts may differ by a few words, so that a cut or altered text is found as well.
Everything is column functions on one row per file: no
shuffle but that of the word counts, and no Python in the tasks.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import whole_text

#: Words are runs of ASCII digits and letters and of all characters beyond ASCII.
APART = "".join(chr(i) for i in range(128) if not chr(i).isalnum())

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of public licences as words, label: (template, mandatory key phrase).
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license version 2 0"),
    "apache-2.0-grant": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "except in compliance with the license",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "cc by nc 4 0"),
    "gpl-3.0": ("licensed under the gnu general public license version 3", "gnu general public license version 3"),
    "gpl-grant": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "under the terms of the gnu general public license",
    ),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    "mit-notice": ("released under the mit license", "the mit license"),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
}

# Whole texts of public licences, label: (text, key phrases of which one must stand in its place).
TEXTS = {
    "bsd-3-text": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
        ("neither the name of", "to endorse or promote products"),
    ),
    "bsd-text": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
        ("in source and binary forms", "redistributions in binary form must reproduce"),
    ),
    "isc-text": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
        ("for any purpose with or without fee", "permission notice appear in all copies"),
    ),
    "mit-text": (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software.""",
        ("free of charge to any person", "publish distribute sublicense", "all copies or substantial portions"),
    ),
    "unlicense-text": (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
        ("free and unencumbered software", "commercial or non commercial and by any means"),
    ),
    "zlib-text": (
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""",
        ("alter it and redistribute it freely", "altered source versions must be plainly marked"),
    ),
}

#: Starts of a whole text that lie so many words apart may agree, and the share of
#: its rare words that must.
DRIFT = 8
AGREE_TEXT = 0.5

#: Rare words of a template in the index, the share of them that must agree on a
#: start, and the score of a base phrase outside any template.
RARE_WORDS = 4
AGREE = 0.75
PHRASE_SCORE = 0.5


def words_of(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def place_of(key: list[str], words: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


def vocabulary() -> list[str]:
    known = [*PHRASES, *(t for t, _ in TEMPLATES.values()), *(t for t, _ in TEXTS.values())]
    return sorted({w for text in known for w in words_of(text)})


def with_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, words)``: one pass lower-cases A-Z and sets spaces between words, on which the text is cut."""
    spaced = F.translate(whole_text(), string.ascii_uppercase + APART, string.ascii_lowercase + " " * len(APART))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_remove(F.split(spaced, " "), "").alias("words"))


def word_idf(docs: DataFrame) -> dict[str, float]:
    """IDF of the licence words over all documents; as many rows as licence words."""
    known = F.array(*[F.lit(w) for w in vocabulary()])
    found = with_words(docs).select(F.explode(F.concat(F.array_intersect("words", known), F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.pop("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary()}


def rarest(words: list[str], idf: dict[str, float], n: int) -> list[tuple[int, str]]:
    """``(place, word)`` of the n distinct words of highest IDF, ties to the earlier place."""
    first = {w: i for i, w in reversed(list(enumerate(words)))}
    best = sorted(first, key=lambda w: (-idf[w], first[w]))[:n]
    return sorted((first[w], w) for w in best)


def stands_at(start: Column, words: list[str]) -> Column:
    return reduce(Column.__and__, [F.get("words", start + i) == w for i, w in enumerate(words)])


def starts_of(word: str, place: int) -> Column:
    """Where a phrase would start, for each hit of its word at a place."""
    return F.transform(F.filter("hits", lambda i: F.get("words", i) == word), lambda i: i - place)


def spans_of(label: str, words: int) -> Column:
    return F.transform(f"`at:{label}`", lambda s: F.struct(F.lit(label).alias("label"), s.alias("start"), F.lit(words).alias("words")))


def phrase_starts(phrase: list[str], idf: dict[str, float]) -> Column:
    """Starts of all places of a phrase, from the hits of its rarest word."""
    [(place, word)] = rarest(phrase, idf, 1)
    return F.filter(starts_of(word, place), lambda s: stands_at(s, phrase))


def template_starts(template: list[str], key: list[str], idf: dict[str, float]) -> Column:
    """Starts on which enough rare words agree and where the key phrase stands."""
    rare = rarest(template, idf, RARE_WORDS)
    starts = F.concat(*[starts_of(word, place) for place, word in rare])
    need = math.ceil(AGREE * len(rare))
    at = place_of(key, template)

    def fits(start: Column) -> Column:
        agreeing = sum((F.coalesce((F.get("words", start + p) == w).cast("int"), F.lit(0)) for p, w in rare), F.lit(0))
        return (agreeing >= need) & stands_at(start + at, key)

    return F.filter(F.array_distinct(starts), fits)


def template_share(starts: str, template: list[str], idf: dict[str, float]) -> Column:
    """The largest share, by IDF, of a template's words that stand in place."""
    total = sum(idf[w] for w in template) or 1.0

    def share(start: Column) -> Column:
        return sum((F.when(F.get("words", start + i) == w, F.lit(idf[w])).otherwise(0.0) for i, w in enumerate(template)), F.lit(0.0))

    return F.coalesce(F.array_max(F.transform(starts, share)) / F.lit(total), F.lit(0.0))


def rare_half(words: list[str], idf: dict[str, float]) -> list[tuple[int, str]]:
    """``(place, word)`` of the half of the distinct words of highest IDF, at their first places; ties spread by a hash."""
    first = {w: i for i, w in reversed(list(enumerate(words)))}
    best = sorted(first, key=lambda w: (-idf[w], hashlib.md5(w.encode()).hexdigest()))[: (len(first) + 1) // 2]
    return sorted((first[w], w) for w in best)


def text_postings(words: list[str], idf: dict[str, float]) -> Column:
    """``(start, place, idf)`` of the hits of a whole text's rare words, by start."""
    rare = rare_half(words, idf)
    index = F.expr("map(" + ", ".join(f"'{w}', named_struct('place', {place}, 'idf', {idf[w]!r}D)" for place, w in rare) + ")")

    def posted(i: Column) -> Column:
        posting = F.element_at(index, F.get("words", i))
        return F.struct((i - posting["place"]).alias("start"), posting["place"].alias("place"), posting["idf"].alias("idf"))

    return F.array_sort(F.transform(F.filter("hits", lambda i: F.get("words", i).isin([w for _, w in rare])), posted))


def text_matches(postings: str, words: list[str], keys: list[list[str]], idf: dict[str, float]) -> Column:
    """``(start, share)`` where enough rare words agree within ``DRIFT`` words and a key phrase stands.

    The postings are in order, and a word starts once at most from each place: only the
    next few are looked at for each, however long the text.
    """
    rare = rare_half(words, idf)
    need, most = math.ceil(AGREE_TEXT * len(rare)), (DRIFT + 1) * len(rare)
    total = sum(idf[w] for _, w in rare) or 1.0
    entries = F.col(f"`{postings}`")

    def window(i: Column) -> Column:
        first = F.get(entries, i)["start"]
        return F.filter(F.slice(entries, i + 1, most), lambda x: x["start"] <= first + DRIFT)

    def has_key(start: Column) -> Column:
        def stands(key: list[str]) -> Column:
            whole, at = F.expr("array(" + ", ".join(f"'{w}'" for w in key) + ")"), place_of(key, words) + 1
            near = F.filter(F.sequence(start + at, start + at + DRIFT), lambda s: s > 0)
            return F.exists(near, lambda s: F.slice("words", s, len(key)) == whole)

        return reduce(Column.__or__, map(stands, keys))

    def agreeing(i: Column) -> Column:
        distinct = F.array_distinct(F.transform(window(i), lambda x: F.struct(x["place"].alias("place"), x["idf"].alias("idf"))))
        share = F.aggregate(distinct, F.lit(0.0), lambda s, x: s + x["idf"], lambda s: s / F.lit(total))
        return F.struct(F.get(entries, i)["start"].alias("start"), F.size(distinct).alias("n"), share.alias("share"))

    # The entry that many places on must be near, before any window is looked at.
    likely = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(entries) - 1, F.lit(0))),
        lambda i: F.coalesce(F.get(entries, i + (need - 1))["start"] <= F.get(entries, i)["start"] + DRIFT, F.lit(False)),
    )
    found = F.filter(F.transform(likely, agreeing), lambda x: (x["n"] >= need) & has_key(x["start"]))
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["share"].alias("share")))


def text_spans(label: str, words: int) -> Column:
    """Places of a whole text: of starts that lie near each other, the first."""
    starts = F.array_distinct(F.transform(f"`text:{label}`", lambda x: x["start"]))
    apart = F.filter(starts, lambda s, i: (i == 0) | (s > F.get(starts, i - 1) + DRIFT))
    return F.transform(apart, lambda s: F.struct(F.lit(label).alias("label"), s.alias("start"), F.lit(words).alias("words")))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per document: ``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)``.

    Texts are read whole, A-Z lower-cased; NULL is empty. ``n_base`` counts the
    places of all base phrases and ``first_word`` and ``last_word`` are their
    smallest and largest start (NULL: none). ``labels`` adds the templates and whole
    texts that match. ``score`` is the best template's share of words in place, a whole
    text's share of rare words that agree, or ``PHRASE_SCORE`` for a bare phrase, at least,
    to six decimals. ``spans`` holds (label, start, words) of all places; a text cut at its
    beginning may start before the first word. Equal matches count at each place; repeated rows are
    rows of their own. Needs doc_id and text.
    """
    idf = word_idf(docs)
    phrases = {label: phrase.split() for phrase, label in PHRASES.items()}
    templates = {label: (t.split(), k.split()) for label, (t, k) in TEMPLATES.items()}
    texts = {label: (words_of(t), [words_of(k) for k in keys]) for label, (t, keys) in TEXTS.items()}
    indexed = {w for t, _ in texts.values() for _, w in rare_half(t, idf)}
    indexed |= {w for x in phrases.values() for _, w in rarest(x, idf, 1)} | {w for t, _ in templates.values() for _, w in rarest(t, idf, RARE_WORDS)}
    last = F.greatest(F.size("words") - 1, F.lit(0))
    rows = with_words(docs).withColumn("hits", F.filter(F.sequence(F.lit(0), last), lambda i: F.get("words", i).isin(sorted(indexed))))
    rows = rows.withColumns(
        {f"at:{x}": phrase_starts(words, idf) for x, words in phrases.items()}
        | {f"at:{x}": template_starts(t, k, idf) for x, (t, k) in templates.items()}
        | {f"post:{x}": text_postings(t, idf) for x, (t, _) in texts.items()}
    )
    rows = rows.withColumns({f"text:{x}": text_matches(f"post:{x}", t, keys, idf) for x, (t, keys) in texts.items()})
    base = F.concat(*[F.col(f"`at:{x}`") for x in phrases])
    shares = {f"share:{x}": template_share(f"`at:{x}`", t, idf) for x, (t, _) in templates.items()}
    shares |= {f"share:{x}": F.coalesce(F.array_max(F.transform(f"`text:{x}`", lambda m: m["share"])), F.lit(0.0)) for x in texts}

    def names(labels) -> Column:
        found = F.array(*[F.when(F.size(f"`text:{x}`" if x in texts else f"`at:{x}`") > 0, F.lit(x)) for x in sorted(labels)])
        return F.array_join(F.filter(found, lambda x: x.isNotNull()), ",")

    rows = rows.withColumns({"base": base} | shares)
    lengths = {x: len(w) for x, w in phrases.items()} | {x: len(t) for x, (t, _) in templates.items()}
    spans = F.concat(*[spans_of(x, n) for x, n in lengths.items()], *[text_spans(x, len(t)) for x, (t, _) in texts.items()])
    bare = F.when(F.size("base") > 0, F.lit(PHRASE_SCORE)).otherwise(0.0)
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        names(phrases).alias("base_labels"),
        names([*lengths, *texts]).alias("labels"),
        F.round(F.least(F.lit(1.0), F.greatest(bare, *[F.col(f"`{x}`") for x in shares])), 6).alias("score"),
        spans.alias("spans"),
    )
