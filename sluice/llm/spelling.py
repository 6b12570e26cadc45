"""Grouping spelling variants: words one edit apart, by dynamic programming over sorted lists.

A scan of a sorted list finds a word's near words. It keeps the rows of a banded
edit matrix, one for each character of the list's word in hand: as the next word
shares a prefix with it (their LCP), the rows of that prefix serve again. Where a row
exceeds one edit all over, no word with this prefix can be near, and the scan
goes on behind the range that shares it.

Lists are made so that none is long. Two words one edit apart, the shorter of m
characters, agree in the first half of these or in the last. So each word goes to
the lists of its first and of its last half, for m its own length and one less;
what is left of the words is scanned there. A list of more than ``LIST`` words is cut
again by halves of what its words do not yet agree on, until lists are short or
one character is left, so no list is cut off. Words of a list of last halves count
only if their first halves differ, so every pair is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import in_slices, whole_bytes, written

#: One in so many (document, word) pairs loses a character, as if mistyped.
TYPO = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: A word takes the form of a near word that is at least so many times as frequent.
MORE = 2
#: Words in one list that is scanned.
LIST = 64
#: Rows of lists that one task scans, about two seconds.
TASK_ROWS = 50_000
FLUSH = 200_000
#: Runs of A-Z, a-z and U+00C0 to U+00FF, as Latin-1 bytes; other characters become "?".
RUN = re.compile(rb"[A-Za-z\xC0-\xFF]+")
FAR = 2
NEAR = "word string, near long, form string, form_n long"


def shown_words(doc_id: int | None, text: bytes) -> list[bytes]:
    """The runs of a text, A-Z lower-cased, some with a character taken out, in Latin-1."""
    plain = text.isascii()
    data = (text if plain else text.decode("utf-8", "replace").encode("latin-1", "replace")).lower()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words = RUN.findall(data)
    if plain:
        hashes = [zlib.crc32(w, start) for w in words]
    else:
        hashes = [zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start) for w in words]
    for i, h in enumerate(hashes):
        if not h % TYPO:
            at = h % len(words[i])
            words[i] = words[i][:at] + words[i][at + 1 :]
    return words


def count_words(min_length: int):
    """``(word, n)`` by document batches, added up in a bounded table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flushed():
            found = [(w.decode("latin-1"), n) for w, n in counts.items() if len(w) >= min_length]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["word", "n"])

        for batch in in_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.update(shown_words(doc_id, text))
                if len(counts) >= FLUSH:
                    yield flushed()
        yield flushed()

    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_bytes().alias("text"))
    counts = rows.mapInArrow(count_words(min_length), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def near_in_list(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places (i, j), i < j, of the words of a sorted list of distinct words that are one edit apart.

    A row of the matrix holds the edits between the candidate's first d characters
    and the query's first d - 1, d and d + 1.
    """
    size = len(words)
    lcp = [0] * (size + 1)  # with the word before
    for j in range(1, size):
        lcp[j] = common_prefix(words[j - 1], words[j])
    lcp[0] = lcp[size] = -1
    behind, stack = [size] * (size + 1), []  # the next place whose LCP is smaller
    for j in range(size, -1, -1):
        while stack and lcp[stack[-1]] >= lcp[j]:
            stack.pop()
        behind[j] = stack[-1] if stack else size
        stack.append(j)
    for i, query in enumerate(words):
        length, j = len(query), i + 1
        if j == size:
            return
        # Up to the prefix it shares with the next word, the query meets itself.
        rows = [(FAR, 0, 1 if length else FAR)] + [(1, 0, 1 if d < length else FAR) for d in range(1, lcp[j] + 1)]
        while j < size:
            word = words[j]
            a, b, c = rows[-1]
            for d in range(len(rows), len(word) + 1):
                x = word[d - 1]
                low = min(a + (d - 2 >= length or x != query[d - 2]), b + 1) if 2 <= d <= length + 1 else (b + 1 if d <= length + 1 else FAR)
                mid = min(b + (x != query[d - 1]), c + 1, low + 1) if d <= length else FAR
                top = min(c + (x != query[d]), mid + 1) if d < length else FAR
                a, b, c = low, mid, top
                rows.append((a, b, c))
                if a >= FAR and b >= FAR and c >= FAR:
                    break
            d = len(rows) - 1
            if a >= FAR and b >= FAR and c >= FAR:
                j += 1
                while lcp[j] >= d:
                    j = behind[j]
            else:
                gap = length - d
                if -1 <= gap <= 1 and (a, b, c)[gap + 1] == 1:
                    yield i, j
                j += 1
            if j < size:
                del rows[max(lcp[j], 0) + 1 :]


def scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, near, form, form_n)`` a list: the number of near words and the most frequent of them.

    Rows come sorted by key, which starts with what the words of its list agree on.
    """

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(x).to_pylist() for x in ("key", "word", "n")), strict=True)

    def made(best):
        columns = list(zip(*((w, *v) for w, v in best), strict=True)) or [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["word", "near", "form", "form_n"])

    found = []
    for key, group in groupby(rows(), itemgetter(0)):
        group = list(group)
        if len(group) < 2:
            continue
        m, head, tail, apart = map(int, key.split(" ", 4)[:4])
        # Beyond what its words agree on; lists of last halves are sorted from their ends.
        if tail > head:
            cut = sorted((word[head : len(word) - tail][::-1], word, n) for _, word, n in group)
        else:
            cut = sorted((word[head : len(word) - tail], word, n) for _, word, n in group)
        best: dict[str, tuple[int, str, int]] = {}
        for i, j in near_in_list([x for x, _, _ in cut]):
            (_, u, n_u), (_, v, n_v) = cut[i], cut[j]
            if min(len(u), len(v)) != m or (apart and u[:apart] == v[:apart]):
                continue
            for word, other, n in ((u, v, n_v), (v, u, n_u)):
                count, form, form_n = best.get(word, (0, "", 0))
                if n > form_n or (n == form_n and other < form):
                    form, form_n = other, n
                best[word] = (count + 1, form, form_n)
        found.extend(best.items())
        if len(found) >= 10_000:
            yield made(found)
            found = []
    yield made(found)


def halves(head: Column, tail: Column, apart: Column) -> Column:
    """The two lists of a word: by the first and by the last half of what is not agreed on yet."""
    word, m = F.col("word"), F.col("m")
    rest = m - head - tail
    first = F.floor(rest / 2).cast("int")
    last = rest - first

    def one(head: Column, tail: Column, apart: Column) -> Column:
        # The words of a list agree on both ends; the key says how much of them.
        ends = F.concat_ws(" ", m, head, tail, apart, F.substring(word, F.lit(1), head), F.substring(word, F.length(word) - tail + 1, tail))
        return F.struct(ends.alias("key"), head.alias("head"), tail.alias("tail"), apart.alias("apart"))

    return F.array(one(head + first, tail, apart), one(head, tail + last, head + first))


def lists(rows: DataFrame) -> DataFrame:
    """``rows(word, n, m, head, tail, apart)`` in two lists each."""
    dealt = rows.withColumn("list", F.explode(halves(F.col("head"), F.col("tail"), F.col("apart"))))
    return dealt.select("list.key", "word", "n", "m", "list.head", "list.tail", "list.apart")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``(word, n_near, form, form_n)`` of ``words(word, n)``: the number of near words and the most frequent one."""
    whole = F.length("word").cast("int")
    zero = F.lit(0)
    rows = words.select("word", "n", F.explode(F.array(whole, whole - 1)).alias("m")).filter(F.col("m") >= min_length)
    rows = rows.select("word", "n", "m", zero.alias("head"), zero.alias("tail"), zero.alias("apart"))
    found = None
    while True:
        listed = written(lists(rows), "word-lists")
        # One character apart is as far as halving goes; such a list is at most the alphabet.
        held = listed.groupBy("key").agg(F.count("*").alias("size"), F.first(F.col("m") - F.col("head") - F.col("tail")).alias("rest"))
        long = written(held.filter((F.col("size") > LIST) & (F.col("rest") > 1)).select("key"), "long-lists")
        short = listed.join(long, "key", "left_anti").select("key", "word", "n")
        tasks = max(1, -(-listed.count() // TASK_ROWS))
        scanned = written(short.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(scan_lists, NEAR), "near-words")
        found = scanned if found is None else found.unionByName(scanned)
        if long.isEmpty():
            break
        rows = listed.join(long, "key", "left_semi").select("word", "n", "m", "head", "tail", "apart")
    most = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    grouped = found.groupBy("word").agg(F.sum("near").alias("n_near"), most.alias("best"))
    return grouped.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the last form reached. Each round doubles the steps taken."""
    jumps = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = jumps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        found = jumps.join(onward, F.col("root") == F.col("at"), "left")
        found = written(found.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jumps = found.select("word", "root")
        if found.filter("moved").isEmpty():
            return jumps


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, a row per word.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z
    lower-cased, of which one in 97 (document, word) pairs, by a hash, loses a
    character; those of at least ``min_length`` characters that occur
    ``min_count`` times stay. ``n_near`` counts the words exactly one inserted, deleted
    or replaced character away; ``form`` is the most frequent of them (ties: the
    smallest by code points) if at least twice as frequent as the word, else
    NULL; ``root`` follows forms to the last. NULL texts have no words, and a NULL
    doc_id counts as an empty id in the hash. Bytes that are not valid UTF-8
    separate words. Repeated rows count again. An empty table has no words. Needs
    doc_id and text; other columns are not read.
    """
    words = written(vocabulary(docs, min_length, min_count), "vocabulary")
    near = near_words(words, min_length)
    joined = words.join(near.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    frequent = F.col("form_n") >= MORE * F.col("n")
    joined = joined.select(
        "word", F.when(frequent, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("form_n")).alias("form_n"),
    )
    joined = written(joined, "word-forms")
    ends = roots(joined.filter("form is not null").select("word", "form")).withColumnRenamed("word", "of")
    found = joined.join(ends, F.col("word") == F.col("of"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
