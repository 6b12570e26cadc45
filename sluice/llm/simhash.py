"""Near-duplicates by SimHash fingerprints, linked through pivot distance tables.

For every distinct fingerprint the Hamming distances to ``PIVOTS`` reference
fingerprints are computed, separately for segments of the 64 bits. Of two
fingerprints at distance d no coordinate differs by more than d, which discards
pairs in two steps. Two differing bits lie in two of three segments at most, so in
one segment all coordinates of a linked pair are equal: that segment's
coordinates are the key that pairs meet on. Of those that meet, the largest
difference of the coordinates over all bits discards most; survivors are verified
on the fingerprints themselves.

A group of more than ``GROUP`` fingerprints with one key is cut again in the same
way by segments of the bits that its members may still differ in, until every
group is small. So no group is large, no pair is left out, and a group gives back
no more links than join its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import in_slices, whole_bytes, written
from sluice.llm.components import components

WORDS = 3
BITS = 64
SEED = 42
#: Differing bits of linked fingerprints.
REACH = 2
PIVOTS = 16
#: Fingerprints compared with each other in one group; at least 8, all that three free bits allow.
GROUP = 512
#: Shingles hashed, and rows compared, at once in a task.
BLOCK, CHUNK = 100_000, 65_536
#: Paths this long leave fewer than three free bits, and are cut no further.
LONGEST = 4**9
KEYED = "fp long, node long, key long, path int"

_random = np.random.default_rng(20240613)
REFERENCES = _random.integers(0, 2**64, PIVOTS, dtype=np.uint64)
FACTORS = _random.integers(0, 2**63, PIVOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def fingerprint(text: bytes) -> int:
    """SimHash of the runs of three words of a UTF-8 text; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    counts = np.zeros((8, 8), np.int64)
    for start in range(0, n, BLOCK):
        part = words[start : start + BLOCK + width - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        first = [0, *ends[: len(part) - width].tolist()]
        runs = [joined[a : b - 1] for a, b in zip(first, ends[width - 1 :].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(runs))
        places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + 256 * np.arange(8)
        counts += np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ BYTE_BITS
    set_bits = (2 * counts > n).astype(np.uint8).ravel()
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        made = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64))], ["doc_id", "fp"])


def segments(path: int) -> list[np.uint64]:
    """Masks of the three segments of the bits that rows on a path may differ in.

    A path names the segments agreed on so far: 1 at first, then a base-4 digit each.
    """
    digits, bits = [], list(range(BITS))
    while path > 1:
        digits.append(path % 4)
        path //= 4

    def cut(bits):
        n = len(bits)
        return [bits[n * i // 3 : n * (i + 1) // 3] for i in range(3)]

    for digit in reversed(digits):
        agreed = set(cut(bits)[digit])
        bits = [b for b in bits if b not in agreed]
    return [np.uint64(sum(1 << b for b in part)) for part in cut(bits)]


def coordinates(fps: np.ndarray, mask: np.uint64 = np.uint64(2**64 - 1)) -> np.ndarray:
    """Distances, a row per fingerprint and a column per reference, in the bits of ``mask``."""
    return np.bitwise_count((fps[:, None] ^ REFERENCES) & mask)


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three rows for each, with keys made of one more segment's coordinates."""
    for batch in in_slices(batches, 8192):
        fps = batch.column("fp").to_numpy().view(np.uint64)
        nodes, keys = batch.column("node").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
        paths = batch.column("path").to_numpy()
        for path in np.unique(paths):
            rows = np.flatnonzero(paths == path)
            for digit, mask in enumerate(segments(int(path))):
                with np.errstate(over="ignore"):
                    made = (coordinates(fps[rows], mask).astype(np.uint64) * FACTORS).sum(axis=1, dtype=np.uint64)
                    made = (made + keys[rows] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(digit + 1)) * np.uint64(0xD6E8FEB86659FD93)
                    made ^= made >> np.uint64(32)
                arrays = [fps[rows].view(np.int64), nodes[rows], made.view(np.int64), np.full(len(rows), 4 * path + digit, np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["fp", "node", "key", "path"])


def forest(fps: np.ndarray, nodes: np.ndarray, keys: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that join the components within groups of equal, adjacent keys."""
    n = len(fps)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, n))
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # rows of the group from here on
    many = np.flatnonzero(left > 1)
    table = coordinates(fps).T.astype(np.int8).copy()
    parent = np.arange(n)
    a, b, step = [], [], 1

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    while len(many):
        i = many[parent[many] != parent[many + step]]
        for distances in table:
            if not len(i):
                break
            i = i[np.abs(distances[i] - distances[i + step]) <= REACH]
        i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= REACH]
        for x in i.tolist():
            p, q = find(x), find(x + step)
            if p != q:
                parent[q] = p
                a.append(int(nodes[x]))
                b.append(int(nodes[x + step]))
        if len(i):
            while not np.array_equal(up := parent[parent], parent):
                parent[:] = up
        step += 1
        many = many[left[many] > step]
    return a, b


def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(a, b)`` from rows that come sorted by key; a group may span batches."""
    kept: list[tuple[np.ndarray, ...]] = []
    held = 0

    def links(parts):
        a, b = forest(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append((batch.column("fp").to_numpy().view(np.uint64), batch.column("node").to_numpy(), batch.column("key").to_numpy()))
        held += batch.num_rows
        if held >= CHUNK:
            whole = [np.concatenate(x) for x in zip(*kept, strict=True)]
            last = int(np.searchsorted(whole[2], whole[2][-1]))
            if last:
                yield links([[x[:last] for x in whole]])
            kept, held = [tuple(x[last:] for x in whole)], len(whole[0]) - last
    if kept:
        yield links(kept)


def fingerprint_links(classes: DataFrame) -> DataFrame:
    """``(a, b)``: links between the nodes of ``classes(fp, node)``, enough to join their components."""
    links = None
    rows = classes.select("fp", "node", F.lit(0).cast("long").alias("key"), F.lit(1).alias("path"))
    while True:
        keyed = written(rows.mapInArrow(spread, KEYED), "segment-keys")
        large = written(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("path").alias("path")).filter((F.col("n") > max(GROUP, 8)) & (F.col("path") < LONGEST)).select("key"), "large-keys")
        small = keyed.join(large, "key", "left_anti").select("fp", "node", "key")
        found = written(small.repartition("key").sortWithinPartitions("key").mapInArrow(linked, "a long, b long"), "links")
        links = found if links is None else links.unionByName(found)
        if large.isEmpty():
            return links
        rows = keyed.join(large, "key", "left_semi").select("fp", "node", "key", "path")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row per document.

    Words are the runs without ASCII white space of the whole text, A-Z
    lower-cased. A bit of the fingerprint is set if it is set in over half the XXH64
    hashes (seed 42) of the runs of three words, repeats included; a shorter text is
    one run. Documents whose fingerprints differ in at most two bits are linked and
    ``component_id`` is the smallest doc_id reachable. Without words (NULL, empty) the
    fingerprint is zero and linked like any other. Texts are taken as bytes, so ones
    that are not valid UTF-8 do no harm. Repeated rows have equal results. A NULL
    doc_id links nothing and has a NULL component. An empty table gives no rows.
    Needs doc_id and text; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_bytes().alias("text"))
    signed = written(rows.mapInArrow(sign, "doc_id long, fp long"), "fingerprints")
    classes = written(signed.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    labels = components(fingerprint_links(classes)).withColumnRenamed("node", "labelled")
    labelled = classes.join(labels, F.col("node") == F.col("labelled"), "left")
    labelled = written(labelled.select(F.col("fp").alias("class"), F.coalesce("label", "node").alias("label")), "labelled")
    found = signed.join(labelled, F.col("fp") == F.col("class"), "left")
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("label")).alias("component_id"),
    )
