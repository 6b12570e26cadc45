"""Near-duplicate detection by min-max hashing.

Each permutation of a document's shingles yields two signature values, the
smallest and the largest hash, so half as many permutations are evaluated as
values are banded. Both match between two documents with a probability equal to
their Jaccard similarity. Documents that share a band become candidates, and a
candidate pair is linked only after its full shingle sets were compared.

Documents with equal sets are one class from the start. Each class is first compared
with one centre of its buckets. What is left of buckets that still hold several
components, members whose size and 256-bit sketch leave a partner in another
component possible, is compared member by member in blocks of bounded size: those
outside the component that holds most of a bucket with all others. Blocks give back no more links than join components. So no pair that could still join two
components is left out, and pairs are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import in_slices, valid_text, written
from sluice.llm.components import components

WORDS = 5
SIMILAR = 75  # per cent
#: Two values a permutation; bands of five. A pair at 0.75 shares no band with
#: probability (1 - 0.75^5)^32 = 0.0002.
PERMUTATIONS = 80
BANDS, ROWS = 32, 5
#: Sketch bits that must agree: at 0.75 similarity 224 of 256 are expected, with a
#: standard deviation of 6; this lies six of them below.
SKETCH_AGREE = 187
BLOCK = 1024
#: Shingles and members of a bucket that one task compares; more are cut into blocks.
BLOCK_SHINGLES, BLOCK_MEMBERS = 256_000, 2000
COLUMNS = 2048
SIGNATURES = "doc_id long, n_shingles long, digest binary, buckets array<long>, sketch array<long>"

_random = np.random.default_rng(20240601)
FACTORS = _random.integers(0, 2**32, (PERMUTATIONS, 1), dtype=np.uint32) | np.uint32(1)
SHIFTS = _random.integers(0, 2**32, (PERMUTATIONS, 1), dtype=np.uint32)
PLACES = _random.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; a shorter text is one run."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    with np.errstate(over="ignore"):
        runs = np.full(n, min(len(words), WORDS), np.uint64)
        for i in range(min(WORDS, len(words))):
            runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n] * PLACES[i]
        runs = (runs ^ (runs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(runs ^ (runs >> np.uint64(32)))


def min_max(hashes: np.ndarray) -> np.ndarray:
    """The minima, then the maxima, under each permutation."""
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), BLOCK):
        moved = short[None, start : start + BLOCK] * FACTORS + SHIFTS
        np.minimum(low, moved.min(axis=1), out=low)
        np.maximum(high, moved.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_buckets(signature: np.ndarray) -> list[int]:
    bands = signature.reshape(BANDS, ROWS)
    return [xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(bands)]


def sketch(signature: np.ndarray) -> list[int]:
    """256 bits: one bit of each value, and a second one of the first 96."""
    one, two = signature >> np.uint32(7) & 1, signature >> np.uint32(11) & 1
    bits = np.concatenate([one, two])[:256].astype(np.uint8)
    return np.packbits(bits).view("<i8").tolist()


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        out = [[], [], [], [], []]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = shingles(text)
            row = [doc_id, len(found), None, None, None]
            if len(found):
                signature = min_max(found)
                row[2:] = [xxhash.xxh3_128_digest(found.tobytes()), band_buckets(signature), sketch(signature)]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "n_shingles", "digest", "buckets", "sketch"])


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        sets = [shingles(x).tobytes() for x in batch.column("text").to_pylist()]
        digests = [xxhash.xxh3_128_digest(x) for x in sets]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], ["node", "digest", "shingles"])


def sets_of_nodes(rows: DataFrame, active: DataFrame, own: DataFrame) -> DataFrame:
    """``(node, shingles)``: one set for each class that an active node stands for, however often its row is repeated.

    ``active`` has node and ``often``, whether several rows have its doc_id. Texts of
    such rows are brought together before their sets are made, and the sets of other
    classes, for which a smaller doc_id stands, are left out.
    """
    texts = rows.join(active, F.col("doc_id") == F.col("node")).select("node", "text", "often")
    kinds = "node long, digest binary, shingles binary"
    once = texts.filter("not often").select("node", "text").mapInArrow(shingle_sets, kinds)
    several = texts.filter("often").select("node", "text").distinct().mapInArrow(shingle_sets, kinds)
    several = several.join(own.select("node", "digest"), ["node", "digest"], "left_semi").dropDuplicates(["node", "digest"])
    return once.unionByName(several).select("node", "shingles")


def similar_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for batch in in_slices(batches):
        same = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            same.append(100 * common >= SIMILAR * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b)`` of ``pairs`` whose shingle sets were found similar."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return written(pairs.join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b").mapInArrow(similar_pairs, "a long, b long"), "links")


def possible(side: str, other: str) -> Column:
    """Whether two sides are in different components, and sizes and sketches leave the similarity possible."""
    sizes = F.least(f"{side}.n_shingles", f"{other}.n_shingles") * 100 >= F.greatest(f"{side}.n_shingles", f"{other}.n_shingles") * SIMILAR
    differing = sum((F.bit_count(F.col(f"{side}.sketch")[i].bitwiseXOR(F.col(f"{other}.sketch")[i])) for i in range(4)), F.lit(0))
    return (F.col(f"{side}.label") != F.col(f"{other}.label")) & sizes & (differing <= 256 - SKETCH_AGREE)


def block_links(rows: pa.Table) -> pa.Table:
    """Links that join components, from comparing all members of a block across them."""
    nodes, labels = rows.column("node").to_numpy(), rows.column("label").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x in sets], np.int64)
    kinds, kind, members = np.unique(labels, return_inverse=True, return_counts=True)
    some = np.flatnonzero(kind != members.argmax()) if len(kinds) > 1 else np.empty(0, np.int64)
    links: list[tuple[int, int]] = []
    if len(some):
        _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row, common = np.repeat(np.arange(len(sets)), sizes), np.zeros((len(some), len(sets)), np.float32)
        shared = held[column] > 1
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            low, high = np.searchsorted(column, [first, first + COLUMNS])
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[row[low:high], column[low:high] - first] = 1
            common += has[some] @ has.T
        parent = np.arange(len(kinds))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for i, counts in zip(some, common.astype(np.int64), strict=True):
            alike = np.flatnonzero((100 * counts >= SIMILAR * (sizes[i] + sizes - counts)) & (kind != kind[i]))
            for j in alike[np.unique(kind[alike], return_index=True)[1]]:
                x, y = find(kind[i]), find(kind[j])
                if x != y:
                    parent[x] = y
                    links.append((nodes[i], nodes[j]))
    return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def dealt(members: DataFrame, shingles: bool) -> tuple[DataFrame, DataFrame]:
    """Members that meet in blocks ``(bucket, row, column)``: those outside their bucket's main component, and all.

    Every member has a row, every one outside also a column of its bucket; outside
    ones go to all rows of their column, others to all columns of their row. A
    block holds about ``BLOCK_MEMBERS`` of each and, with ``shingles``, so many
    shingles.
    """

    def blocks(chosen: Column) -> Column:
        most = F.ceil(F.count_if(chosen) / BLOCK_MEMBERS)
        if shingles:
            most = F.greatest(most, F.ceil(F.sum(F.when(chosen, F.col("n_shingles"))) / BLOCK_SHINGLES))
        return F.greatest(most, F.lit(1)).cast("long")

    sizes = members.groupBy("bucket").agg(blocks(F.lit(True)).alias("rows"), blocks(F.col("outside")).alias("columns"))
    placed = members.join(written(sizes, "blocks"), "bucket")
    own = {"row": F.pmod(F.xxhash64("node"), F.col("rows")), "column": F.pmod(F.xxhash64("node", F.lit(1)), F.col("columns"))}
    outside = placed.filter("outside").withColumn("column", own["column"]).withColumn("row", F.explode(F.expr("sequence(0L, rows - 1)")))
    every = placed.withColumn("row", own["row"]).withColumn("column", F.explode(F.expr("sequence(0L, columns - 1)")))
    return outside.drop("rows", "columns"), every.drop("rows", "columns")


def cross_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b)``: links across components, from the members with a possible partner in their bucket.

    Of two members in different components one at least is outside the bucket's
    main component, the one that holds most of its members.
    """
    counts = members.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("n", "label"))["label"].alias("main"))
    members = written(members.join(main, "bucket").withColumn("outside", F.col("label") != F.col("main")).drop("main"), "sided")
    outside, every = dealt(members, shingles=False)
    same = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.row") == F.col("y.row")) & (F.col("x.column") == F.col("y.column"))
    kept = ["bucket", "node", "label", "n_shingles", "outside"]
    near = outside.alias("x").join(every.alias("y"), same & possible("x", "y"), "left_semi").select(*kept)
    others = every.filter("not outside").alias("x").join(outside.alias("y"), same & possible("x", "y"), "left_semi").select(*kept)
    near = written(near.unionByName(others).dropDuplicates(["bucket", "node"]), "near-members")
    outside, every = dealt(near, shingles=True)
    met = outside.unionByName(every).select("bucket", "row", "column", "node", "label").distinct()
    return written(met.join(sets, "node").groupBy("bucket", "row", "column").applyInArrow(block_links, "a long, b long"), "links")


def unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component's label, of buckets that hold several components."""
    seen = members.join(labels.withColumnRenamed("node", "labelled"), F.col("node") == F.col("labelled"), "left")
    seen = seen.select("bucket", "node", "n_shingles", "sketch", F.coalesce("label", "node").alias("label"))
    mixed = seen.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket")
    return seen.join(mixed, "bucket", "left_semi")


def shared_ids(linkable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a doc_id and differ in their text."""
    ids = linkable.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high")
    rows = linkable.select("doc_id", "digest").join(ids.select("doc_id"), "doc_id", "left_semi").join(classes, "digest")
    return rows.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row per document.

    Words are the runs without ASCII white space of the whole text, A-Z
    lower-cased; a set holds the distinct runs of five words, or the whole of a
    shorter text. Documents are linked where 100 * intersection >= 75 * union.
    ``component_id`` is the smallest doc_id reachable and ``kept`` says that it
    is the document's own. Without words (NULL, empty) a document is linked with
    nothing, and so is a NULL doc_id, whose component is NULL and which is kept.
    Bytes that are not valid UTF-8 count as U+FFFD.
    Rows that share a doc_id count as linked. Needs doc_id and text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), valid_text().alias("text"))
    signed = written(rows.mapInArrow(sign, SIGNATURES), "signatures")
    linkable = signed.filter("digest is not null and doc_id is not null")
    classes = written(linkable.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    # One row of each class stands for it: the node is its smallest doc_id.
    own = linkable.join(classes.withColumnRenamed("digest", "class"), (F.col("digest") == F.col("class")) & (F.col("doc_id") == F.col("node")))
    own = own.dropDuplicates(["digest"]).drop("class")  # a row may be repeated
    banded = own.select("node", F.explode("buckets").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("centre")).filter("n > 1").drop("n")
    met = written(banded.join(shared, "bucket").select("bucket", "node", "centre"), "buckets")
    known = own.select(F.col("node").alias("known"), "n_shingles", "sketch")
    often = linkable.groupBy("doc_id").agg((F.count("*") > 1).alias("often"))
    active = met.select("node").distinct().join(often, F.col("node") == F.col("doc_id")).select("node", "often")
    active = written(active, "active")
    known = written(known.join(active, F.col("known") == F.col("node"), "left_semi"), "sketches")
    sets = written(sets_of_nodes(rows, active, own), "shingle-sets")

    # The centre that most of a node's buckets share is the likeliest, ties to the smallest.
    shares = met.filter("node <> centre").groupBy("node", "centre").agg(F.count("*").alias("n"))
    first = shares.groupBy(F.col("node").alias("a")).agg(F.max_by("centre", F.struct(F.col("n"), -F.col("centre"))).alias("b"))
    links = confirmed(first, sets).unionByName(shared_ids(linkable, classes))
    labels = components(links)
    members = met.join(known, F.col("node") == F.col("known")).select("bucket", "node", "n_shingles", "sketch")
    across = cross_links(written(unsettled(members, labels), "unsettled"), sets)
    if not across.isEmpty():
        labels = components(links.unionByName(across))

    own_class = signed.join(classes.withColumnRenamed("digest", "class"), F.col("digest") == F.col("class"), "left")
    reached = own_class.join(labels.withColumnRenamed("node", "labelled"), F.col("node") == F.col("labelled"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node", "doc_id"))
    return reached.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
