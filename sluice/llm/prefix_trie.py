"""Prefix trie of conversations, in node tables addressed by minimal perfect hashes.

Every turn of every conversation gets the digest of the turns up to it: two 64-bit
values, each the exclusive or of the hashes of (place, turn), so that prefixes of
one conversation can be computed in blocks, and a parent's digest is its child's
without the last hash. Distinct digests are the nodes of the trie.

Paths are cut into blocks of ``BLOCK`` turns and dealt by (conversation, block) into
shards of about ``SHARD_ROWS`` rows, whatever prefix they share. In a shard a
minimal perfect hash gives each distinct digest a slot, and the slot's parent and
last turn are compared with those of every row, so a collision is found. Counts
are scattered into flat arrays by slot and added to the parents' slots from the
deepest nodes up. What a path holds beyond its block arrives as a value of the
block's last row. Shards then add up by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import whole_bytes, written
from sluice.llm.line_dedup import build_levels, mixed, slots

#: A conversation starts with turns of the one that heads its family of 20 ids, up to three.
FAMILY, SHARED = 20, 4
BLOCK = 1024
SHARD_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
PARTIAL = "d1 long, d2 long, n_convs long, gross long, own long, leaves long"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, t1, t2, words)``: a 120-bit identity of role and text, and the text's words."""
    role, text = whole_bytes("role"), whole_bytes("text")
    sha = F.sha2(F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role, text), 256)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        sha.alias("sha"),
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("words"),
    ).filter("conv_id is not null")
    parts = {f"t{i + 1}": F.conv(F.substring("sha", 1 + 15 * i, 15), 16, 10).cast("long") for i in range(2)}
    return rows.withColumns(parts).select("conv_id", "turn", "t1", "t2", "words")


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with their ``place`` in the conversation, from 1.

    Ranges of all rows are numbered on their own, so a conversation of any length is
    numbered by many tasks; where one goes on in the next range, what came before
    is added.
    """
    order = ["turn", "t1", "t2"]
    ranged = turns.withColumn("equal", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order, "equal")
    ranged = written(ranged.withColumn("range", F.spark_partition_id()).drop("equal"), "turn-ranges")
    held = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("before", F.sum("n").over(earlier)).filter("before is not null")
    before = written(before.select("conv_id", "range", "before"), "places-before")
    own = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order))
    placed = ranged.withColumn("own", own).join(before, ["conv_id", "range"], "left")
    return placed.select("conv_id", (F.coalesce("before", F.lit(0)) + F.col("own")).alias("place"), "t1", "t2", "words")


def rebuilt(places: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, place, t1, t2, words)`` of the rebuilt conversations.

    The first h turns are those of the family's head, h being a hash of the
    conv_id; the conversation's own turns after its first h follow.
    """
    shared = F.crc32(F.col("conv_id").cast("string")) % SHARED
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = places.filter((F.col("conv_id") == head) & (F.col("place") < SHARED))
    heads = written(heads.select(F.col("conv_id").alias("head"), "place", "t1", "t2", "words"), "head-turns")
    wanted = convs.withColumns({"shared": shared, "head": head})
    taken = wanted.join(heads, "head").filter("place <= shared").select("conv_id", "place", "t1", "t2", "words")
    # Where the head is shorter than the share, the turns that follow move up.
    lengths = heads.groupBy("head").agg(F.max("place").alias("length"))
    short = wanted.filter("shared > 0").join(lengths, "head", "left").withColumn("missing", F.col("shared") - F.coalesce("length", F.lit(0)))
    short = written(short.filter("missing > 0").select("conv_id", "missing"), "short-heads")
    rest = places.filter(F.col("place") > shared).join(short, "conv_id", "left")
    rest = rest.select("conv_id", (F.col("place") - F.coalesce("missing", F.lit(0))).alias("place"), "t1", "t2", "words")
    return taken.unionByName(rest)


def block() -> Column:
    return F.floor(F.col("place") / BLOCK)


def later_blocks(rows: DataFrame, sums: dict[str, Column], combine, before: bool) -> DataFrame:
    """``(conv_id, block, ...)``: aggregates over the other blocks of conversations that have several."""
    several = rows.filter(F.col("place") >= BLOCK).select("conv_id").distinct()
    blocks = rows.join(several, "conv_id", "left_semi").groupBy("conv_id", block().alias("block")).agg(*[c.alias(k) for k, c in sums.items()])
    side = Window.partitionBy("conv_id").orderBy("block" if before else F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("conv_id", "block", *[combine(F.col(k)).over(side).alias(k) for k in sums]).filter(" and ".join(f"{k} is not null" for k in sums))


def prefix_paths(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, place, t1, t2, words, d1, d2, u1, u2)``: each turn with the digests of its prefix and of the one before.

    Place 0 is the root, which every conversation has.
    """
    root = convs.select("conv_id", *[F.lit(0).cast("long").alias(x) for x in ("place", "t1", "t2", "words", "e1", "e2")])
    made = {f"e{i}": F.xxhash64(F.lit(i), "place", "t1", "t2") for i in (1, 2)}
    rows = written(rows.withColumns(made).unionByName(root), "rebuilt-turns")
    before = later_blocks(rows, {"b1": F.bit_xor("e1"), "b2": F.bit_xor("e2")}, F.bit_xor, True)
    before = written(before.select(F.col("conv_id").alias("of"), "block", "b1", "b2"), "prefixes-before")
    upto = Window.partitionBy("conv_id", block()).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumns({"x1": F.bit_xor("e1").over(upto), "x2": F.bit_xor("e2").over(upto)})
    found = found.join(before, (F.col("conv_id") == F.col("of")) & (block() == F.col("block")), "left")
    digests = {f"d{i}": F.col(f"x{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0).cast("long"))) for i in (1, 2)}
    found = found.withColumns(digests).withColumns({f"u{i}": F.col(f"d{i}").bitwiseXOR(F.col(f"e{i}")) for i in (1, 2)})
    return written(found.select("conv_id", "place", "t1", "t2", "words", "d1", "d2", "u1", "u2"), "prefix-paths")


def distinct_nodes(paths: DataFrame) -> DataFrame:
    """``(d1, d2, depth, conv_id, u1, u2, n_children)`` of the distinct digests; conv_id is the smallest member."""
    same = ["place", "u1", "u2", "t1", "t2", "words"]
    ends = [f(x).alias(f"{x}_{name}") for x in same for name, f in (("low", F.min), ("high", F.max))]
    grouped = paths.groupBy("d1", "d2").agg(F.min("conv_id").alias("conv_id"), *ends)
    differs = F.lit(False)
    for x in same:
        differs |= F.col(f"{x}_low") != F.col(f"{x}_high")
    depth = F.when(differs, F.raise_error(F.lit("two prefixes have one digest")).cast("long")).otherwise(F.col("place_low"))
    nodes = grouped.select("d1", "d2", depth.alias("depth"), "conv_id", F.col("u1_low").alias("u1"), F.col("u2_low").alias("u2"))
    nodes = written(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("u1").alias("c1"), F.col("u2").alias("c2")).agg(F.count("*").alias("n_children"))
    found = nodes.join(children, (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")), "left")
    return written(found.drop("c1", "c2").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes-with-children")


def node_table(rows: pa.Table) -> pa.Table:
    """Counts of a shard's nodes, in arrays addressed by slot."""
    get = {x: rows.column(x).to_numpy() for x in ("place", "d1", "d2", "u1", "u2", "t1", "t2", "gross", "own", "leaves")}
    d1, d2 = get["d1"].view(np.uint64), get["d2"].view(np.uint64)
    u1, u2 = get["u1"].view(np.uint64), get["u2"].view(np.uint64)
    facts = np.stack([get[x] for x in ("d1", "d2", "u1", "u2", "t1", "t2", "place")], axis=1)
    for seed in range(100, 120):
        keys = mixed(d1, seed) ^ d2
        levels = build_levels(np.unique(keys))
        at = slots(keys, levels)
        n = int(at.max()) + 1
        held = np.zeros((n, facts.shape[1]), np.int64)
        held[at] = facts
        if (held[at] == facts).all():
            break
    else:
        raise ValueError("two prefixes of a shard have one digest")
    depth = held[:, -1]
    parent = slots(mixed(u1, seed) ^ u2, levels)
    above = np.full(n, -1, np.int64)
    above[at] = np.where(get["place"] % BLOCK == 0, -1, parent)
    counts = np.bincount(at, minlength=n)
    sums = np.zeros((n, 3), np.int64)
    for i, x in enumerate(("gross", "own", "leaves")):
        np.add.at(sums[:, i], at, get[x])
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[above[level] >= 0]
        np.add.at(sums, above[level], sums[level])
    arrays = [held[:, 0], held[:, 1], counts, *sums.T]
    return pa.table([pa.array(np.ascontiguousarray(x), pa.int64()) for x in arrays], names=["d1", "d2", "n_convs", "gross", "own", "leaves"])


def subtree_sums(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(d1, d2, n_convs, gross, own, leaves)``: members, and what lies in the subtrees.

    ``gross`` are the words of all members' turns from the node on, ``own`` those
    of the distinct nodes, each counted for its smallest member.
    """
    first = nodes.select(F.col("conv_id").alias("of"), "depth", (F.col("n_children") == 0).cast("long").alias("leaf"))
    rows = paths.join(first, (F.col("conv_id") == F.col("of")) & (F.col("place") == F.col("depth")), "left")
    rows = rows.select(
        *[x for x in paths.columns if x != "words"],
        F.col("words").alias("gross"),
        F.when(F.col("of").isNotNull(), F.col("words")).otherwise(0).alias("own"),
        F.coalesce("leaf", F.lit(0).cast("long")).alias("leaves"),
    )
    rows = written(rows, "counted-paths")
    sums = {x: F.sum(x) for x in ("gross", "own", "leaves")}
    after = written(later_blocks(rows, sums, F.sum, False).select(F.col("conv_id").alias("of"), "block", *[F.col(x).alias(f"more_{x}") for x in sums]), "sums-after")
    ends_block = (F.col("conv_id") == F.col("of")) & (block() == F.col("block")) & (F.col("place") % BLOCK == BLOCK - 1)
    rows = rows.join(after, ends_block, "left").withColumns({x: F.col(x) + F.coalesce(f"more_{x}", F.lit(0)) for x in sums})
    shards = max(1, -(-paths.count() // SHARD_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("conv_id", block()), F.lit(shards)))
    kept = ["shard", "place", "d1", "d2", "u1", "u2", "t1", "t2", *sums]
    partial = rows.select(*kept).groupBy("shard").applyInArrow(node_table, PARTIAL)
    return partial.groupBy("d1", "d2").agg(*[F.sum(x).alias(x) for x in ("n_convs", *sums)])


def pack_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids that end at one node as one text each."""
    for batch in batches:
        d1, d2 = batch.column("d1").to_numpy(), batch.column("d2").to_numpy()
        if not len(d1):
            continue
        starts = np.flatnonzero(np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])]))
        ids, ends = batch.column("conv_id").cast(pa.string()).to_pylist(), [*starts[1:].tolist(), len(d1)]
        pieces = [",".join(ids[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)]
        firsts = batch.column("conv_id").to_numpy()[starts]
        yield pa.RecordBatch.from_arrays([pa.array(d1[starts]), pa.array(d2[starts]), pa.array(firsts), pa.array(pieces, pa.string())], ["d1", "d2", "first", "ids"])


def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's texts, which come in order; one hash state is held at a time."""
    current, state = None, None

    def row(made):
        columns = list(zip(*made, strict=True)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["e1", "e2", "ends"])

    for batch in batches:
        made = []
        for d1, d2, ids in zip(*(batch.column(x).to_pylist() for x in ("d1", "d2", "ids")), strict=True):
            if current == (d1, d2):
                state.update(b"," + ids.encode())
                continue
            if state:
                made.append((*current, state.hexdigest()))
            current, state = (d1, d2), hashlib.sha256(ids.encode())
        yield row(made)
    if state:
        yield row([(*current, state.hexdigest())])


def end_hashes(paths: DataFrame) -> DataFrame:
    """``(e1, e2, ends)``: SHA-256 of the comma-joined ids of the conversations that end at a node.

    Ids are sorted by ranges of all rows and joined to pieces there. A hash over
    one text has to run over its pieces one after another, in one task for a node.
    """
    last = paths.groupBy("conv_id").agg(F.max("place").alias("place"))
    ends = written(paths.join(last, ["conv_id", "place"]).select("d1", "d2", "conv_id"), "ends")
    order = ["d1", "d2", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack_ids, "d1 long, d2 long, first long, ids string")
    return pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first").mapInArrow(hash_ids, "e1 long, e2 long, ends string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    Turns are ordered by turn, NULL first, and rows that share a turn by the SHA-256
    of role and text; NULL role and text are empty. A conversation is rebuilt from the
    first h turns of conv_id - conv_id % 20 (all if fewer, none if absent), h being
    crc32 of its id modulo 4, and its own turns after its first h. Each distinct
    sequence of first turns is a node, conv_id its smallest member; the root has
    depth 0, holds every conversation, even one without turns, and has no parent.
    ``n_leaves`` counts nodes without children in the subtree, the node included;
    ``saved_tokens`` sums over it the words of a node's last text for every member
    but one; ``ends_sha256`` hashes the ids of conversations that end there. Rows
    without a conv_id belong to no conversation and take no part. Repeated rows are
    turns of their own. An empty table has no nodes. Texts that are not valid
    UTF-8 are told apart by their bytes. Needs conv_id, turn, role and text.
    """
    places = written(numbered(turn_rows(conversations)), "places")
    convs = written(places.select("conv_id").distinct(), "conversations")
    paths = prefix_paths(rebuilt(places, convs), convs)
    nodes = distinct_nodes(paths)
    sums, ends = subtree_sums(paths, nodes), end_hashes(paths)
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    is_parent = (F.col("u1") == F.col("p1")) & (F.col("u2") == F.col("p2")) & (F.col("depth") > 0)
    found = nodes.join(sums, ["d1", "d2"]).join(ends, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left").join(parents, is_parent, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("gross") - F.col("own")).alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
