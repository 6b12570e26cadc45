"""Dropping lines that many documents share, by a sharded minimal perfect hash.

Every distinct line hash gets a slot of its own in a minimal perfect hash, built
per shard of the hash space. A slot holds a one-byte fingerprint and the number of
documents, saturated at one byte where the threshold allows it: about two and a
half bytes a line and no line text. Documents send the hashes of their lines to
the shards and probe the arrays there; only hits come back. As every line that is
probed was counted before, a probe never meets a foreign slot, and the
fingerprint only proves this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import in_slices, on_plain_names, valid_text, written

MIN_DOCS = 10
#: Distinct lines in a shard, and probes that one task answers.
SHARD_LINES = 200_000
SHARD_PROBES = 1_000_000
GAMMA = 1.6
FLUSH = 500_000
INDEX = "shard long, levels array<binary>, fingerprints binary, counts binary"


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends and A-Z lower-cased, as bytes do it."""
    return line.strip().lower()


def line_hashes(lines: list[bytes]) -> list[int]:
    """Signed 64-bit hashes of the keys; 0 for an empty key."""
    return [xxhash.xxh3_64_intdigest(k) - (1 << 63) if (k := line_key(x)) else 0 for x in lines]


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing step (multiply and shift) under a seed."""
    with np.errstate(over="ignore"):
        x = (keys ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(29))


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays, one a level: keys that meet another at a level go to the next."""
    levels, level = [], 0
    while len(keys):
        size = max(64, int(GAMMA * len(keys)) + 63 & ~63)
        at = (mixed(keys, level + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
        level += 1
    return levels


def slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each key in 0..n-1; -1 for a key that no level holds."""
    out, rest, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        at = (mixed(keys[rest], level + 1) % np.uint64(len(bits))).astype(np.int64)
        held = bits[at]
        rank = np.cumsum(bits) - 1
        out[rest[held]] = base + rank[at[held]]
        base += int(bits.sum())
        rest = rest[~held]
    return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 0) >> np.uint64(56)).astype(np.uint8)


def count_type(min_docs: int) -> np.dtype:
    return np.dtype("u1" if min_docs < 2**8 else "<u4" if min_docs < 2**32 else "<u8")


def build_shard(min_docs: int):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame["line"].to_numpy(np.int64).view(np.uint64)
        levels, kind = build_levels(keys), count_type(min_docs)
        at = slots(keys, levels)
        prints, counts = np.zeros(len(keys), np.uint8), np.zeros(len(keys), kind)
        prints[at] = fingerprint(keys)
        counts[at] = np.minimum(frame["n"].to_numpy(), np.iinfo(kind).max).astype(kind)
        packed = [np.packbits(x).tobytes() for x in levels]
        return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "levels": [packed], "fingerprints": [prints.tobytes()], "counts": [counts.tobytes()]})

    return build


def probe_shard(min_docs: int):
    def probe(arrays: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        keys = asked["line"].to_numpy(np.int64).view(np.uint64)
        row = arrays.iloc[0]
        levels = [np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in row["levels"]]
        prints, counts = np.frombuffer(row["fingerprints"], np.uint8), np.frombuffer(row["counts"], count_type(min_docs))
        at = slots(keys, levels)
        if (at < 0).any() or (prints[at] != fingerprint(keys)).any():
            raise ValueError("a line was probed that was never counted")
        return asked.loc[counts[at] >= min_docs, ["row_key", "line"]]

    return probe


def distinct_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(row_key, line)``: the distinct non-empty keys of each document."""
    for batch in in_slices(batches):
        keys, lines = [], []
        for key, text in zip(batch.column("row_key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = set(line_hashes(text.encode().split(b"\n")))
            found.discard(0)
            lines.extend(found)
            keys.extend([key] * len(found))
            if len(lines) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lines, pa.int64())], ["row_key", "line"])
                keys, lines = [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lines, pa.int64())], ["row_key", "line"])


def drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every column but ``__gone``, the text without these lines, and the counts."""
    for batch in in_slices(batches):
        kept, total, dropped = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("__gone").to_pylist(), strict=True):
            lines = text.encode().split(b"\n")
            gone = frozenset(gone or ())
            rest = [x for x, h in zip(lines, line_hashes(lines), strict=True) if h not in gone] if gone else lines
            kept.append(b"\n".join(rest).decode() if gone else text)
            total.append(len(lines))
            dropped.append(len(lines) - len(rest))
        own = {x: batch.column(x) for x in batch.schema.names if x != "__gone"}
        made = {"text": pa.array(kept, pa.string()), "__n_lines": pa.array(total, pa.int64()), "__n_dropped": pa.array(dropped, pa.int64())}
        yield pa.RecordBatch.from_pydict(own | made)


def line_index(lines: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """Minimal perfect hash, fingerprint and count arrays, a row per shard."""
    counted = lines.groupBy("line").agg(F.count("*").alias("n"))
    sharded = counted.withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(shards)))
    return sharded.groupBy("shard").applyInPandas(build_shard(min_docs), INDEX)


def row_key():
    """A key that equal rows, and they alone, share: of doc_id and text."""
    return F.xxhash64(F.lit(11), F.col("doc_id").cast("long"), valid_text())


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(row_key, gone)``: hashes of a document's lines that ``min_docs`` documents hold."""
    rows = docs.select(row_key().alias("row_key"), valid_text().alias("text"))
    lines = written(rows.mapInArrow(distinct_lines, "row_key long, line long"), "lines")
    shards = max(1, -(-lines.count() // SHARD_LINES))
    index = written(line_index(lines, min_docs, shards), "line-index")
    asked = lines.distinct().withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(shards)))
    # A line that a third of the documents hold makes one shard hot: its probes are dealt over several copies of its arrays.
    busy = asked.groupBy("shard").agg(F.count("*").alias("probes"))
    busy = written(busy.select("shard", F.ceil(F.col("probes") / SHARD_PROBES).cast("long").alias("parts")), "shard-parts")
    arrays = index.join(busy, "shard").withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("parts")
    asked = asked.join(busy, "shard").withColumn("part", F.pmod(F.xxhash64("row_key"), F.col("parts"))).drop("parts")
    hits = arrays.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(probe_shard(min_docs), "row_key long, line long")
    return written(hits.groupBy("row_key").agg(F.collect_set("line").alias("gone")), "gone-lines")


@on_plain_names("doc_id", "text")
def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with the lines kept as ``text``, and ``__n_lines`` and ``__n_dropped`` added.

    A text is split at each \\n; NULL and empty texts are one empty line. A line's
    key is the line without ASCII white space at its ends, A-Z lower-cased. Lines
    whose key holds at least one character and occurs in ``min_docs`` documents or
    more are dropped everywhere, and the others are joined by \\n. Repeated rows
    are documents of their own. Keys are told apart by 64-bit hashes. Needs
    columns doc_id and text; others pass through as they are. Bytes that are not
    valid UTF-8 become U+FFFD.
    """
    gone = frequent_lines(docs, min_docs).toDF("__gone_key", "__gone")
    rows = docs.withColumns({"text": valid_text(), "__row_key": row_key()})
    found = rows.join(gone.hint("merge"), F.col("__row_key") == F.col("__gone_key"), "left").drop("__row_key", "__gone_key")
    fields = [T.StructField("text", T.StringType()) if f.name == "text" else f for f in docs.schema.fields]
    out = T.StructType([*fields, T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())])
    return found.mapInArrow(drop_lines, out)
