"""Best-fit packing of tokenised documents with Martello-Toth dominance reduction.

Piece lengths are whole numbers up to the capacity, so the whole instance is a
count per length: ``capacity`` numbers, however many documents there are. On these
counts the driver first fixes sets that dominate every alternative of their
largest piece, then packs what is left by best fit, largest first. The result is a
short list of sequence patterns with multiplicities. Pieces are then numbered
within their length by a distributed prefix sum, and their number picks the
sequence and the place in it.
"""

from __future__ import annotations

import array
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import in_slices, valid_text, written

CAPACITY = 1024
END_ID = 2
#: Pieces of one length that one task numbers.
CHUNK = 1000
TOKENIZER = "byte_bpe_50k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, packed_ids binary"

Bins = list[tuple[list[tuple[int, int]], int]]  # ([(length, times)], how many such sequences)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 ones for themselves, the others numbered from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path: str) -> Callable[[str], list[int]]:
    """Token ids of a text by the tokenizer file at ``path``.

    Where the file is a byte-level BPE whose ids follow its merges, the same ids
    come several times faster from a rank table of the same vocabulary. Texts
    that hold an added token, and any other tokenizer, go to the tokenizer itself.
    """
    import public_tokenizers

    with open(path) as file:
        spec = json.load(file)
    model, added, symbols, own = spec["model"], [x["content"] for x in spec["added_tokens"]], byte_symbols(), []

    def by_tokenizer(text: str) -> list[int]:
        if not own:
            own.append(tokenizers.Tokenizer.from_file(path))
        return own[0].encode(text, add_special_tokens=False).ids

    vocab, merges = model["vocab"], [x if isinstance(x, list) else x.split(" ") for x in model.get("merges", [])]
    shape = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    ranked = (
        spec["normalizer"] is None
        and isinstance(spec["pre_tokenizer"], dict)
        and shape.items() <= spec["pre_tokenizer"].items()
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
        and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
    )
    if not ranked:
        return by_tokenizer
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_ranks(text: str) -> list[int]:
        return by_tokenizer(text) if any(x in text for x in added) else fast.encode_ordinary(text)

    return by_ranks


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(start, ids)`` of the pieces; only the first may be shorter than the capacity."""
    first = len(ids) % capacity or capacity
    for start, end in zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity), strict=True):
        yield start, ids[start:end]


def packed_type(path: str) -> str:
    """The narrowest unsigned type that holds every id of the tokenizer at ``path``."""
    largest = max(tokenizers.Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)
    return "<u2" if max(largest, END_ID) < 1 << 16 else "<u4"


def tokenize(path: str, capacity: int, packed: str | None):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("packed_ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in in_slices(batches):
            out = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array(array.array("I", [*encode(text), END_ID]), dtype="<u4")
                for piece, (start, own) in enumerate(cut(ids, capacity)):
                    row = (doc_id, piece, start, len(own), zlib.crc32(own.tobytes()), own.astype(packed).tobytes() if packed else None)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, packed: str | None = None) -> DataFrame:
    """``PIECES`` of whole texts, the end id last; ``packed_ids`` are its ids as numbers of the type ``packed``, or NULL."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), valid_text().alias("text"))
    return rows.mapInArrow(tokenize(path, capacity, packed), PIECES)


def with_ids(found: DataFrame, packed: str) -> DataFrame:
    """``found`` with the array ``ids`` in place of ``packed_ids``."""
    columns = [f if f.name != "packed_ids" else T.StructField("ids", T.ArrayType(T.IntegerType())) for f in found.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1024):
            blobs = batch.column("packed_ids").to_pylist()
            ends = np.cumsum([0, *(len(x) // np.dtype(packed).itemsize for x in blobs)], dtype="i4")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), packed).astype("i4")))
            yield pa.RecordBatch.from_pydict({f.name: ids if f.name == "ids" else batch.column(f.name) for f in columns})

    return found.mapInArrow(run, T.StructType(columns))


def reduce_counts(counts: dict[int, int], capacity: int) -> Bins:
    """Takes dominating sets out of ``counts`` and returns them.

    For the largest piece ``j`` with ``room`` beside it, a set dominates when any
    set that holds j can be exchanged for it without another sequence:
    nothing else fits; a piece fills the room exactly; one more fits at most, and
    the largest that fits is taken; two more fit at most, and the largest single
    one is at least the largest fitting pair; or a pair of the largest one and the
    largest beside it, where no pair has both pieces above the second.
    """
    fixed: Bins = []

    def sizes() -> list[int]:
        return sorted(s for s, n in counts.items() if n > 0)

    def fix(pattern: list[tuple[int, int]]) -> bool:
        times = min(counts[s] // k for s, k in pattern)
        for s, k in pattern:
            counts[s] -= k * times
        fixed.append((pattern, times))
        return times > 0

    def found(j: int) -> list[tuple[int, int]] | None:
        room = capacity - j
        counts[j] -= 1
        there = [s for s in sizes() if s <= room]
        left = {s: counts[s] for s in there}
        counts[j] += 1
        if not there:
            return [(j, 1)]
        k = there[-1]
        smallest = [s for s in there[:3] for _ in range(min(3, left[s]))][:3]
        pair = [(j, 2)] if k == j else [(j, 1), (k, 1)]
        if k == room or len(smallest) < 2 or sum(smallest[:2]) > room:
            return pair
        if len(smallest) < 3 or sum(smallest) > room:
            low, high, best = 0, len(there) - 1, 0
            while low <= high:
                a, b = there[low], there[high]
                if a + b > room or (low == high and left[a] < 2):
                    high -= 1
                else:
                    best, low = max(best, a + b), low + 1
            if k >= best:
                return pair
            second = [s for s in there if s <= room - k and (s != k or left[s] > 1)]
            if second:
                b = second[-1]
                above = [s for s in there if s > b]
                if not above or 2 * above[0] > room:
                    pattern: dict[int, int] = {}
                    for s in (j, k, b):
                        pattern[s] = pattern.get(s, 0) + 1
                    return list(pattern.items())
        return None

    changed = True
    while changed:
        changed = False
        for j in reversed(sizes()):
            while counts[j] > 0 and (pattern := found(j)):
                changed |= fix(pattern)
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Largest first, each piece into the fullest open sequence that takes it.

    Sequences filled alike are handled together, so the work follows the number
    of lengths and not of pieces.
    """
    open_bins: dict[int, list[tuple[dict[int, int], int]]] = {}

    def put(room: int, pattern: dict[int, int], times: int) -> None:
        if times:
            open_bins.setdefault(room, []).append((pattern, times))

    for s in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        n = counts[s]
        while n:
            room = min((r for r in open_bins if r >= s), default=None)
            pattern, times = ({}, n) if room is None else open_bins[room].pop()
            if room is None:
                room = capacity
            elif not open_bins[room]:
                del open_bins[room]
            each = room // s
            full = min(times, n // each)
            put(room - each * s, pattern | {s: each}, full)
            n -= full * each
            if full < times:
                rest = min(n, each)
                if rest:
                    put(room - rest * s, pattern | {s: rest}, 1)
                    n -= rest
                if pattern:
                    put(room, pattern, times - full - (1 if rest else 0))
    return [(list(pattern.items()), times) for group in open_bins.values() for pattern, times in group]


def plan_sequences(counts: dict[int, int], capacity: int) -> Bins:
    left = dict(counts)
    return [*reduce_counts(left, capacity), *best_fit(left, capacity)]


def slot_rows(bins: Bins) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, from_no, to_no, per, first_sequence, offset)``: which numbers of a length stand where."""
    rows, used, sequence = [], {}, 0
    for pattern, times in bins:
        offset = 0
        for s, k in pattern:
            start = used.get(s, 0)
            used[s] = start + k * times
            rows.append((s, start, used[s], k, sequence, offset))
            offset += s * k
        sequence += times
    return rows


def number_in_length(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``no``, from 0 within their length: a prefix sum over chunks.

    A column ``spread`` with a number for each row parts repeated rows too.
    """
    chunks = max(1, -(-most // CHUNK))
    key = ["spread"] if "spread" in rows.columns else ["doc_id", "piece", "ids_crc32"]
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(*key), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    starts = written(starts.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_no")), "length-starts")
    inside = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")
    return rows.withColumn("in_chunk", F.row_number().over(inside) - 1).join(starts, ["length", "chunk"]).withColumn("no", F.col("first_no") + F.col("in_chunk"))


def pack_pieces(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; lengths from 1 to the capacity."""
    spark = cut_pieces.sparkSession
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = slot_rows(plan_sequences(counts, capacity))
    schema = "slot_length long, from_no long, to_no long, per long, first_sequence long, slot_offset long"
    slots = F.broadcast(spark.createDataFrame(slots, schema).coalesce(1))
    numbered = number_in_length(cut_pieces, max(counts.values(), default=0))
    here = (F.col("length") == F.col("slot_length")) & (F.col("no") >= F.col("from_no")) & (F.col("no") < F.col("to_no"))
    inside = F.col("no") - F.col("from_no")
    return numbered.join(slots, here).select(
        *[c for c in cut_pieces.columns if c != "spread"],
        (F.col("first_sequence") + F.floor(inside / F.col("per"))).alias("sequence_id"),
        (F.col("slot_offset") + inside % F.col("per") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row per piece: ``(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset)``.

    A document is the ids of its whole text (NULL: empty) and ``END_ID``. Only
    longer ones are cut, into pieces of the capacity, of which the first may be
    shorter. Sequences are filled without gaps from 0. Repeated rows are packed
    as documents of their own. Bytes that are not valid UTF-8 count as U+FFFD. An empty table gives no rows. Needs doc_id and
    text. Slots, of which there are a few per length, are broadcast. ``ids`` are NULL
    without ``keep_ids``; with it they are shuffled once, two bytes each where the
    vocabulary allows.
    """
    path = path or tokenizer_path()
    packed = packed_type(path) if keep_ids else None
    found = pieces(docs, path, capacity, packed).withColumn("spread", F.monotonically_increasing_id())
    found = pack_pieces(written(found, "pieces"), capacity)
    if packed:
        return with_ids(found, packed)
    none = F.lit(None).cast("array<int>").alias("ids")
    return found.select(*[none if c == "packed_ids" else c for c in found.columns])


