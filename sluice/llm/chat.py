"""Chat formatting from event logs.

A log holds events of a conversation in sequence order: messages open, their text
streams in as deltas, edits replace a message's text and regenerations discard that
of the last message of a role, which is then written anew. The log is partitioned
by conversation and sequence into sorted ranges, so that a conversation of any
length is folded by many tasks: running values say which message an event belongs
to, a message's last edit or regeneration is found by a window over its own
events, and what was written since is joined and rendered, a message a row.

Template: ``<s>[INST]role[/INST]text</s>`` for each message. A backslash before
the second character takes a control string in a role or text apart, and a
backslash itself is doubled, so texts are read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import in_slices, written
from sluice.llm.ranges import in_ranges, running

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPED = re.compile(r"\\|" + "|".join(rf"{re.escape(x[0])}(?={re.escape(x[1:])})" for x in CONTROLS))
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
RENDERED = "conv_id long, message long, role string, rendered string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered message, and where the text stands in it."""
    head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
    return f"{head}{body}</s>", len(head), len(head) + len(body)


def read_back(rendered: str) -> tuple[str, str]:
    whole = TURN.fullmatch(rendered)
    return unescape(whole[1]), unescape(whole[2])


def render_messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final messages, each rendered by itself."""
    for batch in in_slices(batches):
        made = [render(role, text) for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        learnt = [role == "assistant" for role in batch.column("role").to_pylist()]
        arrays = [
            batch.column("conv_id"),
            batch.column("message"),
            batch.column("role"),
            pa.array([x for x, _, _ in made], pa.string()),
            pa.array([x if yes else None for (_, x, _), yes in zip(made, learnt, strict=True)], pa.int64()),
            pa.array([x if yes else None for (_, _, x), yes in zip(made, learnt, strict=True)], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "message", "role", "rendered", "loss_start", "loss_end"])


def turn_events(conversations: DataFrame) -> DataFrame:
    """A log of ``(conv_id, seq, tie, copy, part, kind, role, text, target)`` that ends in the given turns.

    Each turn opens a message and streams its text as three deltas. By a hash of the
    turn, some stream the text's first half as a draft before, and then regenerate or
    edit it. Rows that share a turn come one after another, in the order of role and
    text; repeated rows are turns of their own.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("seq"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("copy"),
    )
    n, none = F.length("text"), F.lit(None).cast("long")

    def cut(low: Column, high: Column) -> Column:
        return F.substring("text", (low + 1).cast("int"), (high - low).cast("int"))

    thirds = [F.floor(n * i / 3) for i in range(4)]
    whole = [("delta", cut(a, b)) for a, b in zip(thirds, thirds[1:], strict=False)]
    draft = ("delta", cut(F.lit(0), F.floor(n / 2)))
    logs = [whole, [draft, ("regenerate", F.lit("")), *whole], [draft, ("edit", cut(thirds[0], thirds[1])), *whole[1:]]]

    def events(log: list[tuple[str, Column]]) -> Column:
        log = [("open", F.lit("")), *log]
        return F.array(*[F.struct(F.lit(i).alias("part"), F.lit(kind).alias("kind"), text.alias("text")) for i, (kind, text) in enumerate(log)])

    chosen = F.pmod(F.xxhash64("conv_id", "seq", "role", "text"), F.lit(len(logs)))
    log = F.when(chosen == 0, events(logs[0])).when(chosen == 1, events(logs[1])).otherwise(events(logs[2]))
    tied = turns.withColumns({"tie": F.xxhash64("role", "text"), "event": F.explode(log)})
    return tied.select("conv_id", "seq", "tie", "copy", "event.part", "event.kind", "role", "event.text", none.alias("target"))


def fold_events(events: DataFrame) -> DataFrame:
    """``(conv_id, message, role, text)``: the final messages of a log."""
    order = [x for x in ("seq", "tie", "copy", "part") if x in events.columns]
    plain = events.select(F.col("conv_id").cast("long").alias("conv_id"), *order, "kind", "role", F.coalesce("text", F.lit("")).alias("text"), F.col("target").cast("long").alias("target"))
    rows = in_ranges(plain, ["conv_id"], order, "chat-events")
    opens, again = F.col("kind") == "open", F.col("kind") == "regenerate"
    rows = running(rows, ["conv_id"], "opened", opens.cast("long"), total=True)
    newest = F.when(opens, F.col("opened") - 1)
    said = F.when(opens | again, F.coalesce("role", F.when(opens, F.lit(""))))
    rows = written(rows.withColumns({"newest": newest, "said": said}), "chat-numbered")
    rows = running(rows, ["conv_id", "said"], "newest_of_role", newest)
    renewed = F.when(F.col("role").isNull(), F.when(F.col("opened") > 0, F.col("opened") - 1)).otherwise(F.col("newest_of_role"))
    rows = written(rows.withColumn("turned_to", F.when(opens, newest).when(again, renewed)), "chat-turned")
    rows = running(rows, ["conv_id"], "current", F.col("turned_to"))
    edited = F.when(F.col("target").isNull(), F.col("current")).when((F.col("target") >= 0) & (F.col("target") < F.col("opened")), F.col("target"))
    message = F.when(opens | again, F.col("turned_to")).when(F.col("kind") == "edit", edited).when(F.col("kind") == "delta", F.col("current"))
    rows = rows.withColumn("message", message).filter("message is not null")
    own = Window.partitionBy("conv_id", "message")
    reset = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("place"))).over(own)
    rows = rows.withColumn("reset", reset).filter(opens | F.col("reset").isNull() | (F.col("place") >= F.col("reset")))
    counts = F.col("reset").isNull() | (F.col("place") >= F.col("reset"))
    piece = F.when(counts & ~again, F.struct("place", "text"))
    grouped = rows.groupBy("conv_id", "message").agg(
        F.max(F.when(opens, F.coalesce("role", F.lit("")))).alias("role"), F.array_sort(F.collect_list(piece)).alias("pieces")
    )
    text = F.array_join(F.transform("pieces", lambda x: x["text"]), "")
    return grouped.select("conv_id", "message", F.make_valid_utf8("role").alias("role"), F.make_valid_utf8(text).alias("text"))


def render_chats(events: DataFrame) -> DataFrame:
    """Rendered messages ``(conv_id, message, role, rendered, loss_start, loss_end)``.

    ``events`` has conv_id, seq, kind, role, text and target; ``tie``, ``copy`` and
    ``part`` order events of one seq where present. ``open`` starts a message of a
    role, with a first text; ``delta`` adds to the message in hand; ``edit`` replaces the
    text of message ``target`` (from 0; NULL: the one in hand); ``regenerate``
    empties the last message of its role (NULL: of any) and takes it in hand. Events
    for messages that are not there change nothing. The text of a conversation is
    its messages' in order, and the loss covers ``loss_start`` to ``loss_end`` (code
    points of a message; NULL: no loss). NULL role of a message and NULL text are
    empty, and bytes that are not valid UTF-8 become U+FFFD; events of NULL conv_id
    form one conversation. Other columns are not read.
    """
    return fold_events(events).mapInArrow(render_messages, RENDERED)


def read_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and hashes of conversations read back from rendered messages, in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    current, state = None, None

    def row():
        n, turns, loss_chars, loss, chars = state
        return dict(zip(schema.names, (current[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars), strict=True))

    for batch in in_slices(batches):
        made = []
        for x in batch.to_pylist():
            if current is None or current[0] != x["conv_id"]:
                if state:
                    made.append(row())
                current, state = (x["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_back(x["rendered"])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if x["loss_start"] is not None:
                learnt = unescape(x["rendered"][x["loss_start"] : x["loss_end"]])
                state[2] += len(learnt)
                state[3].update(learnt.encode())
            state[4] += len(x["rendered"])
        yield pa.RecordBatch.from_pylist(made, schema)
    if state:
        yield pa.RecordBatch.from_pylist([row()], schema)


def chat_digests(rendered: DataFrame) -> DataFrame:
    """A row per conversation, read back from rendered messages.

    A hash over a conversation's whole text has to run over its messages in order, in
    one task for a conversation, which holds one batch of them at a time.
    """
    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "message")
    return ordered.mapInArrow(read_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
