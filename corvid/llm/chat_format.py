"""Chat formatting by event-sourced reconstruction.

A conversation log is a table of events ``conv_id, seq, sub, event, role,
text``: ``start`` opens a message with a role, ``delta`` appends to it,
``edit`` replaces its text, ``regenerate`` empties it. The log is partitioned by
conversation and sorted by (seq, sub); each partition is folded in one
streaming pass that holds one message at a time, so a conversation with a
third of all rows costs a task time but not memory. Messages are rendered one
row each (the formatted conversation is the rows' segments in order), and
``read_back`` parses segments, again streaming, into turns, texts and the loss
mask (assistant texts).

Template of a turn: ``### <role>:`` newline, text, ``</turn>`` newline. In
roles and texts the characters ``\\``, ``#`` and ``<`` are escaped by a
backslash, so no control string can arise there; in roles also ``:`` and line
ends.

Defined results: null text is empty, null role is the empty role; a null
conversation id is one conversation, a null sequence number comes first; events
with equal (seq, sub) fold by role and text hash; rows that repeat are
separate turns; events before a conversation's first ``start`` open a message
with an empty role; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EVENTS = "conv_id long, seq long, sub long, event string, role string, text string"
OPEN, CLOSE = "### ", "</turn>\n"
LOSS_ROLE = "assistant"
_SPECIAL = re.compile(r"[\\#<]")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    return re.sub(r"[\\#<:]", lambda m: "\\" + m[0], role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def render_turn(role: str, text: str) -> str:
    return f"{OPEN}{escape_role(role)}:\n{escape(text)}{CLOSE}"


_TURN = re.compile(r"### ((?:[^\\:\n]|\\.)*):\n((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted string; raises on anything else."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn at {at}: {formatted[at : at + 40]!r}")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, chars_at: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``most`` characters (or one row)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[chars_at] or "")
        if size >= most:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def sorted_log(events: DataFrame) -> DataFrame:
    """The log dealt by conversation and sorted by sequence."""
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    return (
        events.select("conv_id", "seq", "sub", "event", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "sub", "role", tie)
    )


def fold(log: DataFrame) -> DataFrame:
    """Sorted log -> final messages, in order: ``conv_id, turn, role, text``
    (``turn`` counts from 0)."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        def messages():
            conv, turn, role, parts, is_open = None, 0, "", [], False
            first = True
            for c, _, _, event, r, text in _rows(batches):
                if first or c != conv or event == "start":
                    if is_open:
                        yield conv, turn, role, "".join(parts)
                        turn += 1
                    if first or c != conv:
                        turn = 0
                    conv, role, parts, is_open, first = c, r or "", [], True, False
                    if event == "start":
                        parts.append(text or "")
                        continue
                    role = ""
                if event == "delta":
                    parts.append(text or "")
                elif event == "edit":
                    parts = [text or ""]
                elif event == "regenerate":
                    parts = []
                else:
                    raise ValueError(f"unknown event {event!r}")
            if is_open:
                yield conv, turn, role, "".join(parts)

        yield from _batched(messages(), schema, 3)

    return log.mapInArrow(run, "conv_id long, turn long, role string, text string")


def render(messages: DataFrame) -> DataFrame:
    """Messages in order -> ``conv_id, turn, segment``, in the same order."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.string())])

    def run(batches):
        rows = ((c, t, render_turn(role or "", text or "")) for c, t, role, text in _rows(batches))
        yield from _batched(rows, schema, 2)

    return messages.mapInArrow(run, "conv_id long, turn long, segment string")


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(segments: DataFrame) -> DataFrame:
    """Segments in order -> one row of digests per conversation."""

    def run(batches):
        def conversations():
            conv, state = None, None
            for c, _, segment in _rows(batches):
                if state is None or c != conv:
                    if state:
                        yield done(conv, state)
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse_turns(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(segment)
            if state:
                yield done(conv, state)

        def done(conv, s):
            return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield from _batched(conversations(), pa.schema(list(zip(names, kinds, strict=True))), 2)

    return segments.mapInArrow(run, DIGESTS)


def format_log(events: DataFrame) -> DataFrame:
    """Event log -> rendered segments, dealt and sorted by conversation."""
    return render(fold(sorted_log(events)))


def as_events(conversations: DataFrame) -> DataFrame:
    """The event log that a table ``conv_id, turn, role, text`` of final
    messages stands for: a start, then the text as streamed deltas. Every
    third turn streams a draft that is regenerated; of the others every
    second is streamed with its last part wrong and then edited."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    third = F.expr("cast(length(coalesce(text, '')) div 3 as int)")

    def event(kind, value, role=None):
        return F.struct(
            F.lit(kind).alias("event"),
            (F.lit(None).cast("string") if role is None else role).alias("role"),
            value.alias("text"),
        )

    parts = [F.substr(text, F.lit(1), third), F.substr(text, third + 1, third), F.substr(text, third * 2 + 1, n)]
    start = event("start", F.lit(""), F.col("role"))
    deltas = [event("delta", p) for p in parts]
    draft = [event("delta", parts[2]), event("delta", parts[0]), event("regenerate", F.lit(""))]
    kind = F.pmod(F.coalesce("turn", F.lit(0)), F.lit(3))
    events = (
        F.when(kind == 1, F.array(start, *draft, *deltas))
        .when(kind == 2, F.array(start, *deltas[:2], event("delta", parts[0]), event("edit", text)))
        .otherwise(F.array(start, *deltas))
    )
    # Rows of one turn keep their events apart by role, text hash and row.
    row = F.row_number().over(
        Window.partitionBy("conv_id", "turn").orderBy(F.coalesce("role", F.lit("")), F.xxhash64(text))
    )
    return conversations.withColumn("__row", row).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long").alias("seq"),
        F.posexplode(events).alias("pos", "e"),
        "__row",
    ).select("conv_id", "seq", (F.col("__row") * 16 + F.col("pos")).cast("long").alias("sub"), "e.event", "e.role", "e.text")
