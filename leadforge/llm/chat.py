"""Chat formatting from event logs.

A conversation is a log of events: ``conv_id, seq, tie, msg_id, sub, kind,
role, text``.  The log is dealt by conversation, sorted by
``seq, tie, msg_id, sub`` and folded as it streams by, one conversation in
memory at a time:

``start``       opens message ``msg_id`` of ``role`` at the end, with ``text``
``delta``       appends ``text`` to the message
``edit``        replaces the message's text
``regenerate``  empties the message and drops all after it; deltas refill it

Events of other kinds or of unknown messages change nothing and are counted.

The template:  user ``[INST]text[/INST]``, assistant ``<s>text</s>``, system
``<<SYS>>text<</SYS>>``, any other role ``[ROLE]role[SAYS]text[/ROLE]``.
Inside texts a backslash and the first character of every control string get
a backslash in front, which makes the format exactly reversible.  The loss
mask covers the assistants' texts, without their marks.

Edge cases: null text and null role are empty; a null ``conv_id`` is one
conversation; equal events all count; a conversation without any message has
a row with no turns; an empty log has no rows.  A conversation is one row, so
it has to fit into one (2 GB).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

EVENTS = "conv_id long, seq long, tie long, msg_id long, sub long, kind string, role string, text string"
ORDER = ["conv_id", "seq", "tie", "msg_id", "sub"]
#: Characters of a streamed delta, where texts are replayed as events.
DELTA_CHARS = 4096

OPEN = {"user": "[INST]", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "<</SYS>>"}
ROLE, SAYS, END_ROLE = "[ROLE]", "[SAYS]", "[/ROLE]"
CONTROL = [*OPEN.values(), *CLOSE.values(), ROLE, SAYS, END_ROLE]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\|(?=" + _CONTROL.pattern + ")")
_TOKEN = re.compile(r"\\.|" + _CONTROL.pattern, re.S)
_UNESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points) under the loss."""
    out, spans, at = [], [], 0
    for role, text in turns:
        body = escape(text)
        head = OPEN.get(role) or ROLE + escape(role) + SAYS
        whole = head + body + (CLOSE.get(role) or END_ROLE)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(whole)
        at += len(whole)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; ValueError if it is none."""
    role_of, marks = {v: k for k, v in OPEN.items()}, [m for m in _TOKEN.finditer(formatted) if m[0][0] != "\\"]
    turns, k, at = [], 0, 0

    def until(mark: str) -> str:
        nonlocal k, at
        if k == len(marks) or marks[k][0] != mark:
            raise ValueError(f"{mark} expected after {at}")
        body = unescape(formatted[at:marks[k].start()])
        at, k = marks[k].end(), k + 1
        return body

    while at < len(formatted):
        if k == len(marks) or marks[k].start() != at:
            raise ValueError(f"text outside turns at {at}")
        mark, at, k = marks[k][0], marks[k].end(), k + 1
        if mark in role_of:
            turns.append((role_of[mark], until(CLOSE[role_of[mark]])))
        elif mark == ROLE:
            role = until(SAYS)
            turns.append((role, until(END_ROLE)))
        else:
            raise ValueError(f"{mark} at {at} opens no turn")
    return turns


class Fold:
    """The state of one conversation."""

    def __init__(self) -> None:
        self.messages: dict[int, list] = {}  # msg_id -> [role, text parts], in order
        self.ignored = 0

    def apply(self, kind: str, msg_id: int, role: str | None, text: str | None) -> None:
        text = text or ""
        if kind == "start" and msg_id not in self.messages:
            self.messages[msg_id] = [role or "", [text]]
        elif kind == "delta" and msg_id in self.messages:
            self.messages[msg_id][1].append(text)
        elif kind == "edit" and msg_id in self.messages:
            self.messages[msg_id][1] = [text]
        elif kind == "regenerate" and msg_id in self.messages:
            for later in [m for m in reversed(self.messages)]:
                if later == msg_id:
                    break
                del self.messages[later]
            self.messages[msg_id][1] = []
        else:
            self.ignored += 1

    def turns(self) -> list[tuple[str, str]]:
        return [(role, "".join(parts)) for role, parts in self.messages.values()]


FORMATTED = "conv_id long, n_turns long, n_ignored long, formatted string, loss_spans array<struct<start:long,end:long>>"
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("n_ignored", pa.int64()), ("formatted", pa.string()),
                        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted events -> formatted conversations."""
    current, state, done, size = None, None, [], 0

    def row():
        turns = state.turns()
        formatted, spans = render(turns)
        return {"conv_id": current, "n_turns": len(turns), "n_ignored": state.ignored, "formatted": formatted,
                "loss_spans": [{"start": a, "end": b} for a, b in spans]}

    for b in batches:
        for conv, kind, msg, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "msg_id", "role", "text"))):
            if state is None or conv != current:
                if state is not None:
                    done.append(row())
                    size += len(done[-1]["formatted"])
                current, state = conv, Fold()
            state.apply(kind, msg, role, text)
            if size > 4 << 20 or len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=_FORMATTED)
                done, size = [], 0
    if state is not None:
        done.append(row())
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_FORMATTED)


def format_conversations(events: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_ignored, formatted, loss_spans`` of every log."""
    n = shuffle_partitions(events.sparkSession)
    return (events.select(*ORDER, "kind", "role", "text").repartition(n, "conv_id").sortWithinPartitions(*ORDER)
            .mapInArrow(_fold, FORMATTED))


def replay(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The event log of finished turns ``conv_id, turn, role, text``: a start
    and the text in deltas.  Turns of equal number are ordered by a hash of
    role and text, so the order does not depend on the partitioning."""
    row = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"), F.xxhash64("role", "text").alias("tie"),
        F.monotonically_increasing_id().alias("msg_id"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    subs = F.sequence(F.lit(0).cast("long"), F.ceil(F.char_length("text") / delta_chars).cast("long"))
    return (row.withColumn("sub", F.explode(subs))
            .select(*ORDER, F.when(F.col("sub") == 0, "start").otherwise("delta").alias("kind"), "role",
                    F.when(F.col("sub") > 0, F.substring("text", ((F.col("sub") - 1) * delta_chars + 1).cast("int"), F.lit(delta_chars))).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted output finds, as digests."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, text, spans in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=DIGESTS)

    return (formatted.select("conv_id", "formatted", "loss_spans")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
