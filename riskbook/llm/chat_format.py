"""Chat formatting with a template that is only ever called, never looked into.

``render(turns)`` gives the text of a conversation. The operator renders every prefix of the turns and
compares it with the one before: what was appended is the turn's span. Where the earlier output does not
stand at the front of the later one, the template rewrites history; the turn is reported and has no span,
nor have the turns before it. The place of an assistant's text inside its span is found by rendering the
prefix with two probe texts in its stead: they first differ where the text begins. All prefixes are rendered
whole, unless the template is declared append-only; only then long conversations are rendered by segments.

The template of this module marks turns by control strings and puts one backslash before every control
string inside a text (before its backslashes, if it has some), so that texts are read back unchanged.

Defined cases: a NULL text is empty; a NULL role is kept as no role; rows of one conversation and turn stand
in the order of role and text; repeated rows are turns of their own; rows with a NULL conversation id are
conversations of one turn each; an empty table gives no rows. A conversation, like a document, is handled in
one task; there is no bound on the number of conversations. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str | None, str]
Render = Callable[[Sequence[Turn]], str]

# What the template writes around a text, by role.
MARKS = {
    "system": ("[SYS] ", " [/SYS]\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("[ANS] ", " </s>\n"),
}
OTHER_OPEN, OTHER_HEAD_END, OTHER_CLOSE = "[ROLE ", "] ", " [/ROLE]\n"
_CONTROL = re.compile(r"(\\*)(</?s>|\[/?(?:INST|SYS|ANS|ROLE)\b)")
_ESCAPED = re.compile(r"\\(\\*)(</?s>|\[/?(?:INST|SYS|ANS|ROLE)\b)")
PROBES = ("A", "B")
LEAST_SEGMENT = 8
CONTEXT_TURNS = 2


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _marks(role: str | None) -> tuple[str, str]:
    if role in MARKS:
        return MARKS[role]
    return OTHER_OPEN + json.dumps(role) + OTHER_HEAD_END, OTHER_CLOSE


def render(turns: Sequence[Turn]) -> str:
    """The template of this module."""
    parts = []
    for role, text in turns:
        before, after = _marks(role)
        parts += [before, escape(text), after]
    return "".join(parts)


def parse(formatted: str) -> list[Turn]:
    """Read roles and texts back from what :func:`render` wrote."""
    turns: list[Turn] = []
    at = 0
    while at < len(formatted):
        for role, (before, after) in MARKS.items():
            if formatted.startswith(before, at):
                start = at + len(before)
                break
        else:
            role, start = json.JSONDecoder().raw_decode(formatted, at + len(OTHER_OPEN))
            start += len(OTHER_HEAD_END)
            after = OTHER_CLOSE
        # Inside a text every control string follows a backslash, so the first bare one ends it.
        end = formatted.index(after, start)
        turns.append((role, unescape(formatted[start:end])))
        at = end + len(after)
    return turns


def _text_place(turns: Sequence[Turn], template: Render) -> tuple[int, int]:
    """Where the text of the last turn begins in the output, and how much of the output follows it."""
    role = turns[-1][0]
    first, second = (template([*turns[:-1], (role, probe)]) for probe in PROBES)
    begin = len(os.path.commonprefix([first, second]))
    return begin, len(first) - begin - len(PROBES[0])


def _piece(turns: Sequence[Turn], template: Render, role: str, before: str, output: str):
    """What the last turn appends to the rendering of those before it, as (piece, place of its text within the
    piece or None); None if it changes what stood before."""
    if not output.startswith(before):
        return None
    place = None
    if turns[-1][0] == role:
        begin, tail = _text_place(turns, template)
        if len(before) <= begin <= len(output) - tail:
            place = (begin - len(before), len(output) - tail - len(before))
    return output[len(before) :], place


def _pieces(turns: Sequence[Turn], template: Render, role: str, low: int, start: int, end: int):
    """What each of turns[start:end] appends to the rendering of turns[low:]; None if one of them changes what
    stood before."""
    before = template(turns[low:start])
    found = []
    for i in range(start, end):
        output = template(turns[low : i + 1])
        piece = _piece(turns[low : i + 1], template, role, before, output)
        if piece is None:
            return None
        found.append(piece)
        before = output
    return found


def locate(
    turns: Sequence[Turn], template: Render, role: str = "assistant", append_only: bool = False
) -> dict:
    """Render the prefixes of a conversation.

    Gives ``formatted``; ``starts`` and ``ends`` of the turns' spans (None where unknown); ``rewrites``,
    the turns at which the template changed earlier output; ``loss``, the (start, end) of the texts of
    ``role`` in ``formatted``.

    Every prefix is rendered whole and compared with the one before, which takes time with the square of the
    turns. Only where the caller declares that the template is ``append_only``, that is that no turn changes
    what stands before it, the turns are cut into about sqrt(turns) segments: whole prefixes are rendered at
    the ends of segments; within one, prefixes start a few turns before the segment, and what they give must
    add up to what the whole prefixes differ by. If it does not, the segment is done again with whole
    prefixes. A rewrite that is undone within a segment would not be seen, so other templates must not be
    declared so.
    """
    n = len(turns)
    step = max(LEAST_SEGMENT, math.isqrt(n)) if append_only else max(1, n)
    starts: list[int | None] = []
    ends: list[int | None] = []
    loss: list[tuple[int, int]] = []
    rewrites: list[int] = []
    whole = template(turns[:0])

    def append(pieces: list, at: int) -> None:
        for piece, place in pieces:
            starts.append(at)
            if place:
                loss.append((at + place[0], at + place[1]))
            at += len(piece)
            ends.append(at)

    for start in range(0, n, step):
        end = min(n, start + step)
        if append_only:
            longer = template(turns[:end])
            pieces = _pieces(turns, template, role, max(0, start - CONTEXT_TURNS), start, end)
            if pieces is not None and whole + "".join(p for p, _ in pieces) == longer:
                append(pieces, len(whole))
                whole = longer
                continue
        for i in range(start, end):
            longer = template(turns[: i + 1])
            piece = _piece(turns[: i + 1], template, role, whole, longer)
            if piece is None:
                rewrites.append(i)
                starts[:], ends[:], loss[:] = [None] * (i + 1), [None] * (i + 1), []
            else:
                append([piece], len(whole))
            whole = longer
    return {"formatted": whole, "starts": starts, "ends": ends, "rewrites": rewrites, "loss": loss}


_SCHEMA = (
    "formatted string, turn_starts array<bigint>, turn_ends array<bigint>, rewrites array<bigint>,"
    " loss array<struct<start:bigint,end:bigint>>"
)
_ARROW = [
    pa.field("formatted", pa.string()),
    pa.field("turn_starts", pa.list_(pa.int64())),
    pa.field("turn_ends", pa.list_(pa.int64())),
    pa.field("rewrites", pa.list_(pa.int64())),
    pa.field("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
]


def format_chats(
    rows: DataFrame,
    template: Render = render,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
    append_only: bool = False,
) -> DataFrame:
    """One row per conversation: its id, the formatted text, turn spans, history rewrites, loss ranges.

    ``append_only`` declares that no turn changes what the template wrote before it, as with this module's
    own template; see :func:`locate`.
    """
    alone = F.when(F.col(conv_id).isNull(), F.monotonically_increasing_id())
    turns = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    grouped = (
        rows.select(F.col(conv_id).alias("id"), alone.alias("alone"), turns.alias("one"))
        .groupBy("id", "alone")
        .agg(F.array_sort(F.collect_list("one")).alias("turns"))
        .select("id", "turns")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for one in batch.column(1):
                turns = [(t["role"].as_py(), t["text"].as_py()) for t in one]
                found.append(locate(turns, template, learn, append_only))
            columns = [
                [f["formatted"] for f in found],
                [f["starts"] for f in found],
                [f["ends"] for f in found],
                [f["rewrites"] for f in found],
                [[{"start": a, "end": b} for a, b in f["loss"]] for f in found],
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["id", *[f.name for f in _ARROW]]
            )

    kind = grouped.schema["id"].dataType.simpleString()
    return grouped.mapInArrow(run, f"id {kind}, {_SCHEMA}").withColumnRenamed("id", conv_id)


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode("utf-8")).hexdigest()


def read_back(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Parse what :func:`format_chats` wrote with this module's template, and digest it per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(text)
                learnt = "".join(unescape(text[r["start"] : r["end"]]) for r in ranges)
                told = "".join(f"{role or ''}\n{body}\n" for role, body in turns)
                rows.append((len(turns), _digest(told), len(learnt), _digest(learnt), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *names])

    kind = formatted.schema[conv_id].dataType.simpleString()
    schema = (
        f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint"
    )
    rows = formatted.select(F.col(conv_id).alias("id"), "formatted", "loss").mapInArrow(run, schema)
    return rows.withColumnRenamed("id", conv_id)
