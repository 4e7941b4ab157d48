"""Chat formatting with a grammar round trip.

A turn is rendered as ``### role: text</turn>`` and a line feed. A deterministic parser reads rendered text back; where what it
recovers differs from the source (a text holds a control string, an escape, or ends in one), conflicting content is escaped
and rendered again until both are identical. Escaping doubles the backslashes before a control string, and before a field's end, and puts one more
before the control string itself, so an odd run means text and an even run means control.

Turns are rendered and checked each on their own, in parallel; a conversation is its turns in order (turn, role, text; nulls first),
so a conversation of any length only streams through the task that folds its digests. Rows: null roles and texts count as empty, a null conv_id is
a conversation of its own, repeated rows are turns of their own, other columns don't matter, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

OPEN, MIDDLE, CLOSE, TRAINED = "### ", ": ", "</turn>", "assistant"
_ROLE = re.compile(r"(\\*)(### |: |</turn>)")
_TEXT = re.compile(r"(\\*)(### |</turn>)")
_LAST = re.compile(r"\\+\Z")


class Conflict(ValueError):
    """Rendered text that the grammar doesn't accept."""


def _escape(field: str, controls: re.Pattern) -> str:
    field = controls.sub(lambda m: m[1] * 2 + "\\" + m[2], field)
    return _LAST.sub(lambda m: m[0] * 2, field)


def unescape(field: str, controls: re.Pattern = _TEXT) -> str:
    """The source of a rendered field."""
    field = controls.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], field)
    return _LAST.sub(lambda m: m[0][: len(m[0]) // 2], field) if field.endswith("\\") else field


def _field(text: str, at: int, controls: re.Pattern, ends: str) -> int:
    """Where the field that starts at ``at`` ends: at the first control string that isn't escaped, which must be ``ends``."""
    for m in controls.finditer(text, at):
        if len(m[1]) % 2 == 0:
            if m[2] != ends:
                raise Conflict(f"{m[2]!r} at {m.start(2)}")
            return m.start(2)
    raise Conflict(f"no {ends!r} behind {at}")


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the rendered text field in code points."""
    at = 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise Conflict(f"no turn at {at}")
        middle = _field(text, at + len(OPEN), _ROLE, MIDDLE)
        start = middle + len(MIDDLE)
        end = _field(text, start, _TEXT, CLOSE)
        yield unescape(text[at + len(OPEN) : middle], _ROLE), unescape(text[start:end]), start, end
        at = end + len(CLOSE) + 1
        if text[at - 1 : at] != "\n":
            raise Conflict(f"no line end at {at - 1}")


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses back to its source, and where its text stands."""
    for r, t in ((role, text), (role, _escape(text, _TEXT)), (_escape(role, _ROLE), _escape(text, _TEXT))):
        shown = f"{OPEN}{r}{MIDDLE}{t}{CLOSE}\n"
        try:
            found = list(parse(shown))
        except Conflict:
            continue
        if [x[:2] for x in found] == [(role, text)]:
            return shown, found[0][2], found[0][3]
    raise Conflict(f"{role!r}, {text!r} can't be rendered")


def format_turns(turns: DataFrame) -> DataFrame:
    """A row per turn: conv_id, turn, role, text as they came, rendered, and the loss mask's span in it (empty unless it is trained on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                rows = [render(r, t) for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                masks = [(b, e) if r == TRAINED else (b, b) for r, (_, b, e) in zip(part.column(2).to_pylist(), rows, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x[0] for x in rows], pa.string()), pa.array([m[0] for m in masks], pa.int64()), pa.array([m[1] for m in masks], pa.int64())], ["conv_id", "turn", "role", "text", "rendered", "loss_start", "loss_end"])

    plain = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    return plain.mapInArrow(run, "conv_id long, turn long, role string, text string, rendered string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """A row per conversation, from the rendered text and masks alone: counts and digests of what the parser recovers."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []

        def closed() -> None:
            if state:
                rows.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, text, start, end in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if now != (conv,):
                    closed()
                    now, state = (conv,), [0, sha256(), 0, sha256(), 0]
                for role, said, *_ in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                lost = unescape(text[start:end])
                state[2] += len(lost)
                state[3].update(lost.encode())
                state[4] += len(text)
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
                rows.clear()
        closed()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
