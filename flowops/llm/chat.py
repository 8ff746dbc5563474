"""Chat formatting that reads back exactly: grammar round trips decide what is escaped.

    conversation := turn*
    turn         := "[INST]" text "[/INST]"              user
                  | "<s>" text "</s>"                    assistant
                  | "<<SYS>>" text "<</SYS>>"            system
                  | "<role:" text "><says>" text "</role>"   any other role

A turn is rendered as it is, parsed again by a deterministic parser and compared with its source. If they
differ, its content is escaped (a backslash before each backslash and control string) and the turn is
rendered again until both are identical. The parser ends each turn in its start state, so identical turns
make identical conversations and no conversation is held whole.

Turns of a conversation come by turn, then role and text; a null text or role is empty, a null conv_id is a
conversation of its own, equal rows are turns of their own. Extra columns are not used.
"""

from __future__ import annotations

import copy
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# How a turn of a role begins and ends.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("<role:", "><says>", "</role>")
CONTROLS = [mark for pair in MARKS.values() for mark in pair] + list(OTHER)
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_SPECIAL = re.compile(r"\\|" + _CONTROL.pattern)
_STEP = re.compile(r"\\(.)|(" + _CONTROL.pattern + ")", re.DOTALL)

Span = tuple[int, int]


def escaped(content: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], content)


def rendered(role: str, text: str) -> tuple[str, Span]:
    """One turn with its content as given, and where the text lies in it."""
    if role in MARKS:
        head, tail = MARKS[role]
    else:
        head, tail = OTHER[0] + role + OTHER[1], OTHER[2]
    return head + text + tail, (len(head), len(head) + len(text))


def _content(source: str, at: int, end: str) -> tuple[str, int, int] | None:
    """Unescaped content from ``at`` to the mark ``end``: (content, place of the mark, place after it)."""
    parts, begin = [], at
    for m in _STEP.finditer(source, at):
        parts.append(source[begin : m.start()])
        begin = m.end()
        if m[1] is not None:
            parts.append(m[1])
        elif m[2] == end:
            return "".join(parts), m.start(), m.end()
        else:
            return None
    return None


def parsed(source: str) -> list[tuple[str, str, Span]] | None:
    """The turns (role, text, place of the text) of a formatted text, or None if it is not in the grammar."""
    turns, at = [], 0
    while at < len(source):
        role, found = None, None
        for name, (head, tail) in MARKS.items():
            if source.startswith(head, at):
                role, begin, found = name, at + len(head), _content(source, at + len(head), tail)
                break
        else:
            if source.startswith(OTHER[0], at) and (named := _content(source, at + len(OTHER[0]), OTHER[1])):
                role, _, begin = named
                found = _content(source, begin, OTHER[2])
        if found is None:
            return None
        text, end, at = found
        turns.append((role, text, (begin, end)))
    return turns


def formatted_turn(role: str, text: str) -> tuple[str, Span]:
    """The rendering of a turn that parses back to it: as it is if it can be, else escaped."""
    for own in ((role, text), (role, escaped(text)), (escaped(role), escaped(text))):
        out, span = rendered(*own)
        if parsed(out) == [(role, text, span)]:
            return out, span
    raise ValueError(f"turn cannot be read back: {role!r}")


def formatted(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text, segment, loss_start, loss_end): the formatted text in segments.

    The formatted conversation is its segments one after the other; the loss mask of a segment is the part
    from loss_start to loss_end in code points, null where nothing is trained on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                segment, span = formatted_turn(role, text)
                start, end = span if role == trained else (None, None)
                segments.append(segment)
                starts.append(start)
                ends.append(end)
            added = [pa.array(segments, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, "segment", "loss_start", "loss_end"]
            )

    source = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schema = copy.deepcopy(source.schema).add("segment", "string").add("loss_start", "long").add("loss_end", "long")
    return source.mapInArrow(run, schema)


class _Reader:
    """What is read back from the segments of one conversation."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, segment: str, loss: Span | None) -> None:
        found = parsed(segment)
        if found is None:
            raise ValueError("formatted text is not in the grammar")
        for role, text, span in found:
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if loss == span:
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(segment)

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text alone: its turns, their digest and the text under the mask.

    Segments stream through in order, one digest is held and no group: a conversation of any length takes
    the memory of one batch.
    """
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader = None, None
        for batch in batches:
            ids, done = [], []
            starts, ends = batch.column("loss_start").to_pylist(), batch.column("loss_end").to_pylist()
            for conv, segment, start, end in zip(batch.column("conv_id").to_pylist(), batch.column("segment"), starts, ends):
                if reader is None or conv != current:
                    if reader is not None:
                        ids.append(current)
                        done.append(reader.row())
                    current, reader = conv, _Reader()
                reader.read(segment.as_py(), None if start is None else (start, end))
            yield _rows(ids, done)
        if reader is not None:
            yield _rows([current], [reader.row()])

    def _rows(ids: list, done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*done) if done else [()] * len(types), types)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], names=["conv_id", *names])

    ordered = (
        segments.withColumn("conv_id", F.col("conv_id").cast("long"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "segment", "loss_start", "loss_end")
    )
    return ordered.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
