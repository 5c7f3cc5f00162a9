"""Chat formatting: records of many layouts to canonical turns, and turns to marked text.

* A record's fingerprint is the hash of its nested field paths, as far as some layout
  knows them. It selects a declarative mapping: where the turns are, and where role and
  text are within them. Every combination of known paths has one, if the paths of some
  layout are all in it: the layout with most paths, of equals the first in ``LAYOUTS``.
  A layout is added by a line there, not by code.
* The template puts ``### role: `` before a turn and `` </turn>`` behind it. Control strings
  within roles and texts get a backslash, and so do backslashes, so the
  output can be read back exactly. The loss mask covers the assistant's texts.
* Turns of a conversation are brought together sorted, and formatted and read as
  streams: a conversation is a sequence of rows of bounded length, never one value. A
  digest over all its turns has to see them in order, so one conversation is one task's.

Defined results. A null text or role is empty. A null conversation id is an id of its own. Rows with
one turn number are ordered by role, then text; repeated rows are repeated turns. A record
that isn't JSON, or has no known layout, gives no turns; ``read_records`` returns those beside
the turns. A list of turns with an element that isn't an object, or a turn number that isn't a
64-bit integer or null, is not of its layout. An empty table has no output. Other columns, and
fields that the record's layout doesn't name, are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W


@dataclass(frozen=True)
class Layout:
    """``paths``: the fields that make the fingerprint. Turns: the list at ``turns`` with
    ``role`` and ``text`` in each, or the (role, path) pairs of ``fixed``, or the record itself."""

    paths: tuple[str, ...]
    turns: str | None = None
    role: str = ""
    text: str = ""
    number: str | None = None
    fixed: tuple[tuple[str, str], ...] = ()


# The known layouts and other names of roles.
LAYOUTS = {
    "turn_row": Layout(("conv_id", "turn", "role", "text"), role="role", text="text", number="turn"),
    "messages": Layout(("messages[].role", "messages[].content"), "messages", "role", "content"),
    "from_value": Layout(("conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    "dialogue": Layout(("dialog[].speaker", "dialog[].text"), "dialog", "speaker", "text"),
    "instruction": Layout(("instruction", "output"), fixed=(("user", "instruction"), ("assistant", "output"))),
    "instruction_input": Layout(
        ("instruction", "input", "output"),
        fixed=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    "prompt_completion": Layout(("prompt", "completion"), fixed=(("user", "prompt"), ("assistant", "completion"))),
    "prompt_response": Layout(("prompt", "response"), fixed=(("user", "prompt"), ("assistant", "response"))),
    "question_answer": Layout(("question", "answer"), fixed=(("user", "question"), ("assistant", "answer"))),
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
KNOWN = {path for layout in LAYOUTS.values() for path in layout.paths}


def paths(value: Any, at: str = "") -> set[str]:
    """The paths of all leaves; the elements of a list share one path."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else str(k)) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(found: set[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(sorted(found & KNOWN)))


# Filled as combinations occur; there are no more of them than subsets of KNOWN.
BY_FINGERPRINT: dict[int, list[Layout]] = {}


def layouts_of(found: set[str]) -> list[Layout]:
    """The layouts whose paths are all among ``found``: most paths first, then in the order
    of ``LAYOUTS``."""
    key = fingerprint(found)
    if key not in BY_FINGERPRINT:
        own = [layout for layout in LAYOUTS.values() if found.issuperset(layout.paths)]
        BY_FINGERPRINT[key] = sorted(own, key=lambda layout: -len(layout.paths))
    return BY_FINGERPRINT[key]


def _string(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def _turns(layout: Layout, found: dict) -> list[tuple[int | None, str, str]] | None:
    """The turns of a record that has the layout's paths, or None if its values don't fit."""
    if layout.turns is None and not found.keys() >= set(layout.paths):
        return None  # a nested field whose path reads the same, below an empty name
    if layout.fixed:
        return [(i, role, _string(found[path])) for i, (role, path) in enumerate(layout.fixed)]
    if layout.turns is None:
        number = found[layout.number]
        if number is not None and not (type(number) is int and -(1 << 63) <= number < 1 << 63):
            return None
        return [(number, _string(found[layout.role]), _string(found[layout.text]))]
    own = found.get(layout.turns)
    if not isinstance(own, list) or not all(isinstance(t, dict) for t in own):
        return None
    parts = [(_string(t.get(layout.role)), _string(t.get(layout.text))) for t in own]
    return [(i, ROLES.get(role, role), text) for i, (role, text) in enumerate(parts)]


def turns_of(record: str | None) -> list[tuple[int | None, str, str]] | None:
    """(turn number, role, text) of a JSON record, or None if its layout isn't known."""
    try:
        found = json.loads(record or "")
    except ValueError:
        return None
    for layout in layouts_of(paths(found)):
        turns = _turns(layout, found)
        if turns is not None:
            return turns
    return None


def read_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns, and beside them the records that gave none: each record is in one of them."""
    return canonical_turns(records), unknown_records(records)


def canonical_turns(records: DataFrame) -> DataFrame:
    """(conv_id, record: JSON text) to conv_id, turn, role, text. What it can't read is in the
    second table of ``read_records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            rows = []
            for conv, record in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(conv, *turn) for turn in turns_of(record) or ()]
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "turn", "role", "text"]
            )

    own = records.select(F.col("conv_id").cast("long").alias("conv_id"), "record")
    return own.transform(map_batches, run, "conv_id long, turn long, role string, text string")


def unknown_records(records: DataFrame) -> DataFrame:
    """The records whose layout isn't known."""
    at = records.columns.index("record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            yield batch.filter(pa.array([turns_of(r) is None for r in batch.column(at).to_pylist()], pa.bool_()))

    return records.transform(map_batches, run, records.schema)


BEGIN, END = "### ", " </turn>\n"
_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*?): ((?:[^\\]|\\[\s\S])*?) </turn>\n", re.S)
_ESCAPED = re.compile(r"\\([\s\S])")


def escape(text: str, control: re.Pattern = _TEXT) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn, and where its text begins and ends in it."""
    head, body = f"{BEGIN}{escape(role, _ROLE)}: ", escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


_FORMATTED = "conv_id long, part long, formatted string, loss array<struct<start:int,end:int>>"


def format_chats(turns: DataFrame, most: int = 1 << 20) -> DataFrame:
    """conv_id, part, formatted, loss: the parts of a conversation, joined in order, are its
    text; ``loss`` has the places within the part that the assistant's texts take. A part
    holds whole turns and ends once it is longer than ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in W.pieces(batches) for r in zip(*(c.to_pylist() for c in b.columns)))
        for conv, own in groupby(rows, key=lambda r: r[0]):
            part, pieces, spans, size = 0, [], [], 0
            for _, role, text in own:
                piece, start, end = format_turn(role or "", text or "")
                if role == "assistant":
                    spans.append({"start": size + start, "end": size + end})
                pieces.append(piece)
                size += len(piece)
                if size > most:
                    yield row(conv, part, pieces, spans)
                    part, pieces, spans, size = part + 1, [], [], 0
            if pieces:
                yield row(conv, part, pieces, spans)

    def row(conv: int | None, part: int, pieces: list[str], spans: list[dict]) -> pa.RecordBatch:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        values = [(conv, pa.int64()), (part, pa.int64()), ("".join(pieces), pa.string()), (spans, span)]
        names = ["conv_id", "part", "formatted", "loss"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], names)

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .transform(map_batches, run, _FORMATTED)
    )


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) pairs of marked text."""
    at = 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        yield unescape(found[1]), unescape(found[2])
        at = found.end()


def read_chats(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation's turns and of what its loss mask covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in W.pieces(batches, 100) for r in zip(*(c.to_pylist() for c in b.columns)))
        names = [p.split()[0] for p in _DIGESTS.split(", ")]
        for conv, own in groupby(rows, key=lambda r: r[0]):
            turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, spans in own:
                size += len(text)
                for role, said in parse_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in spans:
                    covered = unescape(text[span["start"] : span["end"]])
                    loss.update(covered.encode())
                    chars += len(covered)
            values = [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part")
        .select("conv_id", "formatted", "loss")
        .transform(map_batches, run, _DIGESTS)
    )
