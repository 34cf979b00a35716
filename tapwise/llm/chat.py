"""Chat formatting: records of many layouts become canonical turns, then reversible marked text."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layouts: the nested field paths of a record, and where its turns are. A turn is (role, text, number);
# each is a path of the record or of an item of its list, or, after "=", a constant. Fields of a
# record that say nothing about its turns are named under `ignored`.
LAYOUTS: dict[str, dict[str, Any]] = {
    "turn": {
        "paths": ["conv_id", "turn", "role", "text"],
        "turns": [{"role": "role", "text": "text", "number": "turn"}],
    },
    "messages": {
        "paths": ["conv_id", "messages[].role", "messages[].content"],
        "each": "messages",
        "turns": [{"role": "role", "text": "content"}],
    },
    "from_value": {
        "paths": ["conv_id", "conversations[].from", "conversations[].value"],
        "each": "conversations",
        "turns": [{"role": "from", "text": "value"}],
    },
    "prompt_completion": {
        "paths": ["conv_id", "prompt", "completion"],
        "turns": [{"role": "=user", "text": "prompt"}, {"role": "=assistant", "text": "completion"}],
    },
    "system_prompt_response": {
        "paths": ["conv_id", "system", "prompt", "response"],
        "turns": [
            {"role": "=system", "text": "system"},
            {"role": "=user", "text": "prompt"},
            {"role": "=assistant", "text": "response"},
        ],
    },
    "instruction": {
        "paths": ["conv_id", "instruction", "output"],
        "turns": [{"role": "=user", "text": "instruction"}, {"role": "=assistant", "text": "output"}],
    },
    "instruction_input": {
        "paths": ["conv_id", "instruction", "input", "output"],
        "turns": [
            {"role": "=user", "text": ["instruction", "input"]},
            {"role": "=assistant", "text": "output"},
        ],
    },
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LEARNED = "assistant"

TURN_SCHEMA = "conv_id long, turn long, role string, text string, layout string, fingerprint string"
READ_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def field_paths(value: Any, at: str = "") -> set[str]:
    """The paths of a parsed record's leaves; items of a list share theirs, and an empty list or object is a leaf.

    Names that hold what paths are made of are quoted, so that no two fields have the same path.
    """

    def named(key: str) -> str:
        key = json.dumps(key) if not key or any(mark in key for mark in '.[]"\n') else key
        return f"{at}.{key}" if at else key

    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, named(k)) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths: set[str]) -> str:
    """The first 16 hex digits of the SHA-256 of the sorted paths, one per line."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _text(record: Any, path: str | list[str]) -> str:
    if isinstance(path, list):
        return "\n".join(part for part in (_text(record, p) for p in path) if part)
    if path.startswith("="):
        return path[1:]
    value = record.get(path) if isinstance(record, dict) else None
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def _is_long(number: Any) -> bool:
    """Null counts as one."""
    return number is None or type(number) is int and -(2**63) <= number < 2**63


def _is_text(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:
        return False
    return True


def canonical_turns(
    records: DataFrame, layouts: dict[str, dict[str, Any]] | None = None, ignored: tuple[str, ...] = ()
) -> DataFrame:
    """One row per turn of all `records` (record: JSON text): TURN_SCHEMA.

    The field paths of a record, without those `ignored`, are hashed; the hash selects the
    layout that says where role and text are. `conv_id` comes from the record. Null and missing
    texts and roles are empty. A record that is not JSON or nested too deep to read, or of no known layout, gives one
    row with null layout, turn, role and text, so that nothing is lost unseen; and so does one with a turn's number or a
    conv_id that is no whole number of 64 bits (a conv_id of another kind is null), or with half of a surrogate pair in
    a turn, which is no text. A list of no messages has no turns: it is of no known layout. Repeated records give
    repeated turns; an empty table none.
    """
    layouts = LAYOUTS if layouts is None else layouts
    known = {fingerprint(set(layout["paths"])): name for name, layout in layouts.items()}

    def turns(record: str | None) -> list[tuple]:
        try:
            parsed = json.loads(record or "")
            marked = fingerprint(field_paths(parsed) - set(ignored))
        except (ValueError, RecursionError):
            return [(None, None, None, None, None, None)]
        conv_id = parsed.get("conv_id") if isinstance(parsed, dict) else None
        conv_id = conv_id if type(conv_id) is int else None
        name = known.get(marked)
        lost = [(conv_id if _is_long(conv_id) else None, None, None, None, None, marked)]
        if name is None or not _is_long(conv_id):
            return lost
        layout, found = layouts[name], []
        for item in parsed[layout["each"]] if "each" in layout else [parsed]:
            for turn in layout["turns"]:
                at = item.get(turn["number"]) if "number" in turn else len(found)
                role, text = _text(item, turn["role"]), _text(item, turn["text"])
                if not _is_long(at) or "\\u" in record and not (_is_text(role) and _is_text(text)):
                    return lost
                found.append((conv_id, at, ROLES.get(role, role), text, name, marked))
        return found

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), *[pa.string()] * 4]
        names = ["conv_id", "turn", "role", "text", "layout", "fingerprint"]
        for batch in batches:
            rows = [row for record in batch.column("record").to_pylist() for row in turns(record)]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return records.select("record").mapInArrow(convert, TURN_SCHEMA)


def table_records(rows: DataFrame, columns: tuple[str, ...] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """The `columns` of a table's rows as JSON records; fields that are null stay in."""
    return rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("record"))


# What marks a turn: a header with its role, and an end. Inside roles and texts a backslash goes
# before every character that could begin or end a mark, so none is ever taken for one.
HEAD, HEAD_END, END = "### ", ": ", " </turn>\n"
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*) </turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _escape(text: Column, marks: str) -> Column:
    return F.regexp_replace(text, marks, r"\\$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, role, text) with `formatted`, and the span of it that is to be learned.

    A conversation's text is that of its turns in order. `loss_start` and `loss_end` count code points of
    `formatted` and enclose an assistant's (escaped) text; elsewhere they are null. Null texts
    and roles are empty.
    """
    role = _escape(F.coalesce("role", F.lit("")), r"([\\#<:])")
    text = _escape(F.coalesce("text", F.lit("")), r"([\\#<])")
    head = F.concat(F.lit(HEAD), role, F.lit(HEAD_END))
    learned = F.coalesce(F.col("role") == LEARNED, F.lit(False))
    return turns.select(
        "conv_id",
        "turn",
        F.concat(head, text, F.lit(END)).alias("formatted"),
        F.when(learned, F.length(head)).alias("loss_start"),
        F.when(learned, F.length(head) + F.length(text)).alias("loss_end"),
    )


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of marked text."""
    found, at = [], 0
    for match in _TURN.finditer(formatted):
        if match.start() != at:
            break
        found.append(tuple(_ESCAPED.sub(r"\1", part) for part in match.groups()))
        at = match.end()
    if at != len(formatted):
        raise ValueError("text that is no marked turn")
    return found


class _Conversation:
    """What has been read of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        for role, text in parse_turns(formatted):
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        if start is not None:
            learned = _ESCAPED.sub(r"\1", formatted[start:end])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation (READ_SCHEMA), parsed from the output of `format_turns`.

    A conversation's turns are read in order, one at a time, null numbers first; of those that share
    a number the lesser text comes first. However long a conversation is, only digests are held
    of it. Turns without conv_id are one conversation. An empty table gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            done = []
            for conv_id, text, start, end in zip(*(batch.column(c).to_pylist() for c in columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                now.add(text, start, end)
            yield _digests(done)
        if now is not None:
            yield _digests([now.row()])

    columns = ["conv_id", "formatted", "loss_start", "loss_end"]
    ordered = formatted.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select(*columns).mapInArrow(read, READ_SCHEMA)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [field.split()[0] for field in READ_SCHEMA.split(", ")]
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
