"""Chat formatting: records of many layouts, told apart by a fingerprint of their fields, to one template.

The fingerprint of a record is a hash of its nested field paths. It selects a
declared mapping, which names where turns, roles and texts lie. Canonical turns are then
rendered; control strings inside texts are escaped so that the marks of
the template occur nowhere else and every text can be read back unchanged.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Marks of this template, and control strings of other common ones.
TURN, BODY, END = "<|turn|>", "\n", "<|end|>\n"
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
ESCAPE = "\\"
LOSS_ROLE = "assistant"
_ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns. `paths` must all be there, `optional` may be.

    `each` names a list and the role and text inside its elements; `steps` gives
    single fields a role, joined by a blank line where several have the same in a row.
    """

    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: tuple[str, str, str] | None = None
    steps: tuple[tuple[str, str], ...] = ()
    conversation: str | None = None
    order: str | None = None
    aliases: dict = field(default_factory=dict)


MAPPINGS = (
    Mapping(("conv_id", "turn", "role", "text"), steps=(("=role", "text"),), conversation="conv_id", order="turn"),
    Mapping(("messages", "messages[].role", "messages[].content"), ("id", "system"), each=("messages", "role", "content"), steps=(("system", "system"),)),
    Mapping(("conversations", "conversations[].from", "conversations[].value"), ("id", "system"), each=("conversations", "from", "value"), steps=(("system", "system"),), aliases=_ALIASES),
    Mapping(("instruction", "output"), ("id", "input", "system"), steps=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping(("prompt", "response"), ("id", "system"), steps=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping(("prompt", "completion"), ("id", "system"), steps=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Mapping(("question", "answer"), ("id", "context"), steps=(("user", "context"), ("user", "question"), ("assistant", "answer"))),
    Mapping(("data", "data.prompt", "data.response"), ("id",), steps=(("user", "data.prompt"), ("assistant", "data.response"))),
)


def field_paths(record, prefix: str = "") -> set[str]:
    """All nested field paths of a record; elements of lists share the path `name[]`."""
    found: set[str] = set()
    if isinstance(record, dict):
        for name, value in record.items():
            path = f"{prefix}.{name}" if prefix else name
            found |= {path} | field_paths(value, path)
    elif isinstance(record, list):
        for value in record:
            found |= field_paths(value, prefix + "[]")
    return found


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def catalogue(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Every fingerprint a mapping covers, one for each choice of its optional fields."""
    return {
        fingerprint({*m.paths, *some}): m
        for m in mappings
        for n in range(len(m.optional) + 1)
        for some in combinations(m.optional, n)
    }


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """(role, text) in order."""
    found: list[tuple[str, str]] = []
    for role, path in mapping.steps:
        if role.startswith("="):
            found.append((_text(_at(record, role[1:])), _text(_at(record, path))))
        elif _at(record, path) is not None:
            text = _text(_at(record, path))
            if found and found[-1][0] == role and text:
                found[-1] = (role, f"{found[-1][1]}\n\n{text}")
            elif text or role != "user" or not found:
                found.append((role, text))
    if mapping.each:
        name, role, text = mapping.each
        for item in _at(record, name) or []:
            told = _text(item.get(role))
            found.append((mapping.aliases.get(told, told), _text(item.get(text))))
    return found


_TO_ESCAPE = re.compile("|".join([re.escape(ESCAPE), *(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True))]))


def escaped(text: str) -> str:
    """Backslashes doubled, and a backslash put after the first character of each control string."""
    return _TO_ESCAPE.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\\\|\\", lambda m: ESCAPE if len(m[0]) == 2 else "", text)


def escaped_role(role: str) -> str:
    """As for texts; a line feed, which ends the role, becomes a backslash and n."""
    return escaped(role).replace(BODY, ESCAPE + "n")


def unescaped_role(role: str) -> str:
    return re.sub(r"\\[\\n]|\\", lambda m: {ESCAPE: "", ESCAPE + "n": BODY}.get(m[0], ESCAPE), role)


def rendered(role: str, text: str) -> str:
    return f"{TURN}{escaped_role(role)}{BODY}{escaped(text)}{END}"


def canonical_turns(records: DataFrame, mappings=MAPPINGS) -> DataFrame:
    """conv_id, turn, sub, role, text, fingerprint from records (conv_id, record as JSON text).

    A mapping that names a conversation or an order takes them from the record.
    A record that is no JSON object, or of an unknown fingerprint, gives one row without a
    role, so that it can be counted and a mapping be declared.
    """
    known = catalogue(mappings)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    record = json.loads(text or "")
                except ValueError:
                    record = None
                print_ = fingerprint(field_paths(record)) if isinstance(record, dict) else None
                mapping = known.get(print_)
                if mapping is None:
                    rows.append((conv, None, 0, None, None, print_))
                    continue
                conv = _at(record, mapping.conversation) if mapping.conversation else conv
                turn = _at(record, mapping.order) if mapping.order else None
                rows += [(conv, turn, k, role, body, print_) for k, (role, body) in enumerate(turns_of(record, mapping))]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "turn", "sub", "role", "text", "fingerprint"])

    kinds = "conv_id bigint, turn bigint, sub int, role string, text string, fingerprint string"
    return records.select("conv_id", "record").mapInArrow(told, kinds)


def row_records(table: DataFrame) -> DataFrame:
    """A table of one row per turn (conv_id, turn, role, text) as records of that layout."""
    fields = F.struct("conv_id", "turn", "role", "text")
    return table.select("conv_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))


def formatted(turns: DataFrame) -> DataFrame:
    """One row per turn, in order within partitions: conv_id, start, segment, loss_start, loss_end.

    The segments of a conversation one after the other are its formatted text;
    `start` and the loss bounds are code points in it. Loss falls on what
    assistants say, not on marks. Turns are ordered by turn, then sub, role and
    text; null texts and roles are empty, a null conv_id is a conversation of its own.
    Rows stream through, so a conversation of any length needs no memory; it has
    to be read in order, so one task reads it.
    """
    ordered = turns.where("role IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "sub", "role", "text")

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at = object(), 0
        for batch in batches:
            starts, segments, low, high = [], [], [], []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))):
                if conv != current:
                    current, at = conv, 0
                segment = rendered(role, text or "")
                inside = role == LOSS_ROLE
                starts.append(at)
                segments.append(segment)
                low.append(at + len(rendered(role, "")) - len(END) if inside else None)
                at += len(segment)
                high.append(at - len(END) if inside else None)
            columns = [batch.column(0), pa.array(starts, pa.int64()), pa.array(segments, pa.string()), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "start", "segment", "loss_start", "loss_end"])

    return ordered.select("conv_id", "role", "text").mapInArrow(laid, "conv_id bigint, start bigint, segment string, loss_start bigint, loss_end bigint")


_SEGMENT = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*)" + re.escape(END), re.S)


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says, read back: turns, text under the loss mask, lengths.

    `segments` must be as `formatted` gives them: a conversation in one partition, in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state: list | None = None

        def closed(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        for batch in batches:
            rows = []
            for conv, start, segment, low, high in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if state is None or conv != state[0]:
                    if state is not None:
                        rows.append(closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = _SEGMENT.fullmatch(segment).groups()
                role = unescaped_role(role)
                state[1] += 1
                state[2].update(f"{role}\n{unescaped(text)}\n".encode("utf-8", "surrogatepass"))
                if low is not None:
                    said = unescaped(segment[low - start : high - start])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(segment)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(closed(state), kinds)], names)

    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return segments.mapInArrow(read, kinds)
