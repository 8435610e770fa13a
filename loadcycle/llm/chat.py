"""Chat records of many layouts to one training format, and back.

A record's layout is known by the hash of its nested field paths. Each known hash selects a declarative mapping, data
rather than code, that says where the turns, their roles and their texts are. The turns then go through one template,
in which no text can hold a control string, with the spans that count for the loss beside the formatted text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.llm.common import columns, to_arrow

TURN, END = "<|turn|>", "<|end|>\n"
#: No text may hold one of these after escaping: the template's own and those of other common templates.
_CONTROL = re.compile(r"([<\[])(\^*)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])")
_ESCAPED = re.compile(r"([<\[])\^(\^*)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])")
#: Characters of formatted text in one part of the output.
PART_CHARS = 1_000_000

#: Layouts: the fields a record must have and may have, and where its turns are. ``each`` names a list of turns with
#: the fields of role and text in it; ``turns`` lists (role, field) pairs; ``flat`` is a record that is one turn.
LAYOUTS = {
    "flat_turn": {"must": ["role", "text", "turn"], "may": [], "flat": ("turn", "role", "text")},
    "messages": {"must": ["messages[].role", "messages[].content"], "may": [], "each": ("messages", "role", "content")},
    "from_value": {
        "must": ["conversations[].from", "conversations[].value"], "may": [], "each": ("conversations", "from", "value"),
    },
    "prompt_completion": {
        "must": ["prompt", "completion"], "may": ["system"],
        "turns": [("system", "system"), ("user", "prompt"), ("assistant", "completion")],
    },
    "prompt_response": {
        "must": ["prompt", "response"], "may": ["system"],
        "turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")],
    },
    "instruction": {
        "must": ["instruction", "output"], "may": ["input", "system"],
        "turns": [("system", "system"), ("user", ["instruction", "input"]), ("assistant", "output")],
    },
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths: ``a.b`` for fields, ``a[]`` for list elements. Values and order play no part."""
    if isinstance(value, dict):
        found = set()
        for name, inner in value.items():
            found |= field_paths(inner, f"{prefix}.{name}" if prefix else name)
        return found or {prefix + ".{}"}
    if isinstance(value, list):
        found = set()
        for inner in value:
            found |= field_paths(inner, prefix + "[]")
        return found or {prefix + "[]"}
    return {prefix}


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def registry(layouts: dict[str, dict] = LAYOUTS) -> dict[str, str]:
    """Fingerprint -> layout, for each choice of the optional fields and for empty lists of turns."""
    known = {}
    for name, layout in layouts.items():
        for n in range(len(layout["may"]) + 1):
            for some in combinations(layout["may"], n):
                known[fingerprint([*layout["must"], *some])] = name
        if "each" in layout:
            known[fingerprint([layout["each"][0] + "[]"])] = name
    return known


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def apply_layout(layout: dict, record: dict) -> list[tuple[int | None, str, str]]:
    """(order, role, text) of each turn; the order is the record's own where it is one turn."""
    if "flat" in layout:
        order, role, text = layout["flat"]
        return [(record[order], _text(record[role]), _text(record[text]))]
    if "each" in layout:
        name, role, text = layout["each"]
        turns = [(_text(t.get(role)), _text(t.get(text))) for t in record[name]]
        return [(i, ROLES.get(r, r), t) for i, (r, t) in enumerate(turns)]
    turns = []
    for role, fields in layout["turns"]:
        fields = [fields] if isinstance(fields, str) else fields
        texts = [_text(record.get(f)) for f in fields]
        if any(f in record for f in fields) and (role != "system" or texts[0]):
            turns.append((role, "\n\n".join(t for i, t in enumerate(texts) if t or i == 0)))
    return [(i, r, t) for i, (r, t) in enumerate(turns)]


_TURNS = columns("conv_id long, fingerprint string, layout string, turn long, role string, text string")


def canonical_turns(df: DataFrame, *, id_col: str, record_col: str, layouts: dict[str, dict] = LAYOUTS) -> DataFrame:
    """conv_id, fingerprint, layout, turn, role, text of each turn of JSON records of any known layout.

    A record of no known layout, a null one and one that is no JSON object give one row with a null layout and the
    record as text, so that nothing is lost in silence. Null roles and texts count as empty. Other columns, of any name, are passed
    over; an empty table gives no turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, schema, seen = registry(layouts), to_arrow(_TURNS), {}
        for batch in batches:
            rows = []
            for conv, told in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    record = json.loads(told) if told is not None else None
                except ValueError:
                    record = None
                if not isinstance(record, dict):
                    rows.append((conv, None, None, None, None, told))
                    continue
                paths = frozenset(field_paths(record))
                mark = seen.get(paths)
                if mark is None:
                    if len(seen) > 10_000:
                        seen.clear()
                    mark = seen[paths] = fingerprint(paths)
                name = known.get(mark)
                if name is None:
                    rows.append((conv, mark, None, None, None, told))
                    continue
                rows += [(conv, mark, name, *turn) for turn in apply_layout(layouts[name], record)]
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return df.select(F.col(id_col).cast("long"), F.col(record_col).cast("string")).mapInArrow(run, _TURNS)


def escape(text: str) -> str:
    """One more ``^`` after the first character of each control string, escaped ones included."""
    return _CONTROL.sub(r"\1^\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _line(role: str) -> str:
    """A role is one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unline(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


_PARTS = columns(
    "conv_id long, part int, last boolean, n_turns int, formatted string, loss_starts ints, loss_ends ints"
)


class _Parts:
    """Collects the parts of one conversation after the other; a part holds whole turns."""

    def __init__(self, learn: str):
        self.learn, self.rows = learn, []
        self.conv, self.open = None, False

    def begin(self, conv) -> None:
        self.close()
        self.conv, self.open, self.part = conv, True, 0
        self._new()

    def _new(self) -> None:
        self.text, self.chars, self.turns, self.loss = [], 0, 0, ([], [])

    def _flush(self, last: bool) -> None:
        self.rows.append((self.conv, self.part, last, self.turns, "".join(self.text), *self.loss))
        self.part += 1
        self._new()

    def _put(self, text: str) -> None:
        self.text.append(text)
        self.chars += len(text)

    def add(self, role: str, text: str) -> None:
        if self.chars >= PART_CHARS:
            self._flush(False)
        self._put(f"{TURN}{_line(role)}\n")
        start, inner = self.chars, escape(text)
        self._put(inner)
        if role == self.learn and inner:
            self.loss[0].append(start)
            self.loss[1].append(self.chars)
        self._put(END)
        self.turns += 1

    def close(self) -> None:
        if self.open:
            self._flush(True)
            self.open = False

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def format_turns(turns: DataFrame, *, learn: str = "assistant") -> DataFrame:
    """conv_id, part, last, n_turns, formatted, loss_starts, loss_ends: the formatted conversations, in parts of whole turns.

    Turns are put in order of turn, then role and text; null turns come first. Each turn is ``<|turn|>role``, a line
    break, the escaped text, ``<|end|>`` and a line break. The loss columns have the spans of the texts that the role ``learn``
    says, as characters of the part's text. Rows are dealt by conversation and sorted on disk where need be; the
    worker holds one part at a time, so a conversation of any length fits; a part holds one turn at the least, however long. A null
    conv_id is a conversation too; repeated rows are turns of their own; other columns, of any name, are passed over; an empty table
    gives an empty one.
    """
    dealt = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, parts = to_arrow(_PARTS), _Parts(learn)

        def made() -> pa.RecordBatch:
            columns = list(zip(*parts.take())) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for conv, role, text in zip(ids, roles, texts):
                if not parts.open or conv != parts.conv:
                    parts.begin(conv)
                parts.add(role, text)
                if len(parts.rows) >= 16:
                    yield made()
            yield made()
        parts.close()
        yield made()

    return dealt.mapInArrow(run, _PARTS)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a formatted text; the inverse of the template."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        if not piece.startswith(TURN):
            raise ValueError("a turn lacks its mark")
        role, _, text = piece[len(TURN) :].partition("\n")
        turns.append((_unline(role), unescape(text)))
    return turns


_DIGESTS = columns(
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation: digests of turns and learnt texts as they are read from the formatted output.

    ``parts`` must come from ``format_turns`` as it is, so that a conversation's parts follow each other. Digests are
    built part by part. Without parts there are no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow(_DIGESTS)
        turns = chars = learnt = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if turns is None:
                    turns, learnt, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                text = row["formatted"]
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for start, end in zip(row["loss_starts"], row["loss_ends"]):
                    said = unescape(text[start:end])
                    learnt.update(said.encode())
                    chars += len(said)
                size += len(text)
                if row["last"]:
                    rows.append((row["conv_id"], n, turns.hexdigest(), chars, learnt.hexdigest(), size))
                    turns = None
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return parts.mapInArrow(run, _DIGESTS)
