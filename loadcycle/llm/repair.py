"""Repair of the turn structure of conversations by the cheapest edits.

Each row is kept, given another role or deleted, and empty rows are inserted, so that the roles read: nothing, or at most one
system turn and then pairs of user and assistant. The edits of a conversation are a path through a lattice of places between
rows and states of that pattern. A forward and a reverse heap search it from both ends until they have met and no
crossing of equal cost is open; of these the least concatenated audit is taken.

Rows are sorted over all tasks by conversation and turn, so a long conversation lies in several tasks. Where one is cut, and in
slices of long ones, the best path is found for every pair of states at the two ends, and these are joined afterwards.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.llm.common import columns, cut, small_batches, to_arrow

# Costs of the edits, and what a row cut short costs on top unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Rows searched at once; longer runs are searched in slices.
SLICE = 1024

#: States of the pattern: nothing yet, after system, after user, after assistant.
STATES = "NSUA"
_KEPT = {"Ns": "S", "Nu": "U", "Su": "U", "Ua": "A", "Au": "U"}
_NEXT = {"N": "U", "S": "U", "A": "U", "U": "A"}  # the role that an inserted row, or one with a new role, has there
_ROLE = {"U": "user", "A": "assistant"}
_SPACE = r"[\x20\x09-\x0D]"
LEGAL = ("su", "ua", "au")


# The search ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Step:
    """What the search knows of a row: the initial of its role, whether it has to go, what keeping it costs."""

    initial: str
    gone: bool
    extra: int


def _forward(rows: list[Step], place: int, state: str) -> Iterator[tuple[int, str, int, str]]:
    """Edits from a node: place and state reached, cost, initial."""
    yield place, _NEXT[state], INSERT, "I"
    if place == len(rows):
        return
    row = rows[place]
    yield place + 1, state, DELETE, "D"
    if not row.gone:
        kept = _KEPT.get(state + row.initial)
        if kept:
            yield place + 1, kept, row.extra, "K"
        yield place + 1, _NEXT[state], REROLE + row.extra, "R"


_BEFORE_NEXT = {"U": "NSA", "A": "U"}
_BEFORE_KEPT = {(after, both[1]): "".join(b[0] for b in _KEPT if _KEPT[b] == after and b[1] == both[1]) for both, after in _KEPT.items()}


def _reverse(rows: list[Step], place: int, state: str) -> Iterator[tuple[int, str, int, str]]:
    """Edits to a node: place and state they come from, cost, initial."""
    for before in _BEFORE_NEXT.get(state, ""):
        yield place, before, INSERT, "I"
    if not place:
        return
    row = rows[place - 1]
    yield place - 1, state, DELETE, "D"
    if not row.gone:
        for before in _BEFORE_KEPT.get((state, row.initial), ""):
            yield place - 1, before, row.extra, "K"
        for before in _BEFORE_NEXT.get(state, ""):
            yield place - 1, before, REROLE + row.extra, "R"


class _Side:
    """One heap of the search. Of nodes of equal cost those come first from which edits without cost lead to the others."""

    def __init__(self, nodes: list[tuple[int, str]], edits, sign: int):
        self.best = {node: (0, "") for node in nodes}
        self.done: set[tuple[int, str]] = set()
        self.heap = [(0, sign * node[0], node) for node in nodes]
        heapq.heapify(self.heap)
        self._edits, self._sign = edits, sign

    def cost(self) -> int | None:
        """That of the next open node."""
        while self.heap and (self.heap[0][2] in self.done or self.heap[0][0] > self.best[self.heap[0][2]][0]):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self, rows: list[Step]) -> list[tuple[int, str]]:
        """Settles the next open node and gives it and the nodes whose best path became shorter or less."""
        node = heapq.heappop(self.heap)[2]
        self.done.add(node)
        cost, audit = self.best[node]
        touched = [node]
        for place, state, more, initial in self._edits(rows, *node):
            found = cost + more, audit + initial if self._sign > 0 else initial + audit
            to = place, state
            known = self.best.get(to)
            if known is None or found < known:
                if known is None or found[0] < known[0]:
                    heapq.heappush(self.heap, (found[0], self._sign * place, to))
                self.best[to] = found
                touched.append(to)
        return touched


def search(rows: list[Step], entry: str, exits: str) -> tuple[int, str] | None:
    """Least cost and least audit from a state before the rows to one of some states after them."""
    ahead = _Side([(0, entry)], _forward, 1)
    back = _Side([(len(rows), state) for state in exits], _reverse, -1)
    least: int | None = None
    while True:
        a, b = ahead.cost(), back.cost()
        if a is None or b is None or (least is not None and a + b > least):
            break
        side, other = (ahead, back) if a <= b else (back, ahead)
        for node in side.settle(rows):
            if node in other.best:
                through = side.best[node][0] + other.best[node][0]
                least = through if least is None else min(least, through)
    if least is None:
        return None
    crossings = (node for node in ahead.best.keys() & back.best.keys() if ahead.best[node][0] + back.best[node][0] == least)
    return least, min(ahead.best[node][1] + back.best[node][1] for node in crossings)


Paths = dict[tuple[str, str], tuple[int, str]]


def all_paths(rows: list[Step]) -> Paths:
    """The best path for each state before and each state after the rows."""
    found = {(a, b): search(rows, a, b) for a in STATES for b in STATES}
    return {ends: path for ends, path in found.items() if path}


def join_paths(first: Paths, second: Paths) -> Paths:
    """Paths through two neighbouring slices."""
    joined: Paths = {}
    for (a, b), (cost, audit) in first.items():
        for (c, d), (more, rest) in second.items():
            if b == c:
                path = cost + more, audit + rest
                joined[a, d] = min(joined.get((a, d), path), path)
    return joined


def cheapest(paths: Paths) -> tuple[int, str]:
    """The best path of a whole conversation: it ends after an assistant, or nothing is left."""
    return min(path for (a, b), path in paths.items() if a == "N" and b in "NA")


# One run of a conversation's rows in a task -------------------------------------------------

@dataclass
class Run:
    """Rows of one conversation, one after the other: counters, and the paths through the slices that are full."""

    conv_id: int | None
    open: bool = False  # it may go on in another task
    held: list[Step] = field(default_factory=list)
    paths: Paths | None = None
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str = ""
    last: str = ""

    def add(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        for copy in range(copies):
            kind = "duplicate" if copy and fault != "blank" else fault
            if kind:
                setattr(self, kind, getattr(self, kind) + 1)
            if self.rows:
                self.illegal += self.last + initial not in LEGAL
            else:
                self.first = initial
            self.last, self.rows = initial, self.rows + 1
            self.held.append(Step(initial, kind in ("blank", "duplicate"), TRUNCATED if kind == "truncated" else 0))
            if len(self.held) > SLICE:
                self.fold(self.held[:SLICE])
                self.held = self.held[SLICE:]
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low

    def fold(self, rows: list[Step]) -> None:
        found = all_paths(rows)
        self.paths = found if self.paths is None else join_paths(self.paths, found)

    def plan(self) -> tuple:
        """gaps, faults, cost and audit of a whole conversation."""
        if self.paths is None:
            cost, audit = search(self.held, "N", "NA")
        else:
            self.fold(self.held)
            cost, audit = cheapest(self.paths)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit

    def part(self) -> str:
        """The run as text, to be joined with the conversation's other runs."""
        self.fold(self.held)
        told = {k: v for k, v in vars(self).items() if k not in ("conv_id", "open", "held", "paths")}
        return json.dumps(told | {"paths": [(*ends, *path) for ends, path in self.paths.items()]})


def _joined(conv_id: int | None, parts: list[dict]) -> tuple:
    """The plan of a conversation from its runs in order."""
    whole = Run(conv_id)
    for part in parts:
        paths = {(a, b): (cost, audit) for a, b, cost, audit in part.pop("paths")}
        whole.paths = paths if whole.paths is None else join_paths(whole.paths, paths)
        if whole.rows:
            whole.illegal += whole.last + part["first"] not in LEGAL
        if part["low"] is not None:
            whole.turns += part["turns"] - (part["low"] == whole.high)
            whole.low, whole.high = part["low"] if whole.low is None else whole.low, part["high"]
        for name in ("rows", "blank", "duplicate", "truncated", "illegal"):
            setattr(whole, name, getattr(whole, name) + part[name])
        whole.last = part["last"]
    return whole.plan()


# Over all conversations ---------------------------------------------------------------------

_PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_RUNS = columns(_PLAN + ", part string, run long")


def _order(*more: Column) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *more, F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]


def _turns(rows: DataFrame) -> DataFrame:
    """The columns that count; a null role or text is one blank."""
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )


def _faulty(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn, with their number and the first one's fault.

    Equal rows are counted before the shuffle. The first turn of a role and text in a conversation comes from an
    aggregate joined back, in which a hot key is split, not from a window that would hold it in one task.
    """
    turns = _turns(rows).withColumn("key", F.sha2("text", 256))
    same = turns.groupBy("conv_id", "role", "key", "turn", "text").agg(F.count(F.lit(1)).alias("copies"))
    first = turns.groupBy("conv_id", "role", "key").agg(
        F.max(F.col("turn").isNull()).alias("has_null"), F.min("turn").alias("first_turn")
    )
    first = first.select(*[F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "key")], "has_null", "first_turn")
    both = same.join(
        first,
        F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & (F.col("role") == F.col("of_role")) & (F.col("key") == F.col("of_key")),
    )
    seen = F.when(F.col("has_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first_turn"))
    solid = F.regexp_replace("text", _SPACE, "")
    fault = (
        F.when(solid == "", "blank").when(seen, "duplicate").when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return both.select("conv_id", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "copies")


def plans(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation of ``rows`` (conv_id, turn, role, text).

    Rows of a conversation go by turn (nulls first), then role and text. Columns gaps, blank, duplicate, truncated and illegal count
    what is wrong, ``cost`` and ``audit`` tell the edits: K(eep), R(erole), D(elete), I(nsert); equal costs go to the least
    audit. Null conv_ids are one conversation; null roles and texts are one blank, so such a text is deleted and such a role
    replaced; repeated rows are duplicates; a very long text costs no more than a short one; other columns
    of any name are passed over; an empty table gives an empty one.
    """
    small_batches(rows.sparkSession)
    ordered = _faulty(rows)
    ordered = ordered.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    ordered = ordered.select("conv_id", "turn", "initial", "fault", "copies", F.spark_partition_id().cast("long").alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, done, task = to_arrow(_RUNS), None, [], 0

        def out(runs: list[Run]) -> pa.RecordBatch:
            told = [
                (r.conv_id, *[None] * 7, r.part(), 2 * task + i) if r.open else (r.conv_id, *r.plan(), None, None)
                for i, r in enumerate(runs)
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*told), schema)], schema=schema)

        for batch in batches:
            for conv_id, turn, initial, fault, copies, task in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now)
                    now = Run(conv_id, open=now is None)
                now.add(turn, initial, fault, copies)
            if done:
                yield out(done)
                done = []
        if now is not None:
            now.open = True  # the first and the last run of a task may have their other rows in its neighbours
            yield out([now])

    return _joined_runs(cut(ordered.mapInArrow(run, _RUNS), "repair-runs"))


def _joined_runs(found: DataFrame) -> DataFrame:
    """The plans, with those of conversations that lie in several tasks put together: two runs for each task at the most."""

    def run(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["run"].to_pylist(), table["part"].to_pylist()))
        conv_id = table["conv_id"][0].as_py()
        plan = (conv_id, *_joined(conv_id, [json.loads(p) for _, p in parts]))
        return pa.table([pa.array([v], f.type) for v, f in zip(plan, to_arrow(columns(_PLAN)))], schema=to_arrow(columns(_PLAN)))

    names = columns(_PLAN).fieldNames()
    whole = found.filter("part IS NULL").select(*names)
    return whole.unionByName(found.filter("part IS NOT NULL").groupBy("conv_id").applyInArrow(run, columns(_PLAN)))


# The repaired rows --------------------------------------------------------------------------

class Editor:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str):
        self._audit, self._at, self._state = audit, 0, "N"

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self._audit[self._at : self._at + 1] == "I":
            self._at, self._state = self._at + 1, _NEXT[self._state]
            yield _ROLE[self._state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "D":
            return
        self._state = _KEPT[self._state + role[:1]] if edit == "K" else _NEXT[self._state]
        yield (role if edit == "K" else _ROLE[self._state]), text

    end = _inserted


def _edited(rows: DataFrame, found: DataFrame, make, schema: T.StructType) -> DataFrame:
    """Conversation after conversation the audit and then the rows in order, in one task each but never whole in memory.

    ``make`` gives for a conversation an object with ``turn(role, text)`` and ``end()``, which give rows.
    """
    plan = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = plan.withColumn("kind", F.lit(0)).unionByName(_turns(rows).withColumn("kind", F.lit(1)))
    both = both.repartition("conv_id").sortWithinPartitions(*_order(F.col("kind")))
    both = both.select("conv_id", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, editor, sink = to_arrow(schema), None, None

        def batch_of(told: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*told), arrow)], schema=arrow)

        def ended() -> list[tuple]:
            return [] if editor is None else [*[r for turn in editor.end() for r in sink.turn(*turn)], *sink.end()]

        for batch in batches:
            told = []
            for conv_id, kind, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    told += ended()
                    editor, sink = Editor(text), make(conv_id)
                else:
                    told += [r for turn in editor.row(role, text) for r in sink.turn(*turn)]
            if told:
                yield batch_of(told)
        if told := ended():
            yield batch_of(told)

    return both.mapInArrow(run, schema)


class _Numbered:
    def __init__(self, conv_id: int | None):
        self._conv_id, self._place = conv_id, -1

    def turn(self, role: str, text: str) -> list[tuple]:
        self._place += 1
        return [(self._conv_id, self._place, role, text)]

    def end(self) -> list[tuple]:
        return []


class _Digest:
    def __init__(self, conv_id: int | None):
        self._conv_id, self._sum, self._any = conv_id, hashlib.sha256(), False

    def turn(self, role: str, text: str) -> list[tuple]:
        self._sum.update(f"{chr(10) if self._any else ''}{role}:{text}".encode())
        self._any = True
        return []

    def end(self) -> list[tuple]:
        return [(self._conv_id, self._sum.hexdigest())]


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows after the edits of ``found`` (conv_id, audit): conv_id, place, role, text."""
    return _edited(rows, found, _Numbered, columns("conv_id long, place long, role string, text string"))


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation the SHA-256 of its repaired rows, ``role:text`` joined by line breaks.

    The digest is sequential, so one task reads a conversation, as a stream.
    """
    return _edited(rows, found, _Digest, columns("conv_id long, repaired_sha256 string"))
