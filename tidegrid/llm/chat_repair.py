"""Repair of conversation structure by weighted interval parsing.

The roles of a repaired conversation spell ``(s?(ua)+)?`` by their initials. Its grammar in Chomsky normal form has one
symbol for each pair of states of the expression's automaton: ``(p, q)`` derives what leads from state ``p`` to ``q``,
by ``(p, q) -> (p, r) (r, q)`` for every ``r``. A row derives a symbol by an edit: it is kept, given
another role or deleted, each at its cost, and turns may be inserted on both sides of it (the insertion closure). The cell of
a span holds for each symbol the least (cost, audit), where the audit is the edits' initials in order. Spans are
parsed bottom-up by length. With these symbols every cut of a span gives the same cell, so each span is cut once, in
the middle, and a parse takes as many cell products as there are rows.

Comparing (cost, audit) is safe under concatenation: the letters of an audit fix its cost, and only insertions
lengthen one, so of two audits of one span with equal cost neither is the other's beginning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidegrid.llm.batches import small_batches

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {REROLE: 1, DELETE: 2, INSERT: 5}
CUT_SHORT = 5
ROLES = {"u": "user", "a": "assistant"}

#: The automaton of ``(s?(ua)+)?``: nothing yet, system read, user read, assistant read.
STATES = range(4)
LEADS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FINAL = (0, 3)

#: What a row can do in a parse: its role's initial (``-`` for others), in capitals if it is cut short; ``x`` if it must go.
KINDS = "suaSUA-_x"
Cell = tuple[tuple[tuple[int, str] | None, ...], ...]


def least(found: Iterable[tuple[int, str] | None]) -> tuple[int, str] | None:
    return min((f for f in found if f is not None), default=None)


def product(left: Cell, right: Cell) -> Cell:
    """The cell of two spans in a row."""
    return tuple(tuple(
        least((left[p][r][0] + right[r][q][0], left[p][r][1] + right[r][q][1])
              for r in STATES if left[p][r] is not None and right[r][q] is not None)
        for q in STATES) for p in STATES)


def closure() -> Cell:
    """What insertions alone derive: the shortest way between two states."""
    unit = tuple(tuple((0, "") if p == q else None for q in STATES) for p in STATES)
    step = tuple(tuple(least([(COST[INSERT], INSERT) if LEADS[r].get(p) == q else None for r in ROLES]) for q in STATES) for p in STATES)
    cell = unit
    for _ in STATES:
        longer = product(cell, step)
        cell = tuple(tuple(least([cell[p][q], longer[p][q]]) for q in STATES) for p in STATES)
    return cell


NOTHING = closure()


def row_cell(kind: str) -> Cell:
    """The cell of one row, with insertions on both sides."""
    short = CUT_SHORT if kind.isupper() or kind == "_" else 0

    def edits(p: int, q: int) -> Iterator[tuple[int, str]]:
        if p == q:
            yield COST[DELETE], DELETE
        if kind != "x":
            if LEADS.get(kind.lower(), {}).get(p) == q:
                yield short, KEEP
            if any(LEADS[r].get(p) == q for r in ROLES):
                yield COST[REROLE] + short, REROLE

    own = tuple(tuple(least(edits(p, q)) for q in STATES) for p in STATES)
    return product(product(NOTHING, own), NOTHING)


@lru_cache(maxsize=50_000)
def short_span(kinds: str) -> Cell:
    """The cell of a short span, remembered: most conversations look alike."""
    if len(kinds) == 1:
        return row_cell(kinds)
    half = len(kinds) // 2
    return product(short_span(kinds[:half]), short_span(kinds[half:]))


def parse(kinds: str, leaf: int = 16) -> Cell:
    """The cell of a span of rows, combined bottom-up by span length."""
    if not kinds:
        return NOTHING
    level = [short_span(kinds[at:at + leaf]) for at in range(0, len(kinds), leaf)]
    while len(level) > 1:
        level = [product(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


class Repair:
    """One conversation, read block by block: the best parse to each state and the hash of what it leaves."""

    def __init__(self) -> None:
        #: By state: cost, audit, the hash of the repaired lines and whether there are any.
        self.paths: dict[int, tuple[int, str, Any, bool]] = {0: (0, "", hashlib.sha256(), False)}
        self.rows: list[tuple[str, str, str]] = []  # kind, role, text of the block being read
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.turns, self.last = self.turns + 1, turn
        said = text.rstrip(" \t\n\x0b\x0c\r")
        kind = initial if initial and initial in "sua" else "-"
        if not said:
            self.blank, kind = self.blank + 1, "x"
        elif again:
            self.duplicate, kind = self.duplicate + 1, "x"
        elif said[-1] not in ".!?":
            self.truncated += 1
            kind = "_" if kind == "-" else kind.upper()
        self.rows.append((kind, role, text))

    def close_block(self, ends: Sequence[int] = STATES) -> None:
        """Extend the paths by the block's cell; only those that end in ``ends`` are needed."""
        cell = parse("".join(kind for kind, _, _ in self.rows))
        found = {}
        for q in ends:
            ways = [(c + cell[p][q][0], a + cell[p][q][1], p) for p, (c, a, *_) in self.paths.items() if cell[p][q] is not None]
            if ways:
                found[q] = min(ways)
        if len(ends) < len(STATES) and found:  # the end: one path is left
            q = min(found, key=found.get)
            found = {q: found[q]}
        self.paths = {q: self._written(cost, audit, p) for q, (cost, audit, p) in found.items()}
        self.rows = []

    def _written(self, cost: int, audit: str, p: int) -> tuple[int, str, Any, bool]:
        _, before, digest, some = self.paths[p]
        digest = digest.copy()
        lines = [f"{role}:{text}" for role, text, _ in repaired(self.rows, audit[len(before):], p)]
        if lines:
            digest.update((("\n" if some else "") + "\n".join(lines)).encode())
        return cost, audit, digest, some or bool(lines)

    def result(self) -> tuple[int, int, int, int, int, int, str, str]:
        self.close_block(FINAL)
        (cost, audit, digest, _), = self.paths.values()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()


def repaired(rows: Iterable[tuple[str, str, str]], audit: str, state: int = 0) -> Iterator[tuple[str, str, int]]:
    """Role, text and the state reached for each turn that ``audit`` leaves of ``rows`` or inserts."""
    rows = iter(rows)
    for edit in audit:
        if edit == INSERT:
            initial, text = ("a" if state == 2 else "u"), ""
            role = ROLES[initial]
        else:
            kind, role, text = next(rows)
            if edit == DELETE:
                continue
            if edit == REROLE:
                initial = "a" if state == 2 else "u"
                role = ROLES[initial]
            else:
                initial = kind.lower()
        state = LEADS[initial][state]
        yield role, text, state


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def in_turn_order(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``__conv, __turn, __role, __text, __again`` with each conversation in one task and in order.

    ``__again``: the role and text came earlier in the conversation. One exchange serves that search and the order.
    """
    named = turns.select(F.col(conv_col).alias("__conv"), F.col(turn_col).cast("long").alias("__turn"),
                         F.coalesce(role_col, F.lit(" ")).alias("__role"), F.coalesce(text_col, F.lit(" ")).alias("__text"))
    seen = Window.partitionBy("__conv", "__role", "__text").orderBy("__turn")
    flagged = named.repartition("__conv").withColumn("__again", F.row_number().over(seen) > 1)
    return flagged.sortWithinPartitions("__conv", "__turn", "__role", "__text", "__again")


def repair_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", block: int = 4096) -> DataFrame:
    """Faults of each conversation and the cheapest edits that give it roles ``(s?(ua)+)?``.

    A row's first fault counts: ``blank`` (only ASCII white space), ``duplicate`` (role and text came earlier),
    ``truncated`` (the last other character is none of ``.!?``). To keep a row is free, another role (user or assistant) costs 1, to
    delete it 2, an empty turn of the user or assistant inserted anywhere 5; blank and duplicate rows must go, and a
    truncated row that stays adds 5. Columns: the conversation, ``gaps`` (turn numbers missing between the first and last), the three counts,
    ``illegal`` (neighbours whose roles' initials are not su, ua or au), ``cost``, ``audit`` (K, R, D, I in order; the
    least string of the cheapest) and ``repaired_sha256`` of the lines ``role:text`` that are left.

    Rows are ordered by turn, nulls first, then by role and text. A null role or text is one space, null conversations
    are one conversation, and gaps ignore null turns. Rows that repeat are duplicates. An empty table gives no rows; other columns are
    ignored. A conversation of any length is read in blocks of ``block`` rows and never held; its audit is one value.
    """
    names = [conv_col, *RESULT]
    conv_type = turns.schema[conv_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, done, types = None, None, [], None

        def batch_of(rows: list[tuple[Any, ...]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            types = [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            for conv, turn, role, text, again in zip(*[c.to_pylist() for c in batch.columns]):
                if open_ is None or conv != now:
                    if open_ is not None:
                        done.append((now, *open_.result()))
                    now, open_ = conv, Repair()
                open_.add(turn, role, text, again)
                if len(open_.rows) >= block:
                    open_.close_block()
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if open_ is not None:
            done.append((now, *open_.result()))
        if done:
            yield batch_of(done)

    ordered = in_turn_order(small_batches(turns), conv_col, turn_col, role_col, text_col)
    return ordered.mapInArrow(run, f"`{conv_col}` {conv_type}, gaps long, blank long, duplicate long, truncated long, "
                                   "illegal long, cost long, audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame, repairs: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations as rows: the conversation, ``position`` from 0, role and text.

    ``repairs`` holds the conversations' ``audit`` from :func:`repair_conversations` of the same turns. The audit comes as a
    conversation's first row, and its edits are applied as the turns stream by; a conversation without an audit is left out.
    """
    named = turns.select(F.col(conv_col).alias("__conv"), F.lit(1).alias("__part"), F.col(turn_col).cast("long").alias("__turn"),
                         F.coalesce(role_col, F.lit(" ")).alias("__role"), F.coalesce(text_col, F.lit(" ")).alias("__text"))
    audits = repairs.select(F.col(conv_col).alias("__conv"), F.lit(0).alias("__part"), F.lit(None).cast("long").alias("__turn"),
                            F.lit("").alias("__role"), F.col("audit").alias("__text"))
    names = [conv_col, "position", "role", "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b.schema.field(0).type, *r) for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        out, kind, size = [], None, 0
        conv, at, state, audit, position = None, 0, 0, None, 0

        def inserted() -> Iterator[tuple[Any, int, str, str]]:
            nonlocal at, state, position
            while audit is not None and at < len(audit) and audit[at] == INSERT:
                (role, text, state), = repaired([], INSERT, state)
                yield conv, position, role, text
                at, position = at + 1, position + 1

        def turned() -> Iterator[tuple[Any, int, str, str]]:
            nonlocal conv, at, state, audit, position, kind
            for kind, own, part, _, role, text in rows:
                if part == 0:
                    conv, at, state, audit, position = own, 0, 0, text, 0
                elif audit is not None and own == conv:
                    for left_role, left_text, state in repaired([(role[:1], role, text)], audit[at], state):
                        yield conv, position, left_role, left_text
                        position += 1
                    at += 1
                yield from inserted()

        for row in turned():
            out.append(row)
            size += len(row[3])
            if size > 4_000_000 or len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.string()))], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.string()))], names)

    conv_type = turns.schema[conv_col].dataType.simpleString()
    ordered = small_batches(named).unionByName(audits).repartition("__conv").sortWithinPartitions(
        "__conv", "__part", "__turn", "__role", "__text")
    return ordered.mapInArrow(run, f"`{conv_col}` {conv_type}, position long, role string, text string")
