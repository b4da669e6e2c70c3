"""Conversation structure repair by Viterbi with survivor coalescence.

A conversation is well formed when its role initials read ``(s?(ua)+)?``. Rows are kept, given another
role, deleted, or empty turns are put in; the cheapest edits are searched for by dynamic programming
over four states: nothing yet, after system, after user, after assistant. Each state has one survivor,
the cheapest edits that lead to it; of equally cheap ones the ASCII-least initials win.

Survivors are leaves of a tree of backpointers whose nodes count their references: branches that no
survivor needs are freed, and once all survivors share an ancestor the edits up to it are emitted. A
task so holds the unresolved ends only. A tie is broken on these: two survivors of one state are compared
over their complete unresolved ends, from the ancestor they share.

Survivors that cannot win any more are dropped, or "all deleted so far" would keep every edit unresolved:
what follows "nothing yet" costs at most a deletion (of a system turn) more after an assistant turn, and
what follows a system turn costs the same there.

Repeated rows: the first turn of each (conversation, role, text) that occurs more than once is an aggregate
and is joined back, so no task keeps what it has seen.

Defined results: a null conv_id is a conversation of its own; null turns come first; rows of one turn are
ordered by role and text; a null role or text is one space (so such a text is blank); rows equal in all
columns are repeats; an empty table gives no rows; texts of any length are read whole; other columns are
left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.llm import turns
from webgraph_spark.llm.common import same

# White space, ends of sentences, and what edits cost.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE = 1
DELETE = 2
INSERT = 5
TRUNCATED = 5

LEGAL = {"su", "ua", "au"}
NAMES = {"K": "keep", "R": "rerole", "D": "delete", "I": "insert"}

# States: nothing yet, after a system, a user, an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER, _USER: _ASSISTANT}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_KEEPS = {(_START, "s"): _SYSTEM, **{(state, _ROLE[to][0]): to for state, to in _NEXT.items()}}


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str | None


class Edit(NamedTuple):
    initial: str
    row: Row | None
    role: str | None
    text: str | None


class _Node:
    """An edit; ``refs`` counts the edits after it and the survivors that end here."""

    __slots__ = ("parent", "edit", "depth", "refs")

    def __init__(self, parent: _Node | None, edit: Edit | None):
        self.parent = parent
        self.edit = edit
        self.depth = 0 if parent is None else parent.depth + 1
        self.refs = 0
        if parent is not None:
            parent.refs += 1


def _free(node: _Node | None) -> None:
    while node is not None and node.refs == 0:
        parent, node.parent = node.parent, None
        if parent is not None:
            parent.refs -= 1
        node = parent


def _less(a: _Node, b: _Node) -> bool:
    """Whether the initials up to ``a`` are less than those up to ``b``, from their common ancestor on."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit.initial)
            a, skip = a.parent, a.depth > b.depth
            if skip:
                continue
        right.append(b.edit.initial)
        b = b.parent
    return left[::-1] < right[::-1]


class Viterbi:
    """Takes the rows of one conversation and emits edits as soon as they are settled."""

    def __init__(self) -> None:
        self._root = _Node(None, None)
        self._best: dict[int, tuple[int, _Node]] = {}
        self._offer(self._best, _START, 0, self._root)
        self._insert(self._best)
        self.cost = 0

    def _offer(self, best: dict[int, tuple[int, _Node]], state: int, cost: int, node: _Node) -> None:
        known = best.get(state)
        if known is not None and (known[0] < cost or (known[0] == cost and not _less(node, known[1]))):
            _free(node)
            return
        node.refs += 1
        best[state] = (cost, node)
        if known is not None:
            known[1].refs -= 1
            _free(known[1])

    def _insert(self, best: dict[int, tuple[int, _Node]]) -> None:
        for state in (_START, _SYSTEM, _ASSISTANT, _USER):
            if state in best:
                cost, node = best[state]
                to = _NEXT[state]
                self._offer(best, to, cost + INSERT, _Node(node, Edit("I", None, _ROLE[to], "")))

    def push(self, row: Row) -> Iterator[Edit]:
        best: dict[int, tuple[int, _Node]] = {}
        stays = row.fault not in ("blank", "duplicate")
        more = TRUNCATED if row.fault == "truncated" else 0
        deleted = Edit("D", row, None, None)
        for state, (cost, node) in self._best.items():
            self._offer(best, state, cost + DELETE, _Node(node, deleted))
            if stays:
                kept = _KEEPS.get((state, row.role[:1]))
                if kept is not None:
                    self._offer(best, kept, cost + more, _Node(node, Edit("K", row, row.role, row.text)))
                to = _NEXT[state]
                self._offer(best, to, cost + REROLE + more, _Node(node, Edit("R", row, _ROLE[to], row.text)))
        self._insert(best)
        least = best[_ASSISTANT][0]
        if least + DELETE < best.get(_START, (0,))[0]:
            best[_START][1].refs -= 1
            _free(best.pop(_START)[1])
        if least < best.get(_SYSTEM, (0,))[0]:
            best[_SYSTEM][1].refs -= 1
            _free(best.pop(_SYSTEM)[1])
        before, self._best = self._best, best
        for _, node in before.values():
            node.refs -= 1
            _free(node)
        return self._settled()

    def _settled(self) -> Iterator[Edit]:
        if self._root.refs > 1:
            return
        path = []
        node = next(iter(self._best.values()))[1]
        while node is not self._root:
            path.append(node)
            node = node.parent
        ends = {id(node) for _, node in self._best.values()}
        while path and self._root.refs == 1 and id(self._root) not in ends:
            self._root = path.pop()
            self._root.parent = None
            yield self._root.edit

    def finish(self) -> Iterator[Edit]:
        cost, node = self._best[_START] if _START in self._best else self._best[_ASSISTANT]
        other = self._best[_ASSISTANT]
        if other[0] < cost or (other[0] == cost and other[1] is not node and _less(other[1], node)):
            cost, node = other
        self.cost = cost
        path = []
        while node is not self._root:
            path.append(node.edit)
            node = node.parent
        yield from reversed(path)

    def unresolved(self) -> int:
        """Edits that are held and not emitted yet."""
        held = {}
        for _, node in self._best.values():
            while node is not self._root and id(node) not in held:
                held[id(node)] = node
                node = node.parent
        return len(held)


def edits(rows: Iterable[Row], totals: dict | None = None) -> Iterator[Edit]:
    """The cheapest edits of one conversation, in order; ``totals`` gets their cost."""
    search = Viterbi()
    for row in rows:
        yield from search.push(row)
    yield from search.finish()
    if totals is not None:
        totals["cost"] = search.cost


# --- rows -------------------------------------------------------------------


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with one row in twenty dropped, emptied, cut, repeated or given to the user, by
    the checksum of ``conv_id:turn``. (conv_id, turn, role, text, lost); a dropped row stays as a lost one,
    which only tells that its conversation exists.
    """
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    text = _or_space("text")
    damaged = F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(_or_space("role")).alias("role"),
        damaged.alias("text"),
        (kind == 0).alias("lost"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _prepared(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost, later) in order; later: the same role and text came in an earlier turn."""
    lost = F.col("lost") if "lost" in conversations.columns else F.lit(False)
    rows = conversations.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"), lost.alias("lost"))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    # The least of structs, as a null turn comes first.
    first = F.min(F.struct("turn")).alias("first")
    seen = rows.where("not lost").groupBy("conv_id", "role", "digest").agg(first, F.count(F.lit(1)).alias("n"))
    marked = same(rows, seen.where("n > 1").drop("n"), ["conv_id", "role", "digest"])
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return turns.in_order(marked.select("conv_id", "turn", "role", "text", "lost", later.alias("later")), "turn", "role", "text", "lost")


def _with_faults(rows: Iterable[tuple]) -> Iterator[Row]:
    before = None
    for turn, role, text, lost, later in rows:
        if lost:
            continue
        said = text.rstrip(SPACE)
        if not said:
            fault = "blank"
        elif later or before == (turn, role, text):
            fault = "duplicate"
        else:
            fault = None if said[-1] in ENDS else "truncated"
        before = (turn, role, text)
        yield Row(turn, role, text, fault)


class _Audit:
    """What is told of one conversation, gathered as its rows and edits pass."""

    def __init__(self) -> None:
        self.least = self.most = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.initials = bytearray()
        self.digest = hashlib.sha256()
        self.begun = False

    def see(self, rows: Iterable[Row]) -> Iterator[Row]:
        for row in rows:
            if row.turn is not None and row.turn != self.most:
                self.least = row.turn if self.least is None else self.least
                self.most = row.turn
                self.turns += 1
            if row.fault:
                self.faults[row.fault] += 1
            if self.before is not None and self.before + row.role[:1] not in LEGAL:
                self.illegal += 1
            self.before = row.role[:1]
            yield row

    def add(self, edit: Edit) -> None:
        self.initials += edit.initial.encode()
        if edit.role is not None:
            self.digest.update(f"{chr(10) if self.begun else ''}{edit.role}:{edit.text}".encode())
            self.begun = True

    def row(self, conv_id: object) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        told = (gaps, *self.faults.values(), self.illegal, self.cost, self.initials.decode(), self.digest.hexdigest())
        return (conv_id, *told)


def _run(conversations: DataFrame, columns: str, rows_of: Callable[..., Iterator[tuple]], size) -> DataFrame:
    prepared = _prepared(conversations)
    kinds = {name: kind for name, kind in prepared.dtypes}
    schema = f"conv_id {kinds['conv_id']}, {columns}".replace("TURN", kinds["turn"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for conv_id, rows in turns.read(batches) for row in rows_of(conv_id, rows))
        return turns.write(found, arrow, size)

    arrow = turns.arrow_schema(schema)
    return prepared.mapInArrow(work, schema)


def repair(conversations: DataFrame) -> DataFrame:
    """One row per edit: conv_id, place (from 0), edit, turn, old_role, fault, role, text.

    role and text are those of the repaired turn, null where the row is deleted; turn, old_role and fault
    (blank, duplicate, truncated) are null where a turn is put in.
    """

    def rows_of(conv_id: object, rows: Iterable[tuple]) -> Iterator[tuple]:
        for place, edit in enumerate(edits(_with_faults(rows))):
            old = edit.row or Row(None, None, None, None)
            yield conv_id, place, NAMES[edit.initial], old.turn, old.role, old.fault, edit.role, edit.text

    columns = "place long, edit string, turn TURN, old_role string, fault string, role string, text string"
    return _run(conversations, columns, rows_of, lambda row: len(row[-1] or ""))


def audit(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    gaps: turns missing between the least and the greatest; illegal: neighbours whose initials are not su,
    ua or au; audit: initials of the edits; repaired_sha256: digest of the repaired ``role:text`` lines.
    The same edits as ``repair`` gives, folded as they are emitted. A conversation of lost rows only has zeros.
    """

    def rows_of(conv_id: object, rows: Iterable[tuple]) -> Iterator[tuple]:
        told, totals = _Audit(), {}
        for edit in edits(told.see(_with_faults(rows)), totals):
            told.add(edit)
        told.cost = totals["cost"]
        yield told.row(conv_id)

    columns = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _run(conversations, columns, rows_of, lambda row: len(row[-2]))
