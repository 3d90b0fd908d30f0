"""Cheapest repair of a conversation's turns by iterative-deepening A*."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows searched at once; longer conversations are joined from parts of this length.
PART = 16
#: Characters of one conversation held in memory; what is beyond waits in a temporary file.
HELD = 16_000_000
_ROWS_OUT = 5_000

EDITS = (
    "conv_id long, step long, edit string, cost long, fault string, turn long, was string, role string, text string"
)

# What the turns so far end with: nothing, system, user, assistant.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {
    "s": {_NOTHING: _SYSTEM},
    "u": {_NOTHING: _USER, _SYSTEM: _USER, _ASSISTANT: _USER},
    "a": {_USER: _ASSISTANT},
}
_WHOLE = frozenset((_NOTHING, _ASSISTANT))
_NEVER = 1 << 60

Row = tuple[str, str]  # first letter of the role, fault


def _due(state: int) -> tuple[str, int]:
    """The role that an inserted or renamed turn must have, and the state after it."""
    return ("assistant", _ASSISTANT) if state == _USER else ("user", _USER)


def _steps(row: Row | None, state: int) -> Iterator[tuple[str, int, int, bool]]:
    """Edits in ASCII order: letter, cost, state after it, and whether it uses the row up."""
    if row is not None:
        yield "D", DELETE, state, True
    yield "I", INSERT, _due(state)[1], False
    if row is None or row[1] in ("blank", "duplicate"):
        return
    stays = TRUNCATED if row[1] == "truncated" else 0
    after = _AFTER.get(row[0], {}).get(state)
    if after is not None:
        yield "K", stays, after, True
    yield "R", REROLE + stays, _due(state)[1], True


def search(rows: tuple[Row, ...], state: int, goals: frozenset[int], ends: bool) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest edits from ``state`` to one of ``goals``, ASCII-least among equals.

    Depth-first search in ASCII order of the edits under a cost bound, which grows to the least
    cost that passed it. ``needed`` holds for each (rows used, state) a lower bound of what is
    left to pay: at first what each row costs at least, and after a failed visit the least
    that visit has found, so no state is searched again with a budget known to fail. As equal
    costs cannot be prefixes of each other, the first accepted path under the final bound is the
    answer. Unless the conversation ``ends`` here, nothing is inserted after the last row, since
    the next part may insert it before its first. None if no goal can be reached.
    """
    least = [0] * (len(rows) + 1)
    for k in range(len(rows) - 1, -1, -1):
        initial, fault = rows[k]
        least[k] = least[k + 1] + (DELETE if fault else 0 if initial in _AFTER else REROLE)
    needed = [[least[k]] * 4 for k in range(len(rows) + 1)]
    if not ends or not goals & _WHOLE:
        needed[len(rows)] = [0 if s in goals else _NEVER for s in range(4)]
    path: list[str] = []

    def visit(k: int, s: int, left: int) -> bool:
        if needed[k][s] > left:
            return False
        if k == len(rows) and s in goals:
            return True
        best = _NEVER  # nothing on from here
        for letter, cost, after, used in _steps(rows[k] if k < len(rows) else None, s):
            to = k + used
            if cost + needed[to][after] <= left:
                path.append(letter)
                if visit(to, after, left - cost):
                    return True
                path.pop()
            best = min(best, cost + needed[to][after])
        needed[k][s] = best
        return False

    # What can be reached costs no more than deleting every row and inserting two turns.
    while (bound := needed[0][state]) <= DELETE * len(rows) + 2 * INSERT:
        if visit(0, state, bound):
            return bound, "".join(path)
    return None


@lru_cache(maxsize=100_000)
def _part(rows: tuple[Row, ...], state: int, goals: frozenset[int], ends: bool) -> tuple[int, str] | None:
    return search(rows, state, goals, ends)


def edits(rows: list[Row], part: int = PART) -> tuple[int, str]:
    """(cost, edits) for the turns of a conversation, in time that grows with their number.

    A conversation longer than ``part`` is cut. Each part is searched from every state to every
    state; what the rest costs from each state is added up from the end, and the parts are then
    taken from the begin, the ASCII-least among the cheapest. Edits of a part end with one of a
    row of its own, so neither of two is a prefix of the other and the first difference decides.
    """
    cuts = [tuple(rows[k : k + part]) for k in range(0, len(rows), part)] or [()]
    rest = [{s: 0 for s in _WHOLE}]
    for number, own in enumerate(reversed(cuts)):
        to_go = {}
        for s in range(4):
            if number == 0:
                found = [_part(own, s, _WHOLE, True)]
                costs = [f[0] for f in found if f]
            else:
                found = [(t, _part(own, s, frozenset((t,)), False)) for t in rest[-1]]
                costs = [f[0] + rest[-1][t] for t, f in found if f]
            if costs:
                to_go[s] = min(costs)
        rest.append(to_go)
    rest.reverse()
    state, out = _NOTHING, []
    for number, own in enumerate(cuts):
        if number == len(cuts) - 1:
            out.append(_part(own, state, _WHOLE, True)[1])
            break
        found = [(t, _part(own, state, frozenset((t,)), False)) for t in rest[number + 1]]
        cheapest = [(f[1], t) for t, f in found if f and f[0] + rest[number + 1][t] == rest[number][state]]
        best, state = min(cheapest)
        out.append(best)
    return rest[0][_NOTHING], "".join(out)


class _Spool:
    """Rows of one conversation in order; beyond ``HELD`` characters they wait in a file."""

    def __init__(self):
        self.rows, self.chars, self.file = [], 0, None

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.chars += len(row[1]) + len(row[2])
        if self.chars > HELD:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.rows, self.file, pickle.HIGHEST_PROTOCOL)
            self.rows, self.chars = [], 0

    def __iter__(self) -> Iterator[tuple]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
            self.file.close()
        yield from self.rows


def _edited(conv: int | None, flags: list[Row], spool: _Spool) -> Iterator[tuple]:
    _, letters = edits(flags)
    rows, state = iter(spool), _NOTHING
    for step, letter in enumerate(letters):
        if letter == "I":
            role, state = _due(state)
            yield conv, step, "I", INSERT, "", None, None, role, ""
            continue
        turn, was, text, fault = next(rows)
        stays = TRUNCATED if fault == "truncated" else 0
        if letter == "D":
            yield conv, step, "D", DELETE, fault, turn, was, None, text
        elif letter == "K":
            state = _AFTER[was[0]][state]
            yield conv, step, "K", stays, fault, turn, was, was, text
        else:
            role, state = _due(state)
            yield conv, step, "R", REROLE + stays, fault, turn, was, role, text


def faulty(turns: DataFrame) -> DataFrame:
    """The turns with their first ``fault``: blank, duplicate, truncated or none (empty).

    A duplicate has a role and text seen at a lower turn; one of the same turn is told by its
    neighbour once rows are in order. First turns are found by hash with a map-side minimum,
    and the join with them may be split where one text is most of a table.
    """
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    key = F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.octet_length("role"), "role", "text")))
    keyed = turns.withColumn("__key", key).withColumn("__at", order)
    first = keyed.groupBy("__key").agg(F.min("__at").alias("__first"))
    said = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (
        F.when(~said, "blank").when(F.col("__at") > F.col("__first"), "duplicate").when(~whole, "truncated").otherwise("")
    )
    return keyed.join(first, "__key").select("conv_id", "turn", "role", "text", fault.alias("fault"))


def repair(conversations: DataFrame) -> DataFrame:
    """Each edit of the cheapest repair that makes role initials give ``(s?(ua)+)?``, in order.

    Keep (K) costs 0, Rerole to user or assistant (R) 1, Delete (D) 2, Insert of an empty turn (I)
    5. Blank and duplicate rows must go; a truncated row that stays costs 5 more. Among equal
    costs the ASCII-least sequence of letters is taken. Columns: conv_id, step, edit, cost,
    fault, turn, the role before (``was``) and after (null if deleted), text.

    Rows are ordered by turn (null first), then role and text, so repeated rows lie beside each
    other. Null roles and texts are one blank; a null conv_id is a conversation. No rows give no
    rows. Extra columns are left out. A role of no letters has no legal initial. A task streams
    its conversations in order: it holds a flag for each row and a bounded number of characters,
    the rest waits in a temporary file. Time grows with the number of rows.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    ordered = (
        faulty(turns).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    )

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, flags, spool, before = object(), [], _Spool(), None
        out: list[tuple] = []
        for batch in batches:
            columns = (_ids(batch["conv_id"]), _ids(batch["turn"]), batch["role"], batch["text"], batch["fault"])
            for conv, turn, role, text, fault in zip(*columns, strict=True):
                if conv != current:
                    for row in _edited(current, flags, spool):
                        out.append(row)
                        if len(out) >= _ROWS_OUT:
                            yield _frame(out)
                            out = []
                    current, flags, spool, before = conv, [], _Spool(), None
                if fault != "blank" and before == (turn, role, text):
                    fault = "duplicate"
                before = (turn, role, text)
                flags.append((role[:1], fault))
                spool.add((turn, role, text, fault))
        for row in _edited(current, flags, spool):
            out.append(row)
            if len(out) >= _ROWS_OUT:
                yield _frame(out)
                out = []
        yield _frame(out)

    return ordered.mapInPandas(mend, EDITS)


DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def digests(made: DataFrame) -> DataFrame:
    """Per conversation the faults counted, the letters of its edits and a hash of what ``repair`` left."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: _Digest | None = None
        for batch in batches:
            out = []
            ids, turns = _ids(batch["conv_id"]), _ids(batch["turn"])
            columns = (ids, turns, batch["edit"], batch["cost"], batch["fault"], batch["was"], batch["role"], batch["text"])
            for conv, *row in zip(*columns, strict=True):
                if state is None or conv != state.conv:
                    if state is not None:
                        out.append(state.row())
                    state = _Digest(conv)
                state.add(*row)
            yield _frame(out, DIGEST)
        if state is not None:
            yield _frame([state.row()], DIGEST)

    return made.drop("step").mapInPandas(read, DIGEST)


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.cost, self.illegal = conv, 0, 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.first = self.last = self.before = None
        self.turns, self.letters, self.hash, self.any = 0, [], hashlib.sha256(), False

    def add(self, turn: int | None, edit: str, cost: int, fault: str, was: str | None, role: str | None, text: str) -> None:
        self.letters.append(edit)
        self.cost += int(cost)
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None and turn != self.last:
                self.turns += 1
                self.first, self.last = turn if self.first is None else self.first, turn
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
        if edit != "D":
            self.hash.update((f"\n{role}:{text}" if self.any else f"{role}:{text}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest())


def _ids(column: pd.Series) -> list:
    return [None if pd.isna(v) else int(v) for v in column]


def _frame(rows: list[tuple], layout: str = EDITS) -> pd.DataFrame:
    names = [field.split()[0] for field in layout.split(", ")]
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    return frame.astype({n: "Int64" for n, kind in (f.split() for f in layout.split(", ")) if kind == "long"})
