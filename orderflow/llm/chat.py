"""Chat formatting by incremental black-box rendering of turn prefixes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

_OPEN, _CLOSE = "<|im_start|>", "<|im_end|>\n"

PIECES = (
    "conv_id long, turn_no long, role string, formatted string, begin long, end long, "
    "loss array<struct<begin: long, end: long>>, rewrites_history boolean"
)


def escape(text: str) -> str:
    """Text in which no control string can stand: a backslash more after any < before a bar."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def marked_turns(turns: Turns) -> str:
    """The default template: each turn between control strings, its role on the first line."""
    return "".join(f"{_OPEN}{escape_role(role)}\n{escape(text)}{_CLOSE}" for role, text in turns)


def read_back(formatted: str) -> Turns:
    """The turns of a text that ``marked_turns`` made."""
    turns = []
    for part in formatted.split(_OPEN)[1:]:
        role, _, text = part.removesuffix(_CLOSE).partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


@dataclass
class Prefix:
    """What is rendered of a conversation so far."""

    template: Template
    turns: Turns
    rendered: str = ""

    def add(self, role: str, text: str) -> tuple[str, int, bool]:
        """Render one more turn: what it adds, how much of the output stays, whether less than all."""
        self.turns.append((role, text))
        after = self.template(self.turns)
        if after.startswith(self.rendered):
            same = len(self.rendered)
        else:
            same = _common(self.rendered, after)
        added, rewrites = after[same:], same < len(self.rendered)
        self.rendered = after
        return added, same, rewrites


def _common(a: str, b: str) -> int:
    """Length of the longest common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _loss(template: Template, before: Turns, role: str, text: str, added: str) -> list[tuple[int, int]]:
    """Where in the added output the text is: what two other texts leave as it is surrounds it."""
    if role != "assistant" or not text:
        return []
    one, other = (template([*before, (role, probe)]) for probe in ("a", "b"))
    head, tail = _common(one, other), _common(one[::-1], other[::-1])
    full = template([*before, (role, text)])
    begin = len(added) - (len(full) - head)
    return [(max(begin, 0), len(added) - tail)]


def format_turns(conversations: DataFrame, template: Template = marked_turns) -> DataFrame:
    """Each turn's part of its formatted conversation, found without knowing the template.

    Successive prefixes of a conversation are rendered; what one adds to the output before is
    its last turn's span. A template that changes what it wrote before is flagged on the turn
    that makes it do so (``rewrites_history``), and the turn's span starts at the first change.
    ``loss`` holds the spans of assistant texts: what stays when the turn is rendered with two
    other texts instead surrounds them.
    Spans count characters from the conversation's begin.

    Turns are ordered by turn (null last), then role and text, so repeated rows stay beside each
    other and count as turns of their own. Null roles and texts are empty; a null conv_id is a
    conversation. No rows give no rows. Extra columns are left out. A task reads its turns in
    order and holds one conversation at a time. Every prefix is rendered from the first turn on,
    so time grows with the square of a conversation's length. Rows come out in order of conv_id
    and turn within each partition.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "role", "text"
    )

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, prefix, number, done = object(), None, 0, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(_ids(batch["conv_id"]), batch["role"], batch["text"], strict=True):
                if prefix is None or conv != current:
                    current, prefix, number, done = conv, Prefix(template, []), 0, 0
                before, was = list(prefix.turns), len(prefix.rendered)
                added, same, rewrites = prefix.add(role, text)
                # Characters of the output before this turn's span.
                begin = done - (was - same) if rewrites else done
                loss = [(begin + a, begin + b) for a, b in _loss(template, before, role, text, added)]
                done = begin + len(added)
                out.append((conv, number, role, added, begin, done, [{"begin": a, "end": b} for a, b in loss], rewrites))
                number += 1
            yield pd.DataFrame(
                out, columns=["conv_id", "turn_no", "role", "formatted", "begin", "end", "loss", "rewrites_history"]
            ).astype({"conv_id": "Int64"})

    return ordered.mapInPandas(render, PIECES)


def _ids(column: pd.Series) -> list:
    return [None if pd.isna(v) else int(v) for v in column]


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation what can be read back from the pieces ``format_turns`` gave with its own template."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: _Digest | None = None
        for batch in batches:
            out = []
            rows = zip(_ids(batch["conv_id"]), batch["formatted"], batch["begin"], batch["loss"], strict=True)
            for conv, formatted, begin, loss in rows:
                if state is None or conv != state.conv:
                    if state is not None:
                        out.append(state.row())
                    state = _Digest(conv)
                state.add(formatted, [(s["begin"] - begin, s["end"] - begin) for s in loss])
            yield _frame(out)
        if state is not None:
            yield _frame([state.row()])

    return pieces.select("conv_id", "formatted", "begin", "loss").mapInPandas(read, DIGEST)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [field.split()[0] for field in DIGEST.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[tuple[int, int]]) -> None:
        for role, text in read_back(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for begin, end in loss:
            text = unescape(formatted[begin:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
