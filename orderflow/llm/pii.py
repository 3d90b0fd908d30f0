"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

#: Atoms (runs of letters or digits, single other characters) that an entity may have.
MOST_ATOMS = 24

# Fixed patterns of the four kinds. The e-mail pattern is applied around each @.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before an @, and the domain behind it."""
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        # A run before the next @ may not reach back over this one.
        last = domain.end() if domain else at + 1
        at = text.find("@", last)


def _is_ip(text: str) -> bool:
    parts = [part.lstrip("0") for part in text.split(".")]
    return len(parts) == 4 and all(len(part) <= 3 and int(part or "0") <= 255 for part in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """The four kinds' spans by kind, then start."""
    spans: list[Span] = []
    if "@" in text:
        spans += [("email", begin, end) for begin, end in _emails(text)]
    if not _HAS_DIGIT.search(text):
        return spans
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
    spans += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


_HAS_DIGIT = re.compile(r"[0-9]")

# Only in runs of tokens with a digit, an @ or a written-out @ can an entity lie: elsewhere
# every segment is outside with score 0, so the best segmentation falls into those runs.
_ISLAND = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*(?:\x20[^\s0-9@]*[0-9@]\S*)*")
_ISLAND_WRITTEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+\x20?[\[({]at[\])}]\x20?[^\s@]+(?:\x20?[\[({]dot[\])}]\x20?[^\s@]+)*"
)
_AT = re.compile(r"[\[({]at[\])}]")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
_WRITTEN_OUT = re.compile(
    r"[A-Za-z0-9._%+-]+\x20?(?:@|[\[({]at[\])}])\x20?[A-Za-z0-9-]+"
    r"(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]+)+"
)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_FOUR_PARTS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_GROUPED = re.compile(r"[0-9]{4}(?:[ -][0-9]{4}){3}")
_DIALLED = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})+|(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ ]?[0-9]{3,4}[ .-][0-9]{3,4}")
_CUES = {
    "email": re.compile(r"(?:e-?mail|contact|write to)\W*$", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address)\W*$", re.I),
    "card": re.compile(r"\b(?:card|visa|credit|iban)\W*$", re.I),
    "phone": re.compile(r"\b(?:tel|phone|call|fax|mobile|cell)\W*$", re.I),
}
_FEATURES = [
    "always", "email", "email written out", "four parts", "parts too large", "luhn", "16 to 19 digits", "groups of four",
    "dialled", "plus", "8 to 15 digits", "10 or 11 digits", "other digits", "letters", "odd ends", "glued left", "glued right",
    "no @", "cue email", "cue ip", "cue card", "cue phone",
]
_F = {name: k for k, name in enumerate(_FEATURES)}


def cues(text: str, begin: int) -> list[int]:
    """Features of what stands before a segment."""
    before = text[max(0, begin - 16) : begin]
    return [_F[f"cue {kind}"] for kind, cue in _CUES.items() if cue.search(before)] if before else []


def features(text: str, begin: int, end: int) -> list[int]:
    """Whole-span features of a candidate segment, but for its cues."""
    span = text[begin:end]
    digits = _digits(span)
    found = ["always"]
    if _EMAIL.fullmatch(span):
        found.append("email")
    elif _WRITTEN_OUT.fullmatch(span):
        found.append("email written out")
    if _FOUR_PARTS.fullmatch(span):
        found.append("four parts" if _is_ip(span) else "parts too large")
    only = _CARD.fullmatch(span) is not None
    if only and 16 <= len(digits) <= 19:
        found.append("16 to 19 digits")
        if luhn(digits):
            found.append("luhn")
        if _GROUPED.fullmatch(span):
            found.append("groups of four")
    if _DIALLED.fullmatch(span):
        found.append("dialled")
    if span[0] == "+":
        found.append("plus")
    if 8 <= len(digits) <= 15:
        found.append("8 to 15 digits")
        if len(digits) in (10, 11):
            found.append("10 or 11 digits")
    elif not 16 <= len(digits) <= 19:
        found.append("other digits")
    if any(c.isalpha() for c in span):
        found.append("letters")
    if not (span[0].isalnum() or span[0] in "+(") or not span[-1].isalnum():
        found.append("odd ends")
    if begin and (text[begin - 1].isalnum() or text[begin - 1] in "+-.@_%$"):
        found.append("glued left")
    if end < len(text) and (text[end].isalnum() or text[end] in "-@_%" or text[end] == "." and text[end + 1 : end + 2].isalnum()):
        found.append("glued right")
    if "@" not in span and "at" not in span:
        found.append("no @")
    return [_F[name] for name in found]


class Taken:
    """Stretches of a text, and whether others meet them; each question takes logarithmic time."""

    def __init__(self, spans: list[tuple[int, int]]):
        self._begins, self._ends = [], []
        for begin, end in sorted(spans):
            # Stretches that overlap become one.
            if self._ends and begin < self._ends[-1]:
                self._ends[-1] = max(self._ends[-1], end)
            else:
                self._begins.append(begin)
                self._ends.append(end)

    def meets(self, begin: int, end: int) -> bool:
        """Whether any stretch ends after ``begin`` and begins before ``end``."""
        at = bisect_right(self._ends, begin)
        return at < len(self._ends) and self._begins[at] < end


def islands(text: str) -> Iterator[tuple[list[int], list[tuple[int, int, list[int]]]]]:
    """Of each run that may hold entities: the atoms' bounds, and the candidate segments.

    A candidate has an @, plain or written out, or 4 to 19 digits and no letters; it begins and
    ends as some kind can and has seven characters or more.
    """
    runs = list(_ISLAND.finditer(text)) if "@" in text or _HAS_DIGIT.search(text) else []
    if _AT.search(text):
        taken = Taken([r.span() for r in runs])
        runs += [m for m in _ISLAND_WRITTEN.finditer(text) if not taken.meets(*m.span())]
    for m in runs:
        atoms = [a.span() for a in _ATOM.finditer(text, m.start(), m.end())]
        bounds = [begin for begin, _ in atoms] + [m.end()]
        ats, digits, letters = [0], [0], [0]
        for begin, end in atoms:
            first = text[begin]
            ats.append(ats[-1] + (first == "@" or text[begin - 1 : end + 1] in _WRITTEN_AT))
            digits.append(digits[-1] + (end - begin) * ("0" <= first <= "9"))
            letters.append(letters[-1] + first.isalpha())
        segments = []
        for i in range(len(atoms)):
            first = text[bounds[i]]
            if not (first.isalnum() or first in "+("):
                continue
            before = None
            for j in range(i + 1, min(i + MOST_ATOMS, len(atoms)) + 1):
                if not text[bounds[j] - 1].isalnum():
                    continue
                if ats[j] == ats[i] and (letters[j] > letters[i] or not 4 <= digits[j] - digits[i] <= 19):
                    continue
                if bounds[j] - bounds[i] >= 7:
                    before = cues(text, bounds[i]) if before is None else before
                    segments.append((i, j, features(text, bounds[i], bounds[j]) + before))
        yield bounds, segments


_WRITTEN_AT = {left + "at" + right for left in "[({" for right in "])}"}


def best_spans(text: str, weights: np.ndarray) -> list[Span]:
    """The segmentation of highest score: bounded segments of a kind, single atoms outside."""
    out: list[Span] = []
    # Few sets of features occur, so each is scored once a text.
    known: dict[tuple[int, ...], tuple[int, float]] = {}
    for bounds, segments in islands(text):
        ending: dict[int, list[tuple[int, int, float]]] = {}
        for i, j, found in segments:
            if tuple(found) not in known:
                scores = weights[:, found].sum(axis=1)
                known[tuple(found)] = int(scores.argmax()), float(scores.max())
            kind, score = known[tuple(found)]
            if score > 0:
                ending.setdefault(j, []).append((i, kind, score))
        if not ending:
            continue
        best, back = [0.0] * len(bounds), [None] * len(bounds)
        for j in range(1, len(bounds)):
            best[j] = best[j - 1]
            for i, kind, score in ending.get(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind)
        j, own = len(bounds) - 1, []
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                own.append((KINDS[kind], bounds[i], bounds[j]))
                j = i
        out += reversed(own)
    return out


def fit(examples: list[tuple[str, list[Span]]], epochs: int = 12, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights by kind and feature that make the examples' segmentations likeliest."""
    weights = np.zeros((len(KINDS), len(_FEATURES)))
    seen = np.full_like(weights, 1e-6)
    lattices = []
    for text, gold in examples:
        wanted = {(begin, end): KINDS.index(kind) for kind, begin, end in gold}
        for bounds, segments in islands(text):
            matrix = np.zeros((len(segments), len(_FEATURES)))
            right = []
            for row, (i, j, found) in enumerate(segments):
                matrix[row, found] = 1
                right.append(wanted.get((bounds[i], bounds[j]), -1))
            if segments:
                lattices.append((len(bounds) - 1, [(i, j) for i, j, _ in segments], matrix, np.array(right)))
    for _ in range(epochs):
        for size, places, matrix, right in lattices:
            scores = matrix @ weights.T
            joint = np.logaddexp.reduce(scores, axis=1)
            forward, backward = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
            forward[0] = backward[size] = 0.0
            for j in range(1, size + 1):
                terms = [forward[j - 1]] + [forward[i] + joint[k] for k, (i, e) in enumerate(places) if e == j]
                forward[j] = np.logaddexp.reduce(terms)
            for i in range(size - 1, -1, -1):
                terms = [backward[i + 1]] + [backward[e] + joint[k] for k, (b, e) in enumerate(places) if b == i]
                backward[i] = np.logaddexp.reduce(terms)
            edge = np.array([forward[i] + backward[j] for i, j in places]) - forward[size]
            expected = np.exp(scores + edge[:, None])
            for k, kind in enumerate(right):
                if kind >= 0:
                    expected[k, kind] -= 1
            slope = expected.T @ matrix + decay * weights
            seen += slope**2
            weights -= rate * slope / np.sqrt(seen)
    return weights


def examples(count: int = 240, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Made-up labelled lines: entities of all kinds in several ways of writing, and other numbers."""
    rng = random.Random(seed)
    number = lambda size: "".join(rng.choice("0123456789") for _ in range(size))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        digits = "4" + number(14)
        return next(digits + d for d in "0123456789" if luhn(digits + d))

    def no_card() -> str:
        digits = card()
        return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)

    def grouped(digits: str) -> str:
        return rng.choice(" -").join(digits[i : i + 4] for i in range(0, 16, 4))

    email = lambda: f"{word()}.{number(2)}@{word()}.{word()}.com"
    local = lambda: f"({number(3)}) {number(3)}-{number(4)}"
    entity = [
        ("email", email),
        ("email", lambda: f"{word()}@{word()}.org"),
        ("email", lambda: f"{word()} [at] {word()} [dot] com"),
        ("email", lambda: f"{word()}(at){word()}.com"),
        ("ip", lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))),
        ("card", card),
        ("card", lambda: grouped(card())),
        ("phone", lambda: f"+1 {local()}"),
        ("phone", lambda: f"+{rng.randint(20, 99)} {number(3)} {number(3)} {number(4)}"),
        ("phone", local),
        ("phone", lambda: f"{number(3)}-{number(3)}-{number(4)}"),
    ]
    other = [
        no_card,
        lambda: grouped(no_card()),
        lambda: f"20{number(2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
        lambda: f"1{rng.randint(0, 9)}.0{rng.randint(1, 9)}.20{number(2)}",
        lambda: f"{number(3)}.{number(2)}",
        lambda: f"v{number(1)}.{number(1)}.{number(2)}.{number(1)}",
        lambda: f"3{rng.randint(10, 99)}.{rng.randint(300, 999)}.{number(2)}.{number(1)}",
        lambda: number(rng.randint(1, 12)),
        lambda: number(rng.randint(20, 30)),
        lambda: f"{number(2)}:{number(2)}:{number(2)}",
        lambda: f"{number(1)},{number(3)},{number(3)}",
        lambda: f"@{word()}",
        lambda: f"{word()}{number(8)}{word()}",
        lambda: f"{number(6)}a{number(4)}bc{number(8)}",
        lambda: f"{number(4)} {number(4)}",
        lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
    ]
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(rng.randint(1, 4)):
            text += f"{word()} " * rng.randint(0, 2)
            if rng.random() < 0.5:
                kind, make = rng.choice(entity)
                made = make()
                spans.append((kind, len(text), len(text) + len(made)))
            else:
                made = rng.choice(other)()
            text += made + rng.choice(["", "", ".", ",", ";"]) + " "
        out.append((text + word(), spans))
    return out


def all_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and with them the model's that overlap none of them; by kind, then start."""
    base = base_spans(text)
    taken = Taken([(begin, end) for _, begin, end in base])
    added = [span for span in best_spans(text, weights) if not taken.meets(*span[1:])]
    return base, sorted({*base, *added}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "doc_id long, base array<struct<kind: string, begin: long, end: long>>, spans array<struct<kind: string, begin: long, end: long>>"


def find(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """Per document the personal data in its text: base spans, and all spans.

    Spans are (kind, begin, end) in code points by kind, then begin. The model is fitted on
    made-up lines (``examples``) unless weights are given. Null texts are empty and have none.
    Repeated rows are searched each. No documents give no rows. Only doc_id and text are read.
    """
    weights = fit(examples()) if weights is None else weights

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [all_spans(text, weights) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "base": [_structs(base) for base, _ in rows],
                    "spans": [_structs(spans) for _, spans in rows],
                }
            )

    plain = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInPandas(found, SPANS)


def _structs(spans: list[Span]) -> list[dict]:
    return [{"kind": kind, "begin": begin, "end": end} for kind, begin, end in spans]


def masked(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """The documents, all columns, with each personal datum replaced by its kind in brackets.

    Overlapping spans are replaced together, by the kind of the first. ``n_chars``, where there
    is such a column, is that of the new text. Null texts stay null.
    """
    weights = fit(examples()) if weights is None else weights

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([None if text is None else mask_text(text, weights) for text in texts], dtype=object)

    out = docs.withColumn("text", mask(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mask_text(text: str, weights: np.ndarray) -> str:
    _, spans = all_spans(text, weights)
    out, at = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
