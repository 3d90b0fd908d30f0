"""Secret scans that unwrap URL, Unicode, base64 and compressed layers until nothing is left."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")

#: Characters that may be unwrapped from one text: what stops decompression bombs.
MOST_UNWRAPPED = 64_000_000

# Fixed patterns of the three kinds.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _classes(chars: str) -> bytes:
    """A translation of bytes to x for the characters given and a blank for others."""
    return bytes(0x78 if chr(b) in chars else 0x20 for b in range(256))


_HEX_CLASS = _classes("0123456789abcdef")
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_BASE64_CLASS = _classes(_ALNUM + "+/_-")
_LONG = b"x" * 16

Span = tuple[str, int, int]


class Map:
    """Where the characters of a layer lie in the document's text, however deep the layer.

    A map of the text itself says nothing; one of compressed data names one range for all; any
    other holds begin and end of each character. A map of what lies inside is made from the
    layer's own at once, so no map leans on another.
    """

    def __init__(self, begins: np.ndarray | None = None, ends: np.ndarray | None = None, whole: tuple[int, int] | None = None):
        self.begins, self.ends, self.whole = begins, ends, whole

    def __call__(self, a: int, b: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        return (a, b) if self.begins is None else (int(self.begins[a]), int(self.ends[b - 1]))

    def inside(self, begins: np.ndarray, ends: np.ndarray) -> Map:
        """The map of characters that lie at these places of the layer."""
        if self.whole is not None:
            return self
        if self.begins is None:
            return Map(begins.astype(np.int32), ends.astype(np.int32))
        return Map(self.begins[begins], self.ends[ends - 1])


def base_spans(text: str) -> list[Span]:
    """The three kinds' spans in a text as it stands, by start and kind."""
    # One byte a character, so places agree.
    plain = text.encode("ascii", "replace")
    spans: list[Span] = []
    lower = plain.lower()
    if (b"=" in plain or b":" in plain) and any(hint in lower for hint in _ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in plain:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if _LONG in plain.translate(_HEX_CLASS):
        spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_PERCENT = r"(?P<percent>(?:%[0-9A-Fa-f]{2})+)"
_ESCAPE = r"\\(?:u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|u(?P<four>[0-9A-Fa-f]{4})|U(?P<eight>[0-9A-Fa-f]{8})|x(?P<two>[0-9A-Fa-f]{2}))"
_ENCODED = re.compile(f"{_PERCENT}|{_ESCAPE}")
#: With the one-character escapes of JSON strings, which a path or a pattern may hold unescaped.
_ENCODED_IN_JSON = re.compile(f"{_PERCENT}|{_ESCAPE}" + r"""|\\(?P<simple>["'\\/bfnrt])""")
_SIMPLE = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 over several lines; the first and the last may be short.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{1,15}(?![A-Za-z0-9+/_-]))?={0,2}"
)
_IN_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_SEPARATOR = re.compile(r"[+/_-]")
#: What can hold a secret or a further layer: nothing shorter than 16 ASCII characters does.
_ASCII = re.compile(rb"[\x20-\x7e\t\r\n]{16,}")
_UTF16 = {"utf-16-le": re.compile(rb"(?:[\x20-\x7e\t\r\n]\x00){16,}"), "utf-16-be": re.compile(rb"(?:\x00[\x20-\x7e\t\r\n]){16,}")}


class _Layer(NamedTuple):
    """A text with where its characters come from."""

    text: str
    place: Map


class _Places:
    """Where each character of a decoded text begins and ends in the text before: runs left as they are, or one decoded character."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.outs: list[int] = []
        self.begins: list[int] = []
        self.ends: list[int | None] = []

    def add(self, part: str, begin: int, end: int | None = None) -> None:
        """A run from ``begin`` on, or a character that stands for ``begin`` to ``end``."""
        if part:
            self.parts.append(part)
            self.outs.append(self.size)
            self.begins.append(begin)
            self.ends.append(end)
            self.size += len(part)

    def within(self, outer: Map) -> Map:
        """The map of the decoded text."""
        outs = np.array([*self.outs, self.size])
        sizes = np.diff(outs)
        begins = np.repeat(np.array(self.begins, np.int64), sizes)
        step = np.arange(self.size) - np.repeat(outs[:-1], sizes)
        single = np.repeat(np.array([e is not None for e in self.ends], bool), sizes)
        ends = np.repeat(np.array([e or 0 for e in self.ends], np.int64), sizes)
        begins = np.where(single, begins, begins + step)
        return outer.inside(begins, np.where(single, ends, begins + 1))


def _decoded(text: str, pattern: re.Pattern) -> tuple[str, _Places]:
    """The whole text with each match decoded, and where its characters come from."""
    places, at = _Places(), 0
    for m in pattern.finditer(text):
        places.add(text[at : m.start()], at)
        if m["percent"]:
            _add_percent(places, m[0], m.start())
        else:
            places.add(_escaped_char(m), m.start(), m.end())
        at = m.end()
    places.add(text[at:], at)
    return "".join(places.parts), places


def _add_percent(places: _Places, run: str, at: int) -> None:
    for char in bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape"):
        # A byte that is no UTF-8 stands alone.
        odd = "\udc80" <= char <= "\udcff"
        end = at + 3 * (1 if odd else len(char.encode()))
        places.add("\ufffd" if odd else char, at, end)
        at = end


def _escaped_char(m: re.Match) -> str:
    groups = m.groupdict()
    if groups.get("simple"):
        return _SIMPLE.get(m["simple"], m["simple"])
    code = int(m["braced"] or m["four"] or m["eight"] or m["two"], 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


def _unwrapped(layer: _Layer) -> Iterator[tuple[str, Map, set[int]] | tuple[bytes, Map, set[int]]]:
    """What a text holds encoded: the whole text decoded once, and bytes of which base64 runs are made."""
    text, outer = layer.text, layer.place
    if "%" in text or "\\" in text:
        plain = None
        if _ENCODED.search(text):
            plain, places = _decoded(text, _ENCODED)
            yield plain, places.within(outer), set()
        if "\\" in text:
            inner, places = _decoded(text, _ENCODED_IN_JSON)
            if inner not in (text, plain):
                yield inner, places.within(outer), set()
    if _LONG in text.encode("ascii", "replace").translate(_BASE64_CLASS):
        for m in chain(_BASE64.finditer(text), _WRAPPED.finditer(text)):
            places = _Places()
            for line in _IN_LINE.finditer(text, m.start(), m.end()):
                places.add(line[0], line.start())
            run = "".join(places.parts)
            # Text in base64 has letters of both cases; a word or a number has not.
            if run.islower() or run.isupper() or run.isdigit() or run.capitalize() == run:
                continue
            plain = run.translate(_PLAIN_ALPHABET)
            inner = places.within(outer)
            # Behind a word glued to it, a run may begin at any of four places.
            for first in range(4):
                size = len(run) - first
                size -= size % 4 == 1
                raw = base64.b64decode(plain[first : first + size] + "=" * (-size % 4))
                starts = {0, *(p // 4 * 3 for p in _after_separators(run, places, first))}
                yield raw, _by_groups(first, len(run), len(raw), inner), starts


def _after_separators(run: str, places: _Places, first: int) -> Iterator[int]:
    """Places in a run, from ``first`` on, behind a separator or a line end, where whole groups begin."""
    for at in chain((m.end() for m in _SEPARATOR.finditer(run)), places.outs):
        if at > first and (at - first) % 4 == 0:
            yield at - first


_PLAIN_ALPHABET = str.maketrans("-_", "+/")


def _by_groups(first: int, last: int, size: int, outer: Map) -> Map:
    """Places of bytes in a base64 run: every three bytes lie in four characters."""
    at = np.arange(size)
    begins = first + at // 3 * 4 + at % 3
    return outer.inside(begins, np.minimum(begins + 2, last))


_GZIP = b"\x1f\x8b\x08"


def _is_packed(raw: bytes) -> bool:
    return raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78" and len(raw) > 1 and int.from_bytes(raw[:2], "big") % 31 == 0


def _inflated(raw: bytes, most: int) -> tuple[bytes | None, bool]:
    """What a gzip stream of any number of members or a zlib stream holds, and whether ``most`` cut it.

    Of a damaged stream what comes before the damage.
    """
    if not _is_packed(raw):
        return None, False
    out, size = [], 0
    while raw and _is_packed(raw) and size < most:
        stream, left = zlib.decompressobj(zlib.MAX_WBITS | 32), raw
        try:
            while not stream.eof and size < most:
                piece = stream.decompress(left, min(1 << 16, most - size))
                if not piece and not stream.unconsumed_tail:
                    break
                out.append(piece)
                size += len(piece)
                left = stream.unconsumed_tail
        except zlib.error:
            break
        if not stream.eof:
            break
        raw = stream.unused_data
    return (b"".join(out) or None), size >= most


def _texts_of(raw: bytes, place: Map) -> Iterator[_Layer]:
    """Bytes as texts with the places of their characters: UTF-8, else byte by byte, and UTF-16."""
    if _ASCII.search(raw):
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = raw.decode("latin-1")
        if len(text) == len(raw):
            yield _Layer(text, place)
        else:
            starts = np.cumsum([0, *(len(char.encode()) for char in text)])
            yield _Layer(text, place.inside(starts[:-1], starts[1:]))
    for name, pattern in _UTF16.items():
        for m in pattern.finditer(raw):
            at = m.start() + 2 * np.arange((m.end() - m.start()) // 2)
            yield _Layer(m[0].decode(name), place.inside(at, at + 2))


def _layers(inner: bytes, place: Map, starts: set[int], left: int) -> Iterator[tuple[_Layer, bool]]:
    """Texts of bytes and of the compressed streams in them, and whether a stream was cut."""
    for new in _texts_of(inner, place):
        yield new, False
    at = inner.find(_GZIP)
    while at >= 0:
        starts = starts | {at}
        at = inner.find(_GZIP, at + 1)
    for start in sorted(starts):
        unpacked, cut = _inflated(inner[start:], left)
        if unpacked is None:
            continue
        whole = Map(whole=place(start, len(inner)))
        # Streams within streams, as deep as they go; one that holds itself is met again.
        met: set[bytes] = set()
        while unpacked is not None and (digest := hashlib.sha256(unpacked).digest()) not in met:
            met.add(digest)
            for new in _texts_of(unpacked, whole):
                yield new, cut
            left -= len(unpacked)
            if left <= 0:
                yield _Layer("", whole), _is_packed(unpacked)
                break
            unpacked, cut = _inflated(unpacked, left)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The spans of the text as it stands, and all spans with those of what it wraps."""
    return unwrapped_spans(text)[:2]


def unwrapped_spans(text: str) -> tuple[list[Span], list[Span], bool]:
    """The spans of the text as it stands, all spans with those of what it wraps, and whether a limit was met.

    A worklist starts with the text. Each layer is scanned and gives further layers: the whole of
    it with its percent signs and Unicode escapes decoded at once (and again with the escapes of
    JSON strings), so that keys and values in different encodings meet; and of each base64 run
    what it holds, gzip or zlib opened. A layer whose content was met at the same place before is
    left, so cycles end. Spans found inside are mapped to the characters that hold them; in
    compressed data to the run.
    """
    base = base_spans(text)
    found = set(base)
    work: deque[_Layer] = deque([_Layer(text, Map())])
    seen: set[tuple[bytes, int, int]] = set()
    left, limited = MOST_UNWRAPPED, False
    while work:
        layer = work.popleft()
        for inner, place, starts in _unwrapped(layer):
            if isinstance(inner, bytes):
                made = _layers(inner, place, starts, max(left, 1))
            else:
                made = iter([(_Layer(inner, place), False)] if inner != layer.text else [])
            for new, cut in made:
                limited = limited or cut or len(new.text) > left
                if not new.text or len(new.text) > left:
                    continue
                key = (hashlib.sha256(new.text.encode("utf-8", "surrogatepass")).digest(), *new.place(0, len(new.text)))
                if key in seen:
                    continue
                seen.add(key)
                left -= len(new.text)
                found.update((kind, *new.place(start, end)) for kind, start, end in base_spans(new.text))
                work.append(new)
    return base, in_order(list(found)), limited


SPANS = "doc_id long, base array<struct<kind: string, begin: long, end: long>>, spans array<struct<kind: string, begin: long, end: long>>, limited boolean"


def scan(docs: DataFrame) -> DataFrame:
    """Per document the secrets in its text as it stands (base) and with those it wraps (spans).

    Spans are (kind, begin, end) in code points by begin, then kind. Null texts are empty and
    have none. Repeated rows are scanned each. No documents give no rows. Only doc_id and text
    are read. A text is unwrapped up to ``MOST_UNWRAPPED`` characters in all;
    ``limited`` tells whether that left anything out.
    """

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [unwrapped_spans(text or "") for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "base": [_structs(base) for base, _, _ in rows],
                    "spans": [_structs(spans) for _, spans, _ in rows],
                    "limited": [limited for _, _, limited in rows],
                }
            )

    plain = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInPandas(scanned, SPANS)


def _structs(spans: list[Span]) -> list[dict]:
    return [{"kind": kind, "begin": begin, "end": end} for kind, begin, end in spans]
