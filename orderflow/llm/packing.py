"""Lexical retrieval packing: documents fill token sequences together with their BM25 neighbours."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import chunks, hashed_words, mixed, text_bytes, written

#: Words whose ids a worker remembers before it starts anew.
_REMEMBERED = 1_500_000
#: Bytes of text whose words are looked up together.
_BYTES_AT_ONCE = 1_000_000
#: A token that at least one of so many documents of a shard holds has a row of weights of its own.
_FREQUENT = 16
#: Neighbours looked at together when a window is filled.
_AT_ONCE = 32
_K1, _B = 1.2, 0.75

_TOKENS = "doc_id long, ids binary, lead long, tokens array<long>, holders array<long>, led array<long>"
_PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def _tokenizer(saved: str):
    """The tokenizer that a file's text describes."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(saved)


_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[0x41:0x5B] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b".,;:!?*$%")] = True
#: Bytes after which a letter stands alone: ASCII, and the first byte of Latin-1 letters.
_NO_ACCENT = np.zeros(256, bool)
_NO_ACCENT[[*range(0x80), 0xC3]] = True


def _simpler(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with capitals made small, and where marks that follow a letter begin.

    For tokenizers that ignore case and part letters from marks: fewer different words, same
    ids. A letter that a combining accent may follow stays as it is, for not all of them have
    both cases with that accent; and so does all where a special token may be spelt out.
    """
    if b"<|" in data.tobytes():
        return data, np.zeros(0, np.int64)
    alone = np.ones(len(data), bool)
    alone[:-1] = _NO_ACCENT[data[1:]]
    small = data + ((_IS_CAPITAL[data] & alone) * np.uint8(0x20))
    return small, np.flatnonzero(_IS_LETTER[data[:-1]] & _IS_MARK[data[1:]]) + 1


def _ignores_case(tokenizer) -> bool:
    """Whether capitals and marks after a letter make no difference, on a probe of all of them."""
    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    letters = "".join(map(chr, np.flatnonzero(_IS_CAPITAL)))
    marks = [chr(m) for m in np.flatnonzero(_IS_MARK)]
    return all(ids(a + b) == ids(a.lower() + b) for a in letters for b in ("", "the", "\u00e9")) and all(
        ids(a + m + b) == ids(a) + ids(m + b) for a in letters for m in marks for b in ("", "s", m, "1", "\u00e9")
    )


class WordIds:
    """Token ids of texts, put together from remembered ids of their words.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of
    its words in order. Words are known by a 64-bit hash. If the tokenizer ignores case and parts
    letters from marks, so do the remembered words.
    """

    def __init__(self, saved: str, dtype: str):
        self._tokenizer, self._dtype = _tokenizer(saved), dtype
        self._simplify = _ignores_case(self._tokenizer)
        # By hash: when a word was last met, and where its ids are among all.
        self._hashes = np.zeros(0, np.uint64)
        self._met = np.zeros(0, np.int64)
        self._begins, self._ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, self._dtype)
        self._round = 0

    def _forget(self) -> None:
        """Drop the half of the words that were met longest ago."""
        kept = self._met >= np.median(self._met)
        self._hashes, self._met = self._hashes[kept], self._met[kept]
        sizes = (self._ends - self._begins)[kept]
        ends = np.cumsum(sizes)
        self._ids = self._ids[np.arange(sizes.sum()) + np.repeat(self._begins[kept] - (ends - sizes), sizes)]
        self._begins, self._ends = ends - sizes, ends

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        joined = self._tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        ids = np.asarray(joined.ids, dtype=self._dtype)
        at = np.fromiter((start for start, _ in joined.offsets), np.int64, len(ids))
        stops = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        ends = np.searchsorted(at, stops) + len(self._ids)
        begins = np.concatenate(([len(self._ids)], ends[:-1]))
        self._ids = np.concatenate((self._ids, ids))
        place = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, place, hashes)
        self._met = np.insert(self._met, place, self._round)
        self._begins, self._ends = np.insert(self._begins, place, begins), np.insert(self._ends, place, ends)

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text, the end id last."""
        data, bounds = text_bytes(texts)
        for first, last in chunks(bounds, _BYTES_AT_ONCE):
            yield from self._encode(
                data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], end_id
            )

    def _encode(self, data: np.ndarray, bounds: np.ndarray, end_id: int) -> Iterator[np.ndarray]:
        data, cuts = _simpler(data) if self._simplify else (data, None)
        hashes, starts, ends, counts = hashed_words(data, bounds, cuts)
        order = np.argsort(hashes)
        ordered = hashes[order]
        change = np.ones(len(hashes), bool)
        change[1:] = ordered[1:] != ordered[:-1]
        distinct, example = ordered[change], order[change]
        self._round += 1
        if len(self._hashes) + len(distinct) > _REMEMBERED and len(self._hashes):
            self._forget()
        at = np.searchsorted(self._hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self._hashes)
        known[inside] = self._hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            text = data.tobytes()
            spans = zip(starts[example[new]].tolist(), ends[example[new]].tolist(), strict=True)
            self._learn(distinct[new], [text[start:end].decode() for start, end in spans])
            at = np.searchsorted(self._hashes, distinct)
        self._met[at] = self._round
        slots = np.empty(len(hashes), np.int64)
        slots[order] = at[np.cumsum(change) - 1]
        sizes = (self._ends - self._begins)[slots]
        through = np.concatenate(([0], np.cumsum(sizes)))
        ids = self._ids[np.arange(through[-1]) + np.repeat(self._begins[slots] - through[:-1], sizes)]
        text_ends = through[np.cumsum(counts)]
        ids = np.insert(ids, text_ends, end_id)
        return iter(np.split(ids, (text_ends + np.arange(1, len(counts) + 1))[:-1]))


def _distinct(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a document and how often each occurs; ``place`` is scratch, one per token."""
    order = np.arange(len(ids))
    place[ids] = order
    stands_for = place[ids]
    last = stands_for == order
    return ids[last], np.bincount(stands_for, minlength=len(ids))[last]


def tokenized(docs: DataFrame, saved: str, vocabulary: int, end_id: int) -> DataFrame:
    """Every document's ids with the end id, and its lead; stored, with the sums of each task.

    The lead is the document's highest token: merges are numbered by how common they were, so
    the highest is about the rarest. A row holds either a document (doc_id, ids, lead) or what
    one task counted (tokens, in how many documents, and ids of documents that each leads).
    """
    dtype = _dtype(vocabulary)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.binary()), ("lead", pa.int64()), ("tokens", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64())), ("led", pa.list_(pa.int64()))]
    )

    # A worker that runs several tasks keeps the words it knows: it holds a broadcast value once.
    kept = docs.sparkSession.sparkContext.broadcast({"tokenizer": saved})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept.value.get("words") or WordIds(kept.value["tokenizer"], dtype)
        kept.value["words"] = words
        place = np.zeros(vocabulary, np.int64)
        holders, led = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        for batch in batches:
            all_ids, leads = [], []
            for ids in words.encode(batch.column(1), end_id):
                holders[_distinct(ids, place)[0]] += 1
                leads.append(int(ids.max()))
                led[leads[-1]] += len(ids)
                all_ids.append(ids.tobytes())
            columns = [batch.column(0), pa.array(all_ids, pa.binary()), pa.array(leads, pa.int64())]
            columns += [pa.nulls(len(all_ids), schema.field(k).type) for k in (3, 4, 5)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        used = np.flatnonzero(holders)
        yield pa.RecordBatch.from_pylist(
            [{"tokens": used.tolist(), "holders": holders[used].tolist(), "led": led[used].tolist()}], schema=schema
        )

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(plain.mapInArrow(encode, _TOKENS), "pack-tokens")


def _dtype(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _by_token(rows: DataFrame, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Holders and led ids per token: no more numbers than the vocabulary has tokens."""
    holders, led = np.zeros(vocabulary), np.zeros(vocabulary)
    each = rows.select(F.explode(F.arrays_zip("tokens", "holders", "led")).alias("t")).select("t.*")
    sums = each.groupBy("tokens").agg(F.sum("holders").alias("holders"), F.sum("led").alias("led"))
    for row in sums.toLocalIterator():
        holders[row.tokens], led[row.tokens] = row.holders, row.led
    return holders, led


def _idf(holders: np.ndarray, documents: float) -> np.ndarray:
    return np.log1p((documents - holders + 0.5) / (holders + 0.5))


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, shard_tokens: int = 1_000_000
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens, related texts together.

    Returns one row per piece: doc_id, start (the document's ids before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset in that sequence.

    Documents are dealt to shards of about ``shard_tokens`` tokens by their lead, their rarest
    token; a lead that many share is spread over as many shards as its documents need. Token
    statistics come from all documents; the driver holds two numbers per token of the vocabulary. In its shard, a document not yet used opens a window as its seed.
    All its tokens are looked up in the shard's inverted index, and its unused
    neighbours by BM25 fill the window in order, those first that fit whole; then the best one is
    cut and goes on in the next window. A shard's last, partly filled window is dealt to sequences
    whose lengths are powers of two, so none needs padding.

    Null or empty texts are documents of the end id alone. Repeated rows are packed once each. A
    text of any length is cut over as many sequences as it needs. No documents give no rows. Only
    doc_id and text are read. The tokenizer file lies on the driver alone.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        saved = file.read()
    vocabulary = _tokenizer(saved).get_vocab_size()
    dtype = _dtype(vocabulary)
    rows = tokenized(docs, saved, vocabulary, end_id)
    holders, led = _by_token(rows.filter("ids IS NULL").select("tokens", "holders", "led"), vocabulary)
    idf = _idf(holders, float(holders[end_id]))
    begins = np.concatenate(([0.0], np.cumsum(led)[:-1]))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = TaskContext.get().partitionId() << 40
        for batch in batches:
            leads = batch.column(2).to_numpy()
            part = mixed(np.arange(seen, seen + len(leads))) / float(1 << 64)
            seen += len(leads)
            shard = ((begins[leads] + part * led[leads]) // shard_tokens).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=["doc_id", "ids", "lead", "shard"])

    def packed(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["lead", "doc_id"], kind="stable")
        ids = [np.frombuffer(own, dtype) for own in shard["ids"]]
        pieces = fill(ids, idf, window)
        # Sequence numbers of a shard start at a place of their own.
        return _piece_rows(shard["doc_id"].array, ids, pieces, int(key[0]) << 32)

    return (
        rows.filter("ids IS NOT NULL")
        .select("doc_id", "ids", "lead")
        .mapInArrow(dealt, "doc_id long, ids binary, lead long, shard long")
        .groupBy("shard")
        .applyInPandas(packed, _PIECES)
    )


def _piece_rows(doc_ids, ids: list[np.ndarray], pieces: list[tuple], first: int) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc_id": pd.array([doc_ids[d] for d, *_ in pieces], dtype="Int64"),
            "start": [start for _, start, _, _, _ in pieces],
            "length": [length for _, _, length, _, _ in pieces],
            "ids": [ids[d][start : start + length].astype("<u4").tobytes() for d, start, length, _, _ in pieces],
            "doc_tokens": [len(ids[d]) for d, *_ in pieces],
            "sequence_id": [first + number for _, _, _, number, _ in pieces],
            "offset": [offset for _, _, _, _, offset in pieces],
        }
    )


class Index:
    """BM25 over the documents of one shard, with the statistics of all documents."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray):
        place = np.zeros(len(idf), np.int64)
        found = [_distinct(own, place) for own in ids]
        sizes = np.array([len(tokens) for tokens, _ in found])
        tokens = np.concatenate([tokens for tokens, _ in found])
        counts = np.concatenate([counts for _, counts in found]).astype(np.float64)
        docs = np.repeat(np.arange(len(ids)), sizes)
        lengths = np.array([len(own) for own in ids], np.float64)
        relative = (1 - _B + _B * lengths / lengths.mean())[docs]
        weights = idf[tokens] * counts * (_K1 + 1) / (counts + _K1 * relative)
        self._begins = np.concatenate(([0], np.cumsum(sizes)))
        self._tokens = tokens
        order = np.argsort(tokens, kind="stable")
        self._held_by, self._held_weight = docs[order], weights[order]
        self._lists = np.searchsorted(tokens[order], np.arange(len(idf) + 1))
        self._documents, self._lengths = len(ids), lengths
        # Frequent tokens as rows over all documents: at most _FREQUENT numbers for each posting.
        frequent = np.flatnonzero(np.diff(self._lists) * _FREQUENT >= len(ids))
        self._row = np.full(len(idf), -1)
        self._row[frequent] = np.arange(len(frequent))
        self._rows = np.zeros((len(frequent), len(ids)), np.float32)
        inside = self._row[tokens] >= 0
        self._rows[self._row[tokens[inside]], docs[inside]] = weights[inside]

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for all tokens of this one."""
        tokens = self._tokens[self._begins[doc] : self._begins[doc + 1]]
        row = self._row[tokens]
        found = self._rows[row[row >= 0]].sum(axis=0).astype(np.float64)
        rare = tokens[row < 0]
        begins, counts = self._lists[rare], self._lists[rare + 1] - self._lists[rare]
        ends = np.cumsum(counts)
        at = np.arange(counts.sum()) + np.repeat(begins - (ends - counts), counts)
        return found + np.bincount(self._held_by[at], self._held_weight[at], self._documents)

    def neighbours(self, doc: int, unused: np.ndarray, room: Callable[[], int]) -> Iterator[int]:
        """Unused documents by BM25, the nearest first; later on only those that still fit whole."""
        scores = self.scores(doc)
        near = np.flatnonzero((scores > 0) & unused)
        take = _AT_ONCE
        while len(near):
            best, rest = near, near[:0]
            if len(near) > take:
                parted = np.argpartition(-scores[near], take)
                best, rest = near[parted[:take]], near[parted[take:]]
            yield from best[np.lexsort((best, -scores[best]))].tolist()
            near = rest[self._lengths[rest] <= room()]
            take *= 4


def fill(ids: list[np.ndarray], idf: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of one shard."""
    index = Index(ids, idf)
    unused = np.ones(len(ids), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, used = 0, 0

    def place(doc: int, start: int) -> None:
        """The document from start on, over as many windows as it needs."""
        nonlocal sequence, used
        while start < len(ids[doc]):
            length = min(window - used, len(ids[doc]) - start)
            pieces.append((doc, start, length, sequence, used))
            start, used = start + length, used + length
            if used == window:
                sequence, used = sequence + 1, 0

    later = 0
    seed = None
    while True:
        if seed is None:
            while later < len(ids) and not unused[later]:
                later += 1
            if later == len(ids):
                break
            seed = later
            unused[seed] = False
            place(seed, 0)
        cut = None
        if used:
            for near in index.neighbours(seed, unused, lambda: window - used):
                if len(ids[near]) <= window - used:
                    unused[near] = False
                    place(near, 0)
                    if not used:
                        break
                elif cut is None:
                    cut = near
        seed = None
        if used and cut is not None:
            # The best one that did not fit is cut, and seeds the window it goes on in.
            unused[cut] = False
            place(cut, 0)
            seed = cut
    return _powers(pieces, sequence, used)


def _powers(pieces: list[tuple], last: int, used: int) -> list[tuple]:
    """Deal what the last window holds to sequences as long as powers of two."""
    bounds, at = [], 0
    for bit in reversed(range(used.bit_length())):
        if used >> bit & 1:
            bounds.append((at, at + (1 << bit)))
            at += 1 << bit
    done = [p for p in pieces if p[3] != last]
    for doc, start, length, sequence, offset in pieces[len(done) :]:
        for k, (low, high) in enumerate(bounds):
            begin, end = max(low, offset), min(high, offset + length)
            if begin < end:
                done.append((doc, start + begin - offset, end - begin, sequence + k, begin - low))
    return done
