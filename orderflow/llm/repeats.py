"""Long byte strings that occur more than once, by an enhanced suffix array over sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import discard, mixed, text_bytes, written
from orderflow.session import small_batches

#: Bytes of a string that counts as repeated.
SPAN = 200
#: Bytes of a string that is hashed to choose where suffixes are sampled.
GRAM = 100
#: Positions of which one is sampled at least, so that every string of SPAN bytes holds a sample.
_CHOICE = SPAN - GRAM + 1
#: Bytes at most before a sample, and from it on, in a string of SPAN bytes that holds it.
_LEFT, _RIGHT = SPAN - GRAM, SPAN
#: Bytes of a long text that are hashed at once.
_PIECE = 1 << 18
#: Contexts of one gram that a task sorts; those of more are counted string by string instead.
HOT = 256
#: Contexts that a task holds at once, whole grams only.
_HELD = 20_000

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

SAMPLE = "k1 long, k2 long, gram long, around long, pos long"
_CONTEXT = "k1 long, k2 long, gram long, around long, pos long, n long, before binary, after binary"
SPANS = "k1 long, k2 long, begin long, end long"


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    size = _PIECE + 4 * SPAN
    with np.errstate(over="ignore"):
        ups = np.full(size, np.uint64(_BASE))
        downs = np.full(size, np.uint64(pow(_BASE, -1, 1 << 64)))
        ups[0] = downs[0] = 1
        return np.cumprod(ups), np.cumprod(downs)


def _extreme(values: np.ndarray, size: int, pick) -> np.ndarray:
    """The least or greatest of each ``size`` neighbours, by doubling."""
    width = 1
    while 2 * width <= size:
        values = pick(values[:-width], values[width:])
        width *= 2
    if width < size:
        values = pick(values[: len(values) - (size - width)], values[size - width :])
    return values


def samples(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pos, gram, around) of the sampled positions of a text of SPAN bytes or more.

    Hashes of all grams are compared; the least of each ``_CHOICE`` neighbours is sampled, all of
    them if several are equal. The choice depends on the bytes alone, so equal strings of SPAN
    bytes are sampled at the same places. ``around`` is a hash of up to 100 bytes before the
    sample and 200 from it on, all that a string of SPAN bytes that holds the gram can reach.
    """
    found = []
    ups, downs = _powers()
    n = len(data)
    for begin in range(0, n, _PIECE):
        low, high = max(0, begin - _CHOICE), min(n, begin + _PIECE + _CHOICE + SPAN)
        if high - low < SPAN:
            continue
        with np.errstate(over="ignore"):
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * ups[: high - low], out=sums[1:])
            count = high - low - GRAM + 1
            grams = mixed((sums[GRAM:] - sums[:-GRAM]) * downs[:count])
            least = _extreme(grams, _CHOICE, np.minimum)
            edge = np.zeros(_CHOICE - 1, np.uint64)
            # A gram is sampled if the greatest least of the windows that hold it is its own hash.
            pos = np.flatnonzero(_extreme(np.concatenate((edge, least, edge)), _CHOICE, np.maximum) == grams)
            pos = pos[(pos + low >= begin) & (pos + low < begin + _PIECE)]
            start = np.maximum(pos - _LEFT, 0)
            stop = np.minimum(pos + _RIGHT, high - low)
            shape = ((pos - start) * (SPAN + 1) + (stop - pos)).astype(np.uint64)
            around = mixed((sums[stop] - sums[start]) * downs[start] + mixed(shape))
        found.append((pos + low, grams[pos].view(np.int64), around.view(np.int64)))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _sampled(texts: DataFrame) -> DataFrame:
    """Samples of texts (k1, k2, text)."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            found, held, rows = [], [], 0
            for k in range(len(bounds) - 1):
                pos, gram, around = samples(data[bounds[k] : bounds[k + 1]])
                found.append((np.full(len(pos), k), gram, around, pos))
                rows += len(pos)
                if rows > 100_000:
                    held, found, rows = found, [], 0
                    yield made(batch, held)
            if found:
                yield made(batch, found)

    def made(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        row, gram, around, pos = (np.concatenate(part) for part in zip(*found, strict=True))
        texts = pa.array(row)
        columns = [batch.column(0).take(texts), batch.column(1).take(texts), pa.array(gram), pa.array(around), pa.array(pos)]
        return pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "gram", "around", "pos"])

    return texts.mapInArrow(sample, SAMPLE)


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around the samples wanted (gram, around, n, k1, k2, pos), from their texts."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "around", "pos", "n")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            lists = batch.column(3)
            firsts, fields = lists.offsets.to_numpy(), lists.values
            gram, around, pos, n = (fields.field(name) for name in ("gram", "around", "pos", "n"))
            places = pos.to_numpy()
            out, index, of = [], [], []
            for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key in seen:  # a copy of a text that was cut already
                    continue
                seen.add(key)
                text = data[bounds[k] : bounds[k + 1]].tobytes()
                for j in range(firsts[k], firsts[k + 1]):
                    p = int(places[j])
                    out.append((text[max(p - _LEFT, 0) : p], text[p : p + _RIGHT]))
                    index.append(j)
                    of.append(k)
                if len(out) > _HELD:
                    yield frame(batch, gram, around, pos, n, out, index, of)
                    out, index, of = [], [], []
            if out:
                yield frame(batch, gram, around, pos, n, out, index, of)

    def frame(batch, gram, around, pos, n, out, index, of) -> pa.RecordBatch:
        at, row = pa.array(index, pa.int64()), pa.array(of, pa.int64())
        before, after = zip(*out, strict=True)
        columns = [batch.column(0).take(row), batch.column(1).take(row), gram.take(at), around.take(at), pos.take(at), n.take(at)]
        columns += [pa.array(before, pa.binary()), pa.array(after, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _CONTEXT.split(", ")])

    return texts.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "wanted").mapInArrow(cut, _CONTEXT)


def _shared(a: bytes, b: bytes) -> int:
    """Bytes that two strings share from the begin on."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low = 0
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common, first, last) of the nodes of the common-prefix interval tree, children first.

    ``lcp[k]`` is what entry k shares with the entry before it (``lcp[0]`` is not read). One scan
    with a stack of the open intervals: a smaller value closes those that shared more.
    """
    stack = [(0, 0)]
    for k in range(1, len(lcp) + 1):
        now = lcp[k] if k < len(lcp) else -1
        first = k - 1
        while stack and now < stack[-1][0]:
            common, first = stack.pop()
            yield common, first, k - 1
        if now >= 0 and (not stack or now > stack[-1][0]):
            stack.append((now, first))


def maximal_repeats(contexts: list[tuple[bytes, bytes]], least: int = SPAN) -> Iterator[tuple[int, int, list[int]]]:
    """(before, after, members): the maximal repeats of ``least`` bytes or more through one sample.

    ``contexts`` holds for each occurrence the bytes before the sample, reversed, and those from
    it on; no two are equal. The occurrences are sorted by what follows (the suffix array); each
    interval of the tree over their common prefixes is a set that shares ``after`` bytes and
    differs behind them. Its members, sorted by what lies before them, are scanned in the same
    way: an interval there is a set whose left extensions differ after ``before`` bytes. Those
    whose members lie in one child interval share more than ``after`` bytes and come from there.
    Every occurrence of a repeat is in ``members``, not only sorted neighbours.
    """
    order = sorted(range(len(contexts)), key=lambda k: contexts[k][1])
    lcp = [0] + [_shared(contexts[a][1], contexts[b][1]) for a, b in zip(order, order[1:], strict=False)]
    for after, first, last in intervals(lcp):
        if after + _LEFT < least:
            continue
        inside = sorted(range(first, last + 1), key=lambda k: contexts[order[k]][0])
        left = [0] + [
            _shared(contexts[order[a]][0], contexts[order[b]][0]) for a, b in zip(inside, inside[1:], strict=False)
        ]
        if max(left) + after < least:
            continue
        for before, low, high in intervals(left):
            if before + after < least or low == high:
                continue
            ranks = inside[low : high + 1]
            if min(lcp[min(ranks) + 1 : max(ranks) + 1]) == after:
                yield before, after, [order[k] for k in ranks]


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of contexts that occur once and share SPAN bytes with another; rows come sorted by gram."""

    def found(held: list[dict]) -> pa.RecordBatch:
        out: list[tuple[int, int, int, int]] = []
        begin = 0
        for end in range(1, len(held) + 1):
            if end < len(held) and held[end]["gram"] == held[begin]["gram"]:
                continue
            rows = list({row["around"]: row for row in held[begin:end]}.values())
            begin = end
            # All repeats through one sample hold its gram, so together they cover one run.
            most_before, most_after = [0] * len(rows), [0] * len(rows)
            for before, after, members in maximal_repeats([(row["before"][::-1], row["after"]) for row in rows]):
                for k in members:
                    most_before[k] = max(most_before[k], before)
                    most_after[k] = max(most_after[k], after)
            for row, before, after in zip(rows, most_before, most_after, strict=True):
                if after and row["n"] == 1:
                    out.append((row["k1"], row["k2"], row["pos"] - before, row["pos"] + after))
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "begin", "end"])

    held: list[dict] = []
    for batch in batches:
        held += batch.to_pylist()
        if len(held) > _HELD:
            last = held[-1]["gram"]
            rest = [row for row in held if row["gram"] == last]
            yield found(held[: len(held) - len(rest)])
            held = rest
    yield found(held)


_REACH = _CONTEXT + ", most_before long"
#: A string's ``times`` in one chunk of contexts; its place if it is the only one there and looks for others.
_STRING = "gram long, before long, string long, times long, k1 long, k2 long, begin long, end long"


def _most_shared(strings: list[bytes], grams: list[int]) -> list[int]:
    """What each of the sorted strings shares at most with a neighbour of its gram; all for the first and last."""
    pairs = zip(zip(strings, grams, strict=True), zip(strings[1:], grams[1:], strict=True), strict=False)
    beside = [_shared(a, b) if g == h else 0 for (a, g), (b, h) in pairs]
    most = [max(x, y) for x, y in zip([0, *beside], [*beside, 0], strict=True)]
    for k in (0, -1):
        most[k] = len(strings[k])
    return most


def _reach_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        most = _most_shared([b[::-1] for b in batch.column("before").to_pylist()], batch.column("gram").to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(most, pa.int64())], names=[*batch.schema.names, "most_before"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of SPAN bytes of each context that another may share; rows come sorted by gram and what follows.

    Each distinct string is given once a batch, with its number. A context whose strings occur
    more often in the batch gets its span at once; a string alone in it is given with its place.
    """
    names = [field.split()[0] for field in _STRING.split(", ")]
    ups, downs = _powers()
    width = _LEFT + _RIGHT
    for batch in batches:
        for first in range(0, len(batch), 4_000):
            part = batch.slice(first, 4_000)
            before, after = part.column("before").to_pylist(), part.column("after").to_pylist()
            gram, n, pos, k1, k2 = (part.column(c).to_numpy() for c in ("gram", "n", "pos", "k1", "k2"))
            most = np.array(_most_shared(after, gram.tolist()))
            rows = b"".join(b.rjust(_LEFT, b"\0") + a.ljust(_RIGHT, b"\0") for b, a in zip(before, after, strict=True))
            data = np.frombuffer(rows, np.uint8).reshape(-1, width)
            low = SPAN - most
            high = np.minimum(part.column("most_before").to_numpy(), [len(b) for b in before])
            place = np.arange(_LEFT + 1)
            row, own = np.nonzero((place >= low[:, None]) & (place <= high[:, None]))
            with np.errstate(over="ignore"):
                sums = np.zeros((len(data), width + 1), np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ups[:width], axis=1, out=sums[:, 1:])
                start = _LEFT - own
                string = mixed((sums[row, start + SPAN] - sums[row, start]) * downs[start])
                same = mixed(string + mixed(gram[row].view(np.uint64) + own.astype(np.uint64)))
            _, one, index = np.unique(same, return_index=True, return_inverse=True)
            times = np.bincount(index, n[row], len(one)).astype(np.int64)
            alone = (times == 1)[index]
            # Distinct strings that occur more often here.
            several = one[times > 1]
            nothing = np.zeros(len(several), bool)
            yield _string_rows(names, gram, own, string, k1, k2, pos, row, several, times[times > 1], nothing)
            # Strings alone here, with their place.
            single = np.flatnonzero(alone)
            yield _string_rows(names, gram, own, string, k1, k2, pos, row, single, np.ones(len(single), np.int64), np.ones(len(single), bool))
            # What is covered already, as runs of strings that begin next to each other.
            known = np.flatnonzero(~alone & (n[row] == 1))
            if len(known):
                cut = np.flatnonzero((row[known[1:]] != row[known[:-1]]) | (own[known[1:]] != own[known[:-1]] + 1)) + 1
                least, most_ = known[np.append(0, cut)], known[np.append(cut, len(known)) - 1]
                of = row[least]
                none = pa.nulls(len(of), pa.int64())
                columns = [none, none, none, none, pa.array(k1[of]), pa.array(k2[of])]
                columns += [pa.array(pos[of] - own[most_]), pa.array(pos[of] - own[least] + SPAN)]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _string_rows(names, gram, own, string, k1, k2, pos, row, which, times, placed) -> pa.RecordBatch:
    of = row[which]
    begin = pos[of] - own[which]
    columns = [pa.array(gram[of]), pa.array(own[which]), pa.array(string[which].view(np.int64)), pa.array(times)]
    columns += [pa.array(c, mask=~placed) for c in (k1[of], k2[of], begin, begin + SPAN)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _counted(contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, begin, end): the spans of contexts of hot grams, whose strings are counted; and the stored strings.

    Sorted over all tasks by what lies before the sample, and then by what follows it, a context
    shares most with a neighbour; strings that reach further on either side are its own alone.
    Only the others are counted, combined by batch and by task. The first and last row of a batch
    do not know a neighbour and count all.
    """
    columns = [field.split()[0] for field in _CONTEXT.split(", ")]
    once = contexts.dropDuplicates(["gram", "around"]).select(*columns, F.reverse(F.hex("before")).alias("backwards"))
    backwards = once.repartitionByRange("gram", "backwards").sortWithinPartitions("gram", "backwards").select(columns)
    reach = written(backwards.mapInArrow(_reach_before, _REACH), "reach")
    forwards = reach.repartitionByRange("gram", "after", "before").sortWithinPartitions("gram", "after", "before")
    strings = written(forwards.mapInArrow(_strings, _STRING), "strings")
    discard(reach)
    string = ["gram", "before", "string"]
    often = strings.filter("times IS NOT NULL").groupBy(string).agg(F.sum("times").alias("all"), F.count("*").alias("rows"))
    # Strings that occur more often in one batch alone need no second look.
    often = often.filter("all > 1 AND rows > 1").select(string)
    place = ["k1", "k2", "begin", "end"]
    found = strings.filter("times = 1 AND begin IS NOT NULL").join(often, string).select(place)
    return strings.filter("times IS NULL").select(place).unionByName(found), strings


def repeated_spans(texts: DataFrame, copied: DataFrame) -> DataFrame:
    """(k1, k2, spans): bytes of texts (k1, k2, text) that lie in a string of SPAN bytes found elsewhere.

    Texts are sampled so that equal strings of SPAN bytes are sampled at the same places. Grams
    sampled once are dropped. Samples whose whole context is found twice are covered by it. Of the
    other contexts of a gram, those that occur once look for partners: sorted by what follows the
    sample they are an enhanced suffix array, whose interval tree gives the maximal repeats
    with all their occurrences. A gram with more than HOT contexts (a line that very many texts
    hold) is not gathered: its contexts are sorted over all tasks, and those strings of SPAN bytes
    that sorted neighbours may share are counted by hash, which gives the same bytes. Joins on grams and texts may be split where one is hot.

    Copies of a text may be left in or out; a row is one occurrence. Texts in ``copied`` (k1, k2)
    get no row. Every file stored costs an executor some short-lived processes where the shared
    folder is a local path, so what is read once is not stored, and small tables are merged first.
    """
    grams = _sampled(texts).groupBy("gram").agg(
        F.count("*").alias("n"), F.min("around").alias("low"), F.max("around").alias("high")
    )
    grams = grams.filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("differ"))
    grams = written(grams.hint("rebalance", "gram"), "grams")
    hits = written(_sampled(texts).join(grams, "gram"), "hits")
    discard(grams)
    place = F.struct("k1", "k2", "pos")
    kinds = written(
        hits.filter("differ").groupBy("gram", "around").agg(F.count("*").alias("n"), F.min(place).alias("one"))
        .select("gram", "around", "n", "one.*"),
        "kinds",
    )
    again = kinds.filter("n > 1").select("gram", "around")
    whole = hits.filter("NOT differ").unionByName(hits.filter("differ").join(again, ["gram", "around"]))
    whole = whole.select("k1", "k2", F.greatest(F.col("pos") - _LEFT, F.lit(0)).alias("begin"), (F.col("pos") + _RIGHT).alias("end"))
    whole = written(_runs(whole), "whole")
    discard(hits)

    contexts = written(_contexts(texts, kinds), "contexts")
    hot = written(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter(F.col("kinds") > HOT).select("gram"), "hot-grams")
    by_gram = contexts.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    partly = by_gram.mapInArrow(_covered, SPANS)
    counted, strings = _counted(contexts.join(hot, "gram", "left_semi"))
    runs = whole.unionByName(_runs(partly.unionByName(counted)))
    runs = runs.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = written(runs.join(copied, ["k1", "k2"], "left_anti"), "spans")
    for table in (whole, kinds, contexts, hot, strings):
        discard(table)
    return spans


def _runs(spans: DataFrame) -> DataFrame:
    """One row a text: its distinct spans."""
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


RESULT = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary, removed array<struct<begin:long,end:long>>"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = text_bytes(batch.column(2))
        out = []
        for k, spans in enumerate(batch.column(3).to_pylist()):
            text = data[bounds[k] : bounds[k + 1]].tobytes()
            runs: list[list[int]] = []
            for begin, end in sorted((s["begin"], s["end"]) for s in spans):
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([begin, end])
            runs = [[a, min(b, len(text))] for a, b in runs]
            kept = b"".join(text[a:b] for a, b in zip([0] + [r[1] for r in runs], [r[0] for r in runs] + [len(text)], strict=True))
            out.append((len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, [{"begin": a, "end": b} for a, b in runs]))
        removed, n_spans, digest, kept, runs = zip(*out, strict=True) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                pa.array(digest, pa.string()), pa.array(kept, pa.binary()),
                pa.array(runs, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            ],
            names=[field.split()[0] for field in RESULT.split(", ")[:6]] + ["removed"],
        )


def without_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, removed) for every row of ``docs``.

    Removed is every byte covered by a string of SPAN bytes of UTF-8 that also starts anywhere
    else, in the same text or another; overlaps count, and strings are judged on the input. No
    string reaches over the end of a text. ``kept`` holds the bytes that stay, ``removed`` the maximal
    runs that go; both are left out unless ``with_kept``, and null where the whole text stays.

    Null texts are empty. Texts that occur twice lose all their bytes if they have SPAN bytes, so
    repeated rows, a null doc_id and two texts of one doc_id need no rule. Long texts are hashed a
    piece at a time. No rows give no rows. Only doc_id and text are read. Texts stand for
    themselves by 128 bits of hash, strings by the same.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = F.octet_length("text").cast("long")
    rows = plain.select("doc_id", *_keys(F.col("text")), size.alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    texts = plain.filter(size >= SPAN).select(*_keys(F.col("text")), "text")
    with small_batches(docs.sparkSession):
        copied = written(
            rows.filter(F.col("n_bytes") >= SPAN).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.first("n_bytes").alias("n_bytes"))
            .filter("n > 1"),
            "copied",
        )
        spans = repeated_spans(texts, copied)
        cut = texts.join(spans, ["k1", "k2"]).select("k1", "k2", "text", "spans").mapInArrow(_cut_out, RESULT)
        wanted = ["k1", "k2", "n_removed", "n_spans", "kept_sha256"] + (["kept", "removed"] if with_kept else [])
        empty = copied.select(
            "k1", "k2", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            F.sha2(F.lit(""), 256).alias("kept_sha256"), F.lit(b"").alias("kept"),
            F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end"))).alias("removed"),
        )
        verdicts = written(cut.select(wanted).unionByName(empty.select(wanted)).hint("rebalance", "k1", "k2"), "verdicts")
    return rows.join(verdicts, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        *wanted[5:],
    )
