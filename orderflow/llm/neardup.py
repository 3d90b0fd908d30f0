"""Near-duplicate documents by BagMinHash signatures of their shingles and verified overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import chunks, discard, hashed_words, mixed, text_bytes, written
from orderflow.llm.graph import components, joined

SHINGLE = 5
SLOTS = 128
BAND_ROWS = 5
BANDS = 25
_BYTES_AT_ONCE = 1_000_000
#: Rows of a block when members of a group are compared with all of it.
_BLOCK = 512
#: Overlap from which documents belong to one group whose members are compared with each other.
_SAME_GROUP = 0.4
#: Slots that differ by chance: an overlap is looked up if its estimate is at most this much short.
_ESTIMATE_SLACK = 0.16

_ODD = mixed(np.arange(1, 65)) | np.uint64(1)


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each run of five words, its text, and two hashes of each text's words in order.

    A text of fewer words is one shingle; a text without words has none, and hashes 0.
    """
    hashes, _, _, counts = hashed_words(data, bounds)
    begins = np.cumsum(counts) - counts
    texts = np.repeat(np.arange(len(counts)), counts)
    keys = np.zeros((2, len(counts)), np.uint64)
    some = np.flatnonzero(counts)
    with np.errstate(over="ignore"):
        if len(some):
            place = (np.arange(len(hashes)) - begins[texts]).astype(np.uint64)
            for k in range(2):
                keys[k, some] = mixed(np.add.reduceat(hashes * (mixed(place + np.uint64(k << 40)) | np.uint64(1)), begins[some]))
        in_text = np.arange(len(hashes)) - begins[texts]
        full = np.flatnonzero(in_text <= counts[texts] - SHINGLE)
        made = np.zeros(len(full), np.uint64)
        for k in range(SHINGLE):
            made += hashes[full + k] * _ODD[k]
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    return (
        np.concatenate((mixed(made), keys[1, short])),
        np.concatenate((texts[full], short)),
        keys[0],
        keys[1],
    )


def bags(made: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by text with their number, and a hash of every repeat with its text."""
    with np.errstate(over="ignore"):
        both = mixed(made + texts.astype(np.uint64) * _ODD[10])
        order = np.argsort(both)
        both, made, texts = both[order], made[order], texts[order]
        first = np.ones(len(both), bool)
        first[1:] = both[1:] != both[:-1]
        starts = np.flatnonzero(first)
        weights = np.diff(np.append(starts, len(both)))
        repeat = np.arange(len(both)) - np.repeat(starts, weights)
        return made[first], texts[first], weights, mixed(made + repeat.astype(np.uint64) * _ODD[11])


def signatures(made: np.ndarray, texts: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """BagMinHash: per text and slot the first point of its shingles' Poisson processes.

    A shingle's weights are cut into the ranges [0, 1), [1, 2), [2, 4), [4, 8) and so on. In each
    range, points arrive at a rate of its length for every slot, each with a place in the range
    and a slot, all from the shingle's hash. Those at a place below the text's weight count, so a
    text of twice the weight sees the points of the lighter one and as many more. Two texts agree
    in a slot with the probability of their weighted Jaccard similarity. Points come in order of
    time, and a text stops once every slot has one.
    """
    out = np.full(count * SLOTS, np.inf)
    total = np.bincount(texts, weights, count)
    horizon = (np.log(SLOTS) + 2.0) / np.maximum(total, 1)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        active = np.zeros(count, bool)
        active[todo] = True
        chosen = active[texts]
        _points(out, made[chosen], texts[chosen], weights[chosen], horizon)
        filled = np.isfinite(out.reshape(count, SLOTS)).all(axis=1)
        todo = todo[~filled[todo]]
        horizon[todo] *= 2
    return out.reshape(count, SLOTS)


def _points(out: np.ndarray, made: np.ndarray, texts: np.ndarray, weights: np.ndarray, horizon: np.ndarray) -> None:
    low, high, level = 0, 1, 0
    while len(made):
        rate = SLOTS * (high - low)
        hashes, own, limit, until = made, texts, weights, horizon[texts]
        time, number = np.zeros(len(made)), 0
        while len(hashes):
            with np.errstate(over="ignore"):
                draw = mixed(hashes + np.uint64((level << 32) + 2 * number) * _ODD[20])
                other = mixed(draw)
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
            soon = time <= until
            hashes, own, limit, until, time, other = hashes[soon], own[soon], limit[soon], until[soon], time[soon], other[soon]
            slot = (other % np.uint64(SLOTS)).astype(np.int64)
            counted = slice(None)
            if high - low > 1:
                place = low + (other >> np.uint64(20)).astype(np.float64) / (1 << 44) * (high - low)
                counted = place < limit
            np.minimum.at(out, (own * SLOTS + slot)[counted], time[counted])
            number += 1
        low, high, level = high, 2 * high, level + 1
        heavy = weights > low
        made, texts, weights = made[heavy], texts[heavy], weights[heavy]


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, tuple]]:
    data, bounds = text_bytes(texts)
    for first, last in chunks(bounds, _BYTES_AT_ONCE):
        yield first, last, shingles(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])


def _text_key() -> list[Column]:
    """Two hashes that stand for a row's text, null apart from empty."""
    text = F.col("text").cast("string")
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, node, check, bands): hashes of text and words, and of the bands of its signature.

    ``node`` is null for texts without words.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, (made, texts, node, check) in _parts(batch.column(3)):
                own, of, weights, _ = bags(made, texts)
                slots = signatures(own, of, weights, last - first).view(np.uint64)
                with np.errstate(over="ignore"):
                    rows = mixed(slots[:, : BANDS * BAND_ROWS]).reshape(last - first, BANDS, BAND_ROWS)
                    bands = mixed((rows * _ODD[:BAND_ROWS]).sum(axis=2, dtype=np.uint64))
                empty = node == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(first, last - first) for k in range(3)],
                        pa.array(node.view(np.int64), mask=empty),
                        pa.array(check.view(np.int64), mask=empty),
                        pa.FixedSizeListArray.from_arrays(pa.array(bands.reshape(-1).view(np.int64)), BANDS).cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "k1", "k2", "node", "check", "bands"],
                )

    plain = docs.select(F.col("doc_id").cast("long"), *_text_key(), F.lower(F.col("text").cast("string")).alias("text"))
    return plain.mapInArrow(sign, "doc_id long, k1 long, k2 long, node long, check long, bands array<long>")


def bag_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, bag, slots) of the texts of the nodes wanted (doc_id, node), one row a node.

    ``bag`` holds the sorted 32-bit hashes of all shingles, repeats told apart; ``slots`` a byte
    of each slot of the signature.
    """

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted_nodes = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, (made, texts, node, _) in _parts(batch.column(0)):
                own, of, weights, repeats = bags(made, texts)
                slots = mixed(signatures(own, of, weights, last - first).view(np.uint64)).astype(np.uint8)
                all_of = np.repeat(of, weights)
                order = np.lexsort((repeats, all_of))
                low = (repeats[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                ends = np.cumsum(np.bincount(all_of, minlength=last - first))
                found = np.split(low, ends[:-1])
                same = np.flatnonzero(node.view(np.int64) == wanted_nodes[first:last])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node.view(np.int64)[same]),
                        pa.array([np.unique(found[k]).tobytes() for k in same], pa.binary()),
                        pa.array([slots[k].tobytes() for k in same], pa.binary()),
                    ],
                    names=["node", "bag", "slots"],
                )

    plain = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    return (
        plain.join(wanted, "doc_id").select("text", "node")
        .mapInArrow(bag, "node long, bag binary, slots binary")
        .dropDuplicates(["node"])
    )


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if not len(a) or not len(b) or min(len(a), len(b)) < 0.3 * max(len(a), len(b)):
        return 0.0
    both = np.concatenate((a, b))
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return same / (len(both) - same)


def _overlaps(pairs: DataFrame, bag_rows: DataFrame) -> DataFrame:
    """Pairs (a, b) with the similarity of their texts."""
    one = bag_rows.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    other = bag_rows.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [overlap(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    return (
        pairs.join(one, "b").join(other, "a").select("a", "b", "bag_a", "bag_b")
        .mapInArrow(compare, "a long, b long, similarity double")
    )


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, class_id): documents linked by chains of texts that overlap by ``least`` or more.

    Overlap is the Jaccard similarity of bags of five-word shingles of the lower-case text;
    class_id is the smallest doc_id of the class. Texts with the same words in the same order are
    one node. Nodes that agree in a band of their BagMinHash signature are candidates; in every
    bucket of a band, the node that meets most others overall is the centre, and the others'
    overlap with it is computed from the texts. Nodes that overlap by 0.4 or more are a group;
    the members that the links found so far leave outside a group's largest class are compared
    with the whole group, in blocks, by signature and then by overlap. Members of a bucket that
    are not linked to its centre and lie in different groups are compared with each other in the
    same way, so every pair that shares a band is decided. A text pair that overlaps by 0.8 shares
    a band with probability 0.99995.

    Null and empty texts, and those without words, are classes of their own. Rows with the same
    doc_id and text are one document twice; a null doc_id never names a class unless there is no
    other. Ties are of no effect. No documents give no rows. Only doc_id and text are read.
    """
    rows, by_node = _classified(docs, least)
    return rows.select("doc_id", "node").join(by_node, "node", "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def _classified(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (node, root, class_id) of every node: its class and the class's smallest doc_id."""
    if not 0.3 <= least <= 1:
        raise ValueError("overlaps below 0.3 are not looked for")
    rows = written(signed(docs), "signed")
    nodes = written(
        rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("bands").alias("bands")),
        "nodes",
    )
    buckets = written(
        nodes.select("node", F.posexplode("bands").alias("band", "value")), "buckets"
    )
    sizes = written(
        buckets.groupBy("band", "value").agg(F.count("*").alias("size")).filter("size > 1"), "bucket-sizes"
    )
    shared = written(buckets.join(sizes, ["band", "value"]), "shared-buckets")
    degrees = written(shared.groupBy("node").agg(F.sum("size").alias("degree")), "degrees")
    ranked = written(shared.join(degrees, "node").drop("size"), "ranked-buckets")
    # The greatest degree, and of equal ones the smallest node: ``~`` turns the order round.
    top = F.max(F.struct("degree", F.bitwise_not("node").alias("turned"))).alias("top")
    centres = written(
        ranked.groupBy("band", "value").agg(top).select("band", "value", F.bitwise_not("top.turned").alias("a")), "centres"
    )
    pairs = written(
        ranked.join(centres, ["band", "value"]).select("a", F.col("node").alias("b")).filter("a <> b").distinct(), "pairs"
    )
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id"), "node")
    bag_rows = written(bag_table(docs, wanted), "bags")
    found = written(_overlaps(pairs, bag_rows), "overlaps")

    linked = found.filter(F.col("similarity") >= least)
    first = components(linked.select("a", "b"))
    groups = components(found.filter(F.col("similarity") >= min(_SAME_GROUP, least)).select("a", "b"))
    second = joined(first, _links_in_groups(bag_rows, groups, first, least))
    rests = _rests_of_buckets(ranked, centres, linked, groups, second)
    classes = joined(second, _links_in_groups(bag_rows, rests, second, least))

    named = nodes.select("node", "doc_id").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = written(named.groupBy("root").agg(F.min("doc_id").alias("class_id")), "class-names")
    by_node = written(named.select("node", "root").join(names, "root").select("node", "root", "class_id"), "class-of-node")
    for table in (bag_rows, ranked, shared, buckets, found):
        discard(table)
    return rows, by_node


def _rests_of_buckets(
    ranked: DataFrame, centres: DataFrame, linked: DataFrame, groups: DataFrame, classes: DataFrame
) -> DataFrame:
    """(node, root): the members of each bucket that its centre is not linked to, as a group.

    Left out are buckets whose rest lies in one group or one class, which is decided, and all but
    one of those with the same rest.
    """
    group = groups.select("node", F.col("root").alias("grp"))
    cls = classes.select("node", F.col("root").alias("cls"))
    rest = written(
        ranked.join(centres, ["band", "value"])
        .filter("a <> node")
        .join(linked.select("a", F.col("b").alias("node")), ["a", "node"], "left_anti")
        .join(group, "node", "left")
        .join(cls, "node", "left")
        .select(
            "node",
            F.xxhash64("band", "value").alias("root"),
            F.coalesce("grp", "node").alias("grp"),
            F.coalesce("cls", "node").alias("cls"),
        ),
        "bucket-rests",
    )
    members = F.struct(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("other"),
    )
    undecided = (
        rest.groupBy("root")
        .agg(members.alias("members"), F.min("grp").alias("g"), F.max("grp").alias("h"), F.min("cls").alias("c"), F.max("cls").alias("d"))
        .filter("g <> h AND c <> d")
        .groupBy("members")
        .agg(F.min("root").alias("root"))
    )
    return written(rest.join(undecided.select("root"), "root", "left_semi").select("node", "root"), "undecided-rests")


def _links_in_groups(bag_rows: DataFrame, groups: DataFrame, first: DataFrame, least: float) -> DataFrame:
    """Links that the centres missed: members outside a group's largest class against its members.

    A link is between the classes of its texts.
    """
    members = written(
        groups.withColumnRenamed("root", "grp").join(first.withColumnRenamed("root", "cls"), "node", "left")
        .withColumn("cls", F.coalesce("cls", "node")),
        "members",
    )
    classes = members.groupBy("grp", "cls").agg(F.count("*").alias("n"))
    largest = written(
        classes.groupBy("grp").agg(
            F.max(F.struct("n", (-F.col("cls")).alias("minus"))).alias("top"), F.sum("n").alias("members"), F.count("*").alias("classes")
        ).filter("classes > 1").select("grp", (-F.col("top.minus")).alias("main"), "members", (F.col("members") - F.col("top.n")).alias("outside")),
        "largest",
    )
    block = lambda n: F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / _BLOCK).cast("long"))
    split = members.join(largest, "grp")
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / _BLOCK).cast("long") - 1)
    asking = split.filter("cls <> main").withColumn("q", block("outside")).select(
        "grp", "node", "cls", "q", F.explode(every("members")).alias("t"), F.lit(True).alias("asks")
    )
    asked = split.withColumn("t", block("members")).select(
        "grp", "node", "cls", F.explode(every("outside")).alias("q"), "t", F.lit(False).alias("asks")
    )
    tiles = asking.unionByName(asked).join(bag_rows, "node")

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        asks = tile[tile["asks"]].sort_values("node")
        others = tile[~tile["asks"]].sort_values("node")
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        slots = np.array([np.frombuffer(s, np.uint8) for s in others["slots"]]).reshape(-1, SLOTS)
        bag = [np.frombuffer(b, np.uint32) for b in others["bag"]]
        classes = others["cls"].to_numpy()
        out = []
        for own_class, own_slots, own_bag in zip(asks["cls"], asks["slots"], asks["bag"], strict=True):
            alike = (slots == np.frombuffer(own_slots, np.uint8)).mean(axis=1)
            own = np.frombuffer(own_bag, np.uint32)
            for k in np.flatnonzero((alike >= least - _ESTIMATE_SLACK) & (classes != own_class)):
                a, b = root(own_class), root(int(classes[k]))
                if a != b and overlap(own, bag[k]) >= least:
                    parent[max(a, b)] = min(a, b)
                    out.append((own_class, int(classes[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return tiles.groupBy("grp", "q", "t").applyInPandas(compare, "a long, b long")


def survivors(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The documents, all columns, one row of each class of near-duplicates: that of its smallest doc_id.

    Rows are told apart by doc_id and text, so one doc_id may keep several texts and null ids are
    ids like others, after all numbers. Of rows equal in both, one stays. Rows are chosen on
    hashes; whole rows are moved once, to meet the choice.
    """
    rows, by_node = _classified(docs, least)
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "k1", "k2")
    classed = rows.filter("node IS NOT NULL").join(by_node.select("node", "root"), "node")
    first = classed.groupBy("root").agg(F.min(own).alias("own")).select("own.doc_id", "own.k1", "own.k2")
    wordless = rows.filter("node IS NULL").select("doc_id", "k1", "k2").distinct()
    kept = written(first.unionByName(wordless), "kept")
    keyed = docs.select("*", F.col("doc_id").cast("long").alias("__id"), *[c.alias(f"__{n}") for c, n in zip(_text_key(), ("k1", "k2"))])
    key = ["__id", "__k1", "__k2"]
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, ("kept_id", "kept_k1", "kept_k2"))]
    chosen = kept.select(F.col("doc_id").alias("kept_id"), F.col("k1").alias("kept_k1"), F.col("k2").alias("kept_k2"))
    again = Window.partitionBy(*key).orderBy(F.lit(0))
    found = keyed.join(chosen, same, "left_semi").withColumn("__again", F.row_number().over(again)).filter("__again = 1")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
