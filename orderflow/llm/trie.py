"""Prefix trie of conversations by union-find over the common prefixes of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import written

#: Characters of a turn's hash in a conversation's key.
_STEP = 32
#: Characters of keys that a task holds at once; a forest is built for each such run of rows.
RUN = 8_000_000
_ROWS_OUT = 10_000

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
#: Nodes inside a run, parts of nodes that go on beyond it, and the first and last row of a task.
_FOUND = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, parent string, node string, task long, run long, shared long, "
    "before long, longer boolean, ends string, key string, sizes array<long>"
)
_NAMES = [field.split()[0] for field in _FOUND.split(", ")]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (said, bytes).

    ``said`` is a hash of role and text, ``bytes`` the text's length in UTF-8. Turns are ordered
    by turn (null first), those of one turn by hash; repeated rows are turns of their own. Null
    roles and texts are empty; rows without a conv_id are left out, as are other columns. One
    row holds about 60 bytes for each turn of its conversation.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.col("turn").cast("long")
    told = F.struct(turn.isNotNull().alias("some"), turn.alias("turn"), said.alias("said"), F.octet_length(text).cast("long").alias("bytes"))
    ordered = F.transform(F.array_sort(F.collect_list("told")), lambda t: F.struct(t["said"].alias("said"), t["bytes"].alias("bytes")))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), told.alias("told"))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def _field(name: str) -> Column:
    return F.transform("turns", lambda t: t[name])


class _Prefixes:
    """Hashes of the prefixes of one key, by depth, made when they are asked for."""

    def __init__(self, key: str):
        self.key, self.made, self.hash = key, [], hashlib.md5()

    def __getitem__(self, depth: int) -> str:
        while len(self.made) <= depth:
            k = len(self.made)
            self.hash.update(f"{k}:".encode() + self.key[(k - 1) * _STEP : k * _STEP].encode() if k else b"root")
            self.made.append(self.hash.hexdigest())
        return self.made[depth]


def _common(a: str, b: str) -> int:
    """Turns that two keys share from the begin on."""
    low, high = 0, min(len(a), len(b)) // _STEP
    if a[: high * _STEP] == b[: high * _STEP]:
        return high
    step = 1
    while low + step < high and a[low * _STEP : (low + step) * _STEP] == b[low * _STEP : (low + step) * _STEP]:
        low, step = low + step, 2 * step
    high = min(high, low + step)
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low * _STEP : middle * _STEP] == b[low * _STEP : middle * _STEP]:
            low = middle
        else:
            high = middle
    return low if a[low * _STEP : (low + 1) * _STEP] != b[low * _STEP : (low + 1) * _STEP] else low + 1


def _sums(sizes) -> list[int]:
    out = [0]
    for size in sizes:
        out.append(out[-1] + int(size))
    return out


class _Forest:
    """The trie of one run of sorted rows: finished nodes, and parts of those that touch its ends."""

    def __init__(self, rows: list[tuple[int, str, list]], task: int, run: int):
        self.convs = [row[0] for row in rows]
        self.keys = [row[1] for row in rows]
        self.sums = [_sums(row[2]) for row in rows]
        self.task, self.run = task, run
        self.lengths = [len(s) - 1 for s in self.sums]
        n = len(rows)
        self.lcp = [0] + [_common(self.keys[i - 1], self.keys[i]) for i in range(1, n)]
        self.leaves, self.shared = [0], [0]
        for i in range(1, n):
            self.leaves.append(self.leaves[-1] + (self.lcp[i] < self.lengths[i - 1]))
            self.shared.append(self.shared[-1] + self.sums[i][self.lcp[i]])
        self.first, self.last = _Prefixes(self.keys[0]), _Prefixes(self.keys[-1])

    def nodes(self) -> Iterator[tuple]:
        """Edges between neighbours are taken in descending depth; each merge makes a node.

        A component is known by its leftmost row and holds its last row, smallest conversation,
        depth and number of children at that depth. When it is merged into another, the nodes
        between the two depths are written.
        """
        n = len(self.convs)
        parent = list(range(n))
        last = list(range(n))
        least = list(self.convs)
        depth = list(self.lengths)
        children = [0] * n

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        order = sorted(range(1, n), key=lambda i: -self.lcp[i])
        k = 0
        while k < len(order):
            at = self.lcp[order[k]]
            merged: dict[int, list[tuple]] = {}
            while k < len(order) and self.lcp[order[k]] == at:
                i = order[k]
                k += 1
                left, right = root(i - 1), root(i)
                parts = []
                for own in (left, right):
                    # One that was of greater depth so far is a part of the node at this depth.
                    if own in merged:
                        parts += merged.pop(own)
                    elif depth[own] > at:
                        parts.append((own, last[own], least[own], depth[own], children[own]))
                grown = (children[left] if depth[left] == at else self.lengths[left] > at) + (self.lengths[i] > at)
                # The right one's own children count unless its first row has just been counted.
                if depth[right] == at:
                    grown += children[right] - (self.lengths[right] > at)
                parent[right], last[left] = left, last[right]
                least[left], depth[left], children[left] = min(least[left], least[right]), at, grown
                merged[left] = parts
            for own, parts in merged.items():
                for low, high, conv, top, below in parts:
                    yield from self.chain(low, high, conv, top, below, at, least[own], self.open(own, last[own]))
        yield from self.chain(0, n - 1, least[0], depth[0], children[0], -1, None, False)

    def open(self, low: int, high: int) -> bool:
        return low == 0 or high == len(self.convs) - 1

    def chain(
        self, low: int, high: int, conv: int, top: int, below: int, until: int, above: int | None, above_open: bool
    ) -> Iterator[tuple]:
        """The nodes of a component from its own depth up to that of the node it is merged into."""
        edges, leaves, shared = high - low, self.leaves[high] - self.leaves[low], self.shared[high] - self.shared[low]
        own_open = self.open(low, high)
        prefixes = self.first if low == 0 else self.last if own_open else None
        if top == self.lengths[low] and edges == 0:
            below = 0
        for d in range(top, until, -1):
            ends = None
            if self.lengths[low] == d:
                stop = low
                while stop < high and self.lcp[stop + 1] == d == self.lengths[stop + 1]:
                    stop += 1
                ends = ",".join(map(str, self.convs[low : stop + 1]))
            paid = self.sums[low][max(d - 1, 0)]
            number = below if d == top else 1
            if own_open:
                up = prefixes[d - 1] if d else None
                # Children behind the first row's own; that one is added once the whole node is known.
                longer = self.lengths[low] > d
                yield self.part(prefixes[d], up, d, conv, edges + 1, leaves, number - longer, shared, paid, longer, ends)
                continue
            near = d == until + 1
            up = self.prefix(low, d - 1) if near and above_open else None
            row = ("node", conv, d, (None if up else above) if near else conv, edges + 1, number, leaves + 1, shared - edges * paid)
            digest = hashlib.sha256(ends.encode()).hexdigest() if ends is not None else _NO_ENDS
            yield (*row, digest, up, *[None] * 9)

    def prefix(self, low: int, depth: int) -> str:
        """The hash of an open node that holds ``low``: one of the first or of the last row."""
        key = self.keys[low][: depth * _STEP]
        return (self.first if self.keys[0].startswith(key) else self.last)[depth]

    def part(self, node, up, d, conv, convs, leaves, children, shared, paid, longer, ends) -> tuple:
        return (
            "part", conv, d, None, convs, children, leaves, None, None, up, node,
            self.task, self.run, shared, paid, longer, ends, None, None,
        )


def _border(before: tuple[str, list], key: str, sizes: list) -> Iterator[tuple]:
    """What the edge between two runs adds to every node that holds both its rows."""
    common = _common(before[0], key)
    sums, prefixes = _sums(sizes), _Prefixes(key)
    leaf, length = common < len(before[1]), len(sums) - 1
    for d in range(common + 1):
        yield (
            "part", None, d, None, 0, int(d == common and length > d), int(leaf), None, None,
            prefixes[d - 1] if d else None, prefixes[d], None, None, sums[common], sums[max(d - 1, 0)], None, None, None, None,
        )


def _frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) >= _ROWS_OUT:
            yield _frame(out)
            out = []
    yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_NAMES, dtype=object)
    return frame.astype({f.split()[0]: "Int64" for f in _FOUND.split(", ") if f.endswith(" long")})


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    task = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        held, chars, run, before = [], 0, 0, None
        for batch in batches:
            for conv, key, sizes in zip(batch["conv_id"], batch["key"], batch["sizes"], strict=True):
                if before is None and not held:
                    yield _end("first", task, key, sizes)
                held.append((int(conv), key, sizes))
                chars += len(key) + 100
                if chars > RUN:
                    yield from done(held, run, before)
                    held, chars, run, before = [], 0, run + 1, held[-1][1:]
        if held:
            yield from done(held, run, before)
            before = held[-1][1:]
        if before is not None:
            yield _end("last", task, *before)

    def done(held: list[tuple], run: int, before: tuple | None) -> Iterator[tuple]:
        if before is not None:
            yield from _border(before, *held[0][1:])
        yield from _Forest(held, task, run).nodes()

    yield from _frames(rows())


def _end(kind: str, task: int, key: str, sizes: list) -> tuple:
    return (kind, *[None] * 10, task, *[None] * 5, key, list(sizes))


def _borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield from _border((row.key_before, row.sizes_before), row.key, row.sizes)

    yield from _frames(rows())


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, ends_sha256) of lists of conversations that come in pieces, in order."""
    node, total = None, None
    for batch in batches:
        out = []
        for own, ends in zip(batch["node"], batch["ends"], strict=True):
            if own != node:
                if node is not None:
                    out.append((node, total.hexdigest()))
                node, total = own, hashlib.sha256(ends.encode())
            else:
                total.update(b"," + ends.encode())
        yield pd.DataFrame(out, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, total.hexdigest())], columns=["node", "ends_sha256"])


def nodes(told: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the sequences (conv_id, turns): a node of their trie.

    Columns: the smallest conv_id among its members; depth; the parent's conv_id (null for the
    root); members, children and childless nodes below or itself; bytes saved by holding each
    prefix once (for each node of the subtree its members but one times the bytes of its text);
    and a hash of the members that end there.

    Rows are sorted over all tasks by the hashes of their turns. What two neighbours share is an
    edge; each run of rows of a task unites its rows over its edges in descending depth, and every
    union makes a branching node. A node's counts are sums over the edges inside it, so the parts
    of a node that goes on into the next run or task, and the edges between runs, are added up by
    the hash of its prefix. Only nodes on the first or last row of a run are added up that way.
    A hot conversation is spread over tasks by its conv_ids; the list of those that end at one
    node is hashed in order, as pieces of a run each.

    Repeated conv_ids are members of their own; conversations without turns end at the root. No
    rows give no rows. Extra columns are left out.
    """
    spark = told.sparkSession
    rows = told.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.array_join(_field("said"), "").alias("key"),
        _field("bytes").alias("sizes"),
    )
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = written(ordered.mapInPandas(_forests, _FOUND), "forests")

    firsts = found.filter("kind = 'first'").select("task", "key", "sizes")
    lasts = found.filter("kind = 'last'").select("task", F.col("key").alias("key_before"), F.col("sizes").alias("sizes_before"))
    # One row for each task.
    tasks = sorted(row.task for row in lasts.select("task").collect())
    follows = spark.createDataFrame(list(zip(tasks, tasks[1:], strict=False)), "task_before long, task long")
    pairs = firsts.join(follows, "task").join(lasts.withColumnRenamed("task", "task_before"), "task_before")
    borders = pairs.select("key_before", "sizes_before", "key", "sizes").mapInPandas(_borders, _FOUND)
    parts = written(found.filter("kind = 'part'").unionByName(borders).select(*_NAMES[1:17]), "parts")

    place = F.struct("task", "run")
    lists = parts.filter("ends IS NOT NULL").select("node", "task", "run", "ends")
    ends = lists.repartition("node").sortWithinPartitions("node", "task", "run").mapInPandas(_ends, "node string, ends_sha256 string")
    start = F.min(F.when(F.col("longer").isNotNull(), F.struct(place.alias("place"), "longer")))["longer"]
    spanning = parts.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"),
        (F.sum("n_children") + start.cast("long")).alias("n_children"),
        (F.sum("n_leaves") + 1).alias("n_leaves"),
        (F.sum("shared") - (F.sum("n_convs") - 1) * F.max("before")).alias("saved_tokens"),
    )
    spanning = written(
        spanning.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))), "spanning"
    )
    names = [field.split()[0] for field in NODE.split(", ")]
    above = spanning.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inside = found.filter("kind = 'node'")
    rest = [name for name in names if name != "parent_conv_id"]
    hanging = inside.filter("parent IS NOT NULL").select(*rest, "parent").unionByName(spanning.select(*rest, "parent"))
    return inside.filter("parent IS NULL").select(names).unionByName(
        hanging.join(above, "parent", "left").select(*rest, F.col("above").alias("parent_conv_id")).select(names)
    )
