"""The prefix trie against a plain one, however the rows are cut, and on odd rows."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderflow.llm import trie

TOLD = "conv_id long, turns array<struct<said:string,bytes:long>>, depth string, parent string"


def plain(convs):
    """Nodes of [(conv_id, [(said, bytes), ...])] as {prefix: row}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in convs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for prefix, own in members.items():
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += (len(own) - 1) * (prefix[-1][1] if prefix else 0)
            leaves[prefix[:d]] += not children[prefix]
    rows = []
    for prefix, own in members.items():
        parent = min(members[prefix[:-1]]) if prefix else None
        listed = ",".join(map(str, sorted(ends[prefix]))) if prefix in ends else ""
        rows.append(
            (min(own), len(prefix), parent, len(own), children[prefix], leaves[prefix], saved[prefix], hashlib.sha256(listed.encode()).hexdigest())
        )
    return sorted(rows, key=repr)


def made(kind):
    """A turn from a small alphabet, so that prefixes are shared."""
    return (hashlib.md5(kind.encode()).hexdigest(), len(kind) * 3)


def found(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("run", [1, 700, 8_000_000])
def test_same_nodes_however_cut(spark, monkeypatch, run):
    monkeypatch.setattr(trie, "RUN", run)
    chance = random.Random(run)
    convs = [(c, [made(chance.choice("aab" if d < 2 else "abc")) for d in range(chance.randrange(6))]) for c in range(300)]
    # One conversation that a third of all repeat, and long ones that part late.
    convs += [(1000 + k, [made("a")] * 3) for k in range(150)]
    convs += [(-5 - k, [made("a")] * 200 + [made("b")] * k) for k in range(4)]
    rows = [(c, turns, "x", "y") for c, turns in convs]
    assert found(trie.nodes(spark.createDataFrame(rows, TOLD).repartition(5))) == plain(convs)


def test_common_prefix():
    a, b, c = (made(k)[0] for k in "abc")
    for n in range(12):
        for m in range(12):
            one, other = [a] * n + [b] * 5, [a] * m + [c] * 7
            want = next((k for k, (x, y) in enumerate(zip(one, other)) if x != y), min(len(one), len(other)))
            assert trie._common("".join(one), "".join(other)) == want
    assert trie._common("", a) == 0 and trie._common(a, a + b) == 1


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi", "x"),
        (1, None, "system", None, "x"),
        (1, 0, "user", "Hi", "x"),
        (2, None, "system", "", "x"),
        (2, 7, "user", "Hi", "x"),
        (None, 0, "user", "Hi", "x"),
        (3, 0, None, "é" * 100_000, "x"),
    ]
    told = trie.sequences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string"))
    sizes = {row.conv_id: [t.bytes for t in row.turns] for row in told.collect()}
    assert sizes == {1: [0, 2, 2], 2: [0, 2], 3: [200_000]}
    nodes = {(row.conv_id, row.depth): row for row in trie.nodes(told).collect()}
    assert set(nodes) == {(1, 0), (1, 1), (1, 2), (1, 3), (3, 1)}
    assert nodes[1, 0].saved_tokens == 2 and nodes[1, 0].n_children == 2 and nodes[1, 0].n_leaves == 2
    assert nodes[1, 2].n_convs == 2 and nodes[1, 2].ends_sha256 == hashlib.sha256(b"2").hexdigest()


def test_turnless_and_no_rows(spark):
    told = spark.createDataFrame([(4, [], "", ""), (9, [], "", "")], TOLD)
    only = trie.nodes(told).collect()
    assert [tuple(r) for r in only] == [(4, 0, None, 2, 0, 1, 0, hashlib.sha256(b"4,9").hexdigest())]
    assert trie.nodes(told.limit(0)).count() == 0
    assert trie.sequences(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_identical_conversations(spark):
    told = spark.range(50).select(F.col("id").alias("conv_id"), F.array(F.struct(F.lit("0" * 32).alias("said"), F.lit(1).cast("long").alias("bytes"))).alias("turns"))
    nodes = trie.nodes(told).collect()
    assert sorted(n.n_convs for n in nodes) == [50, 50] and {n.saved_tokens for n in nodes} == {49}
