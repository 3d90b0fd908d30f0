"""The repair of conversations against a plain table of cheapest paths, and on odd rows."""

import hashlib
import random

import pandas as pd
import pytest

from orderflow.llm import repair

LAYOUT = "conv_id long, turn long, role string, text string, step string, edit string"
AFTER = {("s", "0"): "s", ("u", "0"): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}


def plain(rows):
    """Least (cost, letters) over all states, row by row."""

    def inserted(states):
        for _ in range(2):
            for s, (cost, letters) in list(states.items()):
                to, path = ("a" if s == "u" else "u"), (cost + 5, letters + "I")
                states[to] = min(states.get(to, path), path)
        return states

    states = {"0": (0, "")}
    for initial, fault in rows:
        new = {}
        for s, (cost, letters) in inserted(dict(states)).items():
            more = [(s, 2, "D")]
            if fault not in ("blank", "duplicate"):
                stays = 5 * (fault == "truncated")
                more.append(("a" if s == "u" else "u", 1 + stays, "R"))
                if (initial, s) in AFTER:
                    more.append((initial, stays, "K"))
            for to, price, letter in more:
                path = (cost + price, letters + letter)
                new[to] = min(new.get(to, path), path)
        states = new
    return min(path for s, path in inserted(states).items() if s in "0a")


@pytest.mark.parametrize("part", [1, 3, 16])
def test_cheapest_and_least(part):
    chance = random.Random(part)
    for _ in range(400):
        rows = [
            (chance.choice(["s", "u", "u", "a", "a", "x", " ", ""]), chance.choice(["", "", "", "blank", "duplicate", "truncated"]))
            for _ in range(chance.randrange(13))
        ]
        assert repair.edits(rows, part) == plain(rows)


def test_long_conversation():
    chance = random.Random(5)
    rows = [(chance.choice("sua"), chance.choice(["", "", "truncated"])) for _ in range(3_000)]
    assert repair.edits(rows) == plain(rows)


def test_spool_keeps_order(monkeypatch):
    monkeypatch.setattr(repair, "HELD", 50)
    spool = repair._Spool()
    rows = [(k, "user", "t" * (k % 30), "") for k in range(100)]
    for row in rows:
        spool.add(row)
    assert spool.file is not None and list(spool) == rows


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi.", "x", "y"),
        (1, 0, "user", "Hi.", "x", "y"),  # a repeat within its turn
        (1, 2, "user", "Hi.", "x", "y"),  # and at a later one
        (1, 1, "assistant", "No end", "x", "y"),
        (1, 5, "assistant", "Yes!", "x", "y"),
        (2, None, None, None, "x", "y"),
        (None, 3, "user", "Hello?", "x", "y"),
        (None, 4, "assistant", "Hello!\n ", "x", "y"),
        (3, 0, "tool", "Done.", "x", "y"),
        (3, 1, "", "Done", "x", "y"),
        (4, 0, "user", "w " * 200_000 + ".", "x", "y"),
    ]
    found = repair.digests(repair.repair(spark.createDataFrame(rows, LAYOUT).repartition(3))).toPandas()
    found = found.set_index(found["conv_id"].map(lambda v: None if pd.isna(v) else int(v)))
    one = found.loc[1]
    assert list(one[["gaps", "blank", "duplicate", "truncated", "illegal"]]) == [2, 0, 2, 1, 1]
    assert (one["cost"], one["audit"]) == plain([("u", ""), ("u", "duplicate"), ("a", "truncated"), ("u", "duplicate"), ("a", "")])
    assert one["audit"] == "KDDDK" and one["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Yes!").hexdigest()
    assert list(found.loc[2][["gaps", "blank", "cost", "audit"]]) == [0, 1, 2, "D"]
    assert found.loc[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    nameless = found[found["conv_id"].isna()].iloc[0]
    assert nameless["audit"] == "KK" and nameless["repaired_sha256"] == hashlib.sha256(b"user:Hello?\nassistant:Hello!\n ").hexdigest()
    assert (found.loc[3]["cost"], found.loc[3]["audit"]) == plain([("t", ""), ("", "truncated")])
    assert (found.loc[4]["cost"], found.loc[4]["audit"]) == plain([("u", "")])
    made = repair.repair(spark.createDataFrame(rows, LAYOUT)).toPandas()
    assert made["cost"].sum() == found["cost"].sum() and set(made.columns) == {f.split()[0] for f in repair.EDITS.split(", ")}


def test_no_rows(spark):
    empty = spark.createDataFrame([], LAYOUT)
    assert repair.repair(empty).count() == 0 and repair.digests(repair.repair(empty)).count() == 0
