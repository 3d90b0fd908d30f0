"""Repeated byte strings against brute force, however the work is cut, and on odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from orderflow.llm import repeats

DOC = "doc_id long, text string, n_bytes string, kept string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain(texts, span=repeats.SPAN):
    """(n_bytes, n_removed, n_spans, sha) of each text, from a count of all strings."""
    data = [(t or "").encode() for t in texts]
    times = Counter(d[k : k + span] for d in data for k in range(len(d) - span + 1))
    rows = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - span + 1):
            if times[d[k : k + span]] > 1:
                gone[k : k + span] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(d) else 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        rows.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return rows


def corpus(seed, letters="abcdefgh é"):
    """Texts that share passages of all lengths around the limit, at all offsets."""
    chance = random.Random(seed)
    noise = lambda n: "".join(chance.choice(letters) for _ in range(n))
    passages = [noise(n) for n in (150, 190, 198, 199, 200, 201, 230, 400, 900)]
    texts = []
    for _ in range(70):
        text = noise(chance.randrange(300))
        for _ in range(chance.randrange(4)):
            passage = chance.choice(passages)
            cut = chance.randrange(120) if chance.random() < 0.5 else 0
            text += passage[cut:] + noise(chance.randrange(40))
        if chance.random() < 0.3 and text:
            k = chance.randrange(len(text))
            text = text[:k] + chance.choice("XYZ") + text[k + 1 :]
        texts.append(text)
    return texts


def check(spark, texts, parts=4):
    rows = [(k, t, "x", "y") for k, t in enumerate(texts)]
    found = repeats.without_repeats(spark.createDataFrame(rows, DOC).repartition(parts)).collect()
    want = plain(texts)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == dict(enumerate(want))
    for r in found:
        if r.removed is not None:
            assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.removed) == r.n_spans


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 256), (3, 0), (4, 2)])
def test_same_bytes_as_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    check(spark, corpus(seed))


def test_periodic_texts_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 512)
    repeats._powers.cache_clear()
    long = corpus(9)
    texts = ["a" * 900, "ab" * 180, "abc" * 67, "abc" * 66 + "ab", "x" + "a" * 250 + "y", " ".join(long)[:6_000], *long[:20]]
    check(spark, texts)
    repeats._powers.cache_clear()


def test_samples_do_not_depend_on_pieces(monkeypatch):
    data = np.frombuffer(" ".join(corpus(5)).encode(), np.uint8)
    whole = repeats.samples(data)
    monkeypatch.setattr(repeats, "_PIECE", 777)
    assert all((a == b).all() for a, b in zip(whole, repeats.samples(data)))
    # Every string of SPAN bytes holds a whole sampled gram.
    starts = np.arange(len(data) - repeats.SPAN + 1)
    assert (np.searchsorted(whole[0], starts + repeats.SPAN - repeats.GRAM, "right") > np.searchsorted(whole[0], starts)).all()


def test_maximal_repeats_against_all_pairs():
    chance = random.Random(2)
    for _ in range(200):
        core = bytes(chance.choice(b"ab") for _ in range(8))
        made = {
            (bytes(chance.choice(b"ab") for _ in range(chance.randrange(7))), core + bytes(chance.choice(b"ab") for _ in range(chance.randrange(7))))
            for _ in range(chance.randrange(1, 9))
        }
        contexts = sorted(made)
        least = chance.randrange(8, 14)
        best = Counter()
        for before, after, members in repeats.maximal_repeats(contexts, least):
            assert len(members) > 1 and before + after >= least
            for k in members:
                best[k, before, after] += 1
        assert set(best.values()) <= {1}
        want = set()
        for k, (left, right) in enumerate(contexts):
            for m, (other_left, other_right) in enumerate(contexts):
                pair = (repeats._shared(left, other_left), repeats._shared(right, other_right))
                if k != m and sum(pair) >= least:
                    want.add((k, *pair))
        # Each pair's string is output with both, or inside a longer one.
        for k, before, after in want:
            assert any(j == k and b >= before and a >= after for j, b, a in best)
        # And nothing is output that its occurrences do not share.
        assert all(any(j == k and b <= before and a <= after for j, before, after in want) for k, b, a in best)


def test_odd_rows(spark):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(500))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (None, text), (None, text), (7, text + "z"), (8, "x" * 199)]
    found = repeats.without_repeats(spark.createDataFrame([(*r, "", "") for r in rows], DOC)).collect()
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, r.n_removed, r.n_spans) for r in found)
    assert got == [(-1, 500, 500, 1)] * 2 + [(1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 0, 0), (3, 5, 0, 0), (7, 501, 500, 1), (8, 199, 0, 0)]
    assert {r.kept_sha256 for r in found if r.n_bytes in (0, 500)} == {EMPTY}


def test_no_rows(spark):
    assert repeats.without_repeats(spark.createDataFrame([], DOC)).count() == 0


def test_little_is_stored_and_batches_are_small(spark, monkeypatch):
    """An executor's memory: few files, and a few MB at once to Python, also from a session with larger batches."""
    files, batch, written = {}, "spark.sql.execution.arrow.maxBytesPerBatch", repeats.written
    before = spark.conf.get(batch)

    def stored(frame, name):
        table = written(frame, name)
        assert int(spark.conf.get(batch)) <= 4 << 20
        files[name] = len(table.inputFiles())
        return table

    monkeypatch.setattr(repeats, "written", stored)
    check(spark, corpus(6))
    assert spark.conf.get(batch) == before
    # Rows and the spans of single strings are read once and not stored.
    assert set(files) == {"copied", "grams", "hits", "kinds", "whole", "contexts", "hot-grams", "reach", "strings", "spans", "verdicts"}
    assert files["grams"] == files["verdicts"] == 1
