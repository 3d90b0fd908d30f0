"""Deep nesting, base spans against the plain patterns, and rows chosen among near-duplicates."""

import base64
import gzip
import random
import re
import time

from orderflow.llm import neardup, secrets

SECRET = "password=hunter2hunter2hunter2"


def plain_base(text):
    """The three patterns as stated, leftmost and without overlap, failing ones dropped."""
    patterns = {
        "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 18),
        "hex": (re.compile("[0-9a-f]+"), 0, 16),
    }
    found = [
        (kind, m.start(), m.end())
        for kind, (pattern, group, least) in patterns.items()
        for m in pattern.finditer(text)
        if len(m[group]) >= least
    ]
    return sorted(found, key=lambda s: (s[1], list(patterns).index(s[0]), s[2]))


def test_base_spans_on_random_texts():
    chance = random.Random(4)
    pieces = ["password", "PASSWD", "secret", "token", "api_key", "ApiKey", ":", "=", " ", "'", '"', "AKIA", "AKIAAKIA", "0", "f", "é", "Z9", "a1b2c3d4", "\n", "-", "ſ", "K"]
    for _ in range(4_000):
        text = "".join(chance.choice(pieces) * chance.choice([1, 1, 1, 2, 5]) for _ in range(chance.randrange(14)))
        assert secrets.base_spans(text) == plain_base(text)


def test_percent_signs_nested_to_any_depth():
    for depth in (1_200, 2_000):
        text = "%" + "25" * depth
        assert secrets.unwrapped_spans(text)[2] is False
        text = "%" + "25" * depth + "70assword=hunter2hunter2"
        base, spans, limited = secrets.unwrapped_spans(text)
        assert ("assign", 0, len(text)) in spans and [kind for kind, _, _ in base] == ["hex"] and not limited


def test_base64_and_streams_nested():
    inner = SECRET
    for _ in range(25):
        inner = base64.b64encode(inner.encode()).decode()
    assert ("assign") in {kind for kind, _, _ in secrets.all_spans(inner)[1]}
    raw = SECRET.encode()
    for _ in range(300):  # more streams than any fixed number of turns
        raw = gzip.compress(raw, 1)
    text = "x " + base64.b64encode(raw).decode() + " y"
    assert ("assign", 2) in {(kind, begin) for kind, begin, _ in secrets.all_spans(text)[1]}


def test_a_limit_met_in_streams_is_told(monkeypatch):
    raw = SECRET.encode()
    for _ in range(300):
        raw = gzip.compress(raw, 1)
    text = base64.b64encode(raw).decode()
    monkeypatch.setattr(secrets, "MOST_UNWRAPPED", 20_000)
    assert secrets.unwrapped_spans(text)[2] is True


def test_time_grows_with_the_text():
    chance = random.Random(1)
    for size in (500_000, 2_000_000):
        text = base64.b64encode(chance.randbytes(size)).decode()
        begin = time.time()
        secrets.unwrapped_spans(text)
        assert time.time() - begin < size / 40_000


def test_deep_texts_in_spark(spark):
    rows = [(1, "%" + "25" * 1_500 + "70assword=hunter2hunter2"), (2, None), (3, SECRET)]
    found = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].spans[0]["kind"] == "assign" and found[2].spans == [] and len(found[3].base) == 1


def test_survivors_are_chosen_by_row(spark):
    a, b, c = (" ".join(f"{letter}{k}" for k in range(60)) for letter in "abc")
    rows = [(None, a), (None, b), (5, b), (5, c), (1, c), (1, c), (2, ""), (2, ""), (3, ""), (4, None), (None, None)]
    docs = spark.createDataFrame([(*r, str(n)) for n, r in enumerate(rows)], "doc_id long, text string, k1 string")
    kept = sorted(((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "") for r in neardup.survivors(docs).collect()))
    assert kept == sorted(
        [(True, 0, False, a), (False, 5, False, b), (False, 1, False, c), (False, 2, False, ""), (False, 3, False, ""), (False, 4, True, ""), (True, 0, True, "")]
    )
    assert neardup.survivors(docs).columns == ["doc_id", "text", "k1"]
