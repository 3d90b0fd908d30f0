"""Whole jobs of the training-corpus operators: cases that an earlier cut left out."""

import base64
import gzip
import random
import re
import zlib
from math import log
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from orderflow.llm import chat, mixing, neardup, quality, secrets

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_does_not_depend_on_how_often_the_corpus_comes(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trusted = labels.filter("quality = 1")
    once = {r.doc_id: r for r in quality.score(docs, trusted).collect()}
    five = docs.crossJoin(spark.range(5).select(F.col("id").alias("time")))
    for r in quality.score(five, trusted).collect():
        assert r.kept == once[r.doc_id].kept and r.ratio == pytest.approx(once[r.doc_id].ratio, abs=1e-12)
    # Brute force: n-grams are hashed by Spark, all else is counted here.
    texts = {r.doc_id: [w for w in WORDS.findall((r.text or "").lower())] for r in docs.collect()}
    ids = {r.doc_id for r in trusted.collect()}
    grams = {k: [(w,) for w in own] + list(zip(own, own[1:])) for k, own in texts.items()}
    every = sorted({g for own in grams.values() for g in own})
    pairs = spark.createDataFrame([(k, g[0], g[1] if len(g) > 1 else None) for k, g in enumerate(every)], "k long, a string, b string")
    hashed = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b"))
    bucket = {every[r.k]: r.bucket for r in pairs.select("k", F.pmod(hashed, F.lit(10_000)).alias("bucket")).collect()}
    raw, target = [0] * 10_000, [0] * 10_000
    for k, own in grams.items():
        for g in own:
            raw[bucket[g]] += 1
            target[bucket[g]] += k in ids
    share = [(t / sum(target)) / (r / sum(raw)) if r else 1.0 for t, r in zip(target, raw)]
    for k, own in grams.items():
        ratio = sum(log((share[bucket[g]] + 0.2) / 1.2) for g in own) / max(len(own), 1)
        assert once[k].ratio == pytest.approx(ratio, abs=1e-9)
        assert once[k].kept == (not once[k].base_failed and ratio >= -0.05)
    # Bad documents of a small corpus are found, and none of the trusted ones goes.
    assert not any(once[r.doc_id].kept for r in labels.filter("quality = 0").collect())
    assert all(once[k].kept for k in ids if not once[k].base_failed)


def _escaped(text):
    return "".join("\\u%04x" % ord(c) for c in text)


SECRET = "hunter2hunter2hunter2"


@pytest.mark.parametrize(
    "text",
    [
        '{"payload":"{\\"password\\":\\"%s\\"}"}' % _escaped(SECRET),
        "C:\\dir\\u0070assword=" + SECRET,
        '{"password": "%s"}' % _escaped(SECRET),
        'password="%s"' % SECRET.replace("2", "%32"),
        "<a href='x?pass%%77ord=%s'>" % SECRET.replace("2", "\\x32"),
        quote('{"password": "%s"}' % _escaped(SECRET)),
        "\\token=" + _escaped(SECRET),
    ],
)
def test_secrets_key_and_value_meet_over_the_whole_text(text):
    before = "é 😀 50%25 C:\\new "
    base, spans = secrets.all_spans(before + text + " end")
    assert set(base) <= set(spans)
    key = min(m.start() for m in re.finditer("pass|token|.u0070|%7B", before + text))
    # The value's last character is the last encoded or plain one of the secret.
    assert any(k == "assign" and b <= key + 40 and e - b > 24 and b >= key for k, b, e in spans)


def test_secrets_places_are_those_of_the_characters():
    text = "x%C3%A9 %FF 50%25 password: " + _escaped(SECRET) + ";"
    begin = text.index("password")
    assert ("assign", begin, len(text) - 1) in secrets.all_spans(text)[1]


MIX = "doc_id long, text string, source string, n long"


@pytest.mark.parametrize("seed", range(3))
def test_mix_passes_over_a_dominating_document(spark, seed):
    rows = [(k, "w " * 500, "a", k) for k in range(1000)] + [(1000, "w " * 300_000, "a", 0)]
    taken = mixing.mix(spark.createDataFrame(rows, MIX), total_ratio=0.3, seed=seed).agg(F.sum("taken"), F.first("target")).first()
    assert 0.99 * taken[1] < taken[0] <= taken[1]


def test_mix_draws_repeated_rows_apart(spark):
    rows = [(None, f"x {k} " * 50, "a", k) for k in range(300)] + [(7, "w " * 100, "a", k) for k in range(300)]
    table = spark.createDataFrame(rows, MIX)
    found = mixing.mix(table, total_ratio=0.5).toPandas()
    assert len(found) == 600 and set(found["n"]) == set(range(300))
    assert 0.99 * found["target"].iloc[0] < found["taken"].sum() <= found["target"].iloc[0]
    assert 100 < found[found["doc_id"] == 7]["copies"].sum() < 200
    again = mixing.mix(table.repartition(5), total_ratio=0.5).toPandas()
    assert sorted(found.groupby("text")["copies"].sum()) == sorted(again.groupby("text")["copies"].sum())


def test_near_duplicates_compares_all_of_a_bucket(spark, monkeypatch):
    """All texts share all bands, so one of them is the centre of every bucket and unlike the others."""
    signed = neardup.signed
    same = F.transform("bands", lambda band, k: k.cast("long"))
    monkeypatch.setattr(neardup, "signed", lambda docs: signed(docs).withColumn("bands", same))
    texts = [" ".join(f"t{k // 2}w{j}" for j in range(100)) + (" end" if k % 2 else "") for k in range(12)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(table).collect()}
    assert found == {k: k // 2 * 2 for k in range(12)}


_NOISE = "".join(random.Random(4).choices("abcdefgh XYZ123", k=300))
_INSIDE = f"{_NOISE} password={SECRET} {_NOISE}"


def _wrapped(raw, size=64, end="\n"):
    text = base64.b64encode(raw).decode()
    return end.join(text[k : k + size] for k in range(0, len(text), size))


@pytest.mark.parametrize(
    "text",
    [
        *[_wrapped(_INSIDE[k:].encode()) for k in (0, 7, 20)],
        _wrapped(_INSIDE.encode(), 76, "\r\n"),
        _wrapped(gzip.compress(_INSIDE.encode())),
        _wrapped(zlib.compress(_INSIDE.encode()), 76),
        *["xY_/-"[:k] + "/" + base64.b64encode(_INSIDE.encode()).decode() for k in range(5)],
        "path/" + base64.b64encode(zlib.compress(_INSIDE.encode())).decode(),
        base64.b64encode(b"\xff\xfe\x80" + _INSIDE.encode()).decode(),
        *[base64.b64encode(_INSIDE.encode(name)).decode() for name in ("utf-16", "utf-16-be")],
        base64.b64encode(gzip.compress(b"first") + gzip.compress(_INSIDE.encode())).decode(),
    ],
)
def test_secrets_in_base64_of_any_form(text):
    base, spans = secrets.all_spans(f"é {text} end")
    assert not base and any(k == "assign" and 2 <= b < e <= 2 + len(text) for k, b, e in spans)


def test_secrets_report_the_limit(monkeypatch):
    text = base64.b64encode(gzip.compress(_INSIDE.encode())).decode()
    assert secrets.unwrapped_spans(text)[2] is False
    monkeypatch.setattr(secrets, "MOST_UNWRAPPED", 50)
    assert secrets.unwrapped_spans(text)[2] is True


def test_chat_renders_long_conversations_from_the_first_turn(spark):
    def numbered(turns):
        """Numbers turns, and leaves out the first one's text once a turn says so."""
        forget = any(text == "forget" for _, text in turns)
        return "".join(f"{k}:{'' if forget and not k else text};" for k, (_, text) in enumerate(turns))

    rows = [(1, k, "assistant" if k % 2 else "user", "forget" if k == 560 else f"text {k}") for k in range(600)]
    pieces = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), numbered)
    found = sorted(pieces.collect(), key=lambda r: r.turn_no)
    assert [r.turn_no for r in found if r.rewrites_history] == [560]
    assert found[560].begin == 2
    whole = numbered([(r, t) for _, _, r, t in rows])
    assert whole[:2] + "".join(r.formatted for r in found[560:]) == whole
    assert all(whole[s.begin : s.end] == f"text {r.turn_no}" for r in found[561:] for s in r.loss)
    assert all(r.loss for r in found if r.role == "assistant")
