"""The training-corpus operators against brute force, and on nulls, repeats and empty tables."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter
from itertools import combinations
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm import chat, html, langid, mixing, neardup, packing, pii, quality, secrets, vectors
from orderflow.llm.queries import HOSTILE, tokenizer_file

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, size string, parts string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, one-word and long texts, repeated rows, and columns named like results."""
    rng = np.random.default_rng(3)
    long_text = " ".join("w%d" % k for k in rng.integers(0, 900, 30_000))
    texts = [None, "", " \n\t ", "word", "a b c d", "same five words in here " * 3, "same five words in here " * 3, long_text, "é ß 中文"]
    rows = [(k, t, [None, "en", "de"][k % 3], [None, "x", "y"][k % 3], 0, "s", "p") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, None, None, None, None, None, None)], DOC).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_mix(spark, docs, odd):
    rows = mixing.mix(docs).toPandas()
    for _, own in rows.groupby("source"):
        # Whole documents only: what stays open is less than any document that could still be added.
        gap = own["target"].iloc[0] - own["taken"].sum()
        left = own[(own["copies"] == own["copies"].min()) & (own["copies"] < 2) & (own["size"] > 0)]["size"]
        assert 0 <= gap < min(left, default=1)
    assert (rows["taken"] <= 2 * rows["size"]).all() and (rows["taken"] == rows["copies"] * rows["size"]).all()
    assert (rows["size"] == [len(WORDS.findall(t or "")) for t in rows["text"]]).all()
    first = rows.set_index("doc_id")["copies"]
    again = mixing.mix(docs.repartition(5)).toPandas().set_index("doc_id")["copies"]
    assert (first.sort_index() == again.sort_index()).all()
    found = mixing.mix(odd)
    assert found.count() == odd.count() and dict(found.dtypes)["size"] == "bigint"
    assert mixing.mix(odd.limit(0)).count() == 0


def test_targets_share_what_full_sources_leave(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 100)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert found["a"] == 20 and found[None] == 200 and found["b"] == pytest.approx(1665 - 220)


def test_html(spark):
    page = (
        "<html><body><nav><a href=x>Home</a></nav><div class='cookie-notice'>Cookies</div><div class='post-content c1'>"
        "<h1>T&eacute;st</h1><p>Some  long\n text, with words.<p>More<br>text<form>Mail</form></div><div class=comments><p>Nice one, a long "
        "comment with many words</div><footer>&copy;</footer>"
    )
    rows = [(1, "http://a.b/x", page), (2, None, None), (3, "bad url", ""), (1, "http://a.b/x", page)]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in found) == [(1, "Tést\nSome long text, with words.\nMore text")] * 2 + [(2, ""), (3, "")]


def _base_pii(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    found += [("ip", *m.span()) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        found += [("card", *m.span())] * (16 <= len(digits) <= 19 and pii.luhn(digits))
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return found + [("phone", *m.span()) for m in phones if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii(spark, docs, odd):
    weights = pii.fit(pii.examples())
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("a1.@+- 5(4)%"), 60)) for _ in range(1500)]
    texts += ["a@b@c.d.e@f.g", "1.2.3.4.5.6.7.8", "x@y.z@w.v", "9" * 50]
    for text in texts:
        assert pii.base_spans(text) == _base_pii(text), text
    right = sum(sorted(pii.best_spans(t, weights)) == sorted(gold) for t, gold in pii.examples(200, 77))
    assert right >= 190
    assert pii.find(odd).count() == odd.count() and pii.find(odd.limit(0)).count() == 0
    assert pii.mask_text("call +1 (614) 555-8001 or a@b.cd", weights) == "call [PHONE] or [EMAIL]"
    assert pii.masked(odd).columns == odd.columns


def test_packing(spark, docs, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    for table in (docs, odd):
        rows = table.select("doc_id", "text").collect()
        pieces = packing.pack(table, tokenizer_file(), shard_tokens=20_000).toPandas()
        wanted = Counter()
        for doc_id, text in rows:
            wanted[doc_id, np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
        made = Counter()
        for doc_id, own in pieces.groupby("doc_id", dropna=False):
            key = None if pd.isna(doc_id) else int(doc_id)
            made[key, b"".join(own.sort_values("start")["ids"])] += 1
        once = {k for k in wanted if sum(d == k[0] for d, _ in rows) == 1}
        assert once <= set(made)
        assert pieces["length"].sum() == sum(len(ids) // 4 * n for (_, ids), n in wanted.items())
        for _, own in pieces.sort_values("offset").groupby("sequence_id"):
            total = own["length"].sum()
            assert total <= 2048 and total & (total - 1) == 0
            assert (own["offset"] == own["length"].cumsum() - own["length"]).all()
    assert packing.pack(odd.limit(0), tokenizer_file()).count() == 0


def test_secrets(spark, odd):
    secret = "password=562cadd56fde595aec"
    once = base64.b64encode(secret.encode()).decode()
    layers = [
        once, quote(secret, safe=""), "".join("\\u%04x" % ord(c) for c in secret), "".join("%%%02X" % ord(c) for c in secret),
        base64.b64encode(gzip.compress(secret.encode())).decode(), base64.b64encode(once.encode()).decode(),
    ]
    for layer in layers:
        base, spans = secrets.all_spans(f"é {layer} end")
        assert set(base) <= set(spans)
        kind, begin, end = next(s for s in spans if s[0] == "assign")
        assert 2 <= begin and end <= 2 + len(layer) and end - begin >= len(layer) - 4
    assert secrets.all_spans("plain words only, onenthereonthingblest") == ([], [])
    assert secrets.scan(odd).count() == odd.count() and secrets.scan(odd.limit(0)).count() == 0


def test_chat(spark):
    rows = [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE), (2, 0, "a\nb\\", "<\\|<|x"), (2, 1, "assistant", "<"), (2, 1, "assistant", "<"), (2, 2, None, None), (None, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.digests(chat.format_turns(table)).collect()}
    for conv in (-1, 2, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert found[conv].loss_sha256 == hashlib.sha256("".join(t for r, t in own if r == "assistant").encode()).hexdigest()
    forgetful = lambda turns: f"{len(turns)}:" + "".join(t for _, t in turns)
    flags = [r.rewrites_history for r in chat.format_turns(table.filter("conv_id = 2"), forgetful).collect()]
    assert flags == [False, True, True, True]
    assert chat.digests(chat.format_turns(table.limit(0))).count() == 0


def _bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(1, len(words)))))


def test_near_duplicates(spark, odd):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in rng.integers(0, 400, 200)]
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, 120)) for _ in range(40)]
    for _ in range(60):
        words = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 8)):
            words[at] = "new%d" % rng.integers(0, 99)
        texts.append(" ".join(words))
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    bags, parent = [_bag(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if (bags[a] & bags[b]).total() >= 0.8 * (bags[a] | bags[b]).total():
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    assert found == {k: root(k) for k in range(len(texts))}
    classes = [(r.doc_id, r.class_id) for r in neardup.near_duplicates(odd).collect()]
    assert (6, 5) in classes and (1, 1) in classes and len(classes) == odd.count()
    assert neardup.survivors(odd).filter("doc_id IN (5, 6)").count() == 1
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_quality_counts(spark, docs, odd):
    trusted = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    for table in (docs, odd.filter("doc_id IS NOT NULL")):
        for r in quality.score(table, trusted).collect():
            text, words = r.text or "", WORDS.findall(r.text or "")
            windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
            again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
            lines = [line for line in text.split("\n") if WORDS.search(line)]
            wanted = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
    assert quality.score(odd.limit(0), trusted).count() == 0


def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(langid.remainder(F.col("doc_id")) == 2)
    right, all_rows = rows.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.98 * all_rows
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(odd, model).collect()]
    assert len(found) == odd.count() and (0, "und", 0.0) in found and (2, "und", 0.0) in found
    assert langid.train(odd.limit(0)) is None and langid.predict(odd, None).filter("lang_pred <> 'und'").count() == 0
    assert langid.identified(odd, model).filter("doc_id < 3").count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(5)
    points = rng.standard_normal((80, 16))
    points[40:] = points[:40] + 0.05 * rng.standard_normal((40, 16))
    rows = [(k, [float(x) for x in p], k % 2) for k, p in enumerate(points)]
    rows += [(100, None, 1), (101, [0.0] * 16, 1), (102, [float("nan")] * 16, 1), (103, [None] * 16, 1), (104, rows[0][1], None), (105, rows[0][1], 0), (106, [1.0], 0)]
    found = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    usable = {k: np.array(v) / np.linalg.norm(v) for k, v, label in rows if k < 100 or k == 105}
    label = {k: own for k, _, own in rows}
    for k in found:
        near = [j for j in usable if j != k and k in usable and label[j] == label[k] and usable[j] @ usable[k] >= 0.98]
        assert found[k].n_links == len(near), k
        assert found[k].kept == (found[k].component_id == k)
    assert found[105].component_id == 0 and vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_pipeline(spark, docs):
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        before = after.cache()
    pieces = corpus_pipeline.packed(spark, before, SF)
    assert pieces.agg(F.count_distinct("doc_id")).first()[0] == before.select("doc_id").distinct().count()


def test_ids_of_remembered_words_are_the_tokenizer_s():
    with open(tokenizer_file(), encoding="utf-8") as file:
        words = packing.WordIds(file.read(), "<u2")
    pick = random.Random(5)
    # Letters of both cases, marks, and accents that join one case of a letter only.
    pieces = [*"aAhHtTjJiIsSkK'.,;:!?*$% \n09|&", "\u0331", "\u0308", "\u030c", "\u0307", "\u00e9", "\u0130", "\u03a3", "\u212a", "'S", "'ll"]
    for more in ([], ["<|endoftext|>", "<|ENDOFTEXT|>", "<|"]):
        texts = ["".join(pick.choices(pieces + more, k=pick.randrange(30))) for _ in range(3000)]
        found = [list(ids) for ids in words.encode(pa.array([None, *texts]), 1)]
        right = words._tokenizer.encode_batch(["", *texts], add_special_tokens=False)
        assert found == [[*one.ids, 1] for one in right]
