"""Language identification: family first, then one-versus-one linear support vector machines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import chunks, text_bytes

UNKNOWN = "und"

#: Families of languages by code; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af da sv no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt tk",
    "indo-aryan": "hi ur bn pa gu mr ne si",
    "dravidian": "ta te kn ml",
    "iranian": "fa ku ps tg",
    "semitic": "ar he mt am",
    "malayo-polynesian": "id ms jv tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_SLOTS = 1 << 16
#: Slots of pairs, then of triples, then one for what crosses the end of a text.
_DIMS = 2 * _SLOTS + 1
_BYTES_AT_ONCE = 1_000_000

# Letters in lower case, all other ASCII characters as one blank, further bytes as they are.
_FOLDED = np.arange(256, dtype=np.uint32)
_FOLDED[:128] = 0x20
for _letter in range(26):
    _FOLDED[65 + _letter] = _FOLDED[97 + _letter] = 97 + _letter


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the pair and the triple of bytes that begin at each byte."""
    folded = np.concatenate((_FOLDED[data], np.full(2, 0x20, np.uint32)))
    pairs = folded[:-2] << np.uint32(8) | folded[1:-1]
    triples = (pairs << np.uint32(8) | folded[2:]) * np.uint32(0x9E3779B1) >> np.uint32(16)
    pairs, triples = pairs.astype(np.int64), triples.astype(np.int64) + _SLOTS
    ends = bounds[1:][np.diff(bounds) > 0]
    pairs[ends - 1] = triples[ends - 1] = _DIMS - 1
    triples[np.maximum(ends - 2, 0)] = _DIMS - 1
    return pairs, triples


def has_letter(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a text has a letter of any script."""
    found = np.zeros(len(bounds) - 1, bool)
    if not len(data):
        return found
    texts = np.flatnonzero(np.diff(bounds) > 0)
    starts = bounds[texts]
    latin = _FOLDED[data]
    found[texts] = np.add.reduceat((latin >= 97) & (latin <= 122), starts, dtype=np.int64) > 0
    further = np.add.reduceat(data >= 0x80, starts, dtype=np.int64) > 0
    for text in texts[further & ~found[texts]]:
        found[text] = any(c.isalpha() for c in data[bounds[text] : bounds[text + 1]].tobytes().decode())
    return found


@dataclass
class Model:
    """Linear separators: one a family against the others, one for each two languages of a family."""

    languages: list[str]
    families: list[str]
    columns: list[tuple]
    weights: np.ndarray
    scales: np.ndarray

    def predict(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and confidence from the margin of each separator, one row a text."""
        sure = 1 / (1 + np.exp(-np.clip(2 * margins / self.scales, -50, 50)))
        place = {name: k for k, name in enumerate(self.columns)}
        if len(self.families) > 1:
            by_family = margins[:, [place[f,] for f in self.families]] / self.scales[[place[f,] for f in self.families]]
            family = by_family.argmax(axis=1)
            score = sure[np.arange(len(margins)), [place[self.families[f],] for f in family]]
        else:
            family, score = np.zeros(len(margins), int), np.ones(len(margins))
        out = np.empty(len(margins), object)
        for number, name in enumerate(self.families):
            rows = np.flatnonzero(family == number)
            own = [lang for lang in self.languages if family_of(lang) == name]
            votes, support = np.zeros((len(rows), len(own))), np.zeros((len(rows), len(own)))
            for a, b in combinations(range(len(own)), 2):
                column = place[own[a], own[b]]
                first = margins[rows, column] >= 0
                votes[:, a] += first
                votes[:, b] += ~first
                support[:, a] += sure[rows, column]
                support[:, b] += 1 - sure[rows, column]
            best = (votes + support / (len(own) + 1)).argmax(axis=1)
            out[rows] = np.array(own, object)[best]
            if len(own) > 1:
                score[rows] *= support[np.arange(len(rows)), best] / (len(own) - 1)
        return out.tolist(), score


def family_of(language: str) -> str:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], f"only {language}")


def _separator(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, rounds: int = 12, cost: float = 4.0) -> np.ndarray:
    """A linear support vector machine without offset, by dual coordinate descent."""
    weights, alphas = np.zeros(_DIMS), np.zeros(len(rows))
    rng = np.random.default_rng(7)
    # Each side gets the same say, however many texts it has.
    limits = np.where(signs > 0, cost * len(rows) / 2 / max(1, (signs > 0).sum()), cost * len(rows) / 2 / max(1, (signs < 0).sum()))
    for _ in range(rounds):
        for k in rng.permutation(len(rows)):
            slots, values = rows[k]
            slope = signs[k] * weights[slots].dot(values) - 1
            alpha = min(max(alphas[k] - slope, 0.0), limits[k])
            if alpha != alphas[k]:
                weights[slots] += (alpha - alphas[k]) * signs[k] * values
                alphas[k] = alpha
    return weights


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]]) -> Model | None:
    """A model from (language, slots, counts) of texts; None if there are no texts."""
    if not samples:
        return None
    labels = [lang for lang, _, _ in samples]
    unit = [(slots, counts / np.linalg.norm(counts)) for _, slots, counts in samples]
    mean = [(slots, counts / counts.sum()) for _, slots, counts in samples]
    languages = sorted(set(labels))
    family = np.array([family_of(lang) for lang in labels])
    families = sorted(set(family.tolist()))
    columns, weights = [], []
    if len(families) > 1:
        for name in families:
            columns.append((name,))
            weights.append(_separator(unit, np.where(family == name, 1.0, -1.0)))
    for a, b in combinations(languages, 2):
        if family_of(a) == family_of(b):
            own = [k for k, lang in enumerate(labels) if lang in (a, b)]
            signs = np.array([1.0 if labels[k] == a else -1.0 for k in own])
            columns.append((a, b))
            weights.append(_separator([unit[k] for k in own], signs))
    table = np.array(weights).reshape(len(columns), _DIMS)
    table[:, -1] = 0
    margins = np.array([[w[slots].dot(values) for w in table] for slots, values in mean])
    scales = np.maximum(np.median(np.abs(margins), axis=0), 1e-12) if len(columns) else np.zeros(0)
    return Model(languages, families, columns, table.astype(np.float32), scales)


def _margins(model: Model, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The mean weight of a text's grams under each separator."""
    out = np.zeros((len(bounds) - 1, len(model.columns)))
    texts = np.flatnonzero(np.diff(bounds) > 0)
    if not len(texts):
        return out
    pairs, triples = grams(data, bounds)
    starts, sizes = bounds[texts], np.diff(bounds)[texts]
    for column, weights in enumerate(model.weights):
        each = weights[pairs] + weights[triples]
        out[texts, column] = np.add.reduceat(each, starts, dtype=np.float64) / (2 * sizes)
    return out


def remainder(doc_id: Column) -> Column:
    """The remainder by which documents are kept for testing: those with 2 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def train(docs: DataFrame, per_language: int = 250) -> Model | None:
    """A model from a sample of about ``per_language`` labelled documents of each language.

    The sample is drawn by a hash of doc_id among documents with text and language whose
    remainder is not 2, so it does not depend on the order of rows.
    """
    labelled = docs.select(
        F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter("text <> '' AND lang IS NOT NULL").filter(remainder(F.col("doc_id")) != 2)
    counts = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30))
    limits = F.create_map(
        *[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(min(1.0, per_language / n) * (1 << 30)))]
    )
    sample = labelled.filter(part < F.element_at(limits, F.col("lang"))).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                data, bounds = text_bytes(batch.column(1).slice(at, 1))
                slots, found = np.unique(np.concatenate(grams(data, bounds)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), pa.array([slots.astype(np.int32)], pa.list_(pa.int32())), pa.array([found.astype(np.int32)], pa.list_(pa.int32()))],
                    names=["lang", "slots", "counts"],
                )

    rows = sample.mapInArrow(counted, "lang string, slots array<int>, counts array<int>").toArrow()
    samples = [
        (rows["lang"][k].as_py(), rows["slots"][k].values.to_numpy(), rows["counts"][k].values.to_numpy().astype(float))
        for k in range(rows.num_rows)
    ]
    # By language and content, so that the fit does not depend on the order in which rows come.
    samples.sort(key=lambda s: (s[0], len(s[1]), s[1].tobytes(), s[2].tobytes()))
    return fit(samples)


PREDICTION = "doc_id long, lang_pred string, score double"


def _languages(texts: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, worked out for a few megabytes at a time."""
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    data, bounds = text_bytes(texts)
    languages, scores = [], [np.zeros(0)]
    for first, last in chunks(bounds, _BYTES_AT_ONCE):
        part, own = data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        known = has_letter(part, own)
        found, sure = model.predict(_margins(model, part, own))
        languages += [lang if letter else UNKNOWN for lang, letter in zip(found, known, strict=True)]
        scores.append(np.where(known, sure, 0.0))
    return languages, np.concatenate(scores)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of each row, from nothing but its text.

    The family whose separator finds a text's byte pairs and triples most its own is taken;
    within it, each two languages are compared and the one with most wins is predicted. Null
    texts and texts without a letter are ``und`` with score 0, as all are without a model.
    Repeated rows are predicted alike. No documents give no rows.
    """

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = _languages(batch.column(1), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
            )

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(predicted, PREDICTION)


#: Texts in no learned language score about 0.25 to 0.385 (random letters, encoded data, other
#: alphabets, keyboard rows); of 10,000 generated documents, one of SHORT or more bytes scores less.
REJECT = 0.39
#: Bytes below which a text tells too little to be rejected by its score.
SHORT = 64


def identified(docs: DataFrame, model: Model | None, least: float = REJECT, short: int = SHORT) -> DataFrame:
    """The documents, all columns, that have a letter and, unless they are short, a score of ``least`` or more.

    The score is what the separators' margins say, so a text whose byte pairs and triples are
    those of no learned language goes. Without a model nothing is known and nothing stays.
    """

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def language(texts: pd.Series) -> pd.DataFrame:
        languages, scores = _languages(pa.array(texts, pa.string()), model)
        return pd.DataFrame({"lang_pred": languages, "score": scores})

    text = F.col("text").cast("string")
    seen = language(text)
    return docs.filter((seen["lang_pred"] != UNKNOWN) & ((seen["score"] >= least) | (F.octet_length(text) < short)))
