"""Quality rules: counts, and a hashed n-gram log-likelihood ratio of trusted against raw text."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import WORD, words

_SYMBOL = "[#*$%&|<>]"

RESULT = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept"
]


def _window_hashes(parts: Column) -> Column:
    """A hash of each window of three words."""
    at = F.sequence(F.lit(0), F.size(parts) - 3)
    window = F.transform(at, lambda i: F.xxhash64(F.get(parts, i), F.get(parts, i + 1), F.get(parts, i + 2)))
    return F.when(F.size(parts) >= 3, window)


def _repeat_words() -> Column:
    """Words in windows found twice or more: windows beside an equal one once sorted, by position."""
    return F.when(F.col("windows").isNotNull(), F.aggregate(
        F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        F.col("windows"),
                        lambda w, i: F.struct(
                            w["at"].alias("at"),
                            (
                                (w["hash"] == F.get("windows", i - 1)["hash"]).eqNullSafe(F.lit(True))
                                | (w["hash"] == F.get("windows", i + 1)["hash"]).eqNullSafe(F.lit(True))
                            ).alias("again"),
                        ),
                    ),
                    lambda w: w["again"],
                ),
                lambda w: w["at"],
            )
        ),
        F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).alias("next")),
        # Each window adds its words that no window before it covers.
        lambda state, at: F.struct(
            (state["covered"] + at + 3 - F.greatest(state["next"], at)).alias("covered"), (at + 3).alias("next")
        ),
        lambda state: state["covered"],
    ))


def rule_counts(docs: DataFrame) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Expects a column ``parts`` with the words of ``text``; null texts have none.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    counted = (
        docs.withColumn("lines", lines)
        .withColumn("hashes", _window_hashes(F.col("parts")))
        .withColumn(
            "windows",
            F.when(
                F.size(F.array_distinct("hashes")) < F.size("hashes"),
                F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))),
            ),
        )
        .withColumns(
            {
                "n_words": F.size("parts").cast("long"),
                "word_chars": F.length(F.array_join("parts", "")).cast("long"),
                "n_symbols": F.regexp_count(text, F.lit(_SYMBOL)).cast("long"),
                "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
                "n_repeat_words": F.coalesce(_repeat_words(), F.lit(0)).cast("long"),
            }
        )
        .drop("lines", "windows", "hashes")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _bucket(buckets: int, *gram: Column) -> Column:
    return F.pmod(F.xxhash64(*gram), F.lit(buckets)).cast("int")


def _after_first(lower: Column) -> Column:
    return F.slice(lower, 2, F.greatest(F.size(lower), F.lit(1)))


def _ngrams(lower: Column, buckets: int) -> Column:
    """Buckets of all words, in lower case, and of all pairs of neighbouring words."""
    single = F.transform(lower, lambda w: _bucket(buckets, w))
    pairs = F.zip_with(lower, _after_first(lower), lambda a, b: F.when(b.isNotNull(), _bucket(buckets, a, b)))
    return F.concat(single, F.filter(pairs, lambda x: x.isNotNull()))


def _ngram_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """is_trusted and bucket of every n-gram, a row each; rows, unlike lambdas, are compiled."""
    lower = docs.select("is_trusted", words(F.lower("text")).alias("lower"))
    neighbours = F.arrays_zip(F.col("lower").alias("a"), _after_first(F.col("lower")).alias("b"))
    a, b = F.col("a"), F.col("b")
    grams = F.array(_bucket(buckets, a), F.when(b.isNotNull(), _bucket(buckets, a, b)))
    pairs = lower.select("is_trusted", F.inline(neighbours).alias("a", "b"))
    return pairs.select("is_trusted", F.explode(grams).alias("bucket")).filter("bucket IS NOT NULL")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int, prior: float) -> list[float]:
    """Per bucket the log of its share in trusted documents over its share in all.

    Two multinomials over the n-grams of all documents. The trusted one starts from ``prior``
    times its own number of n-grams, spread as in all documents, so a corpus repeated gives the
    same ratios. No more numbers than buckets reach the driver. Without trusted text all ratios
    are 0, as are those of buckets that no document has.
    """
    ids = trusted.select("doc_id").distinct().withColumn("is_trusted", F.lit(1))
    marked = docs.select("doc_id", "text").join(ids, "doc_id", "left")
    counts = _ngram_rows(marked, buckets).groupBy("bucket").agg(F.count("*").alias("raw"), F.count("is_trusted").alias("target"))
    raw, target = [0.0] * buckets, [0.0] * buckets
    for row in counts.toLocalIterator():
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    all_raw, all_target = sum(raw), sum(target)
    if not all_target:
        return [0.0] * buckets
    return [
        log((t * all_raw / (r * all_target) + prior) / (1 + prior)) if r else 0.0
        for t, r in zip(target, raw, strict=True)
    ]


def score(
    docs: DataFrame, trusted: DataFrame, buckets: int = 10_000, least: float = -0.05, prior: float = 0.2
) -> DataFrame:
    """Documents with rule counts, the log-likelihood ratio a token and the verdict.

    ``trusted`` holds the doc_id of documents that stand for good text. Every n-gram (words and
    pairs of neighbouring words, hashed to ``buckets``) adds the log of its share in trusted text
    over its share in all text; the mean over a document's n-grams is ``ratio``. Documents with
    ``ratio`` of ``least`` or more are kept, unless a base rule fails them. The weights are one
    number a bucket, whatever the input's size. ``prior`` is a share of the trusted n-grams, so
    verdicts depend on what the texts are and not on how many there are.

    Null and empty texts have no words, ratio 0, and fail the base rules. Repeated rows are
    scored alike. No documents give no rows. Extra columns are kept; those named like a result
    column are replaced.
    """
    kept = [c for c in docs.columns if c not in RESULT]
    plain = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
        "doc_id",
        F.col("text").cast("string").alias("text"),
    )
    weights = ",".join(map(repr, log_ratios(plain, trusted, buckets, prior)))
    weight = F.split(F.lit(weights), ",").cast("array<double>")
    counted = rule_counts(plain.withColumn("parts", words(F.col("text"))))
    summed = counted.withColumn("grams", _ngrams(words(F.lower("text")), buckets)).withColumn(
        "ratio",
        F.aggregate("grams", F.lit(0.0), lambda total, gram: total + F.get(weight, gram))
        / F.greatest(F.size("grams"), F.lit(1)),
    )
    return summed.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least)).select("doc.*", *RESULT)
