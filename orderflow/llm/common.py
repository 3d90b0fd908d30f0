"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import work_dir

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame stored in the shared folder and read back: lost executors cost no recomputation."""
    spark = frame.sparkSession
    path = work_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Free the disk of a table that ``written`` stored, once what was made of it is stored too."""
    files = frame.inputFiles()
    if files:
        folder = files[0].rsplit("/", 1)[0]
        frame.sparkSession.createDataFrame([], frame.schema).write.mode("overwrite").parquet(folder)


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch of texts, and where each text begins and the last ends; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes each; a longer text has one of its own."""
    first, last = 0, len(bounds) - 1
    while first < last:
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, min(end, last)
        first = min(end, last)


_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True


def hashed_words(
    data: np.ndarray, bounds: np.ndarray, cuts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of a batch: a 64-bit hash, first byte, byte after the last, and words per text.

    Words are also cut before the bytes at ``cuts``.
    """
    inside = ~_IS_GAP[data]
    if not inside.any():
        nothing = np.zeros(0, np.int64)
        return nothing.astype(np.uint64), nothing, nothing, np.zeros(len(bounds) - 1, np.int64)
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    begins_text = np.zeros(len(data) + 1, bool)
    begins_text[bounds] = True
    if cuts is not None:
        begins_text[cuts] = True
    starts = np.flatnonzero(inside & (~before[:-1] | begins_text[:-1]))
    after = np.empty(len(data) + 1, bool)
    after[:-1], after[-1] = inside, False
    ends = np.flatnonzero(inside & (~after[1:] | begins_text[1:])) + 1
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = data[inside].astype(np.uint64)
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    factors = mixed(np.arange(int(sizes.max())))
    with np.errstate(over="ignore"):
        letters += np.uint64(1)
        letters *= factors[place]
        hashes = mixed(np.add.reduceat(letters, first) + sizes.astype(np.uint64))
    return hashes, starts, ends, np.diff(np.searchsorted(starts, bounds))
