"""CSV records with line breaks in quoted cells, read by many tasks a file.

A task that begins in the middle of a file cannot know whether it begins inside a quoted cell. So
each byte range is surveyed for both cases; the ends of the ranges of a file, taken in order, tell
in which case each really begins; then every task cuts its own range into records. A record that
goes on in the next range is put together from its parts.
"""

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import work_dir

_SURVEY = "file string, block long, from_outside boolean, from_inside boolean"
_PIECE = "file string, block long, kind string, text string"
_RECORDS_AT_ONCE = 10_000


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether a quoted cell is open at the end of a line that begins inside one, or outside.

    A quote opens a cell only where a cell begins; inside, two quotes are one character.
    """
    at = 0
    while (quote := line.find('"', at)) >= 0:
        if not inside:
            inside = quote == 0 or line[quote - 1] == delimiter
            at = quote + 1
        elif line[quote + 1 : quote + 2] == '"':
            at = quote + 2
        else:
            inside, at = False, quote + 1
    return inside


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of each byte range in a batch, in order, with its file and begin."""
    lines, files, blocks = batch.columns
    if not len(lines):
        return
    change = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
    starts = [0, *(k + 1 for k in pc.indices_nonzero(change).to_pylist()), len(lines)]
    for first, last in zip(starts, starts[1:], strict=False):
        yield (files[first].as_py(), blocks[first].as_py()), lines[first:last]


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, own, outside, inside = [], None, False, True
    for batch in batches:
        for place, lines in _ranges(batch):
            if place != own:
                if own is not None:
                    done.append((*own, outside, inside))
                own, outside, inside = place, False, True
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
    if own is not None:
        done.append((*own, outside, inside))
    names = [field.split()[0] for field in _SURVEY.split(", ")]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
    columns = list(zip(*done, strict=True)) or [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _begun_inside(ranges: pd.DataFrame) -> pd.DataFrame:
    inside, found = False, []
    for row in ranges.sort_values("block").itertuples():
        if inside:
            found.append((row.file, row.block))
        inside = row.from_inside if inside else row.from_outside
    return pd.DataFrame(found, columns=["file", "block"])


def _cutter(begun_inside: set[tuple[str, int]]):
    """Cuts ranges into records: whole ones, and the ``head`` and ``open`` parts of those that span ranges.

    A range in which a cell neither begins nor ends has only a ``middle`` part.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, kind, inside, out = None, [], "whole", False, []

        def end() -> None:
            if held:
                last = {"whole": "open", "head": "middle"}[kind]
                out.append((*own, last, "\n".join(held)))

        for batch in batches:
            for place, lines in _ranges(batch):
                first = False
                if place != own:
                    if own is not None:
                        end()
                    own, held, first = place, [], place[1] == 0
                    inside = place in begun_inside
                    kind = "head" if inside else "whole"
                for line in lines.to_pylist():
                    inside = ends_inside(line, inside) if '"' in line else inside
                    held.append(line)
                    if not inside:
                        if not first:
                            out.append((*own, kind, "\n".join(held)))
                        held, kind, first = [], "whole", False
                if len(out) >= _RECORDS_AT_ONCE:
                    yield _pieces(out)
                    out = []
        if own is not None:
            end()
        yield _pieces(out)

    return cut


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in _PIECE.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _joined(parts: pd.DataFrame) -> pd.DataFrame:
    """Records of one file from their parts, in order of their ranges; the head of a range before its open end."""
    found, held = [], []
    order = parts.assign(last=parts["kind"] == "open").sort_values(["block", "last"])
    for kind, text in zip(order["kind"], order["text"], strict=True):
        held.append(text)
        if kind == "head":
            found.append("\n".join(held))
            held = []
    if held:  # a cell that is never closed
        found.append("\n".join(held))
    return pd.DataFrame({"text": found})


def read_records(spark: SparkSession, path) -> DataFrame:
    """Every record but the header of CSV files as one row (``text``), line breaks in cells kept.

    Reads the files twice, and stores the records in the shared folder, so that both readings
    cut files into the same ranges. What comes to the driver is one row for each range that begins
    inside a cell.
    """
    lines = (
        spark.read.option("lineSep", "\n").text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    )
    # Else the size of a range would follow the number of cores, which may change in between.
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or spark.sparkContext.defaultParallelism)
    try:
        surveyed = lines.mapInArrow(_survey, _SURVEY).groupBy("file").applyInPandas(_begun_inside, "file string, block long")
        begun_inside = {(row.file, row.block) for row in surveyed.collect()}
        folder = work_dir(spark, "records")
        lines.mapInArrow(_cutter(begun_inside), _PIECE).write.parquet(folder)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    pieces = spark.read.schema(_PIECE).parquet(folder)
    parts = pieces.filter("kind <> 'whole'").groupBy("file").applyInPandas(_joined, "text string")
    records = pieces.filter("kind = 'whole'").select("text").unionByName(parts)
    return records.select(F.regexp_replace("text", "\r$", "").alias("text")).filter("text <> ''")
