"""CSV cells with line breaks read by many tasks, exact samples, sums that no partitioning changes."""

import random

import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.__main__ import main
from orderflow.operators import lines, sample
from orderflow.sinks import files
from orderflow.sources.quoted import ends_inside
from orderflow.sources.tables import read_csv
from test_lines import FILES


def quoted(cell):
    return '"' + cell.replace('"', '""') + '"'


def rows_of(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("size", [64, 300, 100_000])
def test_same_rows_as_one_task_a_file(spark, tmp_path, size):
    chance = random.Random(size)
    pieces = ["a", "é", '"', '""', "\n", "\n\n", ",", "\r\n", " ", 'x"y', ',"']
    for number in range(3):
        out = ['id,text,"other one"']
        for k in range(120):
            text = "".join(chance.choice(pieces) for _ in range(chance.randrange(8)))
            long = "line\n" * chance.randrange(1, 40) if chance.random() < 0.1 else "5\" pipe"
            out.append(f"{number}-{k},{quoted(text)},{quoted(long) if long[0] == 'l' else long}")
        end = "\r\n" if number == 1 else "\n"
        (tmp_path / f"t{number}.csv").write_bytes((end.join(out) + (end if number else "")).encode())
    path = str(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = read_csv(spark, path, multi_line=True)
        ranges = spark.read.text(path).rdd.getNumPartitions()
        raw = spark.read.options(header=True, escape='"', multiLine=True, lineSep=None or "\n").csv(path)
        assert ranges > 3 if size < 1_000 else ranges >= 1
        ids = [r.id for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(ids) == sorted(f"{n}-{k}" for n in range(3) for k in range(120))
    strip = [F.regexp_replace(c, "\r", "").alias(c) for c in raw.columns]
    none = [F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in raw.columns]
    assert rows_of(found.select(strip).select(none)) == rows_of(raw.select(strip).select(none))


def test_state_at_the_end_of_a_line():
    assert ends_inside('a,"b', False) and not ends_inside('a,"b"', False) and not ends_inside('5" x', False)
    assert not ends_inside('b"', True) and ends_inside('b""', True) and ends_inside('b","c', True)
    assert ends_inside('"""', False) and not ends_inside('""', False)


def test_written_cells_come_back(spark, out):
    rows = spark.createDataFrame([("  x  ", 'a\nb "c"'), ("y", " "), ("z", 'q"\n')], "a string, b string")
    files.write_csv(rows, out)
    assert rows_of(read_csv(spark, out, rows.schema, multi_line=True)) == rows_of(rows)


def test_sample_command_keeps_columns_and_line_breaks(spark, tmp_path):
    tables = tmp_path / "tables"
    tables.mkdir()
    for name, text in FILES.items():
        head, *rest = text.strip("\n").split("\n")
        extra = [head + ",note"] + [f'{row},"two\nlines, ""{k}"""' for k, row in enumerate(rest)]
        (tables / f"{name}.csv").write_text("\n".join(extra) + "\n")
    cut = tmp_path / "cut"
    main(["sample", "--root", str(cut), "--tables", str(tables), "--num-orders", "2", "--seed", "1", "--multi-line"])
    for name in S.SOURCE_TABLES:
        whole = read_csv(spark, str(tables / f"{name}.csv"), multi_line=True)
        kept = read_csv(spark, str(cut / name), multi_line=True)
        assert kept.columns == whole.columns and "note" in kept.columns
        assert not kept.isEmpty() and set(rows_of(kept)) <= set(rows_of(whole))
        assert all("two\nlines" in r.note for r in kept.collect())


@pytest.mark.parametrize("n", [0, 1, 300, 1_999, 2_000, 5_000])
def test_sample_is_exact_without_a_top_n(spark, n):
    frame = spark.range(2_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("more"))
    found = sample.sample_rows(frame, n, ["k"], 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan and found.columns == frame.columns
    score = F.md5(F.concat_ws("|", "k", F.lit("7")))
    want = frame.orderBy(score, "k").limit(n)
    assert found.collect() == want.collect()


def test_sample_of_repeated_rows_has_its_size(spark):
    frame = spark.range(40).select((F.col("id") % 4).cast("string").alias("k"), F.lit(None).cast("string").alias("j"))
    for n in (1, 9, 10, 11, 39):
        assert sample.sample_rows(frame, n, ["k", "j"], 7).count() == n


def test_line_sums_do_not_depend_on_the_order_of_rows(spark):
    prices = [0.1, 0.2, 0.3, 1e15, -1e15, 0.125, 0.375, 2.675, 1.005]
    rows = [("o", k % 7 + 1, "p", prices[k % len(prices)], prices[(3 * k) % len(prices)]) for k in range(90)]
    rows += [("t", k + 1, "p", 0.01 * (k % 2), 0.005) for k in range(40)]
    items = spark.createDataFrame(rows, S.ITEMS)
    first = rows_of(lines.order_lines(items))
    for parts in range(1, 21):
        assert rows_of(lines.order_lines(items.orderBy(F.rand(parts)).repartition(parts))) == first
