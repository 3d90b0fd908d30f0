"""Compaction: same rows in fewer files that do not overlap, crashes at every step, loads after it."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.sinks import compact, keys
from orderflow.sinks.folders import data_files, exists
from orderflow.sinks.loads import Loads
from orderflow.sinks.warehouse import compact_orders, write_orders
from orderflow.sources.warehouse import read_orders
from test_loads import FIRST, daily_rows, lines, numbers_as_keys, stored_numbers


@pytest.fixture(autouse=True)
def small_index(monkeypatch):
    monkeypatch.setattr(keys, "PARTS", 4)
    monkeypatch.setattr(keys, "BUCKETS", 16)


def loaded(spark, root, count=5):
    loads = Loads(spark, f"{root}/orders", f"{root}/daily")
    for first in range(0, count * 40, 40):
        loads.load(lines(spark, range(first, first + 40)))
    return loads


def files_of(root):
    return sum(name.endswith(".parquet") for _, _, found in os.walk(root) for name in found)


def test_rows_sums_and_keys_stay_and_files_go(spark, tmp_path):
    loads = loaded(spark, tmp_path)
    before = daily_rows(spark, tmp_path)
    many = [files_of(f"{tmp_path}/{name}") for name in ("orders", "daily-sums", "orders-keys")]
    loads.compact(most_files=1)
    few = [files_of(f"{tmp_path}/{name}") for name in ("orders", "daily-sums", "orders-keys")]
    assert all(a < b for a, b in zip(few, many)) and few[2] == 16
    assert stored_numbers(spark, f"{tmp_path}/orders") == numbers_as_keys(range(200))
    assert daily_rows(spark, tmp_path) == before
    # Loads go on: what is known is known, with a table declared in a session that did not know it.
    spark.sql(f"DROP TABLE IF EXISTS {loads.index.name}")
    Loads(spark, f"{tmp_path}/orders", f"{tmp_path}/daily").load(lines(spark, range(150, 230)))
    assert stored_numbers(spark, f"{tmp_path}/orders") == numbers_as_keys(range(230))
    kept, full = daily_rows(spark, tmp_path)
    assert kept == full
    before = files_of(f"{tmp_path}/orders")
    loads.compact()  # nothing is scattered by the usual measure
    assert files_of(f"{tmp_path}/orders") == before


@pytest.mark.parametrize("placed", [0, 1, 3])
def test_crash_while_dates_are_put_in_place(spark, tmp_path, monkeypatch, placed):
    loads, left = loaded(spark, tmp_path, 3), [placed]
    put = compact.put_in_place

    def dies(session, folder, target):
        if not left[0]:
            compact.remove(session, target)  # the old date is gone, the new one not yet there
            raise RuntimeError("lost")
        left[0] -= 1
        put(session, folder, target)

    with monkeypatch.context() as patch:
        patch.setattr(compact, "put_in_place", dies)
        with pytest.raises(RuntimeError, match="lost"):
            compact_orders(spark, f"{tmp_path}/orders", most_files=1)
    loads.load(lines(spark, range(100, 140)))
    assert stored_numbers(spark, f"{tmp_path}/orders") == numbers_as_keys(range(140))
    assert not exists(spark, f"{tmp_path}/orders-compacted")
    kept, full = daily_rows(spark, tmp_path)
    assert kept == full


def test_crash_before_the_files_are_complete(spark, tmp_path):
    loads = loaded(spark, tmp_path, 2)
    half = f"{tmp_path}/orders-compacted/order_date=2018-01-01"
    lines(spark, range(3)).drop("order_date").write.parquet(half)
    loads.compact(most_files=1)
    assert stored_numbers(spark, f"{tmp_path}/orders") == numbers_as_keys(range(80))


def test_crash_between_the_old_index_and_the_new(spark, tmp_path, monkeypatch):
    loads = loaded(spark, tmp_path, 3)

    def dies(session, folder, target):
        keys.remove(session, target)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(keys, "put_in_place", dies)
        with pytest.raises(RuntimeError, match="lost"):
            loads.index.merge(most_files=1)
    loads.load(lines(spark, range(100, 140)))
    assert stored_numbers(spark, f"{tmp_path}/orders") == numbers_as_keys(range(140))
    assert len(spark.table(loads.index.name).select("line").distinct().collect()) == spark.table(loads.index.name).count()


def test_a_product_filter_reads_a_fraction_of_a_dates_files(spark, tmp_path):
    path = f"{tmp_path}/orders"
    number = F.col("id")
    rows = lines(spark, [1], FIRST).drop("order_id", "product_id", "status").crossJoin(spark.range(24_000))
    rows = rows.withColumns(
        {
            "order_id": number.cast("string"),
            # A third of all lines are of one product.
            "product_id": F.when(number % 3 == 0, "p050").otherwise(F.format_string("p%03d", F.pmod(F.hash("id"), F.lit(100)))),
            "status": F.concat(F.lit("S"), (number % 2).cast("string")),
        }
    ).select(S.ORDER_COLUMNS)
    for part in range(4):
        write_orders(rows.filter(F.pmod(F.xxhash64("order_id"), F.lit(4)) == part), path)
    folder = f"{path}/order_date={FIRST}"
    size = sum(data_files(spark, folder))
    assert compact_orders(spark, path, most_files=1, file_bytes=size // 16) == 0  # 4 files are fewer than asked for
    assert compact_orders(spark, path, most_files=1, file_bytes=size // 2) == 1
    compact.compact_dates(read_orders(spark, path), path, ["status", "product_id", "order_id"], -100, size // 16)
    bounds = []
    for name in sorted(os.listdir(folder)):
        if name.endswith(".parquet"):
            file = pq.ParquetFile(f"{folder}/{name}")
            at = file.schema_arrow.names.index("product_id")
            groups = [file.metadata.row_group(k).column(at).statistics for k in range(file.metadata.num_row_groups)]
            bounds.append((min(g.min for g in groups), max(g.max for g in groups)))
    assert len(bounds) >= 12
    rare = [low <= "p020" <= high for low, high in bounds]
    assert 1 <= sum(rare) <= 5 < len(bounds) / 2
    assert sum(low <= "p050" <= high for low, high in bounds) >= 4  # the frequent one is spread
    assert read_orders(spark, path).count() == 24_000

