"""One key holding a third of all rows is split or pre-aggregated, with the same result."""

import re
from contextlib import contextmanager
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from orderflow.operators import clean, lines
from orderflow.plans import batch
from orderflow.session import SETTINGS
from orderflow.sinks import warehouse as sink
from orderflow.sources.tables import SourceTables

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(column, name, cold):
    """A third of the rows share one value, the others have their own."""
    return F.when(column % 3 == 0, name).otherwise(F.concat(F.lit(name), cold.cast("string")))


def final_plan(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    n = 120_000
    ids = spark.range(n, numPartitions=8)
    number = F.col("id")
    orders = spark.range(n // 2, numPartitions=8)
    return SourceTables(
        # a third of all items in one order, and (independently) of one product
        items=ids.select(
            hot(number, "order", number % (n // 2)).alias("order_id"),
            number.cast("int").alias("order_item_id"),
            hot(F.shiftrightunsigned(number, 2), "part", number).alias("product_id"),
            F.lit(1.25).alias("price"),
            F.lit(0.5).alias("freight_value"),
        ),
        orders=orders.select(
            F.when(number == 0, "order")
            .otherwise(F.concat(F.lit("order"), number.cast("string")))
            .alias("order_id"),
            hot(number, "customer", number).alias("customer_id"),
            F.lit("shipped").alias("order_status"),
            F.lit("2018-01-01 00:00:00").alias("order_purchase_timestamp"),
        ),
        payments=ids.select(
            hot(number, "order", number % (n // 2)).alias("order_id"),
            (number % 7).cast("int").alias("payment_sequential"),
            F.concat(F.lit("type"), (number % 5).cast("string")).alias("payment_type"),
        ),
        products=ids.select(
            F.concat(F.lit("part"), number.cast("string")).alias("product_id"),
            F.lit("things").alias("product_category_name"),
        ).unionByName(
            spark.range(1).select(
                F.lit("part").alias("product_id"), F.lit("hot").alias("product_category_name")
            )
        ),
        customers=orders.select(
            F.when(number == 0, "customer")
            .otherwise(F.concat(F.lit("customer"), number.cast("string")))
            .alias("customer_id"),
            F.lit("SP").alias("customer_state"),
        ),
        categories=spark.sql(
            "SELECT 'hot' AS product_category_name, 'warm' AS product_category_name_english"
        ),
    )


def test_hot_keys_are_split_in_every_big_join(spark, tables):
    plain = lines.conformed_lines(tables)
    expected = plain.agg(F.count("*"), F.sum("quantity"), F.sum(F.xxhash64(*plain.columns) % 1000))
    expected = expected.first()
    with settings(spark, SMALL):
        conformed = lines.conformed_lines(tables)
        plan = final_plan(conformed)
        split = set(re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", plan))
        assert split == {"customer_id", "order_id", "product_id"}
        found = conformed.agg(
            F.count("*"), F.sum("quantity"), F.sum(F.xxhash64(*conformed.columns) % 1000)
        ).first()
    assert found == expected


def test_hot_keys_are_split_when_deduplication_follows(spark, tables):
    with settings(spark, {**SMALL, **SETTINGS}):
        rows = batch.orders_in_memory(tables, datetime(2020, 1, 1, tzinfo=timezone.utc))
        plan = final_plan(rows)
        split = set(re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", plan))
        assert split == {"customer_id", "order_id", "product_id"}
        assert rows.count() == lines.order_lines(tables.items).count()


def test_groups_shrink_before_the_shuffle(tables):
    for frame in (
        lines.order_lines(tables.items),
        lines.primary_payment(tables.payments),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        below = plan.split("Exchange", 1)[1]
        assert "partial_" in below


def test_copies_of_one_line_shrink_before_the_shuffle(spark):
    copies = spark.range(90_000, numPartitions=8).select(
        hot(F.col("id"), "order", F.col("id")).alias("order_id"),
        F.lit("p").alias("product_id"),
        F.lit("c").alias("customer_id"),
        F.col("id").cast("double").alias("amount"),
    )
    kept = clean.one_per_line(copies)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan.split("Exchange", 1)[1]
    assert kept.count() == 60_001
    assert kept.filter("order_id = 'order'").first().amount == 89_997.0


def test_hot_date_is_written_by_several_tasks(spark, out):
    rows = spark.range(60_000, numPartitions=8).select(
        F.xxhash64("id").cast("string").alias("order_id"),
        F.md5(F.col("id").cast("string")).alias("product_id"),
        F.lit("SHIPPED").alias("status"),
        F.when(F.col("id") % 3 > 0, F.lit("2018-01-01"))
        .otherwise(F.lit("2018-01-02"))
        .cast("date")
        .alias("order_date"),
    )
    with settings(spark, SMALL):
        sink.append_orders(rows, out)
    table = spark.read.parquet(out)
    files = table.select("order_date", F.input_file_name().alias("f")).distinct()
    per_date = {str(row.order_date): row["count"] for row in files.groupBy("order_date").count().collect()}
    assert per_date["2018-01-01"] > 1
    assert table.count() == 60_000
