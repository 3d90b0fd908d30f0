"""Typing, deduplication, money and labels."""

import math
import random
from datetime import date, datetime, timezone
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import money
from orderflow.operators import clean
from orderflow.plans import marts

RUN = datetime(2020, 1, 1, tzinfo=timezone.utc)


def row(**changes):
    fields = dict(
        order_id="o1", customer_id="c1", product_id="p1", product_category="x", quantity="1",
        unit_price="10", amount="10", freight_value="2", currency="BRL", status="SHIPPED",
        payment_type="card", customer_state="SP", created_at="2018-01-01 10:00:00",
        processed_at="2018-01-01T10:00:00", value_tier="low",
    )
    return tuple({**fields, **changes}[name] for name in S.ENRICHED.names)


def enriched(spark, *rows):
    return spark.createDataFrame(list(rows), S.ENRICHED_TEXT)


def test_layout(spark):
    rows = clean.warehouse_rows(enriched(spark, row()), RUN)
    assert rows.columns == S.ORDER_COLUMNS
    assert [field.dataType for field in rows.schema] == [field.dataType for field in S.WAREHOUSE]
    one = rows.first()
    assert one.order_date == date(2018, 1, 1)
    assert one.revenue == 12.0


def test_quantities_and_sizes(spark):
    cases = {
        "1": (1, "single"), "2": (2, "standard"), "3": (3, "standard"), "4": (4, "bulk"),
        "3.7": (3, "standard"), "many": (None, "single"), None: (None, "single"),
        " 5 ": (5, "bulk"), "99999999999": (None, "single"), "1e3": (None, "single"),
    }
    rows = enriched(spark, *[row(order_id=f"{q}", quantity=q) for q in cases])
    found = {r.order_id: (r.quantity, r.order_size) for r in clean.warehouse_rows(rows).collect()}
    assert found == {f"{q}": expected for q, expected in cases.items()}


def test_bad_values_become_null_and_rows_stay(spark):
    rows = enriched(
        spark,
        row(order_id="date", created_at="yesterday"),
        row(order_id="price", unit_price="n/a"),
        row(order_id="freight", freight_value=None),
        row(order_id="gone", amount="NaN"),
        row(order_id="none", amount=None),
        row(order_id="who", customer_id=None),
        row(order_id=None),
    )
    found = {r.order_id: r for r in clean.warehouse_rows(rows).collect()}
    assert set(found) == {"date", "price", "freight"}
    assert found["date"].order_date is None
    assert found["price"].unit_price is None
    assert found["freight"].revenue is None


def test_typed_input_is_accepted(spark):
    rows = enriched(spark, row()).withColumns(
        {"quantity": F.lit(2.9), "amount": F.lit(1.005), "unit_price": F.lit(3).cast("long")}
    )
    one = clean.warehouse_rows(rows).first()
    assert (one.quantity, one.amount, one.unit_price) == (2, 1.01, 3.0)


def test_one_row_per_line(spark):
    rows = enriched(
        spark,
        row(processed_at="2018-01-01", payment_type="old"),
        row(processed_at="2018-01-02", payment_type="new"),
        row(processed_at="2018-01-03", amount="NaN", payment_type="broken"),
        row(product_id="p2", payment_type="other"),
        row(product_id=None, payment_type="a"),
        row(product_id=None, payment_type="b"),
    )
    for shuffled in (rows, rows.repartition(5), rows.orderBy(F.rand(1))):
        found = clean.warehouse_rows(shuffled).collect()
        assert sorted((r.product_id or "", r.payment_type) for r in found) == [
            ("", "b"), ("p1", "new"), ("p2", "other"),
        ]


def test_dropping_first_equals_dropping_last(spark):
    pick = random.Random(3)
    rows = enriched(
        spark,
        *[
            row(
                order_id=pick.choice(["a", "b", None]),
                product_id=pick.choice(["x", "y", None]),
                customer_id=pick.choice(["c", None]),
                amount=pick.choice(["1", "2.345", "NaN", None]),
                processed_at=str(pick.randrange(5)),
                payment_type=str(pick.randrange(5)),
            )
            for _ in range(60)
        ],
    )
    last = clean.derived(clean.drop_incomplete(clean.one_per_line(clean.typed(rows))))
    assert sorted(map(str, last.collect())) == sorted(map(str, clean.clean_lines(rows).collect()))


def test_cheap_dedup_keeps_one_per_line(spark):
    rows = enriched(spark, row(), row(), row(product_id="p2"))
    assert clean.any_per_line(rows).count() == 2


def test_counts_are_observed_by_the_job(spark, out):
    before, counted_before = clean.counted(enriched(spark, row(), row()), "before")
    after, counted_after = clean.counted(clean.warehouse_rows(before), "after")
    after.write.parquet(out)
    assert (counted_before.get["rows"], counted_after.get["rows"]) == (2, 1)


def test_rounding_rules(spark):
    pick = random.Random(7)
    values = [1.005, 1.015, 2.675, 8.345, 0.125, 0.375, -1.005, 1e15 + 0.3, 4503599627370497.5]
    values += [round(pick.uniform(0, 1e5), pick.choice([1, 2, 3, 4, 8])) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    found = frame.select(
        "x", money.round_half_even(F.col("x")).alias("even"),
        money.round_half_up(F.col("x")).alias("up"),
    ).collect()
    for r in found:
        assert r.even == np.round(r.x, 2)
        assert r.up == float(Decimal(repr(r.x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_cents_add_up_exactly_and_odd_values_are_not_lost(spark):
    def total(*values):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        return frame.agg(
            money.cents_sum(F.col("x")).alias("s"), money.cents_avg(F.col("x")).alias("a")
        ).first()

    assert tuple(total(*[0.1] * 10)) == (1.0, 0.1)
    assert tuple(total(0.1, None, 0.2)) == (0.3, 0.15)
    assert tuple(total(None, None)) == (None, None)
    assert total(1.0, 1e30).s == 1e30
    assert math.isnan(total(1.0, math.nan).s)
    assert total(1.0, math.inf).s == math.inf


def test_daily_sales(spark):
    rows = clean.warehouse_rows(
        enriched(
            spark,
            row(),
            row(product_id="p2", amount="5.5"),
            row(order_id="o2", customer_state=None),
            row(order_id="o3", freight_value=None, status="CREATED"),
        )
    )
    found = {(r.status, r.customer_state): r for r in marts.agg_sales_daily(rows).collect()}
    both = found["SHIPPED", "SP"]
    assert (both.order_count, both.line_count, both.total_revenue, both.avg_line_value) == (
        1, 2, 19.5, 9.75,
    )
    assert found["SHIPPED", None].line_count == 1
    assert found["CREATED", "SP"].total_revenue is None


def test_sums_keep_parts_of_a_cent(spark):
    from orderflow.functions.money import cents_avg, cents_sum

    rows = spark.range(1000).selectExpr("CAST(0.004 AS DOUBLE) AS x").unionByName(
        spark.range(100).selectExpr("CAST(0.10 AS DOUBLE) AS x")
    )
    total, mean = rows.agg(cents_sum(rows["x"]), cents_avg(rows["x"])).first()
    assert abs(total - 14.0) < 1e-9 and mean == 0.01
