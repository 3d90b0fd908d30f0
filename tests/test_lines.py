"""Source tables to order lines and messages."""

import json

import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import lines
from orderflow.operators.messages import to_json_lines, to_messages
from orderflow.plans import batch, marts
from orderflow.sources.tables import SourceTables, read_csv, read_source_tables

# Order 501: a lamp bought three times and a vase; 502: a product without translation, no
# freight; 503: product, customer and payment unknown; 504: no items. 599 is no order.
FILES = {
    "orders": "order_id,order_status,customer_id,order_purchase_timestamp,order_note\n"
    "501,invoiced,ana,2021-06-05 07:08:09,x\n"
    "502,approved,bo,2021-06-06 23:59:59,\n"
    "503,canceled,nobody,2021-07-01 00:00:00,\n"
    "504,approved,ana,2021-07-02 12:30:00,\n",
    "items": "order_id,order_item_id,product_id,price,freight_value,shelf\n"
    "501,1,lamp,7.25,1.10,a\n"
    "501,2,lamp,7.25,1.10,a\n"
    "501,3,lamp,7.25,1.10,a\n"
    "501,4,vase,112.40,9.95,b\n"
    "502,1,rope,0.99,,b\n"
    "503,1,ghost,64.00,3.33,b\n"
    "599,1,lamp,7.25,1.10,a\n"
    ",1,lamp,7.25,1.10,a\n",
    "payments": "payment_type,order_id,payment_sequential\n"
    "gift,501,3\ntransfer,501,2\n,502,1\ncash,502,\ngift,502,4\n",
    "products": "product_category_name,product_id\nluz,lamp\nvaso,vase\ncorda,rope\n,bare\n",
    "customers": "customer_state,customer_id\nBA,ana\nNA,bo\n",
    "categories": "product_category_name_english,product_category_name\nlight,luz\nvases,vaso\n",
}


@pytest.fixture
def tables(spark, tmp_path) -> SourceTables:
    paths = {}
    for name, text in FILES.items():
        paths[name] = str(tmp_path / f"{name}.csv")
        (tmp_path / f"{name}.csv").write_text(text)
    return read_source_tables(spark, paths)


def by_key(frame, *key):
    return {tuple(row[k] for k in key): row for row in frame.collect()}


def test_repeated_units_become_quantity(tables):
    found = by_key(lines.conformed_lines(tables), "order_id", "product_id")
    assert set(found) == {("501", "lamp"), ("501", "vase"), ("502", "rope"), ("503", "ghost")}
    lamp, vase = found["501", "lamp"], found["501", "vase"]
    assert (lamp.quantity, lamp.unit_price, lamp.amount, lamp.freight_value) == (3, 7.25, 21.75, 3.3)
    assert (vase.quantity, vase.amount, vase.product_category) == (1, 112.4, "vases")
    assert {(r.payment_type, r.customer_state) for r in (lamp, vase)} == {("transfer", "BA")}


def test_missing_attributes_get_defaults(tables):
    found = by_key(lines.conformed_lines(tables), "order_id")
    rope, ghost = found[("502",)], found[("503",)]
    assert (rope.product_category, rope.freight_value) == ("corda", 0.0)
    assert (rope.customer_state, rope.payment_type) == ("NA", "gift")
    assert ghost.product_category == S.UNKNOWN_CATEGORY
    assert (ghost.payment_type, ghost.customer_state) == (S.UNKNOWN_PAYMENT, S.UNKNOWN_STATE)


def test_category_falls_back(tables):
    found = by_key(lines.product_categories(tables.products, tables.categories), "product_id")
    assert {key[0]: row.product_category for key, row in found.items()} == {
        "lamp": "light",
        "vase": "vases",
        "rope": "corda",
        "bare": S.UNKNOWN_CATEGORY,
    }


def test_first_payment_skips_null_types_and_puts_null_sequence_last(spark):
    rows = [
        ("a", None, "x"),
        ("a", 2, "y"),
        ("a", 1, None),
        ("b", None, "z"),
        ("c", 1, "n"),
        ("c", 1, "m"),
        ("d", 1, None),
        (None, 1, "q"),
    ]
    payments = spark.createDataFrame(rows, S.PAYMENTS)
    found = {row.order_id: row.payment_type for row in lines.primary_payment(payments).collect()}
    assert found == {"a": "y", "b": "z", "c": "m"}


def test_csv_tokens_and_columns_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('b,a\n"x, ""y""",1\nNaN,\nnull,x\n')
    schema = "a int, b string"
    typed = spark.createDataFrame([], schema).schema
    assert [tuple(row) for row in read_csv(spark, str(path), typed).collect()] == [
        (1, 'x, "y"'),
        (None, None),
        (None, None),
    ]


def test_message_mapping(tables):
    messages = to_messages(lines.conformed_lines(tables))
    assert messages.columns == S.MESSAGE.names
    documents = [json.loads(row.value) for row in to_json_lines(messages).collect()]
    (vase,) = [document for document in documents if document["product_id"] == "vase"]
    assert list(vase) == S.MESSAGE.names
    assert (vase["status"], vase["currency"]) == ("invoiced", S.CURRENCY)
    assert (vase["quantity"], vase["amount"]) == (1, 112.4) and isinstance(vase["quantity"], int)
    assert vase["created_at"] == "2021-06-05 07:08:09"


def test_json_keeps_null_fields(spark):
    text = to_json_lines(spark.range(1).select(F.lit(None).cast("string").alias("a"))).first()
    assert json.loads(text.value) == {"a": None}


def test_repeated_headers_and_products_repeat_lines_whole(spark, tables):
    """Equal and different copies of an order, customer and product: sums of a line stay as they are."""
    again = tables._replace(
        orders=tables.orders.unionByName(tables.orders).unionByName(
            tables.orders.filter("order_id = '501'").withColumn("order_status", F.lit("shipped"))
        ),
        customers=tables.customers.unionByName(tables.customers),
        products=tables.products.unionByName(tables.products).unionByName(
            tables.products.filter("product_id = 'lamp'").withColumn("product_category_name", F.lit("vaso"))
        ),
    )
    found = lines.conformed_lines(again)
    lamps = found.filter("order_id = '501' AND product_id = 'lamp'").collect()
    assert {(row.quantity, row.amount, row.freight_value) for row in lamps} == {(3, 21.75, 3.3)}
    # Orders 2 + 1, customers 2, products 2 + 1.
    assert len(lamps) == 18
    counts = {tuple(row)[:-1]: row["count"] for row in found.groupBy("order_status", "product_category").count().collect()}
    assert counts["invoiced", "light"] == 8 and counts["shipped", "vases"] == 2 + 4
    assert found.filter("order_id = '503'").count() == 2


def test_lines_are_not_shuffled_after_they_met_their_header(spark, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = marts.agg_sales_daily(marts.stg_orders(batch.orders_in_memory(tables)))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    above = plan.split("SortMergeJoin [order_id", 1)[0]
    # The daily groups alone, once orders are counted; a join of lines may not follow.
    assert above.count("Exchange hashpartitioning(") == 1
    assert above.count("Exchange hashpartitioning(order_date") == 1
    assert "SortMergeJoin" not in above


def test_an_order_is_moved_twice(spark, tables):
    """To its customer and to its items; it was moved a third time, with its payment."""
    from tests.test_skew import SMALL, settings

    with settings(spark, {**SMALL, "spark.sql.adaptive.enabled": "false"}):
        plan = lines.conformed_lines(tables)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("hashpartitioning(order_id" in line for line in moves) == 3  # payments, items, orders
    assert sum("hashpartitioning(customer_id" in line for line in moves) == 2
