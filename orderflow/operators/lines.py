"""From source tables to one row per (order, product) line.

Plan at scale: orders meet their customers first, so the item table is moved twice at most:
narrow to meet its product, then to meet its order. That second move is by order, so lines are
collapsed, given their payment, cleaned and counted by order where they are, and an order is
moved twice: to its customer and to its items. Each join of items, orders, customers or products
reads plain shuffles on both sides, which is what lets adaptive execution split a hot order,
customer or product; nothing is broadcast by hint, so Spark's size check decides.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.money import exact_sum, round_half_even
from orderflow.session import small_tasks, split_hot_keys
from orderflow.sources.tables import SourceTables


def order_lines(items: DataFrame, attributes: Sequence[str] = ()) -> DataFrame:
    """Collapse item units to lines: quantity, mean price, total freight, amount.

    Rows without a full key are left out; freight of a line without any is 0. The
    aggregation combines on the map side, so a hot line shrinks before the shuffle. Sums are
    exact, so retries and partitioning never change a mean that lies between two cents.
    ``attributes`` are further columns that items of one line share; items that differ in them
    are different lines.
    """
    return (
        items.dropna(subset=S.LINE_KEY)
        .groupBy(*S.LINE_KEY, *attributes)
        .agg(
            F.count("order_item_id").cast("int").alias("quantity"),
            round_half_even(exact_sum(F.col("price")) / F.nullif(F.count("price"), F.lit(0))).alias("unit_price"),
            round_half_even(F.coalesce(exact_sum(F.col("freight_value")), F.lit(0.0))).alias("freight_value"),
        )
        .withColumn("amount", line_amount())
    )


def line_amount() -> Column:
    """Amount of a line, by its columns ``quantity`` and ``unit_price``."""
    return round_half_even(F.col("quantity") * F.col("unit_price"))


def first_by(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """First non-null ``value`` per ``key`` by ascending ``order``, ties by value.

    A null ``order`` comes last. The minimum of a struct is found with a map-side
    combine, so a key with very many rows sends one row per task.
    """
    ranked = F.struct(F.col(order).isNull(), F.col(order), F.col(value).alias("value"))
    return (
        rows.dropna(subset=[key, value])
        .groupBy(key)
        .agg(F.min(ranked)["value"].alias(value))
    )


def primary_payment(payments: DataFrame) -> DataFrame:
    return first_by(payments, "order_id", "payment_sequential", "payment_type")


def product_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    """English category name, else the original one, else 'unknown'."""
    return products.join(categories, "product_category_name", "left").select(
        "product_id",
        F.coalesce(
            "product_category_name_english",
            "product_category_name",
            F.lit(S.UNKNOWN_CATEGORY),
        ).alias("product_category"),
    )


def order_headers(tables: SourceTables) -> DataFrame:
    """Orders with the customer's state."""
    return tables.orders.join(tables.customers.select("customer_id", "customer_state"), "customer_id", "left")


def _each_once(rows: DataFrame, copies: str) -> DataFrame:
    """Rows that are equal in all columns as one, with their number in the column ``copies``."""
    return rows.groupBy(*rows.columns).agg(F.count("*").alias(copies))


def conformed_lines(tables: SourceTables) -> DataFrame:
    """Lines that have an order, with customer, product and payment attributes filled in.

    Items meet product and header before they are collapsed: the shuffle by order then serves
    the collapse too. A header or product that occurs more than once must not add to the sums
    of a line, so equal ones are joined as one and their line is repeated afterwards. Of the item's
    number, only whether there is one is moved.
    """
    split_hot_keys(tables.items.sparkSession)
    small_tasks(tables.items.sparkSession)
    headers = _each_once(order_headers(tables), "_orders")
    products = _each_once(product_categories(tables.products, tables.categories), "_products")
    items = tables.items.select(S.ITEMS.names).dropna(subset=S.LINE_KEY)
    items = items.withColumn("order_item_id", F.when(F.col("order_item_id").isNotNull(), F.lit(1)))
    joined = items.join(products, "product_id", "left").join(headers, "order_id")
    attributes = [name for name in joined.columns if name not in S.ITEMS.names]
    copies = F.col("_orders") * F.coalesce("_products", F.lit(1))
    return (
        order_lines(joined, attributes)
        .join(primary_payment(tables.payments), "order_id", "left")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), copies.cast("int"))))
        .drop("_copy", "_orders", "_products")
        .fillna(
            {
                "product_category": S.UNKNOWN_CATEGORY,
                "payment_type": S.UNKNOWN_PAYMENT,
                "customer_state": S.UNKNOWN_STATE,
            }
        )
    )
