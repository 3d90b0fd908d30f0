"""The generated star-schema tables seen as order source tables and as message text."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.sources.tables import SourceTables

# Limits that split the generated line amounts at their median and 90th percentile.
LINE_TIERS = {"medium": 53028.16, "high": 94709.31}

# Part types that have a translation; the others keep their own name.
TRANSLATIONS = {
    "ECONOMY": "economy_parts",
    "LARGE": "large_parts",
    "MEDIUM": "medium_parts",
    "PROMO": "promotional_parts",
}


# Stated so that opening a table needs no job to look at its files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows in even shares over the shuffle partitions.

    The generated files have one row group each, so a scan is one task however many rows it
    holds, and what follows here is heavy for each row.
    """
    return rows.hint("rebalance")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def order_status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "P", "processing")
        .otherwise("created")
    )


def categories(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', '{english}')" for name, english in TRANSLATIONS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(S.CATEGORIES.names)})")


def source_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    """All six tables."""
    lineitem = table(spark, sf_dir, "lineitem")
    ordered = F.col("o_orderdate")
    return SourceTables(
        items=lineitem.select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        ),
        orders=table(spark, sf_dir, "orders").select(
            _text("o_orderkey").alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            order_status().alias("order_status"),
            F.date_format(ordered, "yyyy-MM-dd HH:mm:ss").alias("order_purchase_timestamp"),
        ),
        payments=lineitem.select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
        ),
        products=table(spark, sf_dir, "part").select(
            _text("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
        ),
        customers=table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(_text("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_state")),
        categories=categories(spark),
    )


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message: who ordered what, for how much, when."""
    return spread(table(spark, sf_dir, "events")).select(
        "event_id",
        "ts",
        _text("event_id").alias("order_id"),
        _text("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.lit("events").alias("product_category"),
        (F.col("event_id") % 6).cast("int").alias("quantity"),
        F.col("value").alias("unit_price"),
        F.col("value").alias("amount"),
        (F.rint("value") / 10).alias("freight_value"),
        F.lit(S.CURRENCY).alias("currency"),
        F.col("event_type").alias("status"),
        F.lit("card").alias("payment_type"),
        F.lit(None).cast("string").alias("customer_state"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


# What goes wrong with a message, by event_id modulo 40; other remainders stay sound. All
# events are kept: the remainder only picks the fault.
FAULTS = {
    0: "truncated",
    1: "trailing text",
    2: "two documents",
    3: "single quotes",
    4: "early bracket",
    5: "empty line",
    6: "number only",
    7: "list only",
    8: "no customer_id",
    9: "null product_id",
    10: "empty order_id",
    11: "numeric zero order_id",
    12: "zero amount",
    13: "negative amount",
    14: "text amount",
    15: "true amount",
    16: "numeric status",
    17: "empty list status",
    18: "extra field",
    19: "repeated amount",
    20: "NaN amount",
    21: "text zero order_id",
}


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` and the message text (``value``) of every event, faults included."""
    orders = event_orders(spark, sf_dir)
    sound = F.to_json(F.struct(*S.MESSAGE.names), {"ignoreNullFields": "false"})
    body = F.col("sound")

    def with_field(name, literal):
        return F.regexp_replace(body, f'"{name}":("[^"]*"|[^,}}]*)', f'"{name}":{literal}')

    wrong = {
        "truncated": body.substr(F.lit(1), F.length(body) - 1),
        "trailing text": F.concat(body, F.lit(" tail")),
        "two documents": F.concat(body, F.lit(","), body),
        "single quotes": F.translate(body, '"', "'"),
        "early bracket": F.concat(body, F.lit("] tail")),
        "empty line": F.lit(""),
        "number only": _text("event_id"),
        "list only": F.concat(F.lit("["), body, F.lit("]")),
        "no customer_id": F.regexp_replace(body, '"customer_id":"[^"]*",', ""),
        "null product_id": with_field("product_id", "null"),
        "empty order_id": with_field("order_id", '""'),
        "numeric zero order_id": with_field("order_id", "0"),
        "zero amount": with_field("amount", "0.0"),
        "negative amount": F.regexp_replace(body, '"amount":', '"amount":-'),
        "text amount": F.regexp_replace(body, '"amount":([^,]*)', '"amount":"$1"'),
        "true amount": with_field("amount", "true"),
        "numeric status": with_field("status", "5"),
        "empty list status": with_field("status", "[]"),
        "extra field": F.regexp_replace(body, "^\\{", '{"note":{"k":[1]},'),
        "repeated amount": F.regexp_replace(body, "^\\{", '{"amount":"7",'),
        "NaN amount": with_field("amount", "NaN"),
        # Told apart by their product, so that no two of these lines are the same line.
        "text zero order_id": F.regexp_replace(
            body, '"order_id":"([0-9]+)"(.*)"product_id":"[0-9]+"', '"order_id":"0"$2"product_id":"$1"'
        ),
    }
    fault = F.col("event_id") % 40
    value = F.when(fault < 0, body)
    for remainder, name in FAULTS.items():
        value = value.when(fault == remainder, wrong[name])
    return orders.select("event_id", sound.alias("sound")).select(
        "event_id", value.otherwise(body).alias("value")
    )


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as enriched rows of text, with bad numbers, dates, nulls and repeats."""
    odd = F.col("event_id") % 10
    return event_orders(spark, sf_dir).select(
        F.when(odd == 1, None).otherwise(F.col("customer_id")).alias("order_id"),
        F.when(odd == 2, None).otherwise(F.col("status")).alias("customer_id"),
        "product_id",
        "product_category",
        F.when(odd == 3, "many")
        .when(odd == 4, "3.7")
        .when(odd == 5, None)
        .otherwise(_text("quantity"))
        .alias("quantity"),
        F.when(odd == 6, "n/a")
        .otherwise(F.concat(F.format_string("%.2f", "unit_price"), F.lit("5")))
        .alias("unit_price"),
        F.when(odd == 7, "NaN")
        .when(odd == 8, None)
        .otherwise(_text("amount"))
        .alias("amount"),
        F.when(odd == 9, None).otherwise(_text("freight_value")).alias("freight_value"),
        "currency",
        F.upper("status").alias("status"),
        "payment_type",
        "customer_state",
        F.when(odd == 0, "no date").otherwise(F.col("created_at")).alias("created_at"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
        F.when(F.col("amount") >= S.HIGH_AMOUNT, "high")
        .when(F.col("amount") >= S.MEDIUM_AMOUNT, "medium")
        .otherwise("low")
        .alias("value_tier"),
    )
