"""Column layouts of every layer, and the fixed values the layers share."""

from pyspark.sql import types as T


def _strings(*names):
    return [T.StructField(name, T.StringType()) for name in names]


# The column layouts of the source tables.
ITEMS = T.StructType(
    _strings("order_id")
    + [T.StructField("order_item_id", T.IntegerType())]
    + _strings("product_id")
    + [T.StructField("price", T.DoubleType()), T.StructField("freight_value", T.DoubleType())]
)
ORDERS = T.StructType(
    _strings("order_id", "customer_id", "order_status", "order_purchase_timestamp")
)
PAYMENTS = T.StructType(
    _strings("order_id")
    + [T.StructField("payment_sequential", T.IntegerType())]
    + _strings("payment_type")
)
PRODUCTS = T.StructType(_strings("product_id", "product_category_name"))
CUSTOMERS = T.StructType(_strings("customer_id", "customer_state"))
CATEGORIES = T.StructType(_strings("product_category_name", "product_category_name_english"))

SOURCE_TABLES = {
    "items": ITEMS,
    "orders": ORDERS,
    "payments": PAYMENTS,
    "products": PRODUCTS,
    "customers": CUSTOMERS,
    "categories": CATEGORIES,
}

# One order line as it travels in a JSON message.
MESSAGE = T.StructType(
    _strings("order_id", "customer_id", "product_id", "product_category")
    + [
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("freight_value", T.DoubleType()),
    ]
    + _strings("currency", "status", "payment_type", "customer_state", "created_at")
)
ENRICHED = T.StructType(MESSAGE.fields + _strings("processed_at", "value_tier"))

# Every enriched field as text: the typing step decides what a bad number becomes.
ENRICHED_TEXT = T.StructType(_strings(*ENRICHED.names))

# The key of a line, fields a message needs, fields a stored line needs.
LINE_KEY = ["order_id", "product_id"]
REQUIRED = ["order_id", "customer_id", "product_id", "amount", "status"]
CRITICAL = ["order_id", "customer_id", "amount"]

# The column order of the warehouse table.
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "product_category",
    "quantity",
    "unit_price",
    "amount",
    "revenue",
    "freight_value",
    "currency",
    "status",
    "value_tier",
    "order_size",
    "payment_type",
    "customer_state",
    "order_date",
    "created_at",
    "processed_at",
    "loaded_at",
]
CLOCK_COLUMNS = ["processed_at", "loaded_at"]
FACT_COLUMNS = [name for name in ORDER_COLUMNS if name not in CLOCK_COLUMNS]
DAILY_KEY = ["order_date", "status", "customer_state"]

# Statuses an order may have once upper-cased.
STATUSES = [
    "CREATED",
    "APPROVED",
    "PROCESSING",
    "INVOICED",
    "SHIPPED",
    "DELIVERED",
    "UNAVAILABLE",
    "CANCELED",
]

# Currency, fallbacks for missing attributes, tier and size limits.
CURRENCY = "BRL"
UNKNOWN_CATEGORY = "unknown"
UNKNOWN_PAYMENT = "not_defined"
UNKNOWN_STATE = "NA"
HIGH_AMOUNT = 250.0
MEDIUM_AMOUNT = 80.0
BULK_QUANTITY = 4
STANDARD_QUANTITY = 2

# CSV cell texts that mean "no value" (the defaults of pandas.read_csv).
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

_WAREHOUSE_TYPES = {
    "quantity": T.IntegerType(),
    "unit_price": T.DoubleType(),
    "amount": T.DoubleType(),
    "revenue": T.DoubleType(),
    "freight_value": T.DoubleType(),
    "order_date": T.DateType(),
    "loaded_at": T.TimestampType(),
}
WAREHOUSE = T.StructType(
    [T.StructField(name, _WAREHOUSE_TYPES.get(name, T.StringType())) for name in ORDER_COLUMNS]
)
