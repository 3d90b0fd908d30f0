
from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from orderflow import schemas as S  # noqa: E402
from orderflow.functions.labels import order_size as order_size_of  # noqa: E402
from orderflow.functions.labels import utc_text  # noqa: E402
from orderflow.operators import clean, lines, quality, sample, validate  # noqa: E402
from orderflow.operators.messages import to_messages  # noqa: E402
from orderflow.plans import batch, increments, marts, sample_set  # noqa: E402
from orderflow.plans import testdata as data  # noqa: E402
from orderflow.session import WORK_DIR, configure, work_dir  # noqa: E402
from orderflow.sinks import files  # noqa: E402
from orderflow.sinks import warehouse as warehouse_sink  # noqa: E402
from orderflow.sinks.loads import Loads, append_new_orders  # noqa: E402
from orderflow.sources.messages import read_lines, stream_lines  # noqa: E402
from orderflow.sources.tables import SourceTables, read_csv, read_source_tables  # noqa: E402
from orderflow.sources.warehouse import read_orders  # noqa: E402
from orderflow.streaming import feed  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from orderflow.llm import queries as corpus_queries  # noqa: E402
except ModuleNotFoundError as error:
    # The library works without its training-corpus part; any other missing module is an error.
    if error.name not in ("corpus_pipeline", "orderflow.llm", "orderflow.llm.queries"):
        raise
    corpus_pipeline = corpus_queries = None

# Stamped as the moment of every run, so that the clock columns can be compared.
RUN_TS = datetime(2020, 1, 1, tzinfo=timezone.utc)


def _tables(spark, sf_dir) -> SourceTables:
    return data.source_tables(spark, sf_dir)


def _messages(spark, sf_dir) -> DataFrame:
    return to_messages(lines.conformed_lines(_tables(spark, sf_dir)))


def _warehouse(spark, sf_dir) -> DataFrame:
    return batch.orders_in_memory(_tables(spark, sf_dir), RUN_TS, **data.LINE_TIERS)


def _staging(spark, sf_dir) -> DataFrame:
    return marts.stg_orders(_warehouse(spark, sf_dir))


def _clock_as_text(orders: DataFrame) -> DataFrame:
    """``loaded_at`` as text, so that comparing values needs no rule for time zones."""
    return orders.withColumn("loaded_at", utc_text(F.col("loaded_at")))


def _nan_apart(orders: DataFrame) -> DataFrame:
    """NaN amounts as a flag, so that comparing values needs no rule for NaN."""
    is_nan = F.isnan("amount")
    return orders.withColumns(
        {
            "amount_is_nan": F.coalesce(is_nan, F.lit(False)),
            "amount": F.when(~is_nan, F.col("amount")),
        }
    )


def order_lines_collapse(spark, sf_dir):
    return lines.order_lines(_tables(spark, sf_dir).items)


def primary_payment(spark, sf_dir):
    return lines.primary_payment(_tables(spark, sf_dir).payments)


def first_event_per_user(spark, sf_dir):
    return lines.first_by(data.table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


def category_fallback(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    return lines.product_categories(tables.products, tables.categories)


def conformed_lines(spark, sf_dir):
    return _messages(spark, sf_dir)


def orders_left_dims_missing(spark, sf_dir):
    """Dimensions that lack some customers, parts, payments and translations."""
    tables = _tables(spark, sf_dir)
    few_customers = data.table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    few_parts = data.table(spark, sf_dir, "part").filter("p_size <= 25")
    some = tables._replace(
        customers=tables.customers.join(
            few_customers.select(F.col("c_custkey").cast("string").alias("customer_id")),
            "customer_id",
            "left_semi",
        ),
        products=tables.products.join(
            few_parts.select(F.col("p_partkey").cast("string").alias("product_id")),
            "product_id",
            "left_semi",
        ),
        payments=tables.payments.filter("payment_type = 'R'"),
    )
    return lines.conformed_lines(some).select(
        "order_id", "product_id", "product_category", "payment_type", "customer_state"
    )


def message_json_roundtrip(spark, sf_dir):
    """Messages written as JSON text and read back."""
    path = work_dir(spark, "messages")
    files.write_messages(_messages(spark, sf_dir), path, compression=files.COMPRESSED)
    return spark.read.schema(S.MESSAGE).json(path)


def csv_tables_roundtrip(spark, sf_dir):
    """All six tables written as CSV, read back, and conformed again."""
    root = work_dir(spark, "csv")
    tables = _tables(spark, sf_dir)
    for name in S.SOURCE_TABLES:
        files.write_csv(getattr(tables, name), f"{root}/{name}", compression=files.COMPRESSED)
    paths = {name: f"{root}/{name}" for name in S.SOURCE_TABLES}
    return to_messages(lines.conformed_lines(read_source_tables(spark, paths)))


def validate_valid(spark, sf_dir):
    checked = validate.check(data.faulty_lines(spark, sf_dir))
    return _nan_apart(validate.valid_orders(checked, RUN_TS))


def validate_dead_letter(spark, sf_dir):
    checked = validate.check(data.faulty_lines(spark, sf_dir))
    return checked.filter("reject_reason IS NOT NULL").select("event_id", "reject_reason")


def reject_reason_counts(spark, sf_dir):
    checked = validate.check(data.faulty_lines(spark, sf_dir))
    return (
        checked.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome"))
        .agg(F.count("*").alias("line_count"))
    )


def routed_write_readback(spark, sf_dir):
    """Both outputs written in one pass, counted as read back from their folders."""
    path = work_dir(spark, "routed")
    checked = validate.check(data.faulty_lines(spark, sf_dir))
    files.write_routed(validate.routed_lines(checked, RUN_TS), path)
    return read_lines(spark, files.valid_path(path)).agg(
        F.lit(validate.VALID).alias("outcome"), F.count("*").alias("line_count")
    ).unionByName(
        read_lines(spark, files.dead_letter_path(path)).agg(
            F.lit(validate.DEAD_LETTER).alias("outcome"), F.count("*").alias("line_count")
        )
    )


def extra_fields_kept(spark, sf_dir):
    """Valid lines as they leave validation with fields outside the layout carried on."""
    checked = validate.check(data.faulty_lines(spark, sf_dir))
    routed = validate.routed_lines(checked, RUN_TS)
    fields = F.from_json("value", "order_id string, status string, note struct<k array<long>>")
    return (
        routed.filter(F.col("outcome") == validate.VALID)
        .select(fields.alias("fields"))
        .select("fields.order_id", "fields.status", F.col("fields.note.k")[0].alias("note_value"))
    )


def dead_letter_table(spark, sf_dir):
    """Dead letters with their reason written as Parquet, counted per reason."""
    path = work_dir(spark, "dead")
    checked = validate.check(data.faulty_lines(spark, sf_dir))
    files.write_dead_letters(validate.dead_letters(checked), path)
    return (
        spark.read.parquet(path)
        .groupBy("reject_reason")
        .agg(F.count("*").alias("line_count"), F.count_distinct("value").alias("texts"))
    )


def value_tier(spark, sf_dir):
    return validate.enrich(data.event_orders(spark, sf_dir), RUN_TS).select(
        "event_id", "amount", "value_tier"
    )


def status_upper(spark, sf_dir):
    return validate.enrich(data.event_orders(spark, sf_dir), RUN_TS).select("event_id", "status")


def order_size(spark, sf_dir):
    return data.table(spark, sf_dir, "lineitem").groupBy(
        order_size_of(F.col("l_quantity")).alias("order_size"), F.col("l_quantity").alias("quantity")
    ).agg(F.count("*").alias("line_count"))


def clean_types(spark, sf_dir):
    return _nan_apart(clean.derived(clean.typed(data.text_events(spark, sf_dir)))).select(
        "processed_at",
        "quantity",
        "unit_price",
        "amount",
        "amount_is_nan",
        "freight_value",
        "order_date",
        "revenue",
        "order_size",
    ).withColumn("revenue", F.when(~F.isnan("revenue"), F.col("revenue")))


def dedup_lines(spark, sf_dir):
    kept = clean.one_per_line(clean.typed(data.text_events(spark, sf_dir)))
    return _nan_apart(kept).select(
        "order_id", "product_id", "customer_id", "amount", "amount_is_nan", "processed_at"
    )


def drop_null_critical(spark, sf_dir):
    kept = clean.drop_incomplete(clean.typed(data.text_events(spark, sf_dir)))
    return kept.select("order_id", "product_id", "customer_id", "amount", "processed_at")


def clean_lines(spark, sf_dir):
    """Repeats, nulls and bad values all the way to warehouse rows."""
    return _clock_as_text(clean.warehouse_rows(data.text_events(spark, sf_dir), RUN_TS))


def orders_warehouse(spark, sf_dir):
    return _clock_as_text(_warehouse(spark, sf_dir))


def stg_orders(spark, sf_dir):
    marts.create_staging_view(_warehouse(spark, sf_dir), "stg_orders")
    return _clock_as_text(spark.table("stg_orders"))


def fct_orders(spark, sf_dir):
    return marts.fct_orders(_staging(spark, sf_dir))


def agg_sales_daily(spark, sf_dir):
    return marts.agg_sales_daily(_staging(spark, sf_dir))


def partitioned_write_readback(spark, sf_dir):
    """The orders table written by date and read back."""
    path = work_dir(spark, "orders")
    tables = data.source_tables(spark, sf_dir)
    rows = batch.orders_in_memory(tables, RUN_TS, **data.LINE_TIERS)
    warehouse_sink.append_orders(rows, path, batch.in_memory_derived(RUN_TS, **data.LINE_TIERS))
    return _clock_as_text(read_orders(spark, path))


def null_dates_readback(spark, sf_dir):
    """Rows without a date survive the partitioned write."""
    path = work_dir(spark, "events")
    warehouse_sink.append_orders(
        clean.warehouse_rows(data.text_events(spark, sf_dir), RUN_TS), path
    )
    return read_orders(spark, path).groupBy("order_date").agg(F.count("*").alias("line_count"))


def repeated_load(spark, sf_dir):
    """The same lines loaded twice leave one copy; then their dates are replaced in place."""
    path = work_dir(spark, "orders")
    rows = clean.warehouse_rows(data.text_events(spark, sf_dir), RUN_TS)
    for _ in range(2):
        append_new_orders(spark, rows, path)
    warehouse_sink.replace_dates(rows.filter("order_date IS NOT NULL"), path)
    return marts.agg_sales_daily(read_orders(spark, path))


def daily_from_loads(spark, sf_dir):
    """Lines that come in three loads, the second one twice; daily sales as the loads' sums give them."""
    path = work_dir(spark, "loads")
    loads = Loads(spark, f"{path}/orders", f"{path}/daily")
    rows = work_dir(spark, "rows")
    clean.warehouse_rows(data.text_events(spark, sf_dir), RUN_TS).write.parquet(rows)
    rows = spark.read.schema(S.WAREHOUSE).parquet(rows)
    third = F.pmod(F.xxhash64(*S.LINE_KEY), F.lit(3))
    for number in (0, 1, 1, 2):
        loads.load(rows.filter(third == number))
    return spark.read.parquet(f"{path}/daily").select(marts.agg_sales_daily(rows).columns)


def dq_after_loads(spark, sf_dir):
    """Lines that come in loads, those of quantity 2 twice; data tests as the loads' states give them."""
    path = work_dir(spark, "tested")
    loads = Loads(spark, f"{path}/orders", tests=f"{path}/tests")
    rows = clean.warehouse_rows(data.text_events(spark, sf_dir), RUN_TS)
    rows.unionByName(rows.filter("quantity = 2")).write.parquet(f"{path}/rows")
    rows = spark.read.schema(S.WAREHOUSE).parquet(f"{path}/rows")
    half = F.pmod(F.xxhash64(*S.LINE_KEY), F.lit(2))
    for number in (0, 1, 1):
        loads.load(rows.filter(half == number))
    return increments.results(spark, f"{path}/tests")


def csv_line_breaks(spark, sf_dir):
    """Cells with line breaks and quotes, written as CSV and read back record by record."""
    path = work_dir(spark, "csv")
    broken = F.concat(F.replace(F.col("product_category_name"), F.lit(" "), F.lit('\n"')), F.lit('"'))
    products = _tables(spark, sf_dir).products.withColumn("product_category_name", broken)
    files.write_csv(products, path)
    return read_csv(spark, path, S.PRODUCTS, multi_line=True)


def load_counts(spark, sf_dir):
    """Rows before and after cleaning, observed while the table is written."""
    before_rows, before = clean.counted(data.text_events(spark, sf_dir), "enriched")
    after_rows, after = clean.counted(clean.warehouse_rows(before_rows, RUN_TS), "warehouse")
    warehouse_sink.append_orders(after_rows, work_dir(spark, "orders"))
    return spark.sql(
        "SELECT :before AS enriched_rows, :after AS warehouse_rows",
        {"before": before.get["rows"], "after": after.get["rows"]},
    ).select(F.col("enriched_rows").cast("long"), F.col("warehouse_rows").cast("long"))


def batch_run_daily(spark, sf_dir):
    """All stages over files: messages, validation, load, marts; the daily mart read back."""
    layout = batch.Layout.under(work_dir(spark, "run"))
    tables = data.source_tables(spark, sf_dir)
    batch.run_all(spark, tables, layout, run_ts=RUN_TS)
    return marts.read_daily(spark, layout.marts)


def sample_lines(spark, sf_dir):
    """A sample of 1,000 messages."""
    return sample.sample_rows(_messages(spark, sf_dir), 1000, S.LINE_KEY, 42).select(
        "order_id", "product_id", "amount"
    )


def sample_by_cut(spark, sf_dir):
    """A larger sample, of 20,000 items."""
    key = ["order_id", "order_item_id", "product_id"]
    return sample.sample_rows(_tables(spark, sf_dir).items, 20_000, key).select(key)


def sample_orders_consistent(spark, sf_dir):
    """1,000 orders and what belongs to them, written and read back: rows per table."""
    path = work_dir(spark, "sample")
    sample_set.write_sample(spark, _tables(spark, sf_dir), path)
    cut = read_source_tables(spark, {name: f"{path}/{name}" for name in S.SOURCE_TABLES})
    counts = [
        getattr(cut, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in S.SOURCE_TABLES
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def dq_not_null(spark, sf_dir):
    rows = clean.typed(data.text_events(spark, sf_dir))
    return quality.null_counts(rows, ["order_id", "customer_id", "amount", "status", "order_date"])


def dq_accepted_values(spark, sf_dir):
    rows = data.text_events(spark, sf_dir)
    return quality.unaccepted_values(rows, "status", ["VIEW", "CLICK", "PURCHASE", *S.STATUSES])


def dq_unique_combination(spark, sf_dir):
    return quality.repeated_keys(_tables(spark, sf_dir).items, S.LINE_KEY)


def dq_model_tests(spark, sf_dir):
    """All data tests of the stored tables after a whole run; nothing fails."""
    layout = batch.Layout.under(work_dir(spark, "run"))
    batch.run_all(spark, data.source_tables(spark, sf_dir), layout, run_ts=RUN_TS)
    return batch.failing_rows(spark, layout)


def revenue_below_a_cent(spark, sf_dir):
    """Daily sales over revenue with parts of a cent, as tables filled by others may hold."""
    staging = _staging(spark, sf_dir).withColumn("revenue", F.col("quantity") / 256)
    return marts.agg_sales_daily(staging)


def landed_line_breaks(spark, sf_dir):
    """Messages spread over several lines land as one line each; what validation says of them."""
    messages = data.faulty_lines(spark, sf_dir).select(
        "event_id", feed.one_line(F.regexp_replace("value", ",", ",\n")).alias("value")
    )
    path = work_dir(spark, "landing")
    messages.select("value").write.text(path)
    checked = validate.check(read_lines(spark, path))
    return (
        checked.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome"))
        .agg(F.count("*").alias("line_count"))
    )


def pulled_messages(spark, sf_dir):
    """The feed landed by pulls of bounded batches, one pull alone first; what validation says of it."""
    root = work_dir(spark, "pulls")
    data.faulty_lines(spark, sf_dir).select("value").repartition(4).write.text(f"{root}/feed")
    for until_empty in (False, True):
        feed.pull(spark, f"{root}/feed", f"{root}/landing", f"{root}/checkpoint", 20_000, until_empty)
    checked = validate.check(read_lines(spark, f"{root}/landing"))
    return (
        checked.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome"))
        .agg(F.count("*").alias("line_count"))
    )


def _landed(spark, sf_dir) -> str:
    """Faulty messages replayed into a feed folder and landed by a stream."""
    root = work_dir(spark, "feed")
    data.faulty_lines(spark, sf_dir).select("value").repartition(4).write.text(f"{root}/feed")
    source = stream_lines(spark, f"{root}/feed", files_per_batch=2)
    feed.land(source, f"{root}/landing", f"{root}/landing-checkpoint").awaitTermination()
    return root


def _validated(spark, sf_dir) -> str:
    """Landed messages validated by a stream that runs twice; the second run finds nothing."""
    root = _landed(spark, sf_dir)
    for _ in range(2):
        feed.validate_stream(
            stream_lines(spark, f"{root}/landing", files_per_batch=2),
            f"{root}/raw",
            f"{root}/raw-checkpoint",
            RUN_TS,
        ).awaitTermination()
    return root


def stream_validate_available_now(spark, sf_dir):
    valid = feed.read_routed(spark, f"{_validated(spark, sf_dir)}/raw", validate.VALID)
    orders = valid.select(F.from_json("value", S.ENRICHED).alias("order")).select("order.*")
    return _nan_apart(orders)


def stream_load_daily(spark, sf_dir):
    """Feed to daily sales by streams alone; the load runs batch by batch."""
    root = _validated(spark, sf_dir)
    feed.load_stream(
        spark,
        feed.stream_enriched(spark, f"{root}/raw", files_per_batch=2),
        f"{root}/orders",
        f"{root}/load-checkpoint",
        daily=f"{root}/daily",
        run_ts=RUN_TS,
    ).awaitTermination()
    return spark.read.parquet(f"{root}/daily").select(
        "order_date",
        "status",
        "customer_state",
        "order_count",
        "line_count",
        "total_revenue",
        "avg_line_value",
    )


def stream_redelivery_new_date(spark, sf_dir):
    """Lines delivered again years later by the stream add nothing: as loaded the first time."""
    root = _validated(spark, sf_dir)
    first = feed.read_routed(spark, f"{root}/raw", validate.VALID)
    again = F.regexp_replace("value", '"created_at":"[0-9]{4}', '"created_at":"2031')
    first.select("value").write.text(f"{root}/twice/outcome={validate.VALID}")
    for folder in ("twice", "later"):
        if folder == "later":
            first.select(again).write.text(f"{root}/later/outcome={validate.VALID}")
        feed.load_stream(
            spark,
            feed.stream_enriched(spark, f"{root}/{folder}", files_per_batch=2),
            f"{root}/orders",
            f"{root}/{folder}-checkpoint",
            run_ts=RUN_TS,
        ).awaitTermination()
    return read_orders(spark, f"{root}/orders").select("order_id", "product_id", "order_date", "revenue")


def stream_dedup(spark, sf_dir):
    """Every event delivered twice, in separate files; one copy of each passes."""
    root = work_dir(spark, "repeats")
    events = data.event_orders(spark, sf_dir).select("order_id", "product_id", "ts", "amount")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        events.write.mode("append").parquet(f"{root}/feed")
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{root}/feed")
    )
    (
        feed.drop_repeats(stream, "ts", "60 days")
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out").select("order_id", "product_id", "amount")


QUERIES = [
    order_lines_collapse,
    primary_payment,
    first_event_per_user,
    category_fallback,
    conformed_lines,
    orders_left_dims_missing,
    message_json_roundtrip,
    csv_tables_roundtrip,
    validate_valid,
    validate_dead_letter,
    reject_reason_counts,
    routed_write_readback,
    extra_fields_kept,
    dead_letter_table,
    value_tier,
    status_upper,
    order_size,
    clean_types,
    dedup_lines,
    drop_null_critical,
    clean_lines,
    orders_warehouse,
    stg_orders,
    fct_orders,
    agg_sales_daily,
    partitioned_write_readback,
    null_dates_readback,
    repeated_load,
    daily_from_loads,
    dq_after_loads,
    csv_line_breaks,
    load_counts,
    batch_run_daily,
    sample_lines,
    sample_by_cut,
    sample_orders_consistent,
    dq_not_null,
    dq_accepted_values,
    dq_unique_combination,
    dq_model_tests,
    revenue_below_a_cent,
    landed_line_breaks,
    pulled_messages,
    stream_validate_available_now,
    stream_load_daily,
    stream_redelivery_new_date,
    stream_dedup,
]


def _ready(spark: SparkSession) -> SparkSession:
    """The session with its settings; one without a shared folder, as in tests, gets its own."""
    configure(spark)
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.conf.get(WORK_DIR, None):
        spark.conf.set(WORK_DIR, tempfile.mkdtemp(prefix="orderflow-"))
    return spark


def _configured(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(_ready(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Daily sales over the whole chain, on the smallest tables."""
    return agg_sales_daily(_ready(spark), "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = {query.__name__: query for query in QUERIES}
    if corpus_queries:
        registered |= {query.__name__: query for query in corpus_queries.QUERIES}
        registered["pipeline"] = corpus_pipeline.run
    return {name: _configured(query) for name, query in registered.items()}


def oracle_sql() -> dict[str, str]:
    more = corpus_queries.SQL if corpus_queries else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        more = more | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return oracle_queries.sql() | more
