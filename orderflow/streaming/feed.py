"""Streams from message feed to orders table.

Every stream drains what is available and stops; offsets are committed after the output,
so a rerun picks up where the last run ended and a crash repeats at most one batch.
"""

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from orderflow import schemas as S
from orderflow.functions.order_json import is_document
from orderflow.operators.clean import warehouse_rows
from orderflow.operators.validate import VALID, check, routed_lines
from orderflow.plans.marts import agg_sales_daily, stg_orders
from orderflow.session import full_files
from orderflow.sinks.loads import Loads
from orderflow.sources.pulls import stream_messages
from orderflow.sources.warehouse import on_dates_of, read_orders


def one_line(message: Column) -> Column:
    """A message as one line of text.

    Line breaks of a whole JSON document are white space and become blanks. Any other message
    keeps them as escapes, and so stays the dead letter it is.
    """
    broken = message.rlike("[\\r\\n]")
    blanks = F.regexp_replace(message, "[\\r\\n]+", " ")
    escaped = F.replace(F.replace(message, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    whole = is_document(message)
    return F.when(broken & whole, blanks).when(broken, escaped).otherwise(message)


def land(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append feed messages to the landing folder, one line each; no message can block it."""
    return _start(_landing(lines, path, checkpoint).trigger(availableNow=True), lines.sparkSession)


def _start(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a stream that hands over files; a query keeps the settings it was started with."""
    with full_files(spark):
        return writer.start()


def _landing(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Lines of a batch move once, so that they fill few files, not one for each task that reads the feed."""
    return (
        lines.select(one_line(F.col("value")).alias("value"))
        .hint("rebalance")
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def pull(
    spark: SparkSession, feed: str, path: str, checkpoint: str, max_messages: int, until_empty: bool = False
) -> int:
    """Land at most ``max_messages`` messages of a feed folder; returns how many it were.

    With ``until_empty`` such batches follow one another until the feed has no more. A batch that
    was cut off is landed again whole by the next pull, and counts there; none is lost or landed twice.
    """
    lines = stream_messages(spark, feed, f"{checkpoint}/messages", max_messages)
    if until_empty:
        query = _start(_landing(lines, path, checkpoint), spark)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query = land(lines, path, checkpoint)
        query.awaitTermination()
    return sum(progress.numInputRows for progress in query.recentProgress)


def validate_stream(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """Split new lines into valid orders and dead letters under ``path``.

    The file sink lists committed files in its own log, so a batch repeated after a
    crash leaves no duplicates; read the folder itself and filter on ``outcome``. Lines are
    validated by all tasks and then gathered by outcome, so a batch leaves few files.
    """
    writer = (
        routed_lines(check(lines), run_ts)
        .hint("rebalance", "outcome")
        .writeStream.format("text")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _start(writer, lines.sparkSession)


def read_routed(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """Committed lines of one outcome (one directory is read)."""
    return spark.read.text(path).filter(F.col("outcome") == outcome).select("value")


def stream_enriched(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Valid orders committed by ``validate_stream``, every field as text."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    schema = T.StructType([*S.ENRICHED_TEXT.fields, T.StructField("outcome", T.StringType())])
    return reader.schema(schema).json(path).filter(F.col("outcome") == VALID).drop("outcome")


def drop_repeats(orders: DataFrame, event_time: str, within: str) -> DataFrame:
    """Drop repeated deliveries of a line whose event times lie ``within`` of each other.

    ``event_time`` names a timestamp column. Keys are forgotten once the watermark has
    passed, which bounds the state; rows older than the watermark are dropped by Spark, so
    ``within`` must cover the longest delay. Rows without an event time pass through. The
    orders table removes any repeats that are left.
    """
    return orders.withWatermark(event_time, within).dropDuplicatesWithinWatermark(S.LINE_KEY)


def load_stream(
    spark: SparkSession,
    enriched: DataFrame,
    warehouse: str,
    checkpoint: str,
    daily: str | None = None,
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """Append new lines to the orders table and add them to the daily sales.

    Each batch is a load named by checkpoint and number, so one that is delivered again after
    a crash is known by its name, or settled from where it was cut off.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()
    loads = Loads(spark, warehouse, daily)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        loads.load(warehouse_rows(batch, run_ts), f"{stream}-{batch_id}")

    return (
        enriched.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_daily(spark: SparkSession, rows: DataFrame, warehouse: str, daily: str) -> None:
    """Recompute daily sales of the dates that occur in ``rows`` from the lines of the orders table.

    For tables that were changed other than by loads; loads add their own sums.
    """
    staging = stg_orders(on_dates_of(read_orders(spark, warehouse), rows))
    (
        agg_sales_daily(staging)
        .hint("rebalance", "order_date")
        .write.partitionBy("order_date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(daily)
    )
