"""Run the stages from the command line or with spark-submit.

    python -m orderflow publish --tables DIR --root DIR [--num-events N] [--seed N]
    python -m orderflow validate|load|model|test --root DIR
    python -m orderflow land --feed DIR --root DIR [--max-messages N]
    python -m orderflow stream-validate|stream-load --root DIR
    python -m orderflow compact --root DIR
    python -m orderflow all --tables DIR --root DIR
    python -m orderflow sample --tables DIR --root DIR [--num-orders N] [--seed N]

``test`` fails if a data test does; ``all`` ends with it. ``land`` and the streams take what is
new since their last run, and stop; ``land --max-messages N`` takes no more than N messages. A
feed is landed either with that limit or without it, for the two keep count in their own ways.

``--tables`` holds one CSV file or folder per source table; ``--pattern`` says how they are
named, with {table} standing for items, orders, payments, products, customers, categories.
``--multi-line`` reads cells with line breaks.
"""

import argparse

from pyspark.sql import SparkSession

from orderflow import schemas as S
from orderflow.plans import batch
from orderflow.plans.sample_set import write_sample
from orderflow.session import WORK_DIR, configure
from orderflow.sinks.loads import Loads
from orderflow.sources.messages import stream_lines
from orderflow.sources.tables import read_source_tables
from orderflow.streaming import feed


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderflow")
    parser.add_argument(
        "stage",
        choices=[
            "publish",
            "validate",
            "load",
            "model",
            "test",
            "all",
            "sample",
            "land",
            "stream-validate",
            "stream-load",
            "compact",
        ],
    )
    parser.add_argument("--root", required=True, help="folder of the written layers")
    parser.add_argument("--tables", help="folder of the source tables")
    parser.add_argument("--pattern", default="{table}.csv", help="name of a table in it")
    parser.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    parser.add_argument("--num-events", type=int, help="publish a sample of this size")
    parser.add_argument("--num-orders", type=int, default=1000, help="orders in a sample set")
    parser.add_argument("--seed", type=int, help="seed of the sample")
    parser.add_argument("--feed", help="folder that message files arrive in")
    parser.add_argument("--max-messages", type=int, help="land no more than so many messages")
    options = parser.parse_args(arguments)

    spark = configure(SparkSession.builder.appName("orderflow").getOrCreate())
    layout = batch.Layout.under(options.root)

    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.conf.get(WORK_DIR, None):
        spark.conf.set(WORK_DIR, f"{options.root}/work")

    def tables(every_column: bool = False):
        if not options.tables:
            parser.error(f"{options.stage} needs --tables")
        return read_source_tables(
            spark,
            {
                name: f"{options.tables}/{options.pattern.format(table=name)}"
                for name in S.SOURCE_TABLES
            },
            every_column,
            options.multi_line,
        )

    if options.stage == "sample":
        write_sample(spark, tables(every_column=True), options.root, options.num_orders, options.seed)
        return
    if options.stage == "land":
        if not options.feed:
            parser.error("land needs --feed")
        checkpoint = f"{options.root}/checkpoints/land"
        if options.max_messages:
            landed = feed.pull(
                spark, options.feed, layout.landing, checkpoint, options.max_messages
            )
            print(f"messages landed: {landed}")
        else:
            lines = stream_lines(spark, options.feed)
            feed.land(lines, layout.landing, checkpoint).awaitTermination()
    if options.stage == "stream-validate":
        feed.validate_stream(
            stream_lines(spark, layout.landing),
            layout.stream_raw,
            f"{options.root}/checkpoints/validate",
        ).awaitTermination()
    if options.stage == "stream-load":
        feed.load_stream(
            spark,
            feed.stream_enriched(spark, layout.stream_raw),
            layout.warehouse,
            f"{options.root}/checkpoints/load",
            daily=layout.stream_daily,
        ).awaitTermination()
    if options.stage == "compact":
        Loads(spark, layout.warehouse, layout.stream_daily).compact()
    if options.stage in ("publish", "all"):
        batch.publish(tables(), layout, options.num_events, options.seed)
    if options.stage in ("validate", "all"):
        batch.validate(spark, layout)
    if options.stage in ("load", "all"):
        counts = batch.load(spark, layout)
        print(f"rows read: {counts['enriched']}, rows after cleaning: {counts['warehouse']}")
    if options.stage in ("model", "all"):
        batch.model(spark, layout)
    if options.stage in ("test", "all"):
        batch.run_tests(spark, layout)


if __name__ == "__main__":
    main()
