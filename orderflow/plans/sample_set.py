"""A small, consistent copy of the six source tables."""

from pyspark.sql import DataFrame, SparkSession

from orderflow.operators.sample import cut_to_orders, matching, sample_rows
from orderflow.session import work_dir
from orderflow.sinks.files import write_csv
from orderflow.sources.tables import SourceTables


def write_sample(
    spark: SparkSession, tables: SourceTables, path: str, n: int = 1000, seed: int | None = 42
) -> None:
    """Sample ``n`` orders and write all six tables cut down to them as CSV, with all their columns.

    The sampled orders and items are stored as Parquet first, so the big tables are not
    sampled again for each output and keys stay what they are, line breaks included.
    """
    orders = _stored(sample_rows(tables.orders, n, ["order_id"], seed), "sample-orders")
    items = _stored(matching(tables.items, orders, "order_id"), "sample-items")
    sample = cut_to_orders(tables._replace(items=items), orders)
    for name in SourceTables._fields:
        write_csv(items if name == "items" else getattr(sample, name), f"{path}/{name}")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    folder = work_dir(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
