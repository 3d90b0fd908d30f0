"""The six source tables, from CSV files or from DataFrames the caller already has."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow import schemas as S
from orderflow.sources.quoted import read_records


class SourceTables(NamedTuple):
    items: DataFrame
    orders: DataFrame
    payments: DataFrame
    products: DataFrame
    customers: DataFrame
    categories: DataFrame


def _typed(cell: Column, field: T.StructField) -> Column:
    value = F.when(~cell.isin(S.NA_TOKENS), cell)
    if not isinstance(field.dataType, T.StringType):
        value = value.try_cast(field.dataType)
    return value.alias(field.name)


def read_csv(
    spark: SparkSession, path, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Header CSV with columns found by name; cells that mean "no value" become null.

    Cells are read as text, so there is no inference pass over the data. Without a schema
    every column is kept as text. ``multi_line`` allows line breaks in quoted cells; files are
    still read by many tasks each.
    """
    options = {"header": True, "escape": '"'}
    raw = spark.read.options(**options).csv(path)
    if multi_line:
        cells = F.from_csv("text", ", ".join(f"`{name}` string" for name in raw.columns), {"escape": '"'})
        raw = read_records(spark, path).select(cells.alias("cells")).select("cells.*")
    if schema is None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in raw.columns])
    return raw.select([_typed(raw[field.name], field) for field in schema])


def read_source_tables(
    spark: SparkSession, paths: dict[str, str], every_column: bool = False, multi_line: bool = False
) -> SourceTables:
    """Read all six tables; ``paths`` maps each table name to a file, folder or glob.

    Only the columns that the stages use, typed, unless ``every_column`` is wanted, as text.
    """
    return SourceTables(
        **{
            name: read_csv(spark, paths[name], None if every_column else schema, multi_line)
            for name, schema in S.SOURCE_TABLES.items()
        }
    )
