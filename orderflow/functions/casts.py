"""Casts that turn a bad value into null instead of failing the job."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGER_TEXT = r"^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$"


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_int(column: Column, source_type: T.DataType) -> Column:
    """32-bit integer; fractions are cut off, for numbers and for number texts alike."""
    if isinstance(source_type, T.StringType):
        column = F.when(column.rlike(_INTEGER_TEXT), column.try_cast("double"))
    return column.try_cast("int")


def to_day(column: Column) -> Column:
    """Calendar day of a timestamp text."""
    return F.try_to_date(column)
