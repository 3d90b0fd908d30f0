"""Labels derived from amounts, quantities and statuses."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow import schemas as S


def value_tier(amount: Column, medium=S.MEDIUM_AMOUNT, high=S.HIGH_AMOUNT) -> Column:
    """high / medium / low; the limits belong to the upper tier and NaN is low."""
    return (
        F.when(F.isnan(amount), "low")
        .when(amount >= high, "high")
        .when(amount >= medium, "medium")
        .otherwise("low")
    )


def order_size(quantity: Column) -> Column:
    """bulk / standard / single; an unknown quantity is single."""
    return (
        F.when(quantity >= S.BULK_QUANTITY, "bulk")
        .when(quantity >= S.STANDARD_QUANTITY, "standard")
        .otherwise("single")
    )


def run_moment(run_ts: datetime | None) -> Column:
    """The given (time-zone aware) moment of a run, or the clock."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts)


def utc_text(moment: Column) -> Column:
    """ISO-8601 text without a zone, in the session zone (UTC, see ``session.configure``)."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
