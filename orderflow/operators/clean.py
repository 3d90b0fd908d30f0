"""Type, deduplicate and derive: from enriched orders to warehouse rows."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.casts import to_day, to_double, to_int
from orderflow.functions.labels import order_size, run_moment
from orderflow.functions.money import round_half_up

MONEY = ["amount", "unit_price", "freight_value"]


def _complete() -> Column:
    return (
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("amount").isNotNull()
        & ~F.isnan("amount")
    )


def cast_fields(orders: DataFrame) -> DataFrame:
    """Numbers as numbers and the order day; bad values become null."""
    return orders.withColumns(
        {
            **{name: to_double(F.col(name)) for name in MONEY},
            "quantity": to_int(F.col("quantity"), orders.schema["quantity"].dataType),
            "order_date": to_day(F.col("created_at")),
        }
    )


def round_money(orders: DataFrame) -> DataFrame:
    return orders.withColumns({name: round_half_up(F.col(name)) for name in MONEY})


def typed(orders: DataFrame) -> DataFrame:
    """Typed fields, money rounded to cents."""
    return round_money(cast_fields(orders))


def revenue(amount: Column) -> Column:
    return round_half_up(amount + F.col("freight_value"))


def derived(orders: DataFrame) -> DataFrame:
    """Revenue (amount plus freight) and order size."""
    return orders.withColumns(
        {
            "revenue": revenue(F.col("amount")),
            "order_size": order_size(F.col("quantity")),
        }
    )


def drop_incomplete(orders: DataFrame) -> DataFrame:
    """Drop rows without an order, a customer or an amount (null or NaN)."""
    return orders.dropna(subset=S.CRITICAL)


def one_per_line(orders: DataFrame) -> DataFrame:
    """One row per (order, product); null keys count as equal.

    Complete rows win, then the latest ``processed_at``, then the greatest values of the
    other columns, so the survivor does not depend on partitioning. The maximum of a
    struct is found with a map-side combine: a line with very many copies sends one row
    per task and never meets in one place.
    """
    rest = [name for name in orders.columns if name not in S.LINE_KEY]
    rank = ["processed_at"] if "processed_at" in rest else []
    ranked = rank + [name for name in rest if name not in rank]
    best = F.max(F.struct(_complete().alias("_complete"), *ranked))
    return (
        orders.groupBy(*S.LINE_KEY).agg(best.alias("_best")).select(*S.LINE_KEY, "_best.*")
    ).select(orders.columns)


def any_per_line(orders: DataFrame) -> DataFrame:
    """One arbitrary row per (order, product), for inputs whose copies are identical."""
    return orders.dropDuplicates(S.LINE_KEY)


def clean_lines(enriched: DataFrame, merged: bool = True) -> DataFrame:
    """Typed, complete, unique rows with their derived columns; no clock columns added.

    Deduplication prefers complete rows and rounding keeps null and NaN as they are, so
    dropping the incomplete rows first gives the same result as dropping them last, and
    they are never shuffled. Without ``merged`` repeats of a line stay in, for a sink that looks
    for them among the rows it has stored; see ``stored_once``.
    """
    rows = round_money(drop_incomplete(cast_fields(enriched)))
    return derived(one_per_line(rows) if merged else rows)


def warehouse_rows(enriched: DataFrame, run_ts: datetime | None = None, merged: bool = True) -> DataFrame:
    """The 19 warehouse columns in their fixed order; ``merged``: see ``clean_lines``."""
    return clean_lines(enriched, merged).withColumn("loaded_at", run_moment(run_ts)).select(S.ORDER_COLUMNS)


def stored_once(rows: DataFrame) -> DataFrame:
    """Warehouse rows made without ``merged``, one for each line: the one that ``clean_lines`` keeps.

    Columns compare in the order they have before cleaning; derived ones come last and decide nothing.
    """
    ranked = [*S.ENRICHED.names, *[name for name in rows.columns if name not in S.ENRICHED.names]]
    return one_per_line(rows.select(ranked)).select(rows.columns)


def warehouse_derived(run_ts: datetime | None = None) -> dict[str, Column]:
    """How columns of ``warehouse_rows`` follow from its others, so that a sink need not move them."""
    found = {"revenue": revenue(F.col("amount")), "order_size": order_size(F.col("quantity"))}
    return found if run_ts is None else found | {"loaded_at": run_moment(run_ts)}


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while whatever job uses them runs (``observation.get``)."""
    observation = Observation(name)
    return rows.observe(observation, F.count(F.lit(1)).alias("rows")), observation
