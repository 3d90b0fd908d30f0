"""Split message lines into valid, enriched orders and dead letters, in one pass."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow import schemas as S
from orderflow.functions.casts import to_double, to_int
from orderflow.functions.labels import run_moment, utc_text, value_tier
from orderflow.functions.order_json import (
    amount_is_number,
    amount_of,
    reject_reason,
    single_order,
)

VALID = "valid"
DEAD_LETTER = "dead_letter"


def _field(order: Column, name: str) -> Column:
    if name == "quantity":
        return to_int(order[name], T.StringType())
    if name in ("unit_price", "freight_value"):
        return to_double(order[name])
    return order[name]


def check(lines: DataFrame) -> DataFrame:
    """Every line (``value``) with its parsed ``order`` and its ``reject_reason``.

    No row is lost: ``reject_reason`` is null for valid lines, ``order`` null when the
    line holds no single JSON object.
    """
    # A generator's output is computed once, however many filters and columns use it.
    parsed = lines.select("*", F.explode_outer(single_order(F.col("value"))).alias("parsed"))
    order = F.col("parsed")
    measured = parsed.withColumns(
        {"amount": amount_of(order), "amount_is_number": amount_is_number(order)}
    )
    fields = [
        (F.col("amount") if name == "amount" else _field(order, name)).alias(name)
        for name in S.MESSAGE.names
    ]
    reason = reject_reason(F.col("value"), order, F.col("amount"), F.col("amount_is_number"))
    return measured.select(
        *lines.columns, F.struct(*fields).alias("order"), reason.alias("reject_reason")
    )


def enrich(
    orders: DataFrame,
    run_ts: datetime | None = None,
    medium: float = S.MEDIUM_AMOUNT,
    high: float = S.HIGH_AMOUNT,
) -> DataFrame:
    """Upper-case the status, stamp the processing time and assign the value tier."""
    return orders.withColumns(
        {
            "status": F.upper("status"),
            "processed_at": utc_text(run_moment(run_ts)),
            "value_tier": value_tier(F.col("amount"), medium, high),
        }
    )


def valid_orders(checked: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """The 15 columns of each accepted order."""
    accepted = checked.filter(F.col("reject_reason").isNull()).select("order.*")
    return enrich(accepted, run_ts)


def dead_letters(checked: DataFrame) -> DataFrame:
    """Rejected lines as they came in, with the reason."""
    return checked.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def _with_extra_fields(document: Column, line: Column) -> Column:
    """The order's JSON text with the line's fields outside the layout appended."""
    fields = F.from_json(line, "map<string,variant>")
    extra = F.map_filter(fields, lambda name, _: ~name.isin(S.ENRICHED.names))
    opened = F.left(document, F.length(document) - 1)
    more = F.size(F.array_except(F.json_object_keys(line), F.lit(S.ENRICHED.names))) > 0
    return F.when(
        more, F.concat(opened, F.lit(","), F.substr(F.to_json(extra), F.lit(2)))
    ).otherwise(document)


def routed_lines(checked: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Both outputs as text with an ``outcome``, ready for one partitioned write.

    Valid lines become the enriched order as JSON, rejected lines stay as they came in.
    One pass over the input serves both, with nothing cached. Fields outside the layout are
    carried on; only a line whose field names show some is parsed again as a map.
    """
    opened = checked.select("value", "reject_reason", "order.*")
    enriched = enrich(opened, run_ts)
    document = F.to_json(F.struct(*S.ENRICHED.names), {"ignoreNullFields": "false"})
    document = _with_extra_fields(document, F.col("value"))
    accepted = F.col("reject_reason").isNull()
    return enriched.select(
        F.when(accepted, document).otherwise(F.col("value")).alias("value"),
        F.when(accepted, VALID).otherwise(DEAD_LETTER).alias("outcome"),
    )
