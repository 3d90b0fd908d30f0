"""The validation contract, line by line."""

import json
import random
from datetime import datetime

import pytest

from orderflow.operators import validate

BASE = {
    "order_id": "A-77",
    "customer_id": "buyer 5",
    "product_id": "lamp/9",
    "amount": 61.3,
    "status": "invoiced",
}
GOOD = json.dumps(BASE)


def order(**changes):
    fields = {**BASE, **changes}
    return json.dumps({name: value for name, value in fields.items() if value is not ...})


CASES = {
    # line: expected reason, None for a valid line
    GOOD: None,
    "order 77, 61.30": "malformed_json",
    "": "malformed_json",
    "   ": "malformed_json",
    GOOD[:-1]: "malformed_json",
    GOOD + " tail": "malformed_json",
    GOOD + "] tail": "malformed_json",
    GOOD + "]": "malformed_json",
    GOOD + "} tail": "malformed_json",
    GOOD + ", " + GOOD: "malformed_json",
    GOOD + GOOD: "malformed_json",
    GOOD.replace('"', "'"): "malformed_json",
    GOOD + "   ": None,
    "[]": "not_an_object",
    "[" + GOOD + "]": "not_an_object",
    "5": "not_an_object",
    '"s"': "not_an_object",
    "null": "not_an_object",
    "true": "not_an_object",
    "5] 3": "malformed_json",
    "{}": "missing_order_id",
    order(customer_id=...): "missing_customer_id",
    order(amount=0): "missing_amount",
    order(amount=0.0): "missing_amount",
    order(amount=-5): "non_positive_amount",
    order(amount="12"): "bad_type_amount",
    order(amount=True): "bad_type_amount",
    order(amount=[1]): "bad_type_amount",
    order(amount={"a": 1}): "bad_type_amount",
    order(amount="NaN"): "bad_type_amount",
    order(status=5): "bad_type_status",
    order(status=True): "bad_type_status",
    order(status=["a"]): "bad_type_status",
    order(status="5"): None,
    order(status="true"): None,
    order(order_id="0"): None,
    order(order_id="false"): None,
    order(order_id="[]"): None,
    order(order_id=7): None,
    order(amount=float("nan")): None,
    order(amount=float("inf")): None,
    order(note={"k": [{"a": 1}]}): None,
    GOOD[:-1] + ', "amount": 7}': None,
    GOOD[:-1] + ', "amount": "x"}': "bad_type_amount",
    GOOD[:-1] + ', "status": ""}': "missing_status",
    **{
        order(**{field: empty}): f"missing_{field}"
        for field in BASE
        for empty in (None, "", 0, False, [], {})
    },
}


@pytest.fixture(scope="module")
def checked(spark):
    lines = spark.createDataFrame([(line,) for line in CASES], "value string").repartition(4)
    return {row.value: row for row in validate.check(lines).collect()}


def test_reasons(checked):
    assert set(checked) == set(CASES)
    wrong = {
        line: (row.reject_reason, CASES[line])
        for line, row in checked.items()
        if row.reject_reason != CASES[line]
    }
    assert not wrong


def test_parsed_values(checked):
    repeated = checked[GOOD[:-1] + ', "amount": 7}']
    assert repeated.order.amount == 7.0
    assert checked[order(order_id=7)].order.order_id == "7"


def enriched(spark, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    return validate.valid_orders(validate.check(frame)).collect()


def test_valid_order_is_enriched(spark):
    (row,) = enriched(spark, GOOD)
    assert row.status == "INVOICED"
    datetime.fromisoformat(row.processed_at)
    assert row.quantity is None and row.created_at is None


def test_number_texts_in_optional_fields_are_kept(spark):
    (row,) = enriched(spark, order(quantity="2", unit_price="3.5", freight_value="x"))
    assert (row.quantity, row.unit_price, row.freight_value) == (2, 3.5, None)


def test_value_tiers(spark):
    # The limits, and the last amounts below them.
    tiers = {79.99: "low", 80: "medium", 249.99: "medium", 250: "high"}
    tiers |= {0.01: "low", 133.7: "medium", 4321.5: "high"}
    rows = enriched(spark, *[order(amount=amount) for amount in tiers])
    assert {row.amount: row.value_tier for row in rows} == tiers
    (nan,) = enriched(spark, order(amount=float("nan")))
    assert nan.value_tier == "low"


def test_split_keeps_every_line(spark):
    lines = spark.createDataFrame([(line,) for line in CASES], "value string")
    checked = validate.check(lines)
    rejected = validate.dead_letters(checked).collect()
    assert {row.value for row in rejected} == {line for line, why in CASES.items() if why}
    routed = validate.routed_lines(checked).collect()
    assert len(routed) == len(CASES)
    valid = [json.loads(row.value) for row in routed if row.outcome == validate.VALID]
    assert len(valid) == sum(why is None for why in CASES.values())
    assert all("value_tier" in document for document in valid)
    dead = {row.value for row in routed if row.outcome == validate.DEAD_LETTER}
    assert dead == {row.value for row in rejected}


def test_extra_fields_are_carried_on(spark):
    extra = {"note": {"k": [1, None, "{x"]}, "flag": True, "{": 1.5}
    lines = [order(**extra), order(value_tier="mine"), GOOD, "bad"]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    routed = validate.routed_lines(validate.check(frame)).collect()
    valid = [json.loads(row.value) for row in routed if row.outcome == validate.VALID]
    assert {name: valid[0][name] for name in extra} == extra
    assert valid[0]["status"] == "INVOICED"
    assert valid[1]["value_tier"] == "low"
    assert valid[0].keys() - extra.keys() == valid[1].keys() == valid[2].keys()
    assert [row.value for row in routed if row.outcome == validate.DEAD_LETTER] == ["bad"]


def is_valid(line):
    """The contract in plain Python, for lines without special cases of number tokens."""
    try:
        document = json.loads(line)
    except ValueError:
        return False
    if not isinstance(document, dict) or not all(document.get(name) for name in BASE):
        return False
    amount, status = document["amount"], document["status"]
    if isinstance(amount, bool) or not isinstance(amount, (int, float)):
        return False
    return not amount <= 0 and isinstance(status, str)


def damaged_lines(count):
    pick = random.Random(11)
    values = [
        "x", "", " ", "0", "0.0", "false", "null", "[]", "{}", "-1", "é\"\\/\t", "NaN", "] }",
        0, 0.0, -0.0, 1, -1, 1e-9, 1e300, 12345678901234567890, 2.50, True, False, None,
        [], [0], [[]], {}, {"a": 0}, {"a": [{"b": 1}]}, float("nan"), float("inf"), -float("inf"),
    ]
    pieces = list('{}[],:"\\ 0a-') + ["}]", "]}", '"amount":1,', "null", "\t", "//", "tru"]
    lines = set()
    while len(lines) < count:
        fields = dict(BASE)
        for _ in range(pick.randrange(3)):
            fields[pick.choice([*BASE, "quantity", "note"])] = pick.choice(values)
        if pick.random() < 0.2:
            fields.pop(pick.choice(list(fields)))
        line = json.dumps(fields, ensure_ascii=pick.random() < 0.5)
        for _ in range(pick.choice([0, 0, 1, 1, 2])):
            at = pick.randrange(len(line) + 1)
            if pick.random() < 0.5:
                line = line[:at] + pick.choice(pieces) + line[at:]
            else:
                line = line[:at] + line[at + pick.randrange(1, 4) :]
        lines.add(line)
    return sorted(lines)


def test_damaged_lines_agree_with_python(spark):
    lines = damaged_lines(6000)
    frame = spark.createDataFrame([(line,) for line in lines], "value string").repartition(8)
    checked = validate.check(frame)
    found = {row.value: row.reject_reason for row in checked.select("value", "reject_reason").collect()}
    assert len(found) == len(lines)
    wrong = [(line, found[line]) for line in lines if (found[line] is None) != is_valid(line)]
    assert not wrong, wrong[:5]
    assert sum(reason is None for reason in found.values()) > 500
