"""Personal data in long texts: many spans at a cost in proportion, the same as a plain search of all pairs."""

import random

import pytest

from orderflow.llm import pii


@pytest.fixture(scope="module")
def weights():
    return pii.fit(pii.examples())


def test_stretches_met_as_a_search_of_all_of_them_says():
    chance = random.Random(2)
    for _ in range(300):
        spans = [(b, b + chance.randrange(1, 9)) for b in (chance.randrange(60) for _ in range(chance.randrange(9)))]
        taken = pii.Taken(spans)
        for _ in range(40):
            begin = chance.randrange(70)
            end = begin + chance.randrange(1, 9)
            assert taken.meets(begin, end) == any(begin < e and b < end for b, e in spans)


def test_added_spans_are_those_of_the_model_that_overlap_no_base_span(weights):
    chance = random.Random(4)
    parts = ["x [at] y.com", "a@b.cd", "10.0.0.1", "(614) 555-8001", "+1 614 555 8001", "4111 1111 1111 1111", "at", "7"]
    for _ in range(300):
        text = " ".join(chance.choice(parts) for _ in range(chance.randrange(25)))
        base, spans = pii.all_spans(text, weights)
        added = [
            (kind, begin, end)
            for kind, begin, end in pii.best_spans(text, weights)
            if not any(begin < e and b < end for _, b, e in base)
        ]
        assert spans == sorted({*base, *added}, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))


def test_a_text_of_many_spans_costs_in_proportion(weights):
    # 200,000 base spans: comparing each added one with all of them would take hours.
    line = "mail a@b.cd or 10.0.0.1 or (614) 555-8001 "
    base, spans = pii.all_spans(line * 100_000, weights)
    assert len(base) == 200_000 and len(spans) == 300_000


def test_long_runs_of_digits_and_marks(weights):
    chance = random.Random(6)
    text = "".join(chance.choice("0123456789.-() +") for _ in range(200_000))
    base, spans = pii.all_spans(text, weights)
    assert base == pii.base_spans(text) and set(base) <= set(spans)
