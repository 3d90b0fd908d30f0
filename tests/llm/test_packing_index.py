"""The shard index against BM25 written out plainly, over all tokens and all documents."""

import math
from collections import Counter

import numpy as np
import pytest

from orderflow.llm import packing


def shard(seed, count, vocabulary=300):
    """Documents of frequent and rare tokens, some near copies, a very long one, some of one token."""
    chance = np.random.default_rng(seed)
    ids = []
    for n in range(count):
        size = 5000 if n == 7 else int(chance.integers(1, 120))
        own = (chance.pareto(0.6, size) * 4).astype(np.int64) % vocabulary
        if n % 9 == 8:
            own = ids[n - 3].copy()
            own[: len(own) // 10] = chance.integers(0, vocabulary, len(own) // 10)
        ids.append(np.append(own, 1).astype("<u2"))
    holders = np.bincount(np.concatenate([np.unique(own) for own in ids]), minlength=vocabulary)
    return ids, packing._idf(holders.astype(float), float(count))


def plain_scores(ids, idf, doc):
    mean = sum(map(len, ids)) / len(ids)
    out = []
    for own in ids:
        counts, total = Counter(own.tolist()), 0.0
        for token in set(ids[doc].tolist()):
            if token in counts:
                relative = 1 - 0.75 + 0.75 * len(own) / mean
                total += idf[token] * counts[token] * 2.2 / (counts[token] + 1.2 * relative)
        out.append(total)
    return out


@pytest.mark.parametrize("count", [1, 2, 60, 150])
def test_scores_of_all_documents_for_all_tokens(count):
    ids, idf = shard(count, count)
    index = packing.Index(ids, idf)
    for doc in range(0, count, max(1, count // 12)):
        assert index.scores(doc) == pytest.approx(plain_scores(ids, idf, doc), rel=1e-5)


def test_neighbours_come_nearest_first_and_none_that_fits_is_left_out():
    ids, idf = shard(3, 150)
    index, unused = packing.Index(ids, idf), np.ones(150, bool)
    unused[::5] = False
    scores = index.scores(4)
    every = [d for d in np.lexsort((np.arange(150), -scores)).tolist() if unused[d] and scores[d] > 0]
    assert list(index.neighbours(4, unused, lambda: 10**9)) == every
    small = list(index.neighbours(4, unused, lambda: 40))
    assert small == every[: packing._AT_ONCE] + [d for d in every[packing._AT_ONCE :] if len(ids[d]) <= 40]
    assert any(len(ids[d]) > 40 for d in every[packing._AT_ONCE :])


def test_every_near_copy_is_the_nearest_neighbour():
    ids, idf = shard(5, 150)
    index = packing.Index(ids, idf)
    long_ones = [n for n in range(8, 150, 9) if len(ids[n]) > 40]
    for copy in long_ones:
        unused = np.ones(150, bool)
        unused[[copy, 7]] = False  # the very long document holds nearly all tokens
        assert next(index.neighbours(copy, unused, lambda: 10**9)) == copy - 3


@pytest.mark.parametrize("seed", range(4))
def test_windows_are_full_and_hold_each_token_once(seed):
    ids, idf = shard(seed, 120)
    pieces = packing.fill(ids, idf, 256)
    seen = [np.zeros(len(own), int) for own in ids]
    filled = Counter()
    for doc, start, length, sequence, offset in pieces:
        seen[doc][start : start + length] += 1
        assert offset == filled[sequence]
        filled[sequence] += length
    assert all((own == 1).all() for own in seen)
    assert all(size & (size - 1) == 0 for size in filled.values())
