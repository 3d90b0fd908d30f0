"""Components of links: the smallest node reached, in no more rounds than needed."""

import random

from pyspark.sql import functions as F

from orderflow.llm import graph


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def roots(frame):
    rows = [(r.node, r.root) for r in frame.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def frame(spark, links):
    return spark.createDataFrame(links, "a long, b long")


def test_components(spark):
    pick = random.Random(1)
    chain = [(k, k + 1) for k in range(1000, 1060)]
    any_links = [(pick.randrange(-90, 90), pick.randrange(-90, 90)) for _ in range(70)]
    for links in (chain, any_links + any_links, [(5, 5)], [], [(3, 1), (3, 2)], [(-(2**63), 2**63 - 1)]):
        assert roots(graph.components(frame(spark, links))) == plain(links)


def test_stars_need_one_look(spark, monkeypatch):
    """Four tables were stored to see that links were stars already, and four more for the result."""
    stored = []
    written = graph.written
    monkeypatch.setattr(graph, "written", lambda rows, name: stored.append(name) or written(rows, name))
    star = [(k, 1) for k in range(2, 30)]
    assert roots(graph.components(frame(spark, star))) == plain(star)
    assert stored == ["links", "lowest"]


def test_joined_classes(spark):
    links, more = [(1, 4), (4, 6), (2, 7), (3, 8)], [(2, 1), (9, 3), (20, 21)]
    first = graph.components(frame(spark, links))
    assert roots(graph.joined(first, frame(spark, more))) == plain(links + more)
    assert roots(graph.joined(first, frame(spark, more).filter(F.lit(False)))) == plain(links)
