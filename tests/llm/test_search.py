"""Ranked search against SQL and a plain scorer."""

import math
import random
from collections import Counter

import pytest

from plumbline.llm import search

DOCS = "doc_id long, text string, n long, terms string, sketch int"
ITEMS = "item_id long, text string, doc_id int"


def brute(docs, items, k=10):
    counted = [(d, Counter(t.decode() for t in search.terms_of(text or ""))) for d, text, *_ in docs]
    counted = [(d, c, c.total()) for d, c in counted if c]
    n, total = len(counted), sum(size for _, _, size in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for i, text, *_ in items:
        wanted.setdefault(i, set()).update(t.decode() for t in search.terms_of(text or ""))
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, c, size in counted:
            m = 10 + 90 * size * n // total
            score = sum(int(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(i, rank, d, -score) for rank, (score, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def made(seed, n=300):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(60)] + ["É1", "ÜBER"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 40))), i, "x", 0) for i in range(n)], rng, words


@pytest.mark.parametrize("block, query_terms", [(1, 50_000), (4, 12), (1000, 50_000)])
def test_brute_force(spark, block, query_terms):
    docs, rng, words = made(block)
    docs += [docs[17]] * 40 + [(None, docs[17][1], 0, "", 0), (None, None, 0, "", 0), (900, "", 0, "", 0), (901, "-- !", 0, "", 0)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 9))), 0) for i in range(25)]
    items += [(3, "t1 more t2", 0), (None, "t5 t6", 0), (50, None, 0), (51, "", 0), (52, "nowhere", 0)]
    found = search.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), block=block, query_terms=query_terms)
    assert rows_of(found) == brute(docs, items)


def test_blocks_are_skipped(spark):
    """Where documents form clusters, most blocks of the opened lists are not read, and the result is still whole."""
    rng, docs = random.Random(3), []
    for topic in range(40):
        own = [f"topic{topic}x{i}" for i in range(12)]
        docs += [(topic * 100 + i, " ".join(rng.choices(own, k=20) + rng.choices(["the", "of", "and"], k=10)), 0, "", 0) for i in range(50)]
    items = [(t, f"topic{t}x1 topic{t}x2 the topic{t + 1}x3", 0) for t in range(0, 38, 3)]
    report = []
    found = search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block=4, report=report)
    assert rows_of(found) == brute(docs, items)
    assert report[0]["opened"] < report[0]["lists"] and report[0]["left"] < report[0]["blocks"]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one, item = spark.createDataFrame([(1, "a b", 0, "", 0)], DOCS), spark.createDataFrame([(1, "a", 0)], ITEMS)
    for d, i in ((docs, items), (one, items), (docs, item)):
        assert search.search(d, i).count() == 0
    assert rows_of(search.search(one, item)) == brute([(1, "a b")], [(1, "a")])


def test_long_text(spark):
    docs = [(1, "far " * 300_000 + "end", 0, "", 0), (2, "x" * 2_000_000, 0, "", 0), (3, "end of it", 0, "", 0)]
    items = [(1, "the end", 0), (2, "far", 0)]
    assert rows_of(search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_sql(agrees):
    assert agrees("op12_search_geometric_blocks") is None
