"""Decontamination against SQL and a brute force search."""

import hashlib
import re

import pytest

from plumbline.llm import decontaminate


def brute(text, items):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        size = min(10, len(w))
        for g in {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if size and item is not None else ():
            for i in range(len(own) - size + 1):
                if tuple(own[i:i + size]) == g:
                    hit |= set(range(i, i + size))
                    found.add(str(item))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (10, "short item"), (3, None), (4, "!!!"),
         (5, "ÉCOLE école x9"), (None, "never used words"), (1, "another text of item one"), (6, "na na na na na na na na na na na")]
DOCS = [(1, "x ALPHA-beta gamma, delta epsilon zeta eta theta iota kappa lambda mu y"), (2, "beta gamma delta epsilon zeta eta theta iota kappa"),
        (3, "a short  item and Short Item"), (3, "a short  item and Short Item"), (4, None), (5, ""), (None, "École x9 ÉCOLE école x9"), (6, "never used words"),
        (7, "na " * 25), (8, "short " * 50_000 + "item"), (9, "clean words only, nothing here")]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 120])
def test_edge_cases(spark, limit):
    docs = spark.createDataFrame([(d, t, 1, "m") for d, t in DOCS], "doc_id long, text string, n_hit int, m string")
    bench = spark.createDataFrame([(i, t, "e") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = sorted(map(tuple, decontaminate.contamination(docs, bench, limit=limit).collect()), key=str)
    assert got == sorted(((d, *brute(t, ITEMS)) for d, t in DOCS), key=str)
    kept = decontaminate.decontaminate(docs, bench, limit=limit)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, t in DOCS if not brute(t, ITEMS)[-1])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench, "spans", limit=limit).collect()}
    assert len(cut) == len({d for d, _ in DOCS}) and cut[9] == DOCS[-1][1] and cut[4] is None
    assert cut[1] == "x  y" and cut[3] == "a  and "


def test_one_slice_at_a_time(spark, monkeypatch):
    """Beyond the limit no two slices are held by the tasks at once, and the result is the same."""
    items = [(i, f"item {i} holds some words of its own, number {i * 7} of many, and ends here {i}") for i in range(60)]
    docs = [(i, f"before item {i} holds some words of its own, number {i * 7} of many, and ends here {i} after") for i in range(0, 90, 4)]
    alive, most = set(), []
    context = type(spark.sparkContext)
    broadcast = context.broadcast

    def counted(self, value):
        made = broadcast(self, value)
        if isinstance(value, decontaminate.NGrams):
            destroy = made.destroy
            alive.add(id(made))
            most.append(len(alive))
            made.destroy = lambda *a, **k: (alive.discard(id(made)), destroy(*a, **k))[1]
        return made

    monkeypatch.setattr(context, "broadcast", counted)
    rows, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contamination(rows, bench, limit=1024).collect()))
    assert len(most) > 3 and max(most) == 1
    assert got == sorted(map(tuple, decontaminate.contamination(rows, bench).collect())) == sorted((d, *brute(t, items)) for d, t in docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), bench).collect() == []
    rows = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert len(rows) == len(DOCS) and not any(r["contaminated"] for r in rows)
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, "other")


def test_query_agrees_with_sql(agrees):
    assert agrees("op5_benchmark_decontamination") is None
