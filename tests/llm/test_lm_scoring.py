"""Cross-entropy difference against models counted in plain Python."""

import math
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute

from plumbline.llm import lm_scoring

DOCS = [(1, "the cat sat on the mat"), (2, "the dog sat on the log"), (3, "buy cheap cheap cheap pills now"), (3, "buy cheap cheap cheap pills now"), (4, None),
        (5, ""), (None, "the Cat and the dog"), (6, "now now buy the pills"), (7, "cat " * 20_000)]
LABELS = [(1, 1, 0), (2, 1, 0), (2, 1, 1), (3, 0, 0), (None, 1, 0), (50, 1, 0), (6, None, 0)]


def brute(docs, labels, words, contexts, prior):
    split = [(d, (t or "").lower().split()) for d, t in docs]
    count = Counter(w for _, ws in split for w in ws)
    ids = {w: i for i, (w, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))[:words], 1)}
    good = {d for d, q, _ in labels if q == 1 and d is not None}

    def pairs(ws):
        last = None
        for w in ws:
            n = ids.get(w, 0)
            yield (0 if last is None else last if 0 < last <= contexts else contexts + 1 + last % contexts), n
            last = n

    out, tables = [], []
    for keep in (lambda d: d in good, lambda d: True):
        cells = Counter(p for d, ws in split if keep(d) for p in pairs(ws))
        alone, context = Counter(), Counter()
        for (c, n), k in cells.items():
            alone[n] += k
            context[c] += k
        total = sum(alone.values())
        one = lambda n, a=alone, t=total: (a[n] + 1) / (t + len(ids) + 1)
        tables.append(lambda c, n, x=cells, k=context, one=one: math.log((x[c, n] + prior * one(n)) / (k[c] + prior)))
    for d, ws in split:
        t, b = (-sum(f(*p) for p in pairs(ws)) / max(1, len(ws)) for f in tables)
        out.append((d, len(ws), t, b, b - t))
    return sorted(out, key=lambda r: str(r[:2]))


def test_scores(spark):
    docs = spark.createDataFrame([(d, t, "s", 1.0) for d, t in DOCS], "doc_id long, text string, good string, score double").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    for words, contexts in ((1000, 64), (4, 2)):
        got = sorted(map(tuple, lm_scoring.score(docs, labels, words, contexts).collect()), key=lambda r: str(r[:2]))
        for a, b in zip(got, brute(DOCS, LABELS, words, contexts, lm_scoring.PRIOR), strict=True):
            assert a[:2] == b[:2] and all(math.isclose(x, y, abs_tol=1e-5) for x, y in zip(a[2:], b[2:]))
    by = {a[0]: a[4] for a in got}
    assert by[1] > by[3] and by[4] == by[5] == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert lm_scoring.score(docs.limit(0), labels).collect() == []
    assert len(lm_scoring.score(docs, labels.limit(0)).collect()) == len(DOCS)


def test_whole_models_grow_with_the_corpus(spark, monkeypatch):
    # 17,000 words and as many contexts: more than any fixed table held
    docs = DOCS + [(100 + i, " ".join(f"w{i * 170 + j} v{j % 90} w{(i * 31 + j) % 17_000}" for j in range(170))) for i in range(100)]
    labels = LABELS + [(100 + i, 1, 0) for i in range(0, 100, 3)]
    rows = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, row int").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    expected = brute(docs, labels, 10 ** 9, 10 ** 9, lm_scoring.PRIOR)
    for hot, top in ((lm_scoring.HOT, lm_scoring.TOP), (500, 20)):
        monkeypatch.setattr(lm_scoring, "HOT", hot)
        monkeypatch.setattr(lm_scoring, "TOP", top)
        got = sorted(map(tuple, lm_scoring.score(rows, known).collect()), key=lambda r: str(r[:2]))
        for a, b in zip(got, expected, strict=True):
            assert a[:2] == b[:2] and all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(a[2:], b[2:]))


def test_many_buckets(spark, monkeypatch):
    docs = DOCS + [(100 + i, " ".join(f"w{(i * 37 + j * j) % 300} v{j % 7}" for j in range(60))) for i in range(40)]
    labels = LABELS + [(100 + i, 1, 0) for i in range(0, 40, 3)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for name, value in (("BUCKET", 400), ("HOT", 300), ("TOP", 10)):
        monkeypatch.setattr(lm_scoring, name, value)
    got = sorted(map(tuple, lm_scoring.score(rows, known).collect()), key=lambda r: str(r[:2]))
    for a, b in zip(got, brute(docs, labels, 10 ** 9, 10 ** 9, lm_scoring.PRIOR), strict=True):
        assert a[:2] == b[:2] and all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(a[2:], b[2:]))


def test_dealt_tokens_are_a_few_bytes(monkeypatch):
    """Every token not known at hand is dealt out once, in fewer bytes than its 64-bit key and row would take."""
    draw = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in draw.zipf(1.3, 400) % 50_000) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 == 0 or None for i in range(300)]), pa.array(np.arange(300) + 7)], names=("t", "good", "row"))
    monkeypatch.setattr(lm_scoring, "SLICE", 300_000)
    assert len(list(lm_scoring._slices([batch]))) > 1
    counts = pa.Table.from_batches(lm_scoring._count_keys([batch])).group_by("key").aggregate([(x, "sum") for x in ("t", "b", "ct", "cb")]).sort_by("key")
    tokens = sum(counts["b_sum"].to_pylist())
    assert tokens == 300 * 400 and sum(counts["cb_sum"].to_pylist()) == tokens
    hot = counts.filter(pa.compute.or_(pa.compute.greater(counts["b_sum"], 20), pa.compute.equal(counts["key"], 0)))
    m = {x.split("_")[0]: hot[x].to_numpy() for x in hot.column_names} | {"nt": 1.0, "nb": 1.0, "top": np.zeros(0, int), "cell": np.zeros(0, int)}
    shared = SimpleNamespace(value=m | {"cell_t": np.zeros(0), "cell_b": np.zeros(0)})
    dealt = pa.Table.from_batches(lm_scoring._deal(shared, lm_scoring.PRIOR, 4)([batch]))
    rare = tokens - sum(hot["b_sum"].to_pylist())
    n = {kind: sum(x for x, k in zip(dealt["n"].to_pylist(), dealt["kind"].to_pylist()) if k == kind) for kind in range(3)}
    assert n[lm_scoring._OTHERS] == rare and n[lm_scoring._HOT_PAIRS] + rare <= tokens and n[lm_scoring._SUMS] == 300
    assert dealt.nbytes < 10 * tokens
