"""The string kernel against brute force, and held-out accuracy with gapped and bent insults."""

import itertools
import math
import random
import zlib

import numpy as np

from plumbline.llm import toxicity


def brute_features(word):
    codes = [27] + [ord(c) - 96 if "a" <= c <= "z" else ord(c) + 32 for c in word]
    out, square = {}, 0.0
    for p in itertools.combinations(range(len(codes)), toxicity.ORDER):
        if p[-1] - p[0] < toxicity.SPAN:
            w = toxicity.DECAY ** (p[-1] - p[0] + 1)
            key = tuple(codes[i] for i in p)
            out[key] = out.get(key, 0) + w
            square += w * w
    return {k: v / math.sqrt(square) for k, v in out.items()}


WORDS = ["", "ab", "abc", "idiot", "idxiot", "iiddiioott", "worthless", "a" * 24, "zzz9q", "naïve", "дурак", "добры", "ду_рак", "𝄞𝄞𝄞𝄞a", "马马虎虎"]


def test_kernel_is_the_sum_over_common_subsequences():
    marks = [w for w in WORDS if len(w) >= 3]
    got = toxicity.kernel(WORDS, marks)
    for i, a in enumerate(WORDS):
        for j, b in enumerate(marks):
            fa, fb = brute_features(a), brute_features(b)
            assert math.isclose(got[i, j], sum(v * fb.get(k, 0) for k, v in fa.items()), abs_tol=1e-9)
    at = {w: i for i, w in enumerate(WORDS)}
    assert got[at["дурак"], marks.index("добры")] < 0.2 < 0.3 < got[at["ду_рак"], marks.index("дурак")]
    assert got[3, marks.index("idiot")] > got[4, marks.index("idiot")] > got[6, marks.index("idiot")]


def test_folded_machine_is_the_machine_over_landmarks():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeirst") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    labels = [int("st" in w) for w in words]
    table, bias = toxicity.fit_machine(words, labels, [1.0] * len(words), words[:40])
    direct = toxicity.margins(words, table, bias)
    assert (np.sign(direct) == np.where(labels, 1, -1)).mean() > 0.85
    assert all(abs(m - toxicity.margins([w], table, bias)[0]) < 1e-6 for w, m in zip(words[:20], direct))


def test_units():
    assert toxicity.units("You I.D.I.0.T! s t u p i d") == {"you", "idiot", "idiots", "s", "t", "u", "p", "i", "d", "stupid"}
    assert toxicity.units("") == set() and all(len(u) <= toxicity.LONGEST for u in toxicity.units("x" * 100_000))
    assert "idiot" in toxicity.units("É\x00ïdïot ok\tidiot")


def test_units_of_pieces():
    assert {"moron", "idiot"} <= toxicity.units("the mor on and the id iot stand")
    assert "motherstone" not in toxicity.units("mother stone")


def test_insults_in_cyrillic_and_in_pieces(spark):
    rng, docs, labels = random.Random(8), [], []
    clean = ["добры", "город", "книга", "дорог", "стена", "вечер", "школа", "белый", "новый", "рыбак", "мороз", "топор"]
    for i in range(500):
        words, toxic = rng.choices(clean, k=rng.randint(5, 30)), int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["дурак", "сволочь", "подлец"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    more = [(1000, "город и ду рак там"), (1001, "книга по длец"), (1002, "добры книга город"), (1003, "вечер дуурак стена")]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame(docs + more, "doc_id long, text string"),
                                                               spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i] == labels[i][2] for i in held]) > 0.97
    assert got[1000] and got[1001] and not got[1002] and got[1003]


def corpus(n=600):
    rng = random.Random(5)
    parts = ["th", "er", "on", "an", "in", "ed", "to", "re", "st", "ea", "ou", "ing"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(rng.randint(5, 40))], int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "worthless", "scum"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_scores(spark):
    docs, labels = corpus()
    bent = [(10_000, "the thing is an idxiot on there"), (10_001, "there in the w0rth-less stone"), (10_002, "then s c u m on it"), (10_003, "the mooron here"),
            (10_004, None), (10_004, None), (10_005, ""), (None, "a moron"), (10_006, "thing " * 50_000 + "moron")]
    rows = spark.createDataFrame([(d, t, 1, 0.5) for d, t in docs + bent], "doc_id long, text string, toxic int, score double").repartition(4)
    known = spark.createDataFrame(labels + [(3, 1, None), (None, 0, 1), (5, 1, labels[5][2]), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(rows, known).collect()
    assert len(got) == len(docs) + len(bent)
    by = {r["doc_id"]: r for r in got}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(by[i]["held_out"] == (i in set(held)) for i, _ in docs) and not by[None]["held_out"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert np.mean([by[i]["predicted"] == labels[i][2] for i in held]) > 0.97
    assert all(by[i]["predicted"] for i in (10_000, 10_001, 10_002, 10_003, None, 10_006))
    assert by[10_004]["predicted"] == by[10_005]["predicted"] == 0


def test_without_labels_or_rows(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.score(rows, known).collect()] == [0.0, 0.0]
    assert toxicity.score(rows.limit(0), known).collect() == []
