"""Personal data: base spans by plain patterns, revealing terms by counting, on a fixture and on all documents."""

import hashlib
import math
import re

from plumbline.llm import pii

RAW = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute_base(text):
    out = []
    for no, (kind, pattern) in enumerate(RAW.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                    "card": 14 <= len(digits) <= 19 and luhn(digits or "0"), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), no, m.end(), kind, m[0]))
    return sorted(out)


def joined(spans):
    return ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans)


def words_of(text):
    return {w for w in re.findall(r"[^\W\d_]+", text.lower()) if len(w) >= 3}


def outside(text, base):
    for b in base:
        text = text[:b[0]] + " " * (b[2] - b[0]) + text[b[2]:]
    return text


def lower_bound(k, n):
    z = pii.Z
    return (k / n + z * z / (2 * n) - z * math.sqrt(k / n * (1 - k / n) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def brute(rows):
    """rows of (doc_id, text) to the result rows of the query."""
    texts = {t or "" for _, t, *_ in rows}
    n, bases = len(texts), {t: brute_base(t) for t in texts}
    entities, holders, everywhere = {}, {}, {}
    for t in texts:
        entities[t] = {b[3] + ":" + (b[4].lower() if b[3] in ("email", "ip") else re.sub(r"[^0-9]", "", b[4])) for b in bases[t]}
        for e in entities[t]:
            holders.setdefault(e, set()).add(t)
        for w in words_of(t):
            everywhere.setdefault(w, set()).add(t)
    around = {t: words_of(outside(t, bases[t])) for t in texts if bases[t]}
    kinds = {t: {} for t in texts}
    for e, held in holders.items():
        if len(held) == n:
            continue
        for w in set().union(*(around[t] for t in held)):
            p = lower_bound(sum(w in around[t] for t in held), len(everywhere[w]))
            share = math.log(n * p / len(held)) / math.log(n / len(held)) if p > 0 else 0
            if p >= pii.EVEN and share >= pii.GENERALISE:
                for t in held:
                    kinds[t][w] = "removed_term" if share >= pii.REMOVE or kinds[t].get(w) == "removed_term" else "term"
    out = []
    for doc, text, *_ in rows:
        text = text or ""
        base, extra = bases[text], []
        for m in re.finditer(r"[^\W\d_]+", outside(text, base)):
            k = kinds[text].get(m[0].lower())
            if k:
                extra.append((m.start(), 4 + (k == "removed_term"), m.end(), k))
        counts = [sum(b[3] == k for b in base) for k in pii.KINDS]
        out.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + extra)), len(extra)))
    return sorted(out, key=str)


PEOPLE = [(100 + i, f"{'note ' * i}Contact Quentin Abernathy at q.aber@mail.example.org or the office{' again' * i}.") for i in range(5)]
OTHERS = [(200 + i, f"The office wrote again and again, note {i}, about mail.") for i in range(40)]
EDGES = [(1, None), (2, ""), (2, ""), (None, "call +1 (555) 123-4567 now"), (3, "a@b.c.@d.e, x@y @z.q A@b-c.D"), (4, "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3"),
         (5, "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005 x 12345678901234567890123"), (6, "+12345 +1234567890123456 +49 30 1234-5678)"),
         (7, "é" * 50 + " ü@x.de é@x.de 日本 me@日本.jp a@x.y"), (8, "a" * 100_000 + " " + "1" * 100_000 + "." * 1000 + "+" * 1000 + "a@" * 1000), (9, "10.0.0.1" * 30),
         (10, "+1.1.1.1.2345678"), (11, "x@a.b" * 50), (12, "4111111111111111" * 3), (13, "Abernathy without an address")]


def test_fixture(spark):
    rows = PEOPLE + OTHERS + EDGES
    docs = spark.createDataFrame([(d, t, "b", 1) for d, t in rows], "doc_id long, text string, base string, key int").repartition(3)
    expected = brute(rows)
    assert any("term:" in r[-2] for r in expected)
    assert sorted(map(tuple, pii.find(docs).collect()), key=str) == expected


def test_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, pii.find(docs).collect()), key=str) == brute(rows)


def test_sanitise(spark):
    rows = PEOPLE + OTHERS + EDGES
    docs = spark.createDataFrame([(d, t, "b", 1) for d, t in rows], "doc_id long, text string, pii_base string, key int")
    got = pii.sanitise(docs)
    assert got.columns == docs.columns
    by = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(rows) and by[1] is None and by[200] == OTHERS[0][1] and by[13] == EDGES[-1][1]
    assert by[100] == "[TERM] [TERM] Abernathy at [EMAIL] or the office." and by[None] == "call [PHONE] now"
    assert by[3] == "[EMAIL][EMAIL], x@y @z.q [EMAIL]" and by[5] == "[CARD] and 4111-1111-1111-1112, [CARD] x 12345678901234567890123"
    assert not any(brute_base(t) for d, t in by.items() if t and d not in (8, 9, 11, 12))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(docs).collect() == [] and pii.sanitise(docs).collect() == []


FILLER = "the office wrote again about the weather and the mail " * 3
NOTES = [f"{FILLER}note {'ab'[i % 2]}{'cdefghij'[i % 8]}{'klmnopqr'[i // 8 % 8]} {'lo' * (i // 64)}" for i in range(400)]


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, pii.find(docs).collect()), key=str)
    assert got == brute(list(enumerate(texts)))
    return {r[0]: r[-1] for r in got}


def test_meetings_count_once_a_text(spark):
    """Three different texts are evidence, two are not, nor are copies of one, in a corpus of any size."""
    texts = [f"Quentin {FILLER}x@one.example.org {'so ' * i}{FILLER}Abernathy" for i in range(3)]
    texts += [f"Sibyl {FILLER}{'so ' * i}y@two.example.org{' and' * i}" for i in range(2)]
    texts += [f"Ottoline {FILLER}z@three.example.org"] * 50
    for notes in (NOTES, NOTES + [f"{t} {i}" for i in range(5) for t in NOTES]):
        assert found(spark, texts + notes) == {i: 2 if i < 3 else 0 for i in range(len(texts + notes))}


def test_bound_grows_with_meetings():
    bounds = [lower_bound(k, k) for k in range(1, 30)]
    assert bounds == sorted(bounds) and [b >= pii.EVEN for b in bounds].index(True) + 1 == pii.LEAST_TEXTS == 3


def test_a_term_inside_another_word_stays(spark):
    texts = [f"Ann met {'so ' * i}a.nn@one.example.org here, Annabel and ann@one.example.org too" for i in range(4)]
    assert set(found(spark, texts + NOTES).values()) - {0}


def test_long_lists_are_classes(spark):
    """2,000 addresses and 20,000 words in each of four texts: no row per address and word."""
    words = [f"w{chr(97 + i // 676 % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{'abcdefghijkl'[i // 17576]}" for i in range(20_000)]
    addresses = [f"p{i}@list.example.org" for i in range(2_000)]
    texts = [" ".join(addresses) + " " + " ".join(words) + " 1" * i for i in range(4)] + NOTES
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    evidence = pii.evidence(docs)
    hits, _ = pii.disclosed(docs, evidence)
    assert hits.count() == 4 * 20_000
    rows = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert all(rows[i]["n_email"] == 2_000 and rows[i]["n_terms"] == 20_000 for i in range(4)) and not any(rows[i]["n_terms"] for i in range(4, len(texts)))


def test_one_long_list(spark):
    """A single text proves nothing, however many addresses and words it lists."""
    words = [f"w{chr(97 + i // 676 % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{'abcdefghijkl'[i // 17576]}" for i in range(20_000)]
    texts = [" ".join(f"p{i}@list.example.org" for i in range(2_000)) + " " + " ".join(words)] + NOTES[:50]
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_email"], r["n_terms"]) for r in rows} == {i: (0 if i else 2_000, 0) for i in range(len(texts))}
