"""Covering SimHash against brute force over all pairs."""

import itertools
import os

import pytest
import xxhash

from plumbline.llm import simhash

FOLDER = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows):
    """rows: (doc_id, fingerprint); the least id of each row's component."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(rows[i][1] ^ rows[j][1]).count("1") <= 3:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [least.get(root(i)) for i in range(len(rows))]


def expected(texts):
    rows = [(doc, brute_fingerprint(text)) for doc, text in texts]
    return sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows))), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_masks_cover_every_three_positions():
    masks = [m for _, _, m in simhash.mask_paths(1)[0]]
    assert all(any(not (m >> i & 1 or m >> j & 1 or m >> k & 1) for m in masks)
               for i, j, k in itertools.combinations(range(64), 3))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_all_documents(spark, bucket):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(simhash.near_duplicates(docs, bucket=bucket)) == expected(texts)


EDGE = [(5, "One two three four"), (2, "one TWO three four"), (9, None), (7, ""), (7, ""), (None, "x y z"), (None, "q"),
        (3, "ab"), (3, "ab"), (4, "ÀB cd ef gh"), (6, "àB cd ef gh"), (8, "w " * 70_000), (1, "\x0bone\x0ctwo\rthree four")]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(d, t, 0, "s") for d, t in EDGE], "doc_id long, text string, fp int, rep string")
    assert got(simhash.near_duplicates(docs)) == expected(EDGE)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in kept.collect()]
    parts = {c for c in brute_components([(None, brute_fingerprint(t)) for _, t in EDGE])}
    assert parts == {None} and len({f for _, f in rows}) == len(rows)
    assert sorted(str(d) for d, _ in rows) == sorted(["1", "3", "4", "6", "7", "8", "None", "None"])


def test_dense_buckets_lose_no_link(spark):
    """A chain of fingerprints that share nearly all bits, far over the bucket bound."""
    base = 0x0123456789ABCDEF
    values = sorted({base ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)} | {base ^ 0xFF00, base ^ 0xFFFF})
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), bucket=4).collect()
    rows = [(i, v) for i, v in enumerate(values)]
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in found:
        assert bin(a ^ b).count("1") <= 3
        parent[root(a)] = root(b)
    ours = {v: root(v) for v in values}
    brute = dict(zip(values, brute_components(rows)))
    assert len(set(ours.values())) == len(set(brute.values()))
    assert all((ours[a] == ours[b]) == (brute[a] == brute[b]) for a, b in itertools.combinations(values, 2))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.drop_near_duplicates(docs).collect() == []
