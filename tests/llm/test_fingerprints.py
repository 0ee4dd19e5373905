"""Fingerprints against a plain version of the same bins, borrowings and edits."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import fingerprints

SCHEMA = "doc_id long, text string, fingerprint string, lent boolean, bucket int"


def _hash(values, seed=42):
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<Q", v & ((1 << 64) - 1))
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def plain(text, bins=128, bits=8, words=5):
    found = [_hash([w]) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]
    if not found:
        return ""
    hashes = [_hash(found[i:i + words]) for i in range(len(found) - words + 1)] if len(found) >= words else [_hash(found)]
    signed = sorted(h - (1 << 64) if h >> 63 else h for h in hashes)
    shift = 65 - bins.bit_length()
    held = {}
    for h in signed:
        held.setdefault((h & ((1 << 64) - 1)) >> shift, h)
    order = list(held)
    out = []
    for b in range(bins):
        path = [b] + [_hash([b, (t,)]) >> shift for t in range(1, fingerprints.TRIES + 1)]
        path += sorted(order, key=lambda j: (lambda h: h - (1 << 64) if h >> 63 else h)(_hash([j, b])) & -bins | order.index(j))
        out.append(held[next(j for j in path if j in held)] & ((1 << bits) - 1))
    return "".join(format(v, f"0{bits // 4}x") for v in out)


def alike(a, b, bins=128, bits=8):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    d = bits // 4
    same = sum(a[i * d:i * d + d] == b[i * d:i * d + d] for i in range(bins))
    return max(0.0, (same / bins - 2.0 ** -bits) / (1 - 2.0 ** -bits))


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = []
    for i, (doc, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = plain(text), plain(edited), plain(following)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(alike(a, b), 9), round(alike(a, c), 9)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def texts(seed, n=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(400)] + ["𝄞", "Ab"]
    return [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 5, 20, 90, 700]))) for _ in range(n)]


@pytest.mark.parametrize("block_rows", [1, 3, 2000])
def test_brute_force(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [(rng.randrange(-10**12, 10**12), t, "x", True, 3) for t in texts(block_rows)]
    rows += [(None, "null id here", "", True, 0), (7, None, "", True, 0), (8, "", "", True, 0), (7, "two of one id", "", True, 0), (9, " \n\t", "", True, 0)]
    rows += [(5, "a copy stands here", "", False, 1)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(fingerprints.fingerprints(df, block_rows=block_rows)) == brute(rows)


def test_one_and_none(spark):
    assert fingerprints.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(3, "alone in the world it is", "", True, 0)]
    assert rows_of(fingerprints.fingerprints(spark.createDataFrame(one, SCHEMA))) == brute(one)


def test_hot_id(spark):
    rows = [(5, t, "", True, 0) for t in texts(2, 30)] + [(i, t, "", True, 0) for i, t in enumerate(texts(3, 12))]
    assert rows_of(fingerprints.fingerprints(spark.createDataFrame(rows, SCHEMA), block_rows=2)) == brute(rows)


def test_long_text(spark):
    rows = [(1, "word " * 200_000, "", True, 0), (2, "x" * 1_000_000, "", True, 0), (3, "some few words of text", "", True, 0)]
    assert rows_of(fingerprints.fingerprints(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_likeness_is_unbiased(spark):
    """Over many pairs the estimate is close to the true share of common shingles, short texts included."""
    rng, pairs = random.Random(5), []
    for size, share in ((1500, 0.8), (1500, 0.3), (60, 0.5), (25, 0.7)):
        for _ in range(30):
            a = [str(rng.random()) for _ in range(size)]
            cut = int(size * share)
            b = a[:cut] + [str(rng.random()) for _ in range(size - cut)]
            grams = [{tuple(x[i:i + 5]) for i in range(size - 4)} for x in (a, b)]
            pairs.append((size, share, " ".join(a), " ".join(b), len(grams[0] & grams[1]) / len(grams[0] | grams[1])))
    df = spark.createDataFrame(pairs, "size int, share double, a string, b string, truth double")
    df = df.withColumn("near", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))))
    for r in df.groupBy("size", "share").agg(F.avg(F.col("near") - F.col("truth")).alias("bias")).collect():
        assert abs(r["bias"]) < 0.04, r


@pytest.mark.parametrize("bins, bits", [(64, 4), (16, 16)])
def test_other_sizes(spark, bins, bits):
    values = texts(9, 12)
    df = spark.createDataFrame([(t,) for t in values], "t string").select("t", fingerprints.fingerprint(F.col("t"), bins, bits).alias("f"))
    assert all(r["f"] == plain(r["t"], bins, bits) for r in df.collect())
    with pytest.raises(ValueError):
        fingerprints.fingerprint(F.col("t"), 100)


def test_no_python_in_the_plan(spark, small):
    df = fingerprints.fingerprints(spark.read.parquet(f"{small}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, small):
    from plumbline.llm.queries import QUERIES
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert rows_of(QUERIES["op13_fingerprint_one_permutation"](spark, small)) == brute(rows)
