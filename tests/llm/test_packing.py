"""Packing: an exact round trip of the ids, whole sequences, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from plumbline.llm import packing


def whole_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, length, with_ids=True):
    """rows: all pieces. texts: doc_id to text, each once."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(whole_ids(text), "<u4").tobytes()
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            part = ids[4 * at:4 * (at + r["length"])]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids) // 4, zlib.crc32(part))
            if with_ids:
                assert bytes(r["ids"]) == part
            at += r["length"]
        assert at == len(ids) // 4
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= length
    return by_sequence


def test_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack(docs, with_ids=True).collect()
    made = check(rows, texts, 1024)
    total = sum(r["length"] for r in rows)
    assert len(made) * 1024 <= 1.02 * total + 8 * 1024
    joined = packing.sequences(packing.pack(docs, with_ids=True)).collect()
    assert sum(r["n_tokens"] for r in joined) == total and all(len(r["ids"]) == 4 * r["n_tokens"] <= 4096 for r in joined)


def test_edge_cases(spark):
    texts = {1: None, 2: "", 3: "a  b\n\n  c \t d", 4: "x" * 5000, 5: "say <|endoftext|> now", 6: "日本語 テスト", 12: "— “quoted” Привет, αβγ € ไทย 𝒳 ☃", 7: "word " * 4000, 8: " lead",
             9: "trail ", 10: "it's  here", 11: "\n"}
    docs = spark.createDataFrame([(d, t, 1) for d, t in texts.items()], "doc_id long, text string, sequence_id int")
    check(packing.pack(docs, length=64, group=4, with_ids=True).collect(), texts, 64)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "same words here")] * 3 + [(None, "x")], "doc_id long, text string")
    rows = packing.pack(docs).collect()
    n = len(whole_ids("same words here"))
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 3 * n
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == len(whole_ids("x"))
    assert packing.pack(docs.limit(0)).collect() == []


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 300):
        lengths = [rng.randint(1, 1023) for _ in range(n)]
        bins, room = [], []
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            at = next((b for b in range(len(bins)) if room[b] >= lengths[i]), len(bins))
            if at == len(bins):
                bins.append([])
                room.append(1024)
            bins[at].append(i)
            room[at] -= lengths[i]
        assert packing.first_fit_decreasing(lengths) == bins


def test_one_length_for_all_is_topped_up():
    lengths = [700] * 500
    made = packing.topped_up(packing.first_fit_decreasing(lengths), lengths)
    fill = [sum(b - a for _, a, b in content) for content in made]
    assert sum(fill) == 700 * 500 and len(made) == -(-700 * 500 // 1024) and max(fill) <= 1024
    pieces = sorted((i, a, b) for content in made for i, a, b in content)
    assert all(b == pieces[k + 1][1] for k, (i, a, b) in enumerate(pieces[:-1]) if pieces[k + 1][0] == i)
