"""The pipeline: each stage's decisions on its own input, and the whole on a fixture."""

import random
import re

import corpus_pipeline
from plumbline.llm import decontaminate
from plumbline.llm.queries import QUERIES


def test_stages_on_a_fixture(spark, tmp_path):
    rng = random.Random(7)
    prose = lambda n: " ".join(rng.choice("amber birch cedar delta ember frost grove haven ivory jade knoll lumen mosaic".split()) + str(rng.randrange(500)) for _ in range(n))
    leak = prose(30)
    base = prose(200)
    docs = [(i, prose(40), "en", "s", 1) for i in range(20)] + [(100, base, "en", "s", 1), (101, base, "en", "s", 1), (102, base + " end", "en", "s", 1),
            (200, f"{prose(20)} {leak} {prose(20)}", "en", "s", 1), (300, f"{prose(20)} mail x.y@host.example.org now {prose(5)}", "en", "s", 1),
            (400, "spam " * 50, "en", "s", 1), (401, None, "en", "s", 1), (402, "", "en", "s", 1), (100, base, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, now, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            seen.append({r["doc_id"]: r["text"] for r in now.collect()})
            assert len(seen[-1]) == now.count() or i == 0
    clean = {i for i in range(20)}
    assert set(seen[0]) == clean | {100, 101, 102, 200, 300}
    assert set(seen[1]) == clean | {100, 200, 300} and set(seen[2]) == clean | {100, 300} == set(seen[3])
    assert "[EMAIL]" in seen[3][300] and not re.search("@", seen[3][300]) and all(seen[3][i] == docs[i][1] for i in clean)
    pieces = now.collect()
    assert {r["doc_id"] for r in pieces} == set(seen[3])
    whole = QUERIES["pipeline"](spark, str(tmp_path)).collect()
    key = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert {r["doc_id"] for r in whole} == set(seen[3]) and sum(r["length"] for r in whole) == sum(r["length"] for r in pieces)
    assert all(not decontaminate.scan(decontaminate.words_of(t), decontaminate.ngrams([(1, leak)]))[0] for t in seen[3].values())
    assert key(whole)


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [stage(spark, docs, str(tmp_path)).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5
