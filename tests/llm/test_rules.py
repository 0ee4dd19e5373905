"""The rule ledger against SQL, a brute force count and its own policies."""

from plumbline.llm import rules


def brute_repeats(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    return len({p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)})


def test_query_agrees_with_sql(agrees):
    assert agrees("op6_quality_rule_ledger") is None


def test_repeats():
    for text in ("", "a b c d", "a b c d e", "a a a a a a", "a b c d e a b c d e", "a b c d e x a b c d e y z a b c d e",
                 "a b a b a b a b c d e f g h", "ab c d e f a bc d e f"):
        assert rules.repeated_words(text.split()) == brute_repeats(text.split()), text


GOOD = "the quick brown fox jumps over the lazy dog and runs far away from the big house"


def test_edge_cases(spark):
    rows = [(1, GOOD), (1, GOOD), (2, None), (3, ""), (None, "one two"), (4, "spam ham " * 30), (5, "$ " * 20 + GOOD), (6, "x" * 200_000),
            (7, "\n\n".join([GOOD] * 2)), (8, "   nine eight")]
    docs = spark.createDataFrame([(d, t, "k", 5) for d, t in rows], "doc_id long, text string, kept string, n_words int")
    got = rules.judged(rules.ledger(docs)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[1]["failed"] == 0 and by[1]["kept"] and by[2]["failed"] == by[3]["failed"] and by[2]["n_words"] == 0
    assert by[2]["failed"] & rules.BIT["few_words"] and by[4]["failed"] & rules.BIT["repeated_words"]
    assert by[5]["failed"] & rules.BIT["symbols"] and by[6]["failed"] & rules.BIT["huge_word"]
    assert by[7]["n_dup_lines"] == 1 and by[8]["n_words"] == 3
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])
    assert rules.ledger(docs.limit(0)).collect() == [] and rules.keep_good(docs.limit(0)).collect() == []


CHINESE = " ".join("我们在城外的河边走了很久，看见许多白色的鸟从水面飞起" for _ in range(1)) + " " + " ".join(f"他说了第{i}个很长的故事，大家都安静地听着直到太阳落下山去为止" for i in "一二三四五六七八九十百千万")


def test_clean_texts_in_any_script_and_with_long_addresses_stay(spark):
    rows = [(1, CHINESE), (2, GOOD + " https://example.org/" + "a" * 5_000), (3, GOOD + " " + "QUJD" * 1_000), (4, " ".join(chr(97 + i) * 60 for i in range(20)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in rules.keep_good(docs).collect()) == [1, 2, 3]
    assert sorted(r["doc_id"] for r in rules.keep_good(docs, "v1").collect()) == []
    assert rules.POLICIES["v1"] == 127


def test_ablation_counts_as_the_rules_do(spark):
    rows = [(i, f) for i, f in enumerate([0, 1, 1, 3, 4, 5, 64, 64, 128, 0])]
    got = {r["rule"]: r for r in rules.ablation(spark.createDataFrame(rows, "doc_id long, failed long"), "v1").collect()}
    assert set(got) == {name for name, bit in rules.BIT.items() if rules.POLICIES["v1"] & bit}
    for name, bit in ((name, rules.BIT[name]) for name in got):
        active = [f & rules.POLICIES["v1"] for _, f in rows]
        assert got[name]["n_failed"] == sum(bool(f & bit) for f in active)
        assert got[name]["n_only"] == sum(f == bit for f in active)
        assert got[name]["n_kept_without"] == sum(not f & ~bit for f in active)
