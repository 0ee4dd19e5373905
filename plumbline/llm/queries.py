"""Registered queries of the training-data operators and, where SQL can say it, their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import chat, decontaminate, extract, fingerprints, language, lm_scoring, packing, pii, rules, search, simhash, toxicity, trie
from plumbline.llm.common import table
from plumbline.llm.oracles import CHAT_SQL, DECONTAMINATION_SQL, RULES_SQL, SEARCH_SQL, TRIE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


@query("op1_packing_tournament_ffd")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op2_lm_cross_entropy_difference")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_pii_disclosure")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query("op4_toxicity_string_kernel")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_benchmark_decontamination", DECONTAMINATION_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_quality_rule_ledger", RULES_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judged(rules.ledger(table(spark, folder, "documents")))
    base = (F.col("failed").bitwiseAND(F.lit(rules.BASE).cast("long")) != 0).alias("base_failed")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base, "kept", "failed")


@query("op7_language_evidence_fusion")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


@query("op8_html_tree_scoring")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages"))


@query("op9_simhash_covering")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_chat_budgeted_windows", CHAT_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, t AS turn, r AS role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    return chat.digests(chat.windows(rows.unionByName(extra)))


@query("op11_conversation_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(table(spark, folder, "conversations"))


@query("op12_search_geometric_blocks", SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_fingerprint_one_permutation")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
