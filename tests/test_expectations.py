"""Suites: reading, edge cases of rules, analysis."""

import pytest
from pyspark.sql import functions as F

from plumbline.domain import CREDIT, credit_suite
from plumbline.operators import expectations as x
from plumbline.operators.expectations import Expectation, Suite, load_suite, run_suite


def suite(*rules):
    return Suite(tuple(Expectation(t, k) for t, k in rules))


def rows(df, s):
    return {r["idx"]: r for r in run_suite(df, s).collect()}


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, 1.0), (2, "b", 5.0, None), (3, None, 9.0, 9.5), (4, "", None, None), (5, "a", 5.5, 2.0)],
        "id bigint, s string, x double, y double")


def test_shipped_suite_has_the_declared_rules():
    kinds = [e.type for e in credit_suite().expectations]
    assert len(kinds) == 33
    assert [sum(k in t for t in kinds) for k in ("not_be_null", "in_set", "values_to_be_between", "pair")] == [11, 14, 7, 1]
    assert len(CREDIT.columns) == 21
    assert credit_suite().valid_values("foreign_worker") == ["A201", "A202"]
    assert credit_suite().valid_values("credit_amount") is None
    assert credit_suite().valid_values("nothing") == []


def test_row_rules(mixed):
    got = rows(mixed, suite(
        ("expect_column_values_to_not_be_null", {"column": "s"}),
        ("expect_column_values_to_be_in_set", {"column": "s", "value_set": ["a", "b"]}),
        ("expect_column_values_to_be_between", {"column": "x", "min_value": 1, "max_value": 5.5}),
        ("expect_column_values_to_be_between", {"column": "x", "min_value": 1, "strict_min": True}),
        ("expect_column_values_to_be_in_set", {"column": "s", "value_set": []}),
        ("expect_column_values_to_be_in_set", {"column": "x", "value_set": [1, 5]})))
    assert [got[i]["unexpected_count"] for i in range(6)] == [1, 1, 1, 1, 4, 2]
    assert [got[i]["missing_count"] for i in range(6)] == [0, 1, 1, 1, 1, 1]
    assert got[1]["unexpected_percent"] == 25.0 and got[0]["unexpected_percent"] == 20.0
    assert all(got[i]["element_count"] == 5 and not got[i]["success"] for i in range(6))


@pytest.mark.parametrize("ignore,bad,missing", [
    ("both_values_are_missing", 2, 1), ("either_value_is_missing", 1, 2), ("never", 3, 0)])
def test_pair_rule_null_handling(mixed, ignore, bad, missing):
    got = rows(mixed, suite(("expect_column_pair_values_A_to_be_greater_than_B", {
        "column_A": "x", "column_B": "y", "or_equal": True, "ignore_row_if": ignore})))[0]
    assert (got["unexpected_count"], got["missing_count"]) == (bad, missing)


def test_mostly_empty_table_and_all_null(spark, mixed):
    s = suite(("expect_column_values_to_be_between", {"column": "x", "min_value": 2, "mostly": 0.75}),
              ("expect_column_values_to_be_between", {"column": "x", "min_value": 2, "mostly": 0.76}))
    assert [r["success"] for r in rows(mixed, s).values()] == [True, False]
    empty = mixed.filter("id < 0")
    assert all(r["success"] and r["element_count"] == 0 for r in rows(empty, s).values())
    nothing = mixed.withColumn("x", F.lit(None).cast("double"))
    assert rows(nothing, s)[0]["success"]
    stats = x.statistics(run_suite(mixed, Suite(()))).first()
    assert (stats["evaluated_expectations"], stats["success_percent"]) == (0, 0.0)


def test_uniqueness_and_distinct_under_a_hot_value(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("c").alias("c"))
    got = rows(df, suite(
        ("expect_column_values_to_be_unique", {"column": "k"}),
        ("expect_column_unique_value_count_to_be_between", {"column": "k", "min_value": 6001, "max_value": 6001}),
        ("expect_column_proportion_of_unique_values_to_be_between", {"column": "k", "max_value": 0.6}),
        ("expect_compound_columns_to_be_unique", {"column_list": ["k", "c"]}),
        ("expect_column_most_common_value_to_be_in_set", {"column": "k", "value_set": [0]})))
    assert [got[i]["success"] for i in range(5)] == [False, True, False, False, True]
    assert got[0]["unexpected_count"] == got[3]["unexpected_count"] == 3000


def test_most_common_value_ties(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    rule = "expect_column_most_common_value_to_be_in_set"
    got = rows(df, suite((rule, {"column": "s", "value_set": ["b"]}), (rule, {"column": "s", "value_set": ["b"], "ties_okay": True})))
    assert [got[0]["success"], got[1]["success"]] == [False, True]


def test_kl_value_outside_the_partition_is_infinite(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "s string")
    rule = ("expect_column_kl_divergence_to_be_less_than", {
        "column": "s", "threshold": 100.0, "partition_object": {"values": ["a", "b"], "weights": [0.5, 0.5]}})
    assert not rows(df, suite(rule))[0]["success"]
    held = (rule[0], {**rule[1], "tail_weight_holdout": 0.3})
    assert rows(df, suite(held))[0]["success"]


def test_suite_is_one_aggregate_over_one_scan(mixed, tmp_path):
    mixed.write.parquet(str(tmp_path / "t"))
    df = mixed.sparkSession.read.parquet(str(tmp_path / "t"))
    s = suite(("expect_column_values_to_not_be_null", {"column": "s"}), ("expect_column_values_to_be_between", {"column": "x", "min_value": 1}))
    plan = run_suite(df, s)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1
    assert "y" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_unexpected_rows_and_values(mixed):
    s = suite(("expect_column_values_to_not_be_null", {"column": "s"}), ("expect_column_values_to_be_between", {"column": "x", "max_value": 5}),
              ("expect_column_pair_values_A_to_be_greater_than_B", {"column_A": "x", "column_B": "y"}))
    got = {(r["id"], r["idx"]): r["value"] for r in x.unexpected_rows(mixed, s).collect()}
    assert set(got) == {(3, 0), (3, 1), (5, 1), (1, 2), (2, 2), (3, 2)}
    assert got[3, 1] == "9.0" and got[2, 2] == '{"x":5.0}'


def test_analysis_keeps_the_last_failure_of_a_key_column(mixed):
    s = Suite((Expectation("expect_column_values_to_not_be_null", {"column": "s"}),
               Expectation("expect_column_values_to_be_in_set", {"column": "s", "value_set": ["a"]}, "warning"),
               Expectation("expect_column_values_to_be_between", {"column": "x", "max_value": 100})))
    got = x.analyze(run_suite(mixed, s), ["s", "x"]).first()
    assert got["failed_columns"] == ["s"] and not got["completeness_ok"] and not got["consistency_ok"]
    assert (got["critical_failures"], got["warning_failures"], got["records_processed"]) == (1, 1, 5)
    assert got["key_columns_validation"]["s"].asDict() == {
        "expectation_type": "expect_column_values_to_be_in_set", "success": False, "severity": "warning"}


def test_thresholds(mixed):
    s = suite(("expect_column_values_to_not_be_null", {"column": "s"}), ("expect_column_values_to_be_in_set", {"column": "s", "value_set": ["a", "b", ""]}))
    got = x.QualityThreshold().check(run_suite(mixed, s), baseline_rows=6).first()
    assert got.asDict() == {"success_rate_ok": False, "completeness_ok": False, "consistency_ok": True, "volume_ok": True}
    got = x.QualityThreshold(min_success_rate=0, max_null_percentage=20.0).check(run_suite(mixed, s), baseline_rows=7).first()
    assert got["success_rate_ok"] and got["completeness_ok"] and not got["volume_ok"]


def test_failed_expectations_with_and_without_pairs(mixed):
    s = suite(("expect_column_values_to_not_be_null", {"column": "s"}), ("expect_column_pair_values_A_to_be_greater_than_B", {"column_A": "x", "column_B": "y"}))
    assert [r["column"] for r in x.failed_expectations(run_suite(mixed, s)).collect()] == ["s"]
    assert {r["column"] for r in x.failed_expectations(run_suite(mixed, s), include_pairs=True).collect()} == {"s", "x,y"}


@pytest.mark.parametrize("text,message", [
    ("- 1", "mapping"), ("expectations: 3", "list"), ("expectations: [{kwargs: {}}]", "expectation_type"),
    ("expectations: [{expectation_type: expect_nothing}]", "unknown expectation"),
    ("expectations: [{expectation_type: expect_column_values_to_not_be_null, kwargs: {colum: a}}]", "invalid arguments")])
def test_bad_suites_are_refused(text, message):
    with pytest.raises(ValueError, match=message):
        load_suite(text)


def test_suite_defaults_and_file(tmp_path):
    path = tmp_path / "s.yaml"
    path.write_text("expectations: [{expectation_type: expect_column_values_to_not_be_null, kwargs: {column: a}}]")
    for source in (path, str(path)):
        got = load_suite(source)
        assert got.name == "default_validation_suite" and got.expectations[0].severity == "critical"
