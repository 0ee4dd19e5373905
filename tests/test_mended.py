"""Inputs on which rules, readers and logs once went wrong."""

import math
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from plumbline.domain import credit_suite
from plumbline.operators.expectations import run_suite
from plumbline.operators.expectations.run import MergeableSuite, unexpected_rows
from plumbline.operators.expectations.suite import Expectation, Suite
from plumbline.sources import staging
from plumbline.sources.csv import read_csv
from plumbline.sources.layers import current_metadata, load_features
from plumbline.streaming import gate as arrivals


def suite(*rules):
    return Suite(tuple(Expectation(t, k) for t, k in rules), name="s", data_asset_name="s")


MEASURED = suite(
    ("expect_column_values_to_be_unique", {"column": "v"}), ("expect_compound_columns_to_be_unique", {"column_list": ["v", "w"]}),
    ("expect_column_mean_to_be_between", {"column": "v", "min_value": 2}), ("expect_column_stdev_to_be_between", {"column": "v", "max_value": 3}),
    ("expect_column_sum_to_be_between", {"column": "v", "min_value": 50}), ("expect_column_min_to_be_between", {"column": "v", "min_value": 1}),
    ("expect_column_max_to_be_between", {"column": "v", "max_value": 9}), ("expect_column_unique_value_count_to_be_between", {"column": "w", "min_value": 3}),
    ("expect_column_proportion_of_unique_values_to_be_between", {"column": "w", "max_value": 0.2}),
    ("expect_column_distinct_values_to_equal_set", {"column": "w", "value_set": ["a", "b", "c"]}),
    ("expect_column_most_common_value_to_be_in_set", {"column": "w", "value_set": ["a"]}), ("expect_table_row_count_to_be_between", {"min_value": 20}),
    ("expect_column_value_z_scores_to_be_less_than", {"column": "v", "threshold": 1.5}), ("expect_column_values_to_not_be_null", {"column": "v"}),
    ("expect_column_kl_divergence_to_be_less_than", {"column": "w", "threshold": 0.5, "partition_object": {"values": ["a", "b", "c"], "weights": [0.4, 0.3, 0.3]}}))


def measured(spark, n=90):
    rows = [(i, "xyz"[i % 3] if i % 10 else None, None if i % 11 == 0 else float(i * i % (7 + i % 3)), "abcd"[i * 7 % (2 + i % 3)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, v double, w string")


def results(df):
    return sorted((r["g"] or "", r["idx"], r["success"], r["element_count"], r["missing_count"], r["unexpected_count"], r["observed_value"]) for r in df.collect())


def test_measures_and_rules_by_value_run_per_group(spark):
    """Per group the same as on the group's rows alone, whichever way the rows are cut into parts."""
    df = measured(spark)
    alone = [run_suite(df.where(F.col("g").eqNullSafe(F.lit(g))), MEASURED).withColumn("g", F.lit(g)) for g in ("x", "y", "z", None)]
    want = sorted(sum(map(results, alone), []))
    assert results(run_suite(df, MEASURED, ["g"])) == want
    made = MergeableSuite(df, MEASURED)
    parts = [df.where(f"pmod(hash(id), 4) = {i}") for i in range(4)]
    partial, values = (reduce(DataFrame.unionByName, [f(p, ["g"]) for p in parts]) for f in (made.partial, made.values))
    assert results(made.judged(made.merged(partial, ["g"]), made.merged_values(values, ["g"]), ["g"])) == want


def test_what_cannot_be_merged_is_refused(spark):
    df = measured(spark, 5)
    for rule in (("expect_column_median_to_be_between", {"column": "v", "min_value": 1}),
                 ("expect_column_quantile_values_to_be_between", {"column": "v", "quantile_ranges": {"quantiles": [0.5], "value_ranges": [[0, 1]]}})):
        with pytest.raises(ValueError):
            MergeableSuite(df, suite(rule))
        with pytest.raises(ValueError):
            run_suite(df, suite(rule), ["g"])


def test_stream_folds_and_decides_once_complete(spark, tmp_path):
    """Every family of rules over arriving files; batches repeated, folded and folded again give the same; decisions wait for all files."""
    source, sink = str(tmp_path / "layer"), str(tmp_path / "sink")
    df = measured(spark).select("id", "v", "w", F.coalesce("g", F.lit("n")).alias("dataset_id"))
    df.where("dataset_id <> 'z'").repartition(3).write.partitionBy("dataset_id").parquet(source)
    schema = df.schema
    watch = lambda place: arrivals.validate_arrivals(spark, source, schema, MEASURED, sink, str(tmp_path / place), 1).awaitTermination()
    watch("check")
    kept = ["dataset_id", "idx", "success", "element_count", "missing_count", "unexpected_count", "observed_value"]
    rows = lambda d: sorted(map(tuple, d.select(*kept).collect()))
    streamed = lambda: rows(arrivals.arrived_results(spark, schema, MEASURED, sink))
    first = streamed()
    assert first == rows(run_suite(df.where("dataset_id <> 'z'"), MEASURED, ["dataset_id"]))
    files = spark.read.parquet(source).groupBy("dataset_id").agg(F.count_distinct("_metadata.file_path").alias("n_files"))
    manifest = files.withColumn("n_files", F.when(F.col("dataset_id") == "y", F.col("n_files") + 1).otherwise(F.col("n_files")))
    decided = lambda m: {r["dataset_id"]: r["decision"] for r in arrivals.arrived_decisions(spark, schema, MEASURED, sink, m).collect()}
    assert set(decided(manifest)) == {"x", "n"} and set(decided(files)) == {"x", "y", "n"}
    arrivals.compact(spark, schema, MEASURED, sink, 2)
    assert streamed() == first
    arrivals.compact(spark, schema, MEASURED, sink, 2)  # the fold itself repeated
    df.where("dataset_id = 'z'").write.mode("append").partitionBy("dataset_id").parquet(source)
    watch("check")
    whole = streamed()
    assert whole == rows(run_suite(df, MEASURED, ["dataset_id"]))
    arrivals.compact(spark, schema, MEASURED, sink, 4)
    assert streamed() == whole and set(decided(files)) == {"x", "y", "n"}


def test_rows_that_break_uniqueness_are_listed(spark):
    df = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (3, 6, "x"), (4, None, "x"), (5, 5, "y")], "id long, v int, w string")
    got = unexpected_rows(df, suite(("expect_column_values_to_be_unique", {"column": "v"}), ("expect_column_values_to_not_be_null", {"column": "v"}),
                                    ("expect_compound_columns_to_be_unique", {"column_list": ["v", "w"]}))).collect()
    assert sorted((r["idx"], r["id"]) for r in got) == [(0, 1), (0, 2), (0, 5), (1, 4), (2, 2), (2, 5)]


def test_sets_of_other_types_and_nan(spark):
    df = spark.createDataFrame([(1, "1", math.nan), (2, "x", 1.0), (3, None, None)], "id long, t string, v double")
    rows = run_suite(df, suite(("expect_column_values_to_be_in_set", {"column": "t", "value_set": [1, 2]}),
                               ("expect_column_values_to_be_in_set", {"column": "id", "value_set": ["1", "no", 2]}),
                               ("expect_column_values_to_not_be_null", {"column": "v"}),
                               ("expect_column_values_to_be_between", {"column": "v", "min_value": 0, "max_value": 2}))).orderBy("idx").collect()
    assert [r["unexpected_count"] for r in rows] == [1, 1, 2, 0]


def test_header_binds_by_name_and_quotes_are_undone(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b;My Name\n1;"x ""y"" z"\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path), "my_name string, b int").select("my_name", "b").collect()] == [('x "y" z', 1)]
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), "c int")


def test_newest_rows_have_an_order_and_metadata_one_meaning(spark):
    rows = spark.createDataFrame([(1, "d2", 20), (1, "d1", 10), (1, "d3", 30)], "id long, dataset_id string, loaded_at int")
    assert [r["dataset_id"] for r in load_features(rows, ["dataset_id"], 2).collect()] == ["d3", "d2"]
    log = spark.createDataFrame([("a", "raw", "kept", 1, 2, 0.5, 1, 1, False, "v"), ("a", "raw", None, 9, 3, None, 2, 2, True, "w")],
                                "dataset_name string, dataset_type string, description string, row_count long, column_count long, data_quality_score double, "
                                "created_at int, updated_at int, is_active boolean, current_version string")
    row = current_metadata(log).first()
    assert (row["row_count"], row["column_count"], row["updated_at"], row["created_at"], row["is_active"]) == (9, 3, 2, 1, False)
    assert (row["data_quality_score"], row["description"]) == (0.5, "kept")


def test_target_set_comes_before_its_presence():
    names = [(e.type, e.kwargs.get("column")) for e in credit_suite().expectations]
    assert len(names) == 33
    assert names.index(("expect_column_values_to_be_in_set", "category")) < names.index(("expect_column_values_to_not_be_null", "category"))


def test_no_stage_without_a_folder(spark, monkeypatch):
    class Bare:
        class sparkContext:  # noqa: N801
            @staticmethod
            def getConf():
                return {}

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        staging.shared_folder(Bare)


@pytest.mark.parametrize("name", ["f6_measures", "e8_measures_by_group", "f6_arrivals"])
def test_orders_are_joined_once_for_both_versions(spark, monkeypatch, name):
    from catalog import QUERIES, common
    asked, plain = [], common.applications
    monkeypatch.setattr(common, "applications", lambda *args: asked.append(args) or plain(*args))
    QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(asked) == 1
