"""Expectations: row rules, suite results and what is read from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, SUITE, apps, corrupted, rounded, table
from catalog.registry import query
from plumbline.functions.cleaning import printed
from plumbline.operators import expectations as x
from plumbline.operators.expectations.suite import Expectation, Suite, load_suite


def _by_type(part: str) -> Suite:
    return Suite(tuple(e for e in SUITE.expectations if part in e.type))


def _show(results):
    return rounded(results)


def _suite_sql(suite: Suite) -> str:
    return q.with_ctes(q.suite_results("results", "applications", suite), select=f"SELECT {q.SHOW_RESULTS} FROM results")


for _name, _part in (("e1_not_null", "not_be_null"), ("e2_in_set", "to_be_in_set"), ("e3_between", "values_to_be_between"),
                     ("e4_pair_greater", "pair_values_A")):
    _suite = _by_type(_part)
    query(_name, _suite_sql(_suite))(
        lambda spark, folder, suite=_suite: _show(x.run_suite(apps(spark, folder), suite)))


QUANTILES = {"quantiles": [0.05, 0.5, 0.95], "value_ranges": [[20000, 30000], [200000, 300000], [100000, 200000]]}


@query("e5_quantiles", q.with_ctes(select="""
SELECT a >= 20000 AND a <= 30000 AND b >= 200000 AND b <= 300000 AND c >= 100000 AND c <= 200000 AS success,
       printf('%.1f,%.1f,%.1f', a, b, c) AS observed_value
FROM (SELECT quantile_cont(amount, 0.05) a, quantile_cont(amount, 0.5) b, quantile_cont(amount, 0.95) c
      FROM applications)"""))
def e5(spark, folder):
    suite = Suite((Expectation("expect_column_quantile_values_to_be_between",
                               {"column": "amount", "quantile_ranges": QUANTILES}),))
    parts = F.split("observed_value", ",")
    return x.run_suite(apps(spark, folder), suite).select(
        "success", F.concat_ws(",", *[printed(parts[i], 1) for i in range(3)]).alias("observed_value"))


YAML = """
expectation_suite_name: order_lines
expectations:
  - expectation_type: expect_column_values_to_not_be_null
    kwargs: {column: l_shipdate}
  - expectation_type: expect_column_values_to_be_in_set
    kwargs: {column: l_returnflag, value_set: [A, N]}
    severity: warning
  - expectation_type: expect_column_values_to_be_between
    kwargs: {column: l_quantity, min_value: 1, max_value: 45}
  - expectation_type: expect_column_pair_values_A_to_be_greater_than_B
    kwargs: {column_A: l_extendedprice, column_B: l_quantity}
"""


@query("e6_yaml_suite", "WITH " + q.suite_results("results", "lineitem", load_suite(YAML))
       + f" SELECT {q.SHOW_RESULTS} FROM results")
def e6(spark, folder):
    return _show(x.run_suite(table(spark, folder, "lineitem"), load_suite(YAML)))


@query("e8_suite_results", _suite_sql(SUITE))
def e8(spark, folder):
    return _show(x.run_suite(apps(spark, folder), SUITE))


@query("e8_suite_by_group", q.with_ctes(
    q.suite_results("results", "applications", SUITE, keys=("segment",)),
    select=f"SELECT segment, {q.SHOW_RESULTS} FROM results"))
def e8_grouped(spark, folder):
    return _show(x.run_suite(apps(spark, folder), SUITE, keys=["segment"]))


def _unexpected_sql() -> str:
    rows = []
    for i, e in enumerate(SUITE.expectations):
        bad, _, _ = q.bad_and_missing(e)
        rows.append(f"SELECT id, CAST({i} AS INTEGER) AS idx, {q.text(e.type)} AS expectation_type FROM corrupted WHERE {bad}")
    return q.with_ctes(*q.conjoined("corrupted", "applications", "severe"), select=" UNION ALL ".join(rows))


@query("e9_unexpected_rows", _unexpected_sql())
def e9(spark, folder):
    return x.unexpected_rows(corrupted(spark, folder), SUITE).select("id", "idx", "expectation_type")


RESULTS = q.suite_results("results", "applications", SUITE)


@query("e10_statistics", q.with_ctes(RESULTS, select="""
SELECT count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       round(coalesce(count(*) FILTER (WHERE success) / CAST(count(*) AS DOUBLE), 0) * 100, 6) AS success_percent
FROM results"""))
def e10(spark, folder):
    return rounded(x.statistics(x.run_suite(apps(spark, folder), SUITE)))


CORRUPTED_RESULTS = [*q.conjoined("corrupted", "applications", "severe"), q.suite_results("results", "corrupted", SUITE)]
KEY_COLUMNS = ", ".join(q.text(c) for c in DOMAIN.key_columns)


@query("e11_analysis", q.with_ctes(*CORRUPTED_RESULTS, f"""
last_failures AS (SELECT "column", max(idx) AS idx FROM results WHERE NOT success AND "column" IN ({KEY_COLUMNS}) GROUP BY 1)""",
    select="""
SELECT count(*) AS total_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS failed_expectations,
       round(count(*) FILTER (WHERE success) / CAST(count(*) AS DOUBLE) * 100, 6) AS success_rate,
       bool_and(success) AS overall_success,
       coalesce(bool_and(success) FILTER (WHERE expectation_type LIKE '%to_not_be_null%'), true) AS completeness_ok,
       coalesce(bool_and(success) FILTER (WHERE expectation_type LIKE '%to_be_in_set%'), true) AS consistency_ok,
       string_agg(DISTINCT "column", ',' ORDER BY "column") FILTER (WHERE NOT success) AS failed_columns,
       count(*) FILTER (WHERE NOT success AND severity = 'critical') AS critical_failures,
       count(*) FILTER (WHERE NOT success AND severity <> 'critical') AS warning_failures,
       min(element_count) AS records_processed,
       (SELECT string_agg(r."column" || '=' || r.expectation_type || '/' || r.severity, ';' ORDER BY r."column")
        FROM results r JOIN last_failures f ON r.idx = f.idx) AS key_failures
FROM results"""))
def e11(spark, folder):
    found = x.analyze(x.run_suite(corrupted(spark, folder), SUITE), DOMAIN.key_columns)
    entries = F.array_sort(F.map_entries("key_columns_validation"))
    return rounded(found.withColumns({
        "failed_columns": F.array_join("failed_columns", ","),
        "key_failures": F.array_join(F.transform(entries, lambda e: F.concat(
            e["key"], F.lit("="), e["value"]["expectation_type"], F.lit("/"), e["value"]["severity"])), ";"),
    }).drop("key_columns_validation"))


@query("e12_record_count", q.with_ctes(RESULTS, select="SELECT arg_min(element_count, idx) AS record_count FROM results"))
def e12(spark, folder):
    return x.record_count(x.run_suite(apps(spark, folder), SUITE))


@query("e13_adjusted_rate", q.with_ctes(*CORRUPTED_RESULTS, select="""
SELECT CAST(sum(unexpected_count) AS BIGINT) AS unexpected, CAST(count(*) * max(element_count) AS BIGINT) AS examined,
       round((count(*) * max(element_count) - sum(unexpected_count)) / CAST(count(*) * max(element_count) AS DOUBLE) * 100, 6)
       AS adjusted_success_rate FROM results"""))
def e13(spark, folder):
    return rounded(x.adjusted_success_rate(x.run_suite(corrupted(spark, folder), SUITE)))


@query("e14_failed_expectations", q.with_ctes(*CORRUPTED_RESULTS, select="""
SELECT expectation_type AS type, "column" FROM results WHERE NOT success AND "column" IS NOT NULL"""))
def e14(spark, folder):
    return x.failed_expectations(x.run_suite(corrupted(spark, folder), SUITE))


@query("e15_thresholds", q.with_ctes(*CORRUPTED_RESULTS, select="""
SELECT count(*) FILTER (WHERE success) / CAST(count(*) AS DOUBLE) * 100 >= 90 AS success_rate_ok,
       max(unexpected_percent) FILTER (WHERE expectation_type LIKE '%not_be_null') <= 5 AS completeness_ok,
       sum(unexpected_count) FILTER (WHERE expectation_type LIKE '%be_in_set') <= 0 AS consistency_ok,
       max(element_count) / CAST((SELECT count(*) FROM orders) AS DOUBLE) >= 0.8 AS volume_ok
FROM results"""))
def e15(spark, folder):
    return x.QualityThreshold().check(
        x.run_suite(corrupted(spark, folder), SUITE), baseline_rows=table(spark, folder, "orders").count())


# --- rules reachable by name: each over whole tables, one row per rule -----------------

def _tier(name: str, tablename: str, rules: list[tuple[str, dict]], checks: list[tuple[str, str, str]]):
    """``checks``: per rule the SQL of success, of the unexpected count and of the observed value."""
    suite = Suite(tuple(Expectation(t, k) for t, k in rules))
    source = "applications" if tablename == "applications" else tablename
    sql = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS idx, {ok} AS success, CAST({bad} AS BIGINT) AS unexpected_count, "
        f"{seen} AS observed_value FROM {source}" for i, (ok, bad, seen) in enumerate(checks))

    def run(spark, folder):
        df = apps(spark, folder) if tablename == "applications" else table(spark, folder, tablename)
        return x.run_suite(df, suite).select("idx", "success", "unexpected_count", "observed_value")

    query(name, q.with_ctes(select=sql) if source == "applications" else sql)(run)


NONE = "CAST(NULL AS VARCHAR)"


def _rows(bad: str) -> tuple[str, str, str]:
    return (f"count(*) FILTER (WHERE {bad}) = 0", f"count(*) FILTER (WHERE {bad})", NONE)


def _value(expr: str, test: str) -> tuple[str, str, str]:
    return (f"coalesce({expr} {test}, false)", "0", f"printf('%.4f', CAST({expr} AS DOUBLE))")


_tier("x1_null", "applications",
      [("expect_column_values_to_be_null", {"column": "total_qty"}), ("expect_column_values_to_be_null", {"column": "total_qty", "mostly": 0.01})],
      [_rows("total_qty IS NOT NULL"), ("count(*) FILTER (WHERE total_qty IS NOT NULL) / CAST(count(*) AS DOUBLE) <= 0.99",
                                        "count(*) FILTER (WHERE total_qty IS NOT NULL)", NONE)])
_tier("x2_not_in_set", "applications",
      [("expect_column_values_to_not_be_in_set", {"column": "status", "value_set": ["P", "Z"]}),
       ("expect_column_values_to_not_be_in_set", {"column": "category", "value_set": [3]})],
      [_rows("status IN ('P', 'Z')"), _rows("category IN (3)")])
_tier("x3_unique", "lineitem",
      [("expect_column_values_to_be_unique", {"column": "l_partkey"}),
       ("expect_compound_columns_to_be_unique", {"column_list": ["l_orderkey", "l_linenumber"]}),
       ("expect_select_column_values_to_be_unique_within_record", {"column_list": ["l_returnflag", "l_linestatus"]})],
      [("(SELECT coalesce(sum(n), 0) = 0 FROM (SELECT count(*) n FROM lineitem GROUP BY l_partkey HAVING count(*) > 1))",
        "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) n FROM lineitem GROUP BY l_partkey HAVING count(*) > 1)) + 0 * count(*)", NONE),
       ("(SELECT coalesce(sum(n), 0) = 0 FROM (SELECT count(*) n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))",
        "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) + 0 * count(*)", NONE),
       _rows("l_returnflag = l_linestatus")])
_tier("x4_lengths", "documents",
      [("expect_column_value_lengths_to_be_between", {"column": "text", "min_value": 20, "max_value": 20000}),
       ("expect_column_value_lengths_to_equal", {"column": "lang", "value": 2})],
      [_rows("NOT length(text) BETWEEN 20 AND 20000"), _rows("length(lang) <> 2")])
_tier("x5_patterns", "documents",
      [("expect_column_values_to_match_regex", {"column": "text", "regex": "[a-z]{3}"}),
       ("expect_column_values_to_not_match_regex", {"column": "text", "regex": "[0-9]{3}-[0-9]{4}"}),
       ("expect_column_values_to_match_regex_list", {"column": "text", "regex_list": ["[0-9]{2}", "@"], "match_on": "any"}),
       ("expect_column_values_to_match_regex_list", {"column": "text", "regex_list": ["[0-9]{2}", "@"], "match_on": "all"}),
       ("expect_column_values_to_not_match_regex_list", {"column": "text", "regex_list": ["[0-9]{8}", "@"]}),
       ("expect_column_values_to_match_like_pattern", {"column": "source", "like_pattern": "%a%"}),
       ("expect_column_values_to_not_match_like_pattern", {"column": "text", "like_pattern": "%license%"}),
       ("expect_column_values_to_match_like_pattern_list", {"column": "lang", "like_pattern_list": ["e_", "d_"]}),
       ("expect_column_values_to_not_match_like_pattern_list", {"column": "lang", "like_pattern_list": ["e_", "d_"]})],
      [_rows("NOT regexp_matches(text, '[a-z]{3}')"), _rows("regexp_matches(text, '[0-9]{3}-[0-9]{4}')"),
       _rows("NOT (regexp_matches(text, '[0-9]{2}') OR regexp_matches(text, '@'))"),
       _rows("NOT (regexp_matches(text, '[0-9]{2}') AND regexp_matches(text, '@'))"),
       _rows("regexp_matches(text, '[0-9]{8}') OR regexp_matches(text, '@')"),
       _rows("source NOT LIKE '%a%'"), _rows("text LIKE '%license%'"),
       _rows("NOT (lang LIKE 'e_' OR lang LIKE 'd_')"), _rows("lang LIKE 'e_' OR lang LIKE 'd_'")])
_tier("x6_measures", "applications",
      [("expect_column_mean_to_be_between", {"column": "total_qty", "min_value": 90, "max_value": 110}),
       ("expect_column_median_to_be_between", {"column": "avg_discount", "min_value": 0.04, "max_value": 0.06}),
       ("expect_column_stdev_to_be_between", {"column": "n_lines", "min_value": 3}),
       ("expect_column_sum_to_be_between", {"column": "total_qty", "min_value": 1, "max_value": 100}),
       ("expect_column_min_to_be_between", {"column": "amount", "min_value": 1000}),
       ("expect_column_max_to_be_between", {"column": "amount", "max_value": 400000})],
      [_value("avg(total_qty)", "BETWEEN 90 AND 110"), _value("quantile_cont(avg_discount, 0.5)", "BETWEEN 0.04 AND 0.06"),
       _value("stddev_samp(n_lines)", ">= 3"), _value("sum(total_qty)", "BETWEEN 1 AND 100"),
       _value("min(amount)", ">= 1000"), _value("max(amount)", "<= 400000")])
_tier("x7_distinct", "lineitem",
      [("expect_column_unique_value_count_to_be_between", {"column": "l_partkey", "min_value": 10}),
       ("expect_column_proportion_of_unique_values_to_be_between", {"column": "l_suppkey", "max_value": 0.001})],
      [_value("count(DISTINCT l_partkey)", ">= 10"),
       _value("(count(DISTINCT l_suppkey) / CAST(count(l_suppkey) AS DOUBLE))", "<= 0.001")])


def _sets(column: str, values: list[str], contains: bool, inside: bool) -> tuple[str, str, str]:
    listed = ", ".join(q.text(v) for v in values)
    hits = f"count(DISTINCT {column}) FILTER (WHERE {column} IN ({listed}))"
    outside = f"count(*) FILTER (WHERE {column} NOT IN ({listed}))"
    tests = ([f"{outside} = 0"] if inside else []) + ([f"{hits} = {len(values)}"] if contains else [])
    return " AND ".join(tests), "0", f"{hits} || '/' || {outside}"


_tier("x8_distinct_sets", "applications",
      [("expect_column_distinct_values_to_be_in_set", {"column": "segment", "value_set": ["BUILDING", "MACHINERY"]}),
       ("expect_column_distinct_values_to_contain_set", {"column": "segment", "value_set": ["BUILDING", "MACHINERY"]}),
       ("expect_column_distinct_values_to_equal_set", {"column": "status", "value_set": ["F", "O", "P"]})],
      [_sets("segment", ["BUILDING", "MACHINERY"], False, True), _sets("segment", ["BUILDING", "MACHINERY"], True, False),
       _sets("status", ["F", "O", "P"], True, True)])
_tier("x9_most_common", "events",
      [("expect_column_most_common_value_to_be_in_set", {"column": "event_type", "value_set": ["view", "click"], "ties_okay": True}),
       ("expect_column_most_common_value_to_be_in_set", {"column": "event_type", "value_set": ["error"]})],
      [(f"(SELECT {v} FROM (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))", "0 * count(*)",
        "(SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")
       for v in ("event_type IN ('view', 'click')", "event_type = 'error'")])
_tier("x10_quantiles_approximate", "applications",
      [("expect_column_quantile_values_to_be_between", {
          "column": "n_lines", "allow_relative_error": True,
          "quantile_ranges": {"quantiles": [0.25, 0.75], "value_ranges": [[1, 4], [None, 3]]}})],
      [("quantile_disc(n_lines, 0.25) BETWEEN 1 AND 4 AND quantile_disc(n_lines, 0.75) <= 3", "0",
        "printf('%.4f,%.4f', CAST(quantile_disc(n_lines, 0.25) AS DOUBLE), CAST(quantile_disc(n_lines, 0.75) AS DOUBLE))")])
_tier("x11_row_count", "orders",
      [("expect_table_row_count_to_be_between", {"min_value": 1000, "max_value": 10000}),
       ("expect_table_row_count_to_equal", {"value": 15000})],
      [_value("count(*)", "BETWEEN 1000 AND 10000"), _value("count(*)", "= 15000")])
_tier("x12_schema", "region",
      [("expect_table_column_count_to_equal", {"value": 2}), ("expect_table_column_count_to_be_between", {"min_value": 3}),
       ("expect_table_columns_to_match_set", {"column_set": ["r_name"], "exact_match": False}),
       ("expect_table_columns_to_match_ordered_list", {"column_list": ["r_name", "r_regionkey"]}),
       ("expect_column_to_exist", {"column": "r_name", "column_index": 1}),
       ("expect_column_values_to_be_of_type", {"column": "r_name", "type_": "string"}),
       ("expect_column_values_to_be_in_type_list", {"column": "r_regionkey", "type_list": ["bigint", "double"]})],
      [("count(*) >= 0", "0 * count(*)", "'2'"), ("count(*) < 0", "0", "'2'"), ("count(*) >= 0", "0", "'r_name,r_regionkey'"),
       ("count(*) < 0", "0", "'r_regionkey,r_name'"), ("count(*) >= 0", "0", NONE), ("count(*) >= 0", "0", "'string'"),
       ("count(*) < 0", "0", "'int'")])
_tier("x13_pairs", "applications",
      [("expect_column_pair_values_to_be_equal", {"column_A": "total_qty", "column_B": "avg_qty"}),
       ("expect_column_pair_values_to_be_equal", {"column_A": "total_qty", "column_B": "n_lines", "ignore_row_if": "either_value_is_missing"}),
       ("expect_column_pair_values_to_be_in_set", {"column_A": "status", "column_B": "priority",
                                                   "value_pairs_set": [["F", "1-URGENT"], ["O", "2-HIGH"]]})],
      [_rows("total_qty IS DISTINCT FROM avg_qty"), _rows("total_qty <> n_lines"),
       _rows("NOT ((status = 'F' AND priority = '1-URGENT') OR (status = 'O' AND priority = '2-HIGH'))")])
_tier("x14_multicolumn_sum", "part",
      [("expect_multicolumn_sum_to_equal", {"column_list": ["p_size", "p_partkey"], "sum_total": 100})],
      [_rows("p_size + p_partkey <> 100")])
_tier("x15_z_scores", "lineitem",
      [("expect_column_value_z_scores_to_be_less_than", {"column": "l_extendedprice", "threshold": 1.5}),
       ("expect_column_value_z_scores_to_be_less_than", {"column": "l_extendedprice", "threshold": 1.5, "double_sided": False})],
      [(f"(SELECT count(*) = 0 FROM lineitem, {_z} WHERE NOT {_t} < 1.5)",
        f"(SELECT count(*) FROM lineitem, {_z} WHERE NOT {_t} < 1.5) + 0 * count(*)", NONE)
       for _z in ("(SELECT avg(l_extendedprice) m, stddev_samp(l_extendedprice) s FROM lineitem)",)
       for _t in ("abs((l_extendedprice - m) / s)", "((l_extendedprice - m) / s)")])


def _kl(cells: dict[str, float]) -> tuple[str, str, str]:
    total = " + ".join(f"count(*) FILTER (WHERE {c})" for c in cells)
    terms = " + ".join(
        f"CASE WHEN count(*) FILTER (WHERE {c}) = 0 THEN 0 ELSE (count(*) FILTER (WHERE {c}) / CAST({total} AS DOUBLE)) * "
        f"ln((count(*) FILTER (WHERE {c}) / CAST({total} AS DOUBLE)) / {w}) END" for c, w in cells.items())
    return f"({terms}) <= 0.1", "0", f"printf('%.4f', {terms})"


_tier("x16_kl_divergence", "applications",
      [("expect_column_kl_divergence_to_be_less_than", {
          "column": "status", "threshold": 0.1, "partition_object": {"values": ["F", "O", "P"], "weights": [0.5, 0.25, 0.25]}}),
       ("expect_column_kl_divergence_to_be_less_than", {
           "column": "amount", "threshold": 0.1, "tail_weight_holdout": 0.2,
           "partition_object": {"bins": [50000, 200000, 450000], "weights": [0.6, 0.4]}})],
      [_kl({"status = 'F'": 0.5, "status = 'O'": 0.25, "status = 'P'": 0.25}),
       _kl({"amount >= 50000 AND amount < 200000": 0.6 * 0.8, "amount >= 200000 AND amount <= 450000": 0.4 * 0.8,
            "amount < 50000": 0.1, "amount > 450000": 0.1})])
