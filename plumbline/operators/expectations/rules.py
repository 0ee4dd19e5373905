"""The registry: expectation type -> how to count it.

A builder returns a ``Rule``. Row rules say per row what is missing and what is
unexpected; measure rules compare one aggregate with bounds; fixed rules are decided
without the rows (by the schema, or by a pass of their own when a shuffle on the value
is needed, as for uniqueness). All rules of a suite end up in the same single aggregate.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.cleaning import printed
from plumbline.operators import stats


@dataclass
class Rule:
    # row rules
    missing: Column | None = None
    unexpected: Column | None = None
    percent_of_all: bool = False
    mostly: float = 1.0
    # measure rules: aggregates by name, then a test and an observed value over them
    measures: dict[str, Column] = field(default_factory=dict)
    passed: Callable[[dict[str, Column]], Column] | None = None
    observed: Callable[[dict[str, Column]], Column] | None = None
    # unexpected count known beforehand
    unexpected_count: int | None = None
    # value reported for a failing row
    subject: Column | None = None
    # decided by a job over the whole table: not per group, and not to be merged from parts
    own_pass: bool = False
    # columns that must be unique together, where ``repeated_skip`` does not hold
    repeated: list[str] | None = None
    repeated_skip: Column | None = None
    # how a measure rule's aggregates come from parts: partial aggregates with "sum", "min" or "max", and the measures over them
    states: dict[str, tuple[Column, str]] = field(default_factory=dict)
    from_states: Callable[[dict[str, Column]], dict[str, Column]] | None = None
    # how a rule is decided from counts per value
    by_values: "ByValues | None" = None


@dataclass
class ByValues:
    """What is counted per value, and what follows from the counts.

    ``decide`` takes ``(keys, value, number, n)`` and the keys, and returns the keys with ``unexpected``
    for a row rule, or with the rule's measures."""

    value: Column
    decide: Callable[[DataFrame, list[str]], DataFrame]
    number: Column | None = None
    skip: Column | None = None


RULES: dict[str, Callable[..., Rule]] = {}


def rule(name: str):
    def register(builder):
        RULES[name] = builder
        return builder
    return register


def check(expectation) -> None:
    """Unknown types and wrong arguments fail when the suite is read, not when it runs."""
    if expectation.type not in RULES:
        raise ValueError(f"unknown expectation type: {expectation.type}")
    try:
        inspect.signature(RULES[expectation.type]).bind(None, **expectation.kwargs)
    except TypeError as error:
        raise ValueError(f"invalid arguments for {expectation.type}: {error}") from None


def build(df: DataFrame, expectation) -> Rule:
    return RULES[expectation.type](df, **expectation.kwargs)


# Builders of rules that need a pass of their own, for groups and for merging: by counts per value.
MERGEABLE: dict[str, Callable[..., Rule]] = {}


def mergeable(name: str):
    def register(builder):
        MERGEABLE[name] = builder
        return builder
    return register


def build_mergeable(df: DataFrame, expectation) -> Rule:
    """The rule in a form that runs per group and merges from parts; raises where there is none."""
    made = MERGEABLE.get(expectation.type, RULES[expectation.type])(df, **expectation.kwargs)
    if made.own_pass or made.measures and made.by_values is None and not made.states:
        raise ValueError(f"{expectation.type} cannot be merged from partial counts")
    return made


def number_text(value: Column) -> Column:
    return printed(value, 4)


def in_bounds(value: Column, low, high, strict_min=False, strict_max=False) -> Column:
    if low is None and high is None:
        raise ValueError("min_value and max_value cannot both be absent")
    test = F.lit(True)
    if low is not None:
        test = test & (value > F.lit(low) if strict_min else value >= F.lit(low))
    if high is not None:
        test = test & (value < F.lit(high) if strict_max else value <= F.lit(high))
    return test


def fitted(df: DataFrame, column: str, values: list) -> list[Column]:
    """Literals in the column's type; one that does not fit it is NULL and matches nothing."""
    kind = df.select(column).schema[0].dataType
    return [F.lit(str(v) if kind.typeName() == "string" else v).try_cast(kind) for v in values]


def one_of(df: DataFrame, column: str, values: list) -> Column:
    fitting = fitted(df, column, values)
    return F.coalesce(F.col(column).isin(*fitting), F.lit(False)) if fitting else F.lit(False)


def _row(column: str, bad: Column, mostly: float = 1.0) -> Rule:
    c = F.col(column)
    return Rule(missing=c.isNull(), unexpected=c.isNotNull() & bad, mostly=mostly, subject=c)


def _measure(value: Column, low, high, strict_min=False, strict_max=False, extra=None, states=None, final=None) -> Rule:
    """One aggregate within bounds; NULL (no rows) does not pass. ``states`` and ``final`` say how it merges."""
    return Rule(
        states=states or {}, from_states=None if states is None else lambda s: {"value": final(s)},
        measures={"value": value, **(extra or {})},
        passed=lambda m: F.coalesce(in_bounds(m["value"], low, high, strict_min, strict_max), F.lit(False)),
        observed=lambda m: number_text(m["value"]),
    )


def _known(passed: bool, observed: str | None = None, unexpected: int | None = None) -> Rule:
    return Rule(
        passed=lambda m: F.lit(bool(passed)),
        observed=lambda m: F.lit(observed).cast("string"),
        unexpected_count=unexpected,
    )


# --- used by the shipped suite --------------------------------------------------------

@rule("expect_column_values_to_not_be_null")
def not_null(df, column: str, mostly: float = 1.0) -> Rule:
    c = F.col(column)
    return Rule(missing=F.lit(False), unexpected=c.isNull(), percent_of_all=True, mostly=mostly, subject=c)


@rule("expect_column_values_to_be_in_set")
def in_set(df, column: str, value_set: list, mostly: float = 1.0) -> Rule:
    return _row(column, ~one_of(df, column, value_set), mostly)


@rule("expect_column_values_to_be_between")
def values_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                   strict_max: bool = False, mostly: float = 1.0) -> Rule:
    return _row(column, ~in_bounds(F.col(column), min_value, max_value, strict_min, strict_max), mostly)


def _skipped(a: Column, b: Column, ignore_row_if: str) -> Column:
    if ignore_row_if == "both_values_are_missing":
        return a.isNull() & b.isNull()
    if ignore_row_if == "either_value_is_missing":
        return a.isNull() | b.isNull()
    if ignore_row_if == "never":
        return F.lit(False)
    raise ValueError(f"unknown ignore_row_if: {ignore_row_if}")


def _pair(column_A, column_B, ignore_row_if, good: Column, mostly: float) -> Rule:
    skip = _skipped(F.col(column_A), F.col(column_B), ignore_row_if)
    return Rule(missing=skip, unexpected=~skip & ~F.coalesce(good, F.lit(False)), mostly=mostly,
                subject=F.struct(column_A, column_B))


@rule("expect_column_pair_values_A_to_be_greater_than_B")
def pair_greater(df, column_A: str, column_B: str, or_equal: bool = False,
                 ignore_row_if: str = "both_values_are_missing", mostly: float = 1.0) -> Rule:
    a, b = F.col(column_A), F.col(column_B)
    return _pair(column_A, column_B, ignore_row_if, a >= b if or_equal else a > b, mostly)


@rule("expect_column_quantile_values_to_be_between")
def quantiles_between(df, column: str, quantile_ranges: dict, allow_relative_error: bool = False,
                      accuracy: int = 10_000) -> Rule:
    shares = [float(q) for q in quantile_ranges["quantiles"]]
    ranges = quantile_ranges["value_ranges"]
    if len(shares) != len(ranges):
        raise ValueError("quantiles and value_ranges differ in length")

    def test(values: list[Column]) -> Column:
        out = F.lit(True)
        for value, (low, high) in zip(values, ranges):
            if low is not None or high is not None:
                out = out & in_bounds(value, low, high)
        return F.coalesce(out, F.lit(False))

    def text(values: list[Column]) -> Column:
        return F.concat_ws(",", *[number_text(v) for v in values])

    if allow_relative_error:
        sketch = F.percentile_approx(F.col(column).cast("double"), shares, accuracy)
        split = lambda m: [m["values"][i] for i in range(len(shares))]
        return Rule(measures={"values": sketch}, passed=lambda m: test(split(m)), observed=lambda m: text(split(m)))
    found = stats.quantiles(df, {column: (F.col(column), shares)})[column]
    exact = [F.lit(v).cast("double") for v in found]
    told = F.lit(",".join("null" if v is None else repr(v) for v in found))  # unrounded, so that a reader rounds but once
    return Rule(passed=lambda m: test(exact), observed=lambda m: told, own_pass=True)


# --- reachable by name ----------------------------------------------------------------

@rule("expect_column_values_to_be_null")
def is_null(df, column: str, mostly: float = 1.0) -> Rule:
    c = F.col(column)
    return Rule(missing=F.lit(False), unexpected=c.isNotNull(), percent_of_all=True, mostly=mostly, subject=c)


@rule("expect_column_values_to_not_be_in_set")
def not_in_set(df, column: str, value_set: list, mostly: float = 1.0) -> Rule:
    return _row(column, one_of(df, column, value_set), mostly)


def _duplicates(df: DataFrame, columns: list[str], skip: Column) -> int:
    """Rows whose value occurs more than once. Combined per value before the shuffle."""
    repeated = df.filter(~skip).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


@rule("expect_column_values_to_be_unique")
def unique(df, column: str, mostly: float = 1.0) -> Rule:
    skip = F.col(column).isNull()
    return Rule(missing=skip, mostly=mostly, unexpected_count=_duplicates(df, [column], skip), own_pass=True,
                repeated=[column], repeated_skip=skip, subject=F.col(column))


@rule("expect_compound_columns_to_be_unique")
def compound_unique(df, column_list: list, ignore_row_if: str = "all_values_are_missing",
                    mostly: float = 1.0) -> Rule:
    skip = _skipped_list(column_list, ignore_row_if)
    return Rule(missing=skip, mostly=mostly, unexpected_count=_duplicates(df, column_list, skip), own_pass=True,
                repeated=list(column_list), repeated_skip=skip, subject=F.struct(*column_list))


def _skipped_list(columns: list[str], ignore_row_if: str) -> Column:
    nulls = [F.col(c).isNull() for c in columns]
    if ignore_row_if == "never":
        return F.lit(False)
    if ignore_row_if not in ("all_values_are_missing", "any_value_is_missing"):
        raise ValueError(f"unknown ignore_row_if: {ignore_row_if}")
    out = nulls[0]
    for n in nulls[1:]:
        out = out & n if ignore_row_if == "all_values_are_missing" else out | n
    return out


@rule("expect_select_column_values_to_be_unique_within_record")
def unique_within_record(df, column_list: list, ignore_row_if: str = "all_values_are_missing",
                         mostly: float = 1.0) -> Rule:
    skip = _skipped_list(column_list, ignore_row_if)
    values = F.array_compact(F.array(*[F.col(c).cast("string") for c in column_list]))
    return Rule(missing=skip, unexpected=~skip & (F.size(F.array_distinct(values)) < F.size(values)), mostly=mostly,
                subject=F.struct(*column_list))


@rule("expect_column_value_lengths_to_be_between")
def lengths_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                    strict_max: bool = False, mostly: float = 1.0) -> Rule:
    return _row(column, ~in_bounds(F.length(column), min_value, max_value, strict_min, strict_max), mostly)


@rule("expect_column_value_lengths_to_equal")
def lengths_equal(df, column: str, value: int, mostly: float = 1.0) -> Rule:
    return _row(column, F.length(column) != F.lit(value), mostly)


def _any(column: str, patterns: list[str], how: str) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | (F.col(column).rlike(p) if how == "regex" else F.col(column).like(p))
    return out


def _all(column: str, patterns: list[str], how: str) -> Column:
    out = F.lit(True)
    for p in patterns:
        out = out & (F.col(column).rlike(p) if how == "regex" else F.col(column).like(p))
    return out


def _matching(column, patterns, match_on, how) -> Column:
    if match_on not in ("any", "all"):
        raise ValueError(f"match_on must be any or all: {match_on}")
    return _any(column, patterns, how) if match_on == "any" else _all(column, patterns, how)


@rule("expect_column_values_to_match_regex")
def match_regex(df, column: str, regex: str, mostly: float = 1.0) -> Rule:
    return _row(column, ~F.col(column).rlike(regex), mostly)


@rule("expect_column_values_to_not_match_regex")
def not_match_regex(df, column: str, regex: str, mostly: float = 1.0) -> Rule:
    return _row(column, F.col(column).rlike(regex), mostly)


@rule("expect_column_values_to_match_regex_list")
def match_regex_list(df, column: str, regex_list: list, match_on: str = "any", mostly: float = 1.0) -> Rule:
    return _row(column, ~_matching(column, regex_list, match_on, "regex"), mostly)


@rule("expect_column_values_to_not_match_regex_list")
def not_match_regex_list(df, column: str, regex_list: list, mostly: float = 1.0) -> Rule:
    return _row(column, _any(column, regex_list, "regex"), mostly)


@rule("expect_column_values_to_match_like_pattern")
def match_like(df, column: str, like_pattern: str, mostly: float = 1.0) -> Rule:
    return _row(column, ~F.col(column).like(like_pattern), mostly)


@rule("expect_column_values_to_not_match_like_pattern")
def not_match_like(df, column: str, like_pattern: str, mostly: float = 1.0) -> Rule:
    return _row(column, F.col(column).like(like_pattern), mostly)


@rule("expect_column_values_to_match_like_pattern_list")
def match_like_list(df, column: str, like_pattern_list: list, match_on: str = "any", mostly: float = 1.0) -> Rule:
    return _row(column, ~_matching(column, like_pattern_list, match_on, "like"), mostly)


@rule("expect_column_values_to_not_match_like_pattern_list")
def not_match_like_list(df, column: str, like_pattern_list: list, mostly: float = 1.0) -> Rule:
    return _row(column, _any(column, like_pattern_list, "like"), mostly)


def _moments(column: str) -> dict:
    c = F.col(column).cast("double")
    return {"n": (F.count(c), "sum"), "s": (F.sum(c), "sum"), "q": (F.sum(c * c), "sum")}


def _deviation(s: dict[str, Column]) -> Column:
    """Sample deviation from count, sum and sum of squares."""
    n = s["n"].cast("double")
    rest = F.greatest(s["q"] - s["s"] * F.try_divide(s["s"], n), F.lit(0.0))
    return F.when(n > 1, F.sqrt(rest / (n - 1)))


@rule("expect_column_mean_to_be_between")
def mean_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                 strict_max: bool = False) -> Rule:
    return _measure(F.avg(column), min_value, max_value, strict_min, strict_max,
                    states=_moments(column), final=lambda s: F.try_divide(s["s"], s["n"]))


@rule("expect_column_stdev_to_be_between")
def stdev_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                  strict_max: bool = False) -> Rule:
    return _measure(F.stddev_samp(column), min_value, max_value, strict_min, strict_max,
                    states=_moments(column), final=_deviation)


@rule("expect_column_sum_to_be_between")
def sum_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                strict_max: bool = False) -> Rule:
    return _measure(F.sum(column), min_value, max_value, strict_min, strict_max,
                    states={"s": (F.sum(column), "sum")}, final=lambda s: s["s"])


@rule("expect_column_min_to_be_between")
def min_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                strict_max: bool = False) -> Rule:
    return _measure(F.min(column), min_value, max_value, strict_min, strict_max,
                    states={"m": (F.min(column), "min")}, final=lambda s: s["m"])


@rule("expect_column_max_to_be_between")
def max_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                strict_max: bool = False) -> Rule:
    return _measure(F.max(column), min_value, max_value, strict_min, strict_max,
                    states={"m": (F.max(column), "max")}, final=lambda s: s["m"])


@rule("expect_column_median_to_be_between")
def median_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                   strict_max: bool = False) -> Rule:
    median = F.lit(stats.quantiles(df, {column: (F.col(column), [0.5])})[column][0]).cast("double")
    return Rule(
        passed=lambda m: F.coalesce(in_bounds(median, min_value, max_value, strict_min, strict_max), F.lit(False)),
        observed=lambda m: number_text(median),
        own_pass=True,
    )


def _distinct(df: DataFrame, column: str) -> tuple[int, int]:
    """Distinct and non-null counts, through a shuffle on the value."""
    row = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    )
    return row["distinct"], row["total"]


@rule("expect_column_unique_value_count_to_be_between")
def distinct_count_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                           strict_max: bool = False, approximate: bool = False) -> Rule:
    value = F.approx_count_distinct(column) if approximate else F.max(F.lit(_distinct(df, column)[0]))
    return replace(_measure(value, min_value, max_value, strict_min, strict_max), own_pass=not approximate)


@rule("expect_column_proportion_of_unique_values_to_be_between")
def distinct_share_between(df, column: str, min_value=None, max_value=None, strict_min: bool = False,
                           strict_max: bool = False) -> Rule:
    distinct, total = _distinct(df, column)
    share = distinct / total if total else None
    return replace(_measure(F.max(F.lit(share).cast("double")), min_value, max_value, strict_min, strict_max), own_pass=True)


def _distinct_set(df: DataFrame, column: str, value_set: list, inside: bool, contains: bool) -> Rule:
    """Set tests by counting, so the distinct values are never gathered."""
    c = F.col(column)
    measures = {"outside": F.count(F.when(c.isNotNull() & ~one_of(df, column, value_set), 1))}
    for i, value in enumerate(fitted(df, column, value_set)):
        measures[f"hit{i}"] = F.max(F.when(c == value, 1).otherwise(0))

    def hits(m):
        out = F.lit(0)
        for i in range(len(value_set)):
            out = out + F.coalesce(m[f"hit{i}"], F.lit(0))
        return out

    def passed(m):
        test = F.lit(True)
        if inside:
            test = test & (m["outside"] == 0)
        if contains:
            test = test & (hits(m) == len(value_set))
        return test

    return Rule(measures=measures, passed=passed, from_states=lambda s: s,
                states={name: (c, "sum" if name == "outside" else "max") for name, c in measures.items()},
                observed=lambda m: F.concat_ws("/", hits(m).cast("string"), m["outside"].cast("string")))


@rule("expect_column_distinct_values_to_be_in_set")
def distinct_in_set(df, column: str, value_set: list) -> Rule:
    return _distinct_set(df, column, value_set, inside=True, contains=False)


@rule("expect_column_distinct_values_to_contain_set")
def distinct_contain_set(df, column: str, value_set: list) -> Rule:
    return _distinct_set(df, column, value_set, inside=False, contains=True)


@rule("expect_column_distinct_values_to_equal_set")
def distinct_equal_set(df, column: str, value_set: list) -> Rule:
    return _distinct_set(df, column, value_set, inside=True, contains=True)


@rule("expect_column_most_common_value_to_be_in_set")
def most_common_in_set(df, column: str, value_set: list, ties_okay: bool = False) -> Rule:
    """One of the most frequent values is allowed; without ``ties_okay`` it must be the only one."""
    counts = stats.value_counts(df, {column: F.col(column)})
    allowed = [str(v) for v in value_set]
    best = counts.groupBy("n").agg(
        F.count(F.lit(1)).alias("tied"), F.min("value").alias("lowest"),
        F.count(F.when(F.col("value").isin(allowed), 1)).alias("hits"),
    ).orderBy(F.desc("n")).limit(1).collect()
    if not best:
        return replace(_known(False), own_pass=True)
    top = best[0]
    return replace(_known(top["hits"] > 0 if ties_okay else top["hits"] == 1 and top["tied"] == 1, top["lowest"]), own_pass=True)


@rule("expect_table_row_count_to_be_between")
def row_count_between(df, min_value=None, max_value=None, strict_min: bool = False, strict_max: bool = False) -> Rule:
    return _measure(F.count(F.lit(1)), min_value, max_value, strict_min, strict_max,
                    states={"n": (F.count(F.lit(1)), "sum")}, final=lambda s: s["n"])


@rule("expect_table_row_count_to_equal")
def row_count_equal(df, value: int) -> Rule:
    return _measure(F.count(F.lit(1)), value, value, states={"n": (F.count(F.lit(1)), "sum")}, final=lambda s: s["n"])


@rule("expect_table_row_count_to_equal_other_table")
def row_count_equal_other(df, other_table_name: str) -> Rule:
    return row_count_equal(df, df.sparkSession.table(other_table_name).count())


@rule("expect_table_column_count_to_equal")
def column_count_equal(df, value: int) -> Rule:
    return _known(len(df.columns) == value, str(len(df.columns)))


@rule("expect_table_column_count_to_be_between")
def column_count_between(df, min_value: int | None = None, max_value: int | None = None) -> Rule:
    n = len(df.columns)
    return _known((min_value is None or n >= min_value) and (max_value is None or n <= max_value), str(n))


@rule("expect_table_columns_to_match_set")
def columns_match_set(df, column_set: list, exact_match: bool = True) -> Rule:
    have, want = set(df.columns), set(column_set)
    return _known(have == want if exact_match else want <= have, ",".join(sorted(have)))


@rule("expect_table_columns_to_match_ordered_list")
def columns_match_list(df, column_list: list) -> Rule:
    return _known(list(df.columns) == list(column_list), ",".join(df.columns))


@rule("expect_column_to_exist")
def column_exists(df, column: str, column_index: int | None = None) -> Rule:
    there = column in df.columns
    return _known(there and column_index in (None, df.columns.index(column)), None)


def _type_name(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


@rule("expect_column_values_to_be_of_type")
def of_type(df, column: str, type_: str) -> Rule:
    return type_in_list(df, column, [type_])


@rule("expect_column_values_to_be_in_type_list")
def type_in_list(df, column: str, type_list: list) -> Rule:
    kind = _type_name(df, column)
    names = {kind, type(df.schema[column].dataType).__name__}
    return _known(bool(names & set(type_list)), kind)


@rule("expect_column_pair_values_to_be_equal")
def pair_equal(df, column_A: str, column_B: str, ignore_row_if: str = "both_values_are_missing",
               mostly: float = 1.0) -> Rule:
    return _pair(column_A, column_B, ignore_row_if, F.col(column_A).eqNullSafe(F.col(column_B)), mostly)


@rule("expect_column_pair_values_to_be_in_set")
def pair_in_set(df, column_A: str, column_B: str, value_pairs_set: list,
                ignore_row_if: str = "both_values_are_missing", mostly: float = 1.0) -> Rule:
    good = F.lit(False)
    for a, b in value_pairs_set:
        good = good | (F.col(column_A).eqNullSafe(F.lit(a)) & F.col(column_B).eqNullSafe(F.lit(b)))
    return _pair(column_A, column_B, ignore_row_if, good, mostly)


@rule("expect_multicolumn_sum_to_equal")
def multicolumn_sum(df, column_list: list, sum_total: float, ignore_row_if: str = "all_values_are_missing",
                    mostly: float = 1.0) -> Rule:
    skip = _skipped_list(column_list, ignore_row_if)
    total = F.lit(0)
    for c in column_list:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return Rule(missing=skip, unexpected=~skip & (total != F.lit(sum_total)), mostly=mostly,
                subject=F.struct(*column_list))


@rule("expect_column_value_z_scores_to_be_less_than")
def z_scores(df, column: str, threshold: float, double_sided: bool = True, mostly: float = 1.0) -> Rule:
    c = F.col(column)
    moments = stats.scalars(df, {"mean": F.avg(c), "sd": F.stddev_samp(c)})
    if not moments["sd"]:
        return replace(_row(column, F.lit(False), mostly), own_pass=True)
    z = (c - F.lit(moments["mean"])) / F.lit(moments["sd"])
    return replace(_row(column, ~((F.abs(z) if double_sided else z) < F.lit(float(threshold))), mostly), own_pass=True)


@rule("expect_column_kl_divergence_to_be_less_than")
def kl_divergence(df, column: str, partition_object: dict, threshold: float,
                  tail_weight_holdout: float = 0.0, internal_weight_holdout: float = 0.0) -> Rule:
    """Divergence of the observed shares from a given partition.

    Categorical partitions give ``values`` and ``weights``; numeric ones ``bins`` (edges)
    and ``weights``. A value outside the partition makes the divergence infinite, unless
    a holdout reserves weight for the tails (or for empty weights inside).
    """
    c = F.col(column)
    weights = [float(w) for w in partition_object["weights"]]
    if "values" in partition_object:
        cells = [F.coalesce(c == v, F.lit(False)) for v in fitted(df, column, partition_object["values"])]
        tails = [c.isNotNull() & ~one_of(df, column, partition_object["values"])]
    else:
        edges = partition_object["bins"]
        last = len(edges) - 2
        cells = [
            (c >= F.lit(lo)) & ((c <= F.lit(hi)) if i == last else (c < F.lit(hi)))
            for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
        ]
        tails = [c < F.lit(edges[0]), c > F.lit(edges[-1])]
    inner = 1.0 - tail_weight_holdout - internal_weight_holdout
    empty = sum(1 for w in weights if w == 0)
    expected = [w * inner if w or not empty else internal_weight_holdout / empty for w in weights]
    expected += [tail_weight_holdout / len(tails)] * len(tails)
    measures = {f"n{i}": F.count(F.when(cell, 1)) for i, cell in enumerate(cells + tails)}

    def divergence(m):
        total = m["n0"]
        for i in range(1, len(expected)):
            total = total + m[f"n{i}"]
        out = F.lit(0.0)
        for i, q in enumerate(expected):
            p = F.try_divide(m[f"n{i}"], total)
            term = p * F.ln(p / F.lit(q)) if q > 0 else F.lit(float("inf"))
            out = out + F.when(p > 0, term).otherwise(F.lit(0.0))
        return F.when(total > 0, out)

    return Rule(measures=measures, states={name: (c, "sum") for name, c in measures.items()}, from_states=lambda s: s,
                passed=lambda m: F.coalesce(divergence(m) <= F.lit(float(threshold)), F.lit(False)),
                observed=lambda m: number_text(divergence(m)))


# --- rules with a pass of their own, from counts per value ------------------------------

def _repeats(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected"))


@mergeable("expect_column_values_to_be_unique")
def unique_by_values(df, column: str, mostly: float = 1.0) -> Rule:
    c = F.col(column)
    return Rule(missing=c.isNull(), mostly=mostly, subject=c, by_values=ByValues(c.cast("string"), _repeats, skip=c.isNull()))


@mergeable("expect_compound_columns_to_be_unique")
def compound_unique_by_values(df, column_list: list, ignore_row_if: str = "all_values_are_missing", mostly: float = 1.0) -> Rule:
    skip = _skipped_list(column_list, ignore_row_if)
    return Rule(missing=skip, mostly=mostly, subject=F.struct(*column_list), by_values=ByValues(F.to_json(F.struct(*column_list)), _repeats, skip=skip))


def _by_distinct(column: str, value: Column, bounds: tuple) -> Rule:
    c = F.col(column)
    return Rule(passed=lambda m: F.coalesce(in_bounds(m["value"], *bounds), F.lit(False)), observed=lambda m: number_text(m["value"]),
                measures={"value": F.lit(None)},
                by_values=ByValues(c.cast("string"), lambda counts, keys: counts.groupBy(*keys).agg(value.alias("value")), skip=c.isNull()))


@mergeable("expect_column_unique_value_count_to_be_between")
def distinct_count_by_values(df, column: str, min_value=None, max_value=None, strict_min: bool = False, strict_max: bool = False,
                             approximate: bool = False) -> Rule:
    """Exact also where an approximate count is asked for."""
    return _by_distinct(column, F.count(F.lit(1)), (min_value, max_value, strict_min, strict_max))


@mergeable("expect_column_proportion_of_unique_values_to_be_between")
def distinct_share_by_values(df, column: str, min_value=None, max_value=None, strict_min: bool = False, strict_max: bool = False) -> Rule:
    return _by_distinct(column, F.count(F.lit(1)) / F.sum("n"), (min_value, max_value, strict_min, strict_max))


@mergeable("expect_column_most_common_value_to_be_in_set")
def most_common_by_values(df, column: str, value_set: list, ties_okay: bool = False) -> Rule:
    c, allowed = F.col(column), [str(v) for v in value_set]

    def decide(counts: DataFrame, keys: list[str]) -> DataFrame:
        same = counts.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("tied"), F.min("value").alias("lowest"), F.count_if(F.col("value").isin(allowed)).alias("hits"))
        top = same.groupBy(*keys).agg(*[F.max_by(x, "n").alias(x) for x in ("tied", "lowest", "hits")])
        good = F.col("hits") > 0 if ties_okay else (F.col("hits") == 1) & (F.col("tied") == 1)
        return top.select(*keys, good.alias("good"), "lowest")

    return Rule(passed=lambda m: F.coalesce(m["good"], F.lit(False)), observed=lambda m: m["lowest"],
                measures={"good": F.lit(None), "lowest": F.lit(None)}, by_values=ByValues(c.cast("string"), decide, skip=c.isNull()))


@mergeable("expect_column_value_z_scores_to_be_less_than")
def z_scores_by_values(df, column: str, threshold: float, double_sided: bool = True, mostly: float = 1.0) -> Rule:
    c = F.col(column)

    def decide(counts: DataFrame, keys: list[str]) -> DataFrame:
        v, n = F.col("number"), F.col("n")
        moments = counts.groupBy(*keys).agg((F.sum(v * n) / F.sum("n")).alias("mean"), F.sum("n").alias("total"))
        same = [F.col(f"c.`{k}`").eqNullSafe(F.col(f"m.`{k}`")) for k in keys]
        far = counts.alias("c").join(moments.alias("m"), same).select(*[F.col(f"c.`{k}`") for k in keys], (v - F.col("mean")).alias("off"), "n", "total")
        spread = far.groupBy(*keys).agg(F.when(F.max("total") > 1, F.sqrt(F.sum(F.col("off") * F.col("off") * n) / (F.max("total") - 1))).alias("sd"))
        same = [F.col(f"f.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys]
        z = F.try_divide(F.abs("off") if double_sided else F.col("off"), F.col("sd"))
        return far.alias("f").join(spread.alias("s"), same).groupBy(*[F.col(f"f.`{k}`") for k in keys]).agg(
            F.coalesce(F.sum(F.when(z >= F.lit(float(threshold)), n)), F.lit(0)).alias("unexpected"))

    return Rule(missing=c.isNull(), mostly=mostly, subject=c, by_values=ByValues(c.cast("string"), decide, c.cast("double"), c.isNull()))
