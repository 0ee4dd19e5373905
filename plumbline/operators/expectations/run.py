"""Run a suite: every counter of every expectation in one aggregate, then one row each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.cleaning import nan_to_null
from plumbline.operators.expectations import rules
from plumbline.operators.expectations.suite import Suite
from plumbline.sources.staging import staged

RESULT_SCHEMA = (
    "idx int, expectation_type string, column string, column_b string, severity string, success boolean, "
    "element_count bigint, missing_count bigint, unexpected_count bigint, unexpected_percent double, "
    "observed_value string"
)


def _columns_of(expectation) -> tuple[str | None, str | None]:
    kwargs = expectation.kwargs
    if "column_A" in kwargs:
        return None, f"{kwargs['column_A']},{kwargs['column_B']}"
    if "column_list" in kwargs and "column" not in kwargs:
        return None, ",".join(kwargs["column_list"])
    return expectation.column, None


class CompiledSuite:
    """Aggregates of a suite and the result rows over them."""

    def __init__(self, df: DataFrame, suite: Suite):
        self.suite = suite
        self.rules = [rules.build(df, e) for e in suite.expectations]
        self.counters: dict[str, Column] = {"elements": F.count(F.lit(1))}
        self.measures: dict[str, Column] = {}
        for i, rule in enumerate(self.rules):
            if rule.missing is not None:
                self.counters[f"missing_{i}"] = F.count(F.when(rule.missing, 1))
            if rule.unexpected is not None:
                self.counters[f"unexpected_{i}"] = F.count(F.when(rule.unexpected, 1))
            for name, measure in rule.measures.items():
                self.measures[f"m_{i}_{name}"] = measure

    def aggregate(self, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        aggregates = [c.alias(n) for n, c in {**self.counters, **self.measures}.items()]
        return (df.groupBy(*keys) if keys else df).agg(*aggregates)

    def results(self, counted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        rows = [self._row(i, e, r) for i, (e, r) in enumerate(zip(self.suite.expectations, self.rules))]
        if not rows:
            return counted.select(*keys, F.inline(F.from_json(F.lit("[]"), f"array<struct<{_ddl()}>>")))
        return counted.select(*keys, F.inline(F.array(*rows)))

    def _row(self, i: int, expectation, rule: rules.Rule) -> Column:
        elements = F.col("elements")
        missing = F.col(f"missing_{i}") if rule.missing is not None else F.lit(0)
        if rule.unexpected is not None or rule.by_values is not None and rule.passed is None:
            unexpected = F.col(f"unexpected_{i}")
        else:
            unexpected = F.lit(rule.unexpected_count or 0)
        observed = F.lit(None)
        if rule.passed is not None:
            measures = {name: F.col(f"m_{i}_{name}") for name in rule.measures}
            success = rule.passed(measures)
            observed = rule.observed(measures) if rule.observed else observed
            percent = F.lit(0.0)
        else:
            base = elements if rule.percent_of_all else elements - missing
            share = F.coalesce(F.try_divide(unexpected, base), F.lit(0.0))
            percent = share * 100
            if rule.mostly >= 1.0:
                success = unexpected == 0
            else:
                success = share <= F.lit(1.0 - rule.mostly + 1e-12)
        column, column_b = _columns_of(expectation)
        values = {
            "idx": F.lit(i), "expectation_type": F.lit(expectation.type), "column": F.lit(column),
            "column_b": F.lit(column_b), "severity": F.lit(expectation.severity), "success": success,
            "element_count": elements, "missing_count": missing, "unexpected_count": unexpected,
            "unexpected_percent": percent, "observed_value": observed,
        }
        types = dict(part.strip().split(" ") for part in RESULT_SCHEMA.split(","))
        return F.struct(*[values[n].cast(t).alias(n) for n, t in types.items()])


class MergeableSuite(CompiledSuite):
    """A suite over groups whose rows come in parts.

    A part is two tables: ``partial`` has counters and states of measures per group, ``values`` counts per
    value where a rule needs them. Parts are united and merged by sum, least or greatest, and
    ``judged`` turns them into result rows. Nothing is lost by cutting the rows another way.
    """

    def __init__(self, df: DataFrame, suite: Suite):
        self.suite = suite
        self.rules = [rules.build_mergeable(df, e) for e in suite.expectations]
        self.columns: dict[str, tuple[Column, str]] = {"elements": (F.count(F.lit(1)), "sum")}
        for i, rule in enumerate(self.rules):
            if rule.missing is not None:
                self.columns[f"missing_{i}"] = (F.count(F.when(rule.missing, 1)), "sum")
            if rule.unexpected is not None:
                self.columns[f"unexpected_{i}"] = (F.count(F.when(rule.unexpected, 1)), "sum")
            for name, state in rule.states.items():
                self.columns[f"s_{i}_{name}"] = state

    def partial(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.groupBy(*keys).agg(*[c.alias(n) for n, (c, _) in self.columns.items()])

    def values(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``(keys, idx, value, number, n)``, combined before the shuffle: one row per value however often it occurs."""
        cells = [F.when(~F.coalesce(v.skip, F.lit(False)), F.struct(F.lit(i).alias("idx"), v.value.alias("value"), (F.lit(None) if v.number is None else v.number).cast("double").alias("number")))
                 for i, v in self._by_values()]
        kind = "array<struct<idx:int,value:string,number:double>>"
        each = df.select(*keys, F.inline(F.array(*cells).cast(kind) if cells else F.array().cast(kind)))
        return each.where("idx IS NOT NULL").groupBy(*keys, "idx", "value").agg(F.first("number").alias("number"), F.count(F.lit(1)).alias("n"))

    def _by_values(self):
        return [(i, r.by_values) for i, r in enumerate(self.rules) if r.by_values is not None]

    def merged(self, partial: DataFrame, keys: Sequence[str]) -> DataFrame:
        how = {"sum": F.sum, "min": F.min, "max": F.max}
        return partial.groupBy(*keys).agg(*[how[kind](n).alias(n) for n, (_, kind) in self.columns.items()])

    @staticmethod
    def merged_values(values: DataFrame, keys: Sequence[str]) -> DataFrame:
        return values.groupBy(*keys, "idx", "value").agg(F.first("number").alias("number"), F.sum("n").alias("n"))

    def judged(self, partial: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Result rows of merged parts."""
        keys = list(keys)
        measures = {}
        for i, rule in enumerate(self.rules):
            if rule.states:
                for name, value in rule.from_states({n: F.col(f"s_{i}_{n}") for n in rule.states}).items():
                    measures[f"m_{i}_{name}"] = value
        counted = partial.withColumns(measures)
        for i, v in self._by_values():
            rule, own = self.rules[i], v.decide(values.where(F.col("idx") == i).drop("idx"), keys)
            names = {"unexpected": f"unexpected_{i}"} if rule.passed is None else {n: f"m_{i}_{n}" for n in rule.measures}
            own = own.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(n).alias(to) for n, to in names.items()])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            counted = counted.join(own, same, "left").drop(*[f"_{k}" for k in keys])
            if rule.passed is None:
                counted = counted.fillna(0, [f"unexpected_{i}"])
        return self.results(counted, keys)


def _ddl() -> str:
    return ", ".join(p.strip().replace(" ", ": ") for p in RESULT_SCHEMA.split(","))


def run_suite(df: DataFrame, suite: Suite, keys: Sequence[str] = ()) -> DataFrame:
    """One row per expectation (and per group of ``keys``): a single scan of ``df``.

    Uniqueness, exact distinct counts, exact quantiles, the most common value and z-scores add a
    pass of their own; per group they are decided from one table of counts per value. Exact
    quantiles do not run per group.
    """
    df = nan_to_null(df)
    if keys and any(e.type in rules.MERGEABLE for e in suite.expectations):
        made = MergeableSuite(df, suite)
        return made.judged(made.partial(df, keys), staged(made.values(df, keys), "values"), keys)
    compiled = CompiledSuite(df, suite)
    if keys and any(r.own_pass for r in compiled.rules):
        raise ValueError("exact quantiles cannot run per group")
    return compiled.results(compiled.aggregate(df, keys), keys)


def unexpected_rows(df: DataFrame, suite: Suite, key: str = "id") -> DataFrame:
    """(key, idx, expectation_type, value) for every cell that breaks a row rule.

    Lazy and distributed: violating cells stay rows, nothing is gathered. Rows that break
    uniqueness are found by joining their repeated values back.
    """
    df = nan_to_null(df)
    found, types, values, repeats = [], {}, F.lit(None).cast("string"), []
    for i, e in enumerate(suite.expectations):
        rule = rules.build(df, e)
        if rule.repeated:
            repeats.append(_repeated_rows(df, i, e, rule, key))
        if rule.unexpected is None:
            continue
        found.append(F.when(rule.unexpected, F.lit(i)))
        types[i] = e.type
        value = rule.subject.cast("string") if e.column else F.to_json(rule.subject)
        values = F.when(F.col("idx") == i, value).otherwise(values)
    if not found and repeats:
        return reduce(DataFrame.unionByName, repeats)
    if not found:
        return df.select(key).filter(F.lit(False)).selectExpr(
            key, "cast(null as int) idx", "cast(null as string) expectation_type", "cast(null as string) value")
    # only numbers of broken rules are generated; type and value are looked up for those alone
    names = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    broken = df.select("*", F.explode(F.array(*found)).alias("idx")).filter(F.col("idx").isNotNull())
    rows = broken.select(key, "idx", names[F.col("idx")].alias("expectation_type"), values.alias("value"))
    return reduce(DataFrame.unionByName, repeats, rows)


def _repeated_rows(df: DataFrame, i: int, expectation, rule: rules.Rule, key: str) -> DataFrame:
    value = rule.subject.cast("string") if expectation.column else F.to_json(rule.subject)
    rows = df.filter(~rule.repeated_skip)
    many = rows.groupBy(*rule.repeated).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = reduce(lambda a, b: a & b, [F.col(f"r.`{c}`").eqNullSafe(F.col(f"m.`{c}`")) for c in rule.repeated])
    broken = rows.alias("r").join(many.alias("m"), same, "left_semi")
    return broken.select(key, F.lit(i).alias("idx"), F.lit(expectation.type).alias("expectation_type"), value.alias("value"))
