"""Repair only what failed: a chain of projections whose statistics are fitted first.

Every step fits its scalars for all its columns in one or two passes and then is a plain
projection against literals, so the whole chain collapses into few projections over one
scan and no step joins statistics back.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.domain import CREDIT, Domain
from plumbline.functions.cleaning import numeric_columns, text_columns
from plumbline.functions.draws import between, uniform, with_key, without_key
from plumbline.operators import impute, isolation, stats
from plumbline.operators.expectations import Suite
from plumbline.sources.staging import staged

NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class Failures:
    """The failed rules of a validation, as the gate hands them over."""

    pairs: frozenset[tuple[str, str | None]]

    @classmethod
    def of(cls, failed: Iterable) -> "Failures":
        """From (type, column) pairs, {type, column} mappings or rows."""
        return cls(frozenset(
            tuple(f) if isinstance(f, tuple) and not hasattr(f, "asDict") else (f["type"], f["column"]) for f in failed
        ))

    @property
    def columns(self) -> set[str]:
        return {name for _, c in self.pairs if c for name in c.split(",")}

    def any_type(self, part: str) -> bool:
        return any(part in t for t, _ in self.pairs)

    def failing(self, kind: str, df: DataFrame) -> list[str]:
        return [c for c in df.columns if (kind, c) in self.pairs]


def fill_missing(df: DataFrame, columns: Sequence[str], suite: Suite, domain: Domain = CREDIT,
                 rows: int | None = None) -> DataFrame:
    """NULL to: the mean for the amount, duration and age columns (a nearest-neighbour fill on
    one column is its mean), the median for other numbers, and for categories the most
    frequent allowed value, else the first allowed one, else UNKNOWN."""
    numbers = numeric_columns(df, columns)
    texts = [c for c in columns if c in text_columns(df)]
    means = stats.scalars(df, {c: F.avg(c) for c in numbers if c in domain.mean_filled})
    medians = stats.quantiles(df, {c: (F.col(c), [0.5]) for c in numbers if c not in domain.mean_filled})
    fills: dict[str, Column] = {}
    for c in numbers:
        value = means[c] if c in means else medians[c][0]
        if value is not None:
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(value)))
    for c, value in _replacements(df, texts, suite, unknown=UNKNOWN).items():
        fills[c] = F.coalesce(F.col(c), F.lit(value))
    return df.withColumns(fills)


def _replacements(df: DataFrame, columns: Sequence[str], suite: Suite, unknown: str | None) -> dict[str, str]:
    allowed = {c: suite.valid_values(c) or [] for c in columns}
    tops = stats.top_values(df, {
        c: F.when(F.col(c).isin(allowed[c]), F.col(c)) if allowed[c] else F.col(c) for c in columns
    })
    out = {}
    for c in columns:
        if c in tops:
            out[c] = tops[c].value
        elif allowed[c]:
            out[c] = allowed[c][0]
        elif unknown is not None:
            out[c] = unknown
    return out


def cap_outliers(df: DataFrame, columns: Sequence[str], *, key: str = "id", seed: int = 42,
                 flag: Column | None = None, tag: str = "cap", rows: int | None = None) -> DataFrame:
    """Values above Q3 + 1.5 IQR move into the upper normal region, between the 75th and the
    95th percentile of what is left. Columns without spread stay. With ``flag`` only flagged
    rows count as outliers."""
    numbers = numeric_columns(df, columns)
    value = {c: F.col(c).cast("double") for c in numbers}
    quartiles = stats.quantiles(df, {c: (value[c], [0.25, 0.75]) for c in numbers})
    bounds = {
        c: q3 + 1.5 * (q3 - q1) for c, (q1, q3) in quartiles.items() if q1 is not None and q3 > q1
    }
    high = {c: value[c] > F.lit(b) for c, b in bounds.items()}
    if flag is not None:
        high = {c: h & flag for c, h in high.items()}
    normal = stats.quantiles(df, {
        c: (F.when(~h, value[c]), [0.75, 0.95]) for c, h in high.items()
    })
    changed = {}
    for c, h in high.items():
        low, top = normal[c]
        if low is None:
            new = F.lit(bounds[c])
        elif low == top:
            new = F.lit(min(bounds[c], top))
        else:
            new = between(low, top, uniform(f"{tag}:{c}", seed))
        changed[c] = F.when(h, new).otherwise(value[c])
    return without_key(with_key(df, key).withColumns(changed)) if changed else df


def fix_categories(df: DataFrame, columns: Sequence[str], suite: Suite) -> DataFrame:
    """Values outside the allowed set become the most frequent allowed one. Numbers are left alone."""
    texts = [c for c in columns if c in text_columns(df) and suite.valid_values(c)]
    return df.withColumns({
        c: F.when(F.col(c).isNotNull() & ~F.col(c).isin(suite.valid_values(c)), F.lit(value)).otherwise(F.col(c))
        for c, value in _replacements(df, texts, suite, unknown=None).items()
    })


def fix_pair(df: DataFrame, domain: Domain = CREDIT, *, key: str = "id", seed: int = 42) -> DataFrame:
    """Where the amount is below the duration, 10 to 50 times the duration."""
    amount, duration = F.col(domain.amount).cast("double"), F.col(domain.duration).cast("double")
    return without_key(with_key(df, key).withColumn(domain.amount, F.when(
        amount < duration, duration * between(10, 50, uniform("pair", seed))).otherwise(amount)))


def fix_range(df: DataFrame, domain: Domain = CREDIT, rows: int | None = None) -> DataFrame:
    """Values outside the plausible range become the median of those inside."""
    low, high = domain.age_range
    c = F.col(domain.age).cast("double")
    median = stats.quantiles(df, {"age": (F.when(c.between(low, high), c), [0.5])})["age"][0]
    if median is None:
        return df
    return df.withColumn(domain.age, F.when((c < low) | (c > high), F.lit(median)).otherwise(c))


def multivariate_outliers(df: DataFrame, columns: Sequence[str], *, key: str = "id", seed: int = 42,
                          contamination: float = 0.1, trees: int = 100) -> DataFrame:
    """Isolation forest over the numeric columns, then the capping rule on flagged rows only.

    The flagged table is written once, since later passes must not score again."""
    numbers = numeric_columns(df, columns)
    if not numbers:
        return df
    flagged = staged(isolation.flag(df, numbers, key=key, seed=seed, contamination=contamination, trees=trees,
                                    output="_isolated"), "isolated")
    return cap_outliers(flagged, numbers, key=key, seed=seed, flag=F.col("_isolated"), tag="isolated").drop("_isolated")


def conditional_fill(df: DataFrame, columns: Sequence[str], target: str, few: int = 10_000) -> DataFrame:
    """NULL categories become the one under which the row's target is most likely; rows without
    a known target get the most frequent category. Ties go to the lowest category."""
    texts = [c for c in columns if c in text_columns(df)]
    if not texts:
        return df
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in texts])
    counts = (
        df.select(F.col(target).alias("target"), F.inline(cells)).filter(F.col("value").isNotNull())
        .groupBy("name", "value", "target").agg(F.count(F.lit(1)).alias("n"))
    )
    known = counts.filter(F.col("target").isNotNull())
    totals = known.groupBy("name", "value").agg(F.sum("n").alias("total"))
    best = (
        known.join(totals, ["name", "value"])
        .groupBy("target", "name")
        .agg(F.min(F.struct((-F.col("n") / F.col("total")).alias("minus_share"), "value")).alias("top"))
        .groupBy("target").pivot("name", texts).agg(F.first("top.value"))
        .select(F.col("target").alias("_target"), *[F.col(c).alias(f"_fill_{c}") for c in texts])
    )
    best = staged(best, "fills")
    if best.count() <= few:
        best = F.broadcast(best)
    tops = stats.top_values(df, {c: F.col(c) for c in texts})
    joined = df.join(best, F.col(target) == F.col("_target"), "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.col(f"_fill_{c}"), F.lit(tops[c].value)) for c in texts if c in tops
    }).select(*df.columns)


def improve(df: DataFrame, failed: Iterable, suite: Suite, domain: Domain = CREDIT, *, key: str = "id",
            seed: int = 42, advanced: bool = True, isolation_columns: Sequence[str] | None = None,
            contamination: float = 0.1, trees: int = 100) -> DataFrame:
    """All repairs that the failures call for, in order: nulls, outliers, categories, the pair
    rule, the range rule, and with ``advanced`` isolation forest, conditional and chained fill.
    Nothing failed: the table as it is."""
    failures = failed if isinstance(failed, Failures) else Failures.of(failed)
    if not failures.pairs:
        return df
    rows = df.count()
    if failures.any_type("null"):
        df = fill_missing(df, failures.failing(NOT_NULL, df), suite, domain, rows)
    if failures.any_type("between"):
        df = cap_outliers(df, failures.failing(BETWEEN, df), key=key, seed=seed, rows=rows)
    if failures.any_type("in_set"):
        df = fix_categories(df, failures.failing(IN_SET, df), suite)
    if {domain.amount, domain.duration} & failures.columns and {domain.amount, domain.duration} <= set(df.columns):
        df = fix_pair(df, domain, key=key, seed=seed)
    if domain.age in failures.columns and domain.age in df.columns:
        df = fix_range(df, domain, rows)
    if not advanced:
        return df
    numbers = numeric_columns(df, failures.columns)
    texts = [c for c in df.columns if c in failures.columns and c in text_columns(df)]
    if len(numbers) >= 2 and failures.any_type("between"):
        pool = numeric_columns(df, isolation_columns or domain.columns)
        df = multivariate_outliers(df, pool, key=key, seed=seed, contamination=contamination, trees=trees)
    if texts and domain.target in df.columns:
        df = conditional_fill(df, texts, domain.target)
    if len(numbers) >= 2 and failures.any_type("null"):
        df = impute.iterative(df, numbers)
    return df
