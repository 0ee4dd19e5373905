"""Repeatable error injection. Every corruptor takes a frame with a unique key and gives
the same frame with some cells changed; all but exact missing counts are pure projections."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from plumbline.domain import CREDIT, Domain, level
from plumbline.functions.draws import HALVES, between, key_of, pick, ticket, uniform, with_key, without_key
from plumbline.operators import stats


def _drawing(step):
    """Give a corruptor the mixed key and take it away again, unless the caller brought one."""
    @functools.wraps(step)
    def run(df, scenario, domain=CREDIT, *, key="id", **options):
        changed = step(with_key(df, key), scenario, domain, key=key, **options)
        return changed if HALVES[0] in df.columns else without_key(changed)
    return run


@_drawing
def missing_values(df: DataFrame, scenario: str, domain: Domain = CREDIT, *, key: str = "id", seed: int = 42,
                   fraction: float | None = None) -> DataFrame:
    """NULL in an exact number of rows per column, where the table has more rows than that.

    ``fraction`` nulls that share of the rows instead, without looking at the table first.
    """
    counts = {c: k for c, k in domain.missing_counts[level(scenario)].items() if c in df.columns}
    if fraction is not None:
        hits = {c: uniform(f"missing:{c}:u", seed) < F.lit(float(fraction)) for c in counts}
    else:
        tickets = {c: (ticket(f"missing:{c}", seed), [n]) for c, n in counts.items()}
        # a cut that would take every row takes none: the count must stay below the table's size
        rows = df.count()
        tickets = {c: t for c, t in tickets.items() if t[1][0] < rows}
        cuts = stats.ticket_cuts(df, tickets, F.expr(key_of(df, key))) if tickets else {}
        hits = {c: p[0] for c, p in cuts.items()}
    return df.withColumns({c: F.when(~hit, F.col(c)) for c, hit in hits.items()})


@_drawing
def outliers(df: DataFrame, scenario: str, domain: Domain = CREDIT, *, key: str = "id", seed: int = 42) -> DataFrame:
    """Multiply some numbers out of range, replace some of those by a fixed extreme."""
    params = domain.outliers[level(scenario)]
    changed = {}
    for c, p in params.probability.items():
        if c not in df.columns:
            continue
        hit, extreme, draw, choice = (uniform(f"outlier:{c}:{d}", seed) for d in ("hit", "extreme", "size", "pick"))
        value = F.col(c).cast("double")
        scaled = value * between(*params.multiplier[c], draw)
        if c in domain.extreme_values:
            extremes = pick([float(v) for v in domain.extreme_values[c]], choice)
        elif c in domain.extreme_multiplier:
            extremes = value * between(*domain.extreme_multiplier[c], choice)
        else:
            extremes = scaled
        changed[c] = F.when(
            hit < F.lit(p), F.when(extreme < F.lit(params.extreme_share), extremes).otherwise(scaled)
        ).otherwise(value)
    return df.withColumns(changed)


@_drawing
def categorical_errors(df: DataFrame, scenario: str, domain: Domain = CREDIT, *, key: str = "id",
                       seed: int = 42) -> DataFrame:
    """Replace some categories by values outside the column's domain."""
    p, columns = domain.category_errors[level(scenario)]
    return df.withColumns({
        c: F.when(uniform(f"category:{c}:hit", seed) < F.lit(p),
                  pick(list(domain.invalid_values[c]), uniform(f"category:{c}:pick", seed))).otherwise(F.col(c))
        for c in columns if c in df.columns and c in domain.invalid_values
    })


@_drawing
def label_errors(df: DataFrame, scenario: str, domain: Domain = CREDIT, *, key: str = "id", seed: int = 42,
                 prob: float | None = None) -> DataFrame:
    """Swap the two classes 1 and 2 in some rows."""
    p = domain.label_flip[level(scenario)] if prob is None else prob
    label = F.col(domain.target)
    return df.withColumn(domain.target, F.when(
        uniform("label:hit", seed) < F.lit(float(p)), (F.lit(3) - label).cast(df.schema[domain.target].dataType)
    ).otherwise(label))


@_drawing
def relationship_violations(df: DataFrame, scenario: str, domain: Domain = CREDIT, *, key: str = "id",
                            seed: int = 42) -> DataFrame:
    """Make the duration larger than the amount in some rows with a positive amount."""
    p = domain.relation[level(scenario)]
    amount = F.col(domain.amount).cast("double")
    hit = (uniform("relation:hit", seed) < F.lit(p)) & (amount > 0)
    return df.withColumn(domain.duration, F.when(
        hit, amount * between(1.1, 2.0, uniform("relation:size", seed))
    ).otherwise(F.col(domain.duration).cast("double")))


@_drawing
def conjoined(df: DataFrame, scenario: str, domain: Domain = CREDIT, *, key: str = "id", seed: int = 42) -> DataFrame:
    """Missing values, outliers, categorical errors and violations, one after the other."""
    for step in (missing_values, outliers, categorical_errors, relationship_violations):
        df = step(df, scenario, domain, key=key, seed=seed)
    return df


CORRUPTORS: dict[str, Callable[..., DataFrame]] = {
    "missing_values": missing_values,
    "outliers": outliers,
    "categorical_errors": categorical_errors,
    "label_errors": label_errors,
    "relationship_violation": relationship_violations,
    "conjoined_corruption": conjoined,
}
