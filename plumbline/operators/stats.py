"""Statistics that other operators fit on a table: fused aggregates, exact order
statistics and most frequent values.

Each function takes all the columns of a stage at once and returns scalars, like the
``fit`` of a Spark ML estimator. What reaches the driver is one row per job or a bounded
number of rows per column, whatever the size of the table.

Order statistics are exact and found one way at every size. A value becomes a 64-bit key of
the same order, and a pass counts the keys of all columns by their next ``DIGIT`` bits, in a
grouped aggregate that is combined before the shuffle. The wanted ranks lie in one cell
each; the next pass counts inside these cells only. A cell that holds a single value, such
as one that a third of the rows share, ends the search at once. Three passes reach the last
bit; values of few digits need one.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.sources.staging import staged

DIGIT = 22  # bits that a pass tells apart: at most 2**22 cells of a column
HALF = DIGIT // 2


def scalars(df: DataFrame, measures: Mapping[str, Column]) -> dict[str, Any]:
    """All measures in one aggregate."""
    if not measures:
        return {}
    names = list(measures)
    row = df.agg(*[measures[n].alias(f"m{i}") for i, n in enumerate(names)]).first()
    return {n: row[i] for i, n in enumerate(names)}


@dataclass(frozen=True)
class Placed:
    """A value with how many values lie below it and how many are equal."""

    value: Any
    below: int
    equal: int


@dataclass
class _Search:
    """Ranks still wanted among the keys that begin like ``cell`` (all keys, if None)."""

    cell: int | None
    below: int
    ranks: list[int]


def with_ordered_key(df: DataFrame, column: str, output: str) -> DataFrame:
    """Add a bigint in the order of a double column: its bits, from the exact exponent and mantissa.

    Zeros of both signs are one key; NULL gives NULL; NaN is not expected.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(*kept, F.abs(F.col(column)).alias("_size"))
    rows = rows.select("*", F.least(F.greatest(F.floor(F.log2("_size")), F.lit(-1022)), F.lit(1023)).alias("_e"))
    # the logarithm may be off by one next to a power of two; scaling by powers of two is exact
    m = F.col("_size") / F.pow(F.lit(2.0), F.col("_e"))
    rows = rows.select(*kept, "_size", (F.col("_e") + F.when(m >= 2, 1).when((m < 1) & (F.col("_e") > -1022), -1).otherwise(0)).alias("_e"))
    whole = (F.col("_size") / F.pow(F.lit(2.0), F.col("_e")) * float(1 << 52)).cast("bigint")
    bits = F.when(F.col("_size") == float("inf"), F.lit(2047 << 52)).when(F.col("_size") == 0, F.lit(0)).otherwise((F.col("_e") + 1022) * F.lit(1 << 52) + whole)
    return rows.select(*kept, F.when(F.col(column) < 0, -bits).otherwise(bits).alias(output))


def _ordered_key(rows: DataFrame) -> DataFrame:
    """``(name, key)`` of ``(name, value)``."""
    return with_ordered_key(rows, "value", "key").select("name", "key")


def _from_key(key: int) -> float:
    value, = struct.unpack("<d", struct.pack("<q", abs(key)))
    return -value if key < 0 else value


def order_statistics(
    df: DataFrame,
    wanted: Mapping[str, tuple[Column, Sequence[int] | Callable[[int], Sequence[int]]]],
    dtype: str = "double",
) -> dict[str, dict[int, Placed]]:
    """Exact values at 0-based ranks among the non-null values of each column.

    ``dtype`` is "double" (NaN counts as null) or "bigint". Ranks may be a function of the number of
    values; ranks beyond it have no value.
    """
    found: dict[str, dict[int, Placed]] = {n: {} for n in wanted}
    searches: dict[str, list[_Search]] | None = None
    for shift in (2 * DIGIT - 2, DIGIT - 2, 0):
        if searches is not None and not searches:
            break
        names = list(wanted if searches is None else searches)
        values = F.array(*[F.struct(F.lit(n).alias("name"), wanted[n][0].cast(dtype).alias("value")) for n in names])
        rows = df.select(F.inline(values)).where("value IS NOT NULL")
        if searches is not None:  # by value, so that only rows in the wanted cells get a key
            rows = rows.where(_inside(searches, shift + width, dtype))
        rows = _ordered_key(rows.where(~F.isnan("value"))) if dtype == "double" else rows.select("name", F.col("value").alias("key"))
        width = 64 - shift if searches is None else width
        cells = rows.groupBy("name", F.shiftright("key", shift).alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        cells = staged(cells, "cells")
        coarse = cells.groupBy("name", F.shiftright("cell", HALF).alias("at")).agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()  # 2**HALF rows per column and search
        if searches is None:
            searches = {}
            for n in names:
                total = sum(r["n"] for r in coarse if r["name"] == n)
                ranks = wanted[n][1](total) if callable(wanted[n][1]) else wanted[n][1]
                ranks = sorted({r for r in ranks if 0 <= r < total})
                if ranks:
                    searches[n] = [_Search(None, 0, ranks)]
        open_at = _walk(coarse, searches, found, width - HALF, dtype, False)
        if not open_at:
            break
        chosen = F.lit(False)
        for n, own in open_at.items():
            chosen = chosen | ((F.col("name") == n) & F.shiftright("cell", HALF).isin([s.cell for s in own]))
        fine = cells.where(chosen).withColumnRenamed("cell", "at").collect()  # 2**HALF rows per open cell
        searches = _walk(fine, open_at, found, HALF, dtype, shift == 0)
        width = DIGIT if shift == 2 * DIGIT - 2 else DIGIT - 2
    return found


def _inside(searches: Mapping[str, list[_Search]], bits: int, dtype: str) -> Column:
    """Whether a value lies in one of the cells still searched; a cell's keys lack their last ``bits`` bits."""
    ends = 2047 << 52  # the keys of the infinities
    bound = (lambda key: F.lit(_from_key(min(max(key, -ends), ends)))) if dtype == "double" else F.lit
    inside = F.lit(False)
    for name, own in searches.items():
        for cell in {s.cell for s in own}:
            low, high = cell << bits, ((cell + 1) << bits) - 1
            inside = inside | ((F.col("name") == name) & F.col("value").between(bound(low), bound(high)))
    return inside


def _walk(cells, searches, found, bits: int, dtype: str, last: bool) -> dict[str, list[_Search]]:
    """Each rank's cell among ``cells``; what is not settled there is searched for in the cell."""
    out: dict[str, list[_Search]] = {}
    for name, own in searches.items():
        mine = sorted((r["at"], r["n"], r["lo"], r["hi"]) for r in cells if r["name"] == name)
        for search in own:
            below, ranks = search.below, search.ranks
            for at, n, lo, hi in mine:
                if search.cell is not None and at >> bits != search.cell:
                    continue
                here = [r for r in ranks if below <= r < below + n]
                if here and (lo == hi or last):
                    value = _from_key(lo) if dtype == "double" else lo
                    found[name].update({r: Placed(value, below, n) for r in here})
                elif here:
                    out.setdefault(name, []).append(_Search(at, below, here))
                below += n
    return out


def quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]]) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, NULL and NaN ignored."""
    if not wanted:
        return {}
    totals: dict[str, int] = {}

    def ranks(name: str):
        def of(total: int) -> list[int]:
            totals[name] = total
            return [int(f(p * (total - 1))) for p in wanted[name][1] for f in (math.floor, math.ceil)]
        return of

    found = order_statistics(df, {n: (c, ranks(n)) for n, (c, _) in wanted.items()})
    out: dict[str, list[float | None]] = {}
    for n, (_, shares) in wanted.items():
        out[n] = []
        for p in shares:
            if not totals.get(n):
                out[n].append(None)
                continue
            x = p * (totals[n] - 1)
            low, high = math.floor(x), math.ceil(x)
            lo, hi = found[n][low].value, found[n][high].value
            out[n].append(lo if low == high or lo == hi else (high - x) * lo + (x - low) * hi)
    return out


def value_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(name, value, n) for every distinct non-null value; combined before the shuffle."""
    cells = F.array(*[
        F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in columns.items()
    ])
    return (
        df.select(F.inline(cells))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass(frozen=True)
class TopValue:
    value: str
    count: int
    total: int
    distinct: int


def top_values(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, TopValue]:
    """Most frequent value per column, the lowest on ties. Absent for all-null columns.

    Counts come from a shuffle on (column, value), so no task holds a column's values.
    """
    if not columns:
        return {}
    rows = (
        value_counts(df, columns)
        .groupBy("name")
        .agg(
            F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("top"),
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("distinct"),
        )
        .collect()  # one row per column
    )
    return {r["name"]: TopValue(r["top"]["value"], -r["top"]["minus_n"], r["total"], r["distinct"]) for r in rows}


def ticket_cuts(
    df: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[int]]], key: Column,
) -> dict[str, list[Column]]:
    """Predicates that hold for exactly the k rows with the smallest (ticket, key).

    ``wanted`` maps a name to a ticket (a bigint, NULL for rows that take no part) and the sizes
    k. The predicates compare with literals, so picking an exact number of rows needs neither
    a join nor a window over the table. Rows with the k-th ticket are split by key.
    """
    out = {n: [F.lit(False)] * len(ks) for n, (_, ks) in wanted.items()}
    totals: dict[str, int] = {}

    def ranks(name: str, sizes: Sequence[int]):
        def of(total: int) -> list[int]:
            totals[name] = total
            return [k - 1 for k in sizes if 0 < k < total]
        return of

    found = order_statistics(df, {n: (t, ranks(n, ks)) for n, (t, ks) in wanted.items()}, "bigint") if wanted else {}
    for n, (ticket, ks) in wanted.items():
        for i, k in enumerate(ks):
            if k >= totals.get(n, 0):
                out[n][i] = ticket.isNotNull()
            elif k > 0:
                cut = found[n][k - 1]
                if cut.below + cut.equal == k:
                    out[n][i] = F.coalesce(ticket <= F.lit(cut.value), F.lit(False))
                    continue
                rank = k - cut.below - 1
                last = order_statistics(df.filter(ticket == F.lit(cut.value)), {"key": (key, [rank])}, "bigint")["key"][rank].value
                test = (ticket < F.lit(cut.value)) | ((ticket == F.lit(cut.value)) & (key <= F.lit(last)))
                out[n][i] = F.coalesce(test, F.lit(False))
    return out
