"""Drift of a table against a baseline: missing share, dominance, entropy, KL divergence,
percentile shift and PSI, per column.

Both tables are reduced to counts per (column, cell) in one shuffle with map-side combine,
a cell being a category or a bin number; all metrics are sums over those counts.

``bins="shared"`` (default) cuts numbers on the baseline's range with open ends and compares
every cell that either side has. ``bins="own"`` cuts each side on its own range: KL then
compares bins by number, and PSI only counts bins whose rounded edges coincide and categories
that both sides have.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.cleaning import numeric_columns, to_number
from plumbline.operators import stats

EPSILON = 1e-8
KL_BINS = 20
PSI_BINS = 10
PERCENTILES = (0.5, 0.9, 0.95, 0.99)
# Alert limits (fixed values).
DOMINANT_GROWTH_LIMIT, PSI_LIMIT, KL_LIMIT = 0.10, 0.25, 0.2

REPORT_SCHEMA = (
    "column string, kind string, missing_before double, missing_after double, missing_reduction double, "
    "dominant_growth double, kl_divergence double, entropy_before double, entropy_after double, entropy_drop double, "
    "psi double, " + ", ".join(f"p{int(p * 100)}_{s} double" for p in PERCENTILES for s in ("before", "after", "drift"))
)


def histogram_edges(low: float, high: float, bins: int) -> list[float]:
    """Edges of equal-width bins; a constant column is widened by a half on both sides."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [i * step + low for i in range(bins)] + [high]


def cut_edges(low: float, high: float, bins: int) -> list[float]:
    """Edges of right-closed bins; a constant column is widened by a thousandth."""
    if low == high:
        low, high = (low - (0.001 * abs(low) or 0.001), high + (0.001 * abs(high) or 0.001))
    return histogram_edges(low, high, bins)


def _guess(value: str, edges: list[float]) -> Column:
    """Bin by division, at most one off the bin that the edges say; beyond the ends the end bin."""
    bins = len(edges) - 1
    width = (edges[-1] - edges[0]) / bins
    return F.expr(f"cast(least(greatest(floor(({value} - ({edges[0]!r}D)) / {width!r}D), 0), {bins - 1}) as int)")


def _settled(value: str, guess: str, edges: list[float], right_closed: bool) -> Column:
    """The guess corrected by its own edges; inner edges belong to the upper bin, or to the lower
    one where bins are right-closed. Ends are open."""
    bins = len(edges) - 1
    at = f"array({', '.join(f'{e!r}D' for e in edges)})"
    below, above = ("<=", ">") if right_closed else ("<", ">=")
    return F.expr(
        f"case when {value} is null then null "
        f"when {guess} > 0 and {value} {below} element_at({at}, {guess} + 1) then {guess} - 1 "
        f"when {guess} < {bins - 1} and {value} {above} element_at({at}, {guess} + 2) then {guess} + 1 else {guess} end")


def edge_labels(low: float, high: float, bins: int) -> list[tuple[float, float]]:
    """Rounded edges by which own-range bins are matched: three significant decimals, more only
    where edges would otherwise coincide; the first edge sits a thousandth of the range lower."""
    edges = cut_edges(low, high, bins)
    if low != high:
        edges[0] -= 0.001 * (high - low)

    def rounded(x: float, digits: int) -> float:
        if x == 0 or not math.isfinite(x):
            return x
        whole = math.trunc(x)
        places = digits if whole else -math.floor(math.log10(abs(x))) - 1 + digits
        return round(x, places)

    for digits in range(3, 20):
        shown = [rounded(e, digits) for e in edges]
        if len(set(shown)) == len(shown):
            break
    return list(zip(shown, shown[1:]))


def _cells(df: DataFrame, side: int, cats: Sequence[str], nums: Sequence[str], edges: dict) -> DataFrame:
    # values, guesses, bins and cells in projections of their own: each is computed once per row
    cut = [(i, c, metric, e) for i, c in enumerate(nums) for metric, e in zip(("kl", "psi"), edges[c, side]) if e]
    df = df.select(*[F.col(c).cast("string").alias(f"s{i}") for i, c in enumerate(cats)],
                   *[to_number(F.col(c)).alias(f"v{i}") for i, c in enumerate(nums)])
    df = df.select("*", *[_guess(f"v{i}", e).alias(f"g{i}_{m}") for i, _, m, e in cut])
    df = df.select(*[f"s{i}" for i in range(len(cats))], *[
        _settled(f"v{i}", f"g{i}_{m}", e, m == "psi").alias(f"b{i}_{m}")
        for i, _, m, e in cut])
    # a number stands for (column, metric) until the counts are in: it hashes faster than two names
    slots = {slot: i for i, slot in enumerate(_slots(cats, nums))}
    cell = lambda name, metric, value: F.struct(
        F.lit(slots[name, metric]).alias("slot"), value.cast("string").alias("cell"))
    cells = [cell(c, "kl", F.col(f"s{i}")) for i, c in enumerate(cats)]
    cells += [cell(c, m, F.col(f"b{i}_{m}")) for i, c, m, _ in cut]
    return (
        df.select(F.inline(F.array(*cells))).filter(F.col("cell").isNotNull())
        .select("*", F.lit(side).alias("side"))
    )


def _slots(cats: Sequence[str], nums: Sequence[str]) -> list[tuple[str, str]]:
    return [(c, "kl") for c in cats] + [(c, m) for c in nums for m in ("kl", "psi")]


def profile(df: DataFrame, columns: Sequence[str]) -> dict:
    """Rows, missing share, and range of the numbers: one pass."""
    measures = {"rows": F.count(F.lit(1))}
    for c in columns:
        measures[c, "gone"] = F.avg(F.col(c).isNull().cast("int"))
    for c in numeric_columns(df, columns):
        measures[c, "min"], measures[c, "max"] = F.min(to_number(F.col(c))), F.max(to_number(F.col(c)))
    return stats.scalars(df, measures)


def cell_counts(before: DataFrame, after: DataFrame, columns: Sequence[str], bins: str = "shared", ends=None):
    """(column, metric, cell, n_before, n_after), the numeric columns, the bin widths used for
    densities and, for own ranges, the bins that both sides share."""
    nums = numeric_columns(before, columns)
    cats = [c for c in columns if c not in nums]
    edges, widths, ranges = {}, {}, {}
    ends = ends or [profile(df, columns) for df in (before, after)]
    for c in nums:
        for side in (0, 1):
            low, high = (ends[side if bins == "own" else 0][c, f] for f in ("min", "max"))
            ranges[c, side] = (low, high)
            if low is None:
                edges[c, side], widths[c, side] = (None, None), 1.0
            else:
                kl = histogram_edges(low, high, KL_BINS)
                edges[c, side] = (kl, cut_edges(low, high, PSI_BINS))
                widths[c, side] = (kl[-1] - kl[0]) / KL_BINS
    moved: dict[str, dict[int, int]] = {}
    if bins == "own":
        for c in nums:
            if None not in ranges[c, 0] + ranges[c, 1]:
                theirs = {label: i for i, label in enumerate(edge_labels(*ranges[c, 1], PSI_BINS))}
                moved[c] = {theirs[label]: i for i, label in enumerate(edge_labels(*ranges[c, 0], PSI_BINS))
                            if label in theirs}
    counted = _cells(before, 0, cats, nums, edges).unionByName(_cells(after, 1, cats, nums, edges))
    slots = _slots(cats, nums)
    names = {
        name: F.element_at(F.array(*[F.lit(slot[j]) for slot in slots]), F.col("slot") + 1)
        for j, name in enumerate(("column", "metric"))
    }
    if bins == "own" and nums:
        # bins of the second table get the number of the coinciding bin of the first, or a name of their own
        pairs = [(c, str(j), str(i)) for c in nums for j, i in moved.get(c, {}).items()]
        renamed = F.lit(None).cast("string")
        for c, j, i in pairs:
            renamed = F.when((F.col("column") == c) & (F.col("cell") == j), F.lit(i)).otherwise(renamed)
        counted = counted.groupBy("slot", "cell", "side").agg(F.count(F.lit(1)).alias("n")).withColumns(names).withColumn(
            "cell", F.when((F.col("side") == 1) & (F.col("metric") == "psi"),
                           F.coalesce(renamed, F.concat(F.lit("other "), F.col("cell")))).otherwise(F.col("cell")))
    else:
        counted = counted.withColumn("n", F.lit(1).cast("bigint"))
    counts = counted.groupBy("slot", "cell").agg(
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("n_before"),
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("n_after"),
    ).withColumns(names).drop("slot")
    return counts, nums, widths, {c: [str(i) for i in m.values()] for c, m in moved.items()}


def divergences(before: DataFrame, after: DataFrame, columns: Sequence[str], bins: str = "shared",
                ends=None) -> DataFrame:
    """(column, kind, dominant_growth, kl_divergence, entropy_before, entropy_after, psi)."""
    if bins not in ("shared", "own"):
        raise ValueError(f"bins must be 'shared' or 'own': {bins}")
    counts, nums, widths, shared = cell_counts(before, after, columns, bins, ends)
    totals = counts.groupBy("column", "metric").agg(
        F.sum("n_before").alias("t_before"), F.sum("n_after").alias("t_after"), F.count(F.lit(1)).alias("present"))
    number = F.col("column").isin(list(nums)) if nums else F.lit(False)
    wide = {0: F.lit(1.0), 1: F.lit(1.0)}
    for (c, side), w in widths.items():
        wide[side] = F.when(F.col("column") == c, F.lit(float(w))).otherwise(wide[side])
    # one totals row per column and metric, so the join is a broadcast of a known size
    joined = counts.join(F.broadcast(totals), ["column", "metric"]).select(
        "column", "metric", "cell", "n_before", "n_after", "present",
        F.coalesce(F.try_divide(F.col("n_before"), F.col("t_before")), F.lit(0.0)).alias("share_b"),
        F.coalesce(F.try_divide(F.col("n_after"), F.col("t_after")), F.lit(0.0)).alias("share_a"),
        F.col("t_before").alias("tb"), F.col("t_after").alias("ta"), number.alias("is_number"),
        wide[0].alias("w_b"), wide[1].alias("w_a"),
    ).withColumns({
        "room": F.when(F.col("is_number"), F.lit(KL_BINS)).otherwise(F.col("present")),
    }).withColumns({
        "z_b": F.when(F.col("tb") > 0, 1 / F.col("w_b")).otherwise(0.0) + F.col("room") * F.lit(EPSILON),
        "z_a": F.when(F.col("ta") > 0, 1 / F.col("w_a")).otherwise(0.0) + F.col("room") * F.lit(EPSILON),
    }).withColumns({
        "p": (F.col("share_b") / F.col("w_b") + F.lit(EPSILON)) / F.col("z_b"),
        "q": (F.col("share_a") / F.col("w_a") + F.lit(EPSILON)) / F.col("z_a"),
        "gap": F.col("share_b") - F.col("share_a"),
        "ratio": F.ln((F.col("share_b") + F.lit(EPSILON)) / (F.col("share_a") + F.lit(EPSILON))),
    })
    is_kl = F.col("metric") == "kl"
    psi_here = F.when(F.col("is_number"), F.col("metric") == "psi").otherwise(is_kl)
    if bins == "own":
        matched = ~F.col("is_number") & (F.col("n_before") > 0) & (F.col("n_after") > 0)
        for c, cells in shared.items():
            matched = matched | ((F.col("column") == c) & F.col("cell").isin(cells))
        psi_here = psi_here & matched
    summed = joined.groupBy("column").agg(
        F.max(F.when(is_kl, F.col("share_a"))).alias("top_a"), F.max(F.when(is_kl, F.col("share_b"))).alias("top_b"),
        F.sum(F.when(is_kl, F.col("p") * F.ln(F.col("p") / F.col("q")))).alias("kl"),
        F.sum(F.when(is_kl, -F.col("p") * F.ln("p"))).alias("h_b"),
        F.sum(F.when(is_kl, -F.col("q") * F.ln("q"))).alias("h_a"),
        F.sum(F.when(psi_here, F.col("gap") * F.col("ratio")).otherwise(0.0)).alias("psi"),
        F.max("is_number").alias("is_number"),
        F.max(F.when(is_kl, F.lit(EPSILON) / F.col("z_b"))).alias("e_b"),
        F.max(F.when(is_kl, F.lit(EPSILON) / F.col("z_a"))).alias("e_a"),
        F.max(F.when(is_kl, F.col("room") - F.col("present"))).alias("absent"),
        F.max("tb").alias("tb"), F.max("ta").alias("ta"),
    )
    # bins that neither side has still hold the epsilon mass
    both = ~F.col("is_number") | ((F.col("tb") > 0) & (F.col("ta") > 0))
    some = lambda total: ~F.col("is_number") | (total > 0)
    return summed.select(
        "column", F.when(F.col("is_number"), "numeric").otherwise("categorical").alias("kind"),
        F.when(~F.col("is_number"), F.col("top_a") - F.col("top_b")).alias("dominant_growth"),
        F.when(both, F.col("kl") + F.col("absent") * F.col("e_b") * F.ln(F.col("e_b") / F.col("e_a"))).alias("kl_divergence"),
        F.when(some(F.col("tb")), F.col("h_b") - F.col("absent") * F.col("e_b") * F.ln("e_b")).alias("entropy_before"),
        F.when(some(F.col("ta")), F.col("h_a") - F.col("absent") * F.col("e_a") * F.ln("e_a")).alias("entropy_after"),
        F.when(both, F.col("psi")).alias("psi"),
    )


def percentile_shift(before: DataFrame, after: DataFrame, columns: Sequence[str], rows=(None, None)) -> dict[str, list[tuple]]:
    """(before, after) per percentile and column."""
    wanted = {c: (to_number(F.col(c)), PERCENTILES) for c in columns}
    b, a = (stats.quantiles(df, wanted) for df in (before, after))
    return {c: list(zip(b[c], a[c])) for c in columns}


def report(before: DataFrame, after: DataFrame, columns: Sequence[str], bins: str = "shared") -> DataFrame:
    """All drift metrics, one row per column that both tables have."""
    columns = [c for c in columns if c in before.columns and c in after.columns]
    nums = numeric_columns(before, columns)
    ends = [profile(df, columns) for df in (before, after)]
    shifts = percentile_shift(before, after, nums, (ends[0]["rows"], ends[1]["rows"]))
    rows = []
    for c in columns:
        gb, ga = ends[0][c, "gone"], ends[1][c, "gone"]
        flat = []
        for i in range(len(PERCENTILES)):
            b, a = shifts[c][i] if c in shifts else (None, None)
            flat += [b, a, a - b if a is not None and b is not None else None]
        rows.append((c, gb, ga, gb - ga if gb is not None and ga is not None else None, *flat))
    names = [p.split()[0] for p in REPORT_SCHEMA.split(", ")]
    scalar_names = ["column", *names[2:5], *names[11:]]
    schema = ", ".join(f"{n} {'string' if n == 'column' else 'double'}" for n in scalar_names)
    spark = before.sparkSession
    one_each = spark.createDataFrame(rows, schema)  # one row per column
    joined = one_each.join(divergences(before, after, columns, bins, ends), "column", "left")
    return joined.withColumns({
        "kind": F.when(F.col("column").isin(nums) if nums else F.lit(False), "numeric").otherwise("categorical"),
        "entropy_drop": F.col("entropy_after") - F.col("entropy_before"),
    }).select(*names)


def alerts(drift: DataFrame) -> DataFrame:
    """(column, alert, value): one row per exceeded limit. A metric a column lacks counts as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    found = [
        F.when(test, F.struct(F.lit(name).alias("alert"), zero(c).alias("value"))) for name, c, test in (
            ("dominant_growth", "dominant_growth", F.abs(zero("dominant_growth")) > F.lit(DOMINANT_GROWTH_LIMIT)),
            ("psi", "psi", zero("psi") > F.lit(PSI_LIMIT)),
            ("kl_divergence", "kl_divergence", zero("kl_divergence") > F.lit(KL_LIMIT)),
        )
    ]
    return drift.select("column", F.inline(F.array(*found))).filter(F.col("alert").isNotNull())
