"""Repair steps on the corrupted applications, one by one and as a chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, SUITE, apps, corrupted, rounded, shown, staged
from catalog.registry import query
from plumbline.operators import corrupt, impute, isolation, repair
from plumbline.operators.expectations import failed_expectations, run_suite
from plumbline.plans import flows

CORRUPTED = q.conjoined("corrupted", "applications", "severe")
NAMES = list(DOMAIN.columns)


def _on_corrupted(*steps: str) -> str:
    return q.with_ctes(*CORRUPTED, *steps, select=q.shown("repaired", 4))




GATED = [("expect_column_values_to_be_between", "amount"), ("expect_column_values_to_be_in_set", "status"),
         ("expect_column_values_to_not_be_null", "priority")]


@query("r1_gate", _on_corrupted(
    q.fill("g1", "corrupted", ["priority"], SUITE), *q.cap("g2", "g1", ["amount"]),
    q.fix_categories("g3", "g2", ["status"], SUITE), q.fix_pair("repaired", "g3")))
def r1(spark, folder):
    return shown(repair.improve(corrupted(spark, folder), GATED, SUITE, DOMAIN, advanced=False), 4)


@query("r1_nothing_failed", q.with_ctes(select=q.shown("applications")))
def r1_clean(spark, folder):
    return shown(repair.improve(apps(spark, folder), [], SUITE, DOMAIN))


@query("r2_mean_fill", _on_corrupted(q.fill("repaired", "corrupted", ["amount", "total_qty", "avg_qty"], SUITE)))
def r2(spark, folder):
    return shown(repair.fill_missing(corrupted(spark, folder), ["amount", "total_qty", "avg_qty"], SUITE, DOMAIN), 4)


@query("r3_median_fill", _on_corrupted(q.fill("repaired", "corrupted", ["n_lines", "avg_discount"], SUITE)))
def r3(spark, folder):
    return shown(repair.fill_missing(corrupted(spark, folder), ["n_lines", "avg_discount"], SUITE, DOMAIN), 4)


@query("r4_mode_fill", _on_corrupted(q.fill("repaired", "corrupted", q.IN_SET_COLUMNS, SUITE)))
def r4(spark, folder):
    return shown(repair.fill_missing(corrupted(spark, folder), q.IN_SET_COLUMNS, SUITE, DOMAIN), 4)


@query("r5_cap_outliers", _on_corrupted(*q.cap("repaired", "corrupted", q.BETWEEN_COLUMNS)))
def r5(spark, folder):
    return shown(repair.cap_outliers(corrupted(spark, folder), q.BETWEEN_COLUMNS), 4)


@query("r6_fix_categories", _on_corrupted(q.fix_categories("repaired", "corrupted", q.IN_SET_COLUMNS, SUITE)))
def r6(spark, folder):
    return shown(repair.fix_categories(corrupted(spark, folder), q.IN_SET_COLUMNS, SUITE), 4)


@query("r7_fix_pair", _on_corrupted(q.fix_pair("repaired", "corrupted")))
def r7(spark, folder):
    return shown(repair.fix_pair(corrupted(spark, folder), DOMAIN), 4)


@query("r8_fix_range", _on_corrupted(q.fix_range("repaired", "corrupted")))
def r8(spark, folder):
    return shown(repair.fix_range(corrupted(spark, folder), DOMAIN), 4)


@query("r9_isolation_forest")
def r9a(spark, folder):
    flagged = isolation.flag(corrupted(spark, folder), q.NUMBERS)
    return flagged.select("id", "is_outlier")


@query("r9_multivariate_repair")
def r9(spark, folder):
    return shown(repair.multivariate_outliers(corrupted(spark, folder), q.NUMBERS))


@query("r9_cap_flagged", _on_corrupted(*q.cap("repaired", "corrupted", q.BETWEEN_COLUMNS, "coalesce(priority = '1-URGENT', false)", "isolated")))
def r9b(spark, folder):
    df = corrupted(spark, folder)
    return shown(repair.cap_outliers(df, q.BETWEEN_COLUMNS, flag=F.coalesce(F.col("priority") == "1-URGENT", F.lit(False)),
                                     tag="isolated"), 4)


def _conditional(c: str) -> str:
    return f"""coalesce({c}, (SELECT value FROM best_{c} b WHERE b.target = m.category), {q.mode_of(c, 'm')})"""


@query("r10_conditional_fill", q.with_ctes(
    q.missing("m", "applications", "severe"),
    *[f"""best_{c} AS (
      SELECT target, value FROM (
        SELECT target, value, row_number() OVER (PARTITION BY target ORDER BY share DESC, value) AS place FROM (
          SELECT category AS target, {c} AS value, count(*) / CAST(sum(count(*)) OVER (PARTITION BY {c}) AS DOUBLE) AS share
          FROM m WHERE {c} IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2)) WHERE place = 1)""" for c in q.IN_SET_COLUMNS],
    q.step("repaired", "m", {c: _conditional(c) for c in q.IN_SET_COLUMNS}), select=q.shown("repaired")))
def r10(spark, folder):
    gaps = staged(corrupt.missing_values(apps(spark, folder).select("id", *NAMES), "severe", DOMAIN), "gaps")
    return shown(repair.conditional_fill(gaps, q.IN_SET_COLUMNS, DOMAIN.target))


def _chained(rounds: int) -> list[str]:
    """Unrolled rounds for amount (fewer gaps) and total_qty."""
    ctes = ["z0 AS (SELECT id, amount, total_qty, coalesce(amount, (SELECT avg(amount) FROM m)) AS x, "
            "coalesce(total_qty, (SELECT avg(total_qty) FROM m)) AS y FROM m)"]
    for r in range(1, rounds + 1):
        ctes.append(f"x{r} AS (SELECT id, amount, total_qty, coalesce(amount, s.b + s.a * y) AS x, y FROM z{r - 1}, (SELECT "
                    f"regr_slope(amount, y) AS a, regr_intercept(amount, y) AS b FROM z{r - 1} WHERE amount IS NOT NULL) s)")
        ctes.append(f"z{r} AS (SELECT id, amount, total_qty, x, coalesce(total_qty, s.b + s.a * x) AS y FROM x{r}, (SELECT "
                    f"regr_slope(total_qty, x) AS a, regr_intercept(total_qty, x) AS b FROM x{r} WHERE total_qty IS NOT NULL) s)")
    return ctes


@query("r11_chained_two_columns", q.with_ctes(q.missing("m", "applications", "severe"), *_chained(3), select="""
SELECT id, round(x, 3) AS amount, round(y, 3) AS total_qty FROM z3"""))
def r11_two(spark, folder):
    gaps = staged(corrupt.missing_values(apps(spark, folder).select("id", *NAMES), "severe", DOMAIN), "gaps")
    filled = impute.iterative(gaps, ["amount", "total_qty"], max_iter=3, ridge=0.0)
    return filled.select("id", F.round("amount", 3).alias("amount"), F.round("total_qty", 3).alias("total_qty"))


# Columns with fewer gaps come first.
THREE_ORDER = sorted(range(3), key=lambda i: DOMAIN.missing_counts["severe"].get(("amount", "total_qty", "avg_qty")[i], 0))
THREE_ORDER = [i for i in THREE_ORDER if ("amount", "total_qty", "avg_qty")[i] in DOMAIN.missing_counts["severe"]]


def _chained_three(rounds: int) -> list[str]:
    """Unrolled rounds for three columns: each on the two others, by the normal equations of the centred sums."""
    names = ("amount", "total_qty", "avg_qty")
    ctes = ["t0 AS (SELECT id, " + ", ".join(f"{c}, coalesce({c}, (SELECT avg({c}) FROM m)) AS z{i}" for i, c in enumerate(names)) + " FROM m)"]
    last = "t0"
    for r in range(1, rounds + 1):
        for i in THREE_ORDER:
            a, b = (j for j in range(3) if j != i)
            sums = (f"SELECT avg({names[i]}) AS my, avg(z{a}) AS ma, avg(z{b}) AS mb, var_pop(z{a}) AS saa, var_pop(z{b}) AS sbb, covar_pop(z{a}, z{b}) AS sab, "
                    f"covar_pop(z{a}, {names[i]}) AS say, covar_pop(z{b}, {names[i]}) AS sby FROM {last} WHERE {names[i]} IS NOT NULL")
            value = (f"my + (say * sbb - sby * sab) / (saa * sbb - sab * sab) * (z{a} - ma) + (sby * saa - say * sab) / (saa * sbb - sab * sab) * (z{b} - mb)")
            kept = ", ".join(f"coalesce({names[i]}, {value}) AS z{i}" if j == i else f"z{j}" for j in range(3))
            ctes.append(f"t{r}_{i} AS (SELECT id, {', '.join(names)}, {kept} FROM {last}, ({sums}) s)")
            last = f"t{r}_{i}"
    return [*ctes, f"three AS (SELECT * FROM {last})"]


@query("r11_chained_three_columns", q.with_ctes(q.missing("m", "applications", "severe"), *_chained_three(3), select="""
SELECT id, round(z0, 3) AS amount, round(z1, 3) AS total_qty, round(z2, 3) AS avg_qty FROM three"""))
def r11_three(spark, folder):
    gaps = staged(corrupt.missing_values(apps(spark, folder).select("id", *NAMES), "severe", DOMAIN), "gaps")
    filled = impute.iterative(gaps, ["amount", "total_qty", "avg_qty"], max_iter=3, ridge=0.0)
    return filled.select("id", *[F.round(c, 3).alias(c) for c in ("amount", "total_qty", "avg_qty")])


@query("r11_chained")
def r11(spark, folder):
    gaps = staged(corrupt.missing_values(apps(spark, folder).select("id", *NAMES), "severe", DOMAIN), "gaps")
    return shown(impute.iterative(gaps, ["amount", "total_qty", "avg_qty", "n_lines", "avg_discount"]), 4)


REPAIRED = q.basic_repair("repaired", "corrupted", SUITE)
BOTH = [q.suite_results("initial", "corrupted", SUITE), q.suite_results("final", "repaired", SUITE)]
RATE = "count(*) FILTER (WHERE success) / CAST(count(*) AS DOUBLE) * 100"


@query("r13_improvement", q.with_ctes(*CORRUPTED, *REPAIRED, *BOTH, f"""
rates AS (SELECT (SELECT {RATE} FROM initial) AS a, (SELECT {RATE} FROM final) AS b,
          (SELECT count(*) FROM initial WHERE NOT success) AS c, (SELECT count(*) FROM final WHERE NOT success) AS d)""", select="""
SELECT round(a, 6) AS initial_success_rate, round(b, 6) AS final_success_rate, round(b - a, 6) AS improvement,
       c AS initial_failures, d AS final_failures, c - d AS failures_fixed,
       round(CASE WHEN a > 0 THEN (b - a) / a * 100 ELSE 0 END, 6) AS improvement_percentage FROM rates"""))
def r13(spark, folder):
    df = corrupted(spark, folder)
    initial = run_suite(df, SUITE)
    _, _, final = flows.remediate(df, failed_expectations(initial).collect(), SUITE, domain=DOMAIN, advanced=False)
    return rounded(flows.improvement(initial, final))


@query("r14_revalidated", q.with_ctes(*CORRUPTED, *REPAIRED, BOTH[1], select=f"SELECT {q.SHOW_RESULTS} FROM final"))
def r14(spark, folder):
    df = corrupted(spark, folder)
    failed = failed_expectations(run_suite(df, SUITE)).collect()
    _, _, final = flows.remediate(df, failed, SUITE, domain=DOMAIN, advanced=False)
    return rounded(final)


@query("r14_repaired_rows", _on_corrupted(*REPAIRED))
def r14_rows(spark, folder):
    df = corrupted(spark, folder)
    failed = failed_expectations(run_suite(df, SUITE)).collect()
    return shown(repair.improve(df, failed, SUITE, DOMAIN, advanced=False), 4)


@query("r14_all_repairs")
def r14_all(spark, folder):
    df = corrupted(spark, folder)
    failed = failed_expectations(run_suite(df, SUITE)).collect()
    _, _, final = flows.remediate(df, failed, SUITE, baseline=apps(spark, folder), domain=DOMAIN)
    return rounded(final)
