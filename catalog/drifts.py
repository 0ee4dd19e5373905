"""Drift of corrupted applications against the clean ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, apps, corrupted, rounded, staged, table
from catalog.registry import query
from plumbline.functions.cleaning import to_number
from plumbline.operators import corrupt, drift

NUMS = [c for c in q.NUMBERS if c != "category"]
TEXTS = q.TEXTS
E8 = "1e-8"


def _categorical(c: str, before: str, after: str, own: bool) -> str:
    only = "WHERE nb > 0 AND na > 0" if own else ""
    return f"""
SELECT '{c}' AS "column", max(q) - max(p) AS dominant_growth, sum(pp * ln(pp / qq)) AS kl_divergence,
       -sum(pp * ln(pp)) AS entropy_before, -sum(qq * ln(qq)) AS entropy_after,
       sum((p - q) * ln((p + {E8}) / (q + {E8}))) {f'FILTER ({only})' if own else ''} AS psi
FROM (SELECT *, (p + {E8}) / (1 + k * {E8}) AS pp, (q + {E8}) / (1 + k * {E8}) AS qq
      FROM (SELECT nb, na, nb / CAST(sum(nb) OVER () AS DOUBLE) AS p, na / CAST(sum(na) OVER () AS DOUBLE) AS q,
                   count(*) OVER () AS k
            FROM (SELECT cell, sum(b) AS nb, sum(a) AS na
                  FROM (SELECT {c} AS cell, 1 AS b, 0 AS a FROM {before} WHERE {c} IS NOT NULL
                        UNION ALL SELECT {c}, 0, 1 FROM {after} WHERE {c} IS NOT NULL) GROUP BY cell)))"""


def _bin(x: str, bins: int, op: str, lo: str, hi: str) -> str:
    return " + ".join(f"CAST({x} {op} {i} * (({hi} - {lo}) / {bins}) + {lo} AS INTEGER)" for i in range(1, bins))


def _ends(c: str, name: str, source: str) -> str:
    return (f"{name} AS (SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE CAST(min({c}) AS DOUBLE) END AS lo, "
            f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE CAST(max({c}) AS DOUBLE) END AS hi FROM {source})")


def _numeric_ctes(c: str, before: str, after: str, own: bool) -> list[str]:
    ctes = [_ends(c, f"{c}_eb", before), _ends(c, f"{c}_ea", after if own else before)]
    for side, source in (("b", before), ("a", after)):
        for kind, bins, op in (("h", 20, ">="), ("p", 10, ">")):
            ctes.append(
                f"{c}_{kind}{side} AS (SELECT bin, n, n / CAST(sum(n) OVER () AS DOUBLE) AS share FROM (SELECT "
                f"{_bin(c, bins, op, 'lo', 'hi')} AS bin, count(*) AS n FROM {source}, {c}_e{side} WHERE {c} IS NOT NULL GROUP BY 1))")
    ctes.append(f"""{c}_h AS (
      SELECT (coalesce(b.share, 0) / ((eb.hi - eb.lo) / 20) + {E8}) / (1 / ((eb.hi - eb.lo) / 20) + 20 * {E8}) AS pp,
             (coalesce(a.share, 0) / ((ea.hi - ea.lo) / 20) + {E8}) / (1 / ((ea.hi - ea.lo) / 20) + 20 * {E8}) AS qq
      FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) s LEFT JOIN {c}_hb b ON s.bin = b.bin
      LEFT JOIN {c}_ha a ON s.bin = a.bin, {c}_eb eb, {c}_ea ea)""")
    if own:
        def label(i: str, side: str) -> str:
            x = f"({i} * ((hi - lo) / 10) + lo - CASE WHEN {i} = 0 THEN 0.001 * (hi - lo) ELSE 0 END)"
            return (f"CASE WHEN {x} = 0 THEN 0 WHEN trunc({x}) <> 0 THEN round({x}, 3) "
                    f"ELSE round({x}, CAST(2 - floor(log10(abs({x}))) AS INTEGER)) END")
        for side in ("b", "a"):
            ctes.append(f"{c}_l{side} AS (SELECT CAST(range AS INTEGER) AS bin, {label('range', side)} AS lower, "
                        f"{label('(range + 1)', side)} AS upper FROM range(10), {c}_e{side})")
        ctes.append(f"""{c}_p AS (SELECT coalesce(b.share, 0) AS p, coalesce(a.share, 0) AS q FROM {c}_lb x JOIN {c}_la y
          ON x.lower = y.lower AND x.upper = y.upper LEFT JOIN {c}_pb b ON x.bin = b.bin LEFT JOIN {c}_pa a ON y.bin = a.bin)""")
    else:
        ctes.append(f"""{c}_p AS (SELECT coalesce(b.share, 0) AS p, coalesce(a.share, 0) AS q
          FROM {c}_pb b FULL JOIN {c}_pa a ON b.bin = a.bin)""")
    return ctes


def _numeric(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", CAST(NULL AS DOUBLE) AS dominant_growth, (SELECT sum(pp * ln(pp / qq)) FROM {c}_h) AS kl_divergence,
       (SELECT -sum(pp * ln(pp)) FROM {c}_h) AS entropy_before, (SELECT -sum(qq * ln(qq)) FROM {c}_h) AS entropy_after,
       (SELECT coalesce(sum((p - q) * ln((p + {E8}) / (q + {E8}))), 0) FROM {c}_p) AS psi"""


CORRUPTED = q.conjoined("after", "applications", "severe")
GAPS = [q.missing("after", "applications", "severe")]


def _divergence_ctes(columns, own: bool, before="applications", after="after") -> list[str]:
    ctes = [cte for c in columns if c in NUMS for cte in _numeric_ctes(c, before, after, own)]
    rows = [_numeric(c) if c in NUMS else _categorical(c, before, after, own) for c in columns]
    return [*ctes, "drift AS (" + " UNION ALL ".join(rows) + ")"]


def _check(columns, picked: list[str], own: bool, after: list[str]) -> str:
    shown = ", ".join(f"round({c}, 6) AS {c}" for c in picked)
    return q.with_ctes(*after, *_divergence_ctes(columns, own), select=f'SELECT "column", {shown} FROM drift')


def _gaps(spark, folder):
    return staged(corrupt.missing_values(apps(spark, folder).select("id", *q.NAMES), "severe", DOMAIN), "gaps")


def _register(name, columns, picked, bins="shared", after=CORRUPTED, make=corrupted):
    @query(name, _check(columns, picked, bins == "own", after))
    def run(spark, folder):
        clean = staged(apps(spark, folder).select("id", *q.NAMES), "applications")
        found = drift.divergences(clean, make(spark, folder), columns, bins)
        return rounded(found.select("column", *picked))


@query("d1_missing_shares", q.with_ctes(*CORRUPTED, select=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(b, 6) AS missing_before, round(a, 6) AS missing_after, round(b - a, 6) AS missing_reduction
    FROM (SELECT (SELECT avg(CAST({c} IS NULL AS INTEGER)) FROM applications) AS b, (SELECT avg(CAST({c} IS NULL AS INTEGER)) FROM after) AS a)"""
    for c in DOMAIN.features)))
def d1(spark, folder):
    gone = [drift.profile(df, DOMAIN.features) for df in (apps(spark, folder), corrupted(spark, folder))]
    rows = [(c, gone[0][c, "gone"], gone[1][c, "gone"]) for c in DOMAIN.features]
    df = spark.createDataFrame(rows, "column string, missing_before double, missing_after double")  # one row per column
    return rounded(df.withColumn("missing_reduction", F.col("missing_before") - F.col("missing_after")))


_register("d2_dominance", TEXTS, ["dominant_growth"])
_register("d3_categorical_kl", TEXTS, ["kl_divergence"])
_register("d4_entropy", TEXTS, ["entropy_before", "entropy_after"])
_register("d5_numeric_kl_shared", NUMS, ["kl_divergence", "entropy_before", "entropy_after"])
_register("d5_numeric_kl_own", NUMS, ["kl_divergence", "entropy_before", "entropy_after"], "own")
_register("d7_psi_shared", NUMS, ["psi"])
_register("d7_psi_own", NUMS, ["psi"], "own", GAPS, _gaps)
_register("d8_psi_categorical_shared", TEXTS, ["psi"])
_register("d8_psi_categorical_own", TEXTS, ["psi"], "own")

SHIFTS = [(f"p{int(p * 100)}", p) for p in drift.PERCENTILES]


def _percentiles(c: str) -> str:
    return "SELECT '" + c + "' AS \"column\", " + ", ".join(
        f"{q.quantile(c, p, 'applications')} AS {n}_before, {q.quantile(c, p, 'after')} AS {n}_after" for n, p in SHIFTS)


SHIFT_COLUMNS = ", ".join(
    f"round({n}_before, 4) AS {n}_before, round({n}_after, 4) AS {n}_after, round({n}_after - {n}_before, 4) AS {n}_drift"
    for n, _ in SHIFTS)


@query("d6_percentiles", q.with_ctes(*CORRUPTED, select=f'SELECT "column", {SHIFT_COLUMNS} FROM ('
                                     + " UNION ALL ".join(_percentiles(c) for c in NUMS) + ")"))
def d6(spark, folder):
    shifts = drift.percentile_shift(apps(spark, folder), corrupted(spark, folder), NUMS)
    names = [f"{n}_{s}" for n, _ in SHIFTS for s in ("before", "after")]
    rows = [(c, *[v for pair in shifts[c] for v in pair]) for c in NUMS]  # one row per column
    df = spark.createDataFrame(rows, "column string, " + ", ".join(f"{n} double" for n in names))
    return rounded(df.withColumns({f"{n}_drift": F.col(f"{n}_after") - F.col(f"{n}_before") for n, _ in SHIFTS}), 4)


ALERTS = """SELECT "column", alert, round(value, 6) AS value FROM (
  SELECT "column", 'dominant_growth' AS alert, coalesce(dominant_growth, 0) AS value FROM drift WHERE abs(coalesce(dominant_growth, 0)) > 0.1
  UNION ALL SELECT "column", 'psi', psi FROM drift WHERE psi > 0.25
  UNION ALL SELECT "column", 'kl_divergence', kl_divergence FROM drift WHERE kl_divergence > 0.2)"""


@query("d9_alerts", q.with_ctes(*CORRUPTED, *_divergence_ctes(TEXTS + NUMS, False), select=ALERTS))
def d9(spark, folder):
    clean = staged(apps(spark, folder).select("id", *q.NAMES), "applications")
    return rounded(drift.alerts(drift.divergences(clean, corrupted(spark, folder), TEXTS + NUMS)))


@query("d10_coercion", """
SELECT event_id, TRY_CAST(substr(event_type, 1, 1) || CAST(user_id AS VARCHAR) AS DOUBLE) AS from_text,
       TRY_CAST(CAST(user_id AS VARCHAR) || '.5' AS DOUBLE) AS from_digits FROM events""")
def d10(spark, folder):
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(
        "event_id", to_number(F.concat(F.substring("event_type", 1, 1), user)).alias("from_text"),
        to_number(F.concat(user, F.lit(".5"))).alias("from_digits"))


for _bins in ("shared", "own"):
    @query(f"d11_report_{_bins}", q.with_ctes(
        *CORRUPTED, *_divergence_ctes(TEXTS + NUMS, _bins == "own"),
        "shifts AS (" + " UNION ALL ".join(_percentiles(c) for c in NUMS) + ")",
        "gone AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", (SELECT avg(CAST({c} IS NULL AS INTEGER)) FROM applications) AS b, "
            f"(SELECT avg(CAST({c} IS NULL AS INTEGER)) FROM after) AS a" for c in TEXTS + NUMS) + ")",
        select=f"""
SELECT d."column", CASE WHEN s."column" IS NULL THEN 'categorical' ELSE 'numeric' END AS kind,
       round(g.b, 4) AS missing_before, round(g.a, 4) AS missing_after, round(g.b - g.a, 4) AS missing_reduction,
       round(dominant_growth, 4) AS dominant_growth, round(kl_divergence, 4) AS kl_divergence,
       round(entropy_before, 4) AS entropy_before, round(entropy_after, 4) AS entropy_after,
       round(entropy_after - entropy_before, 4) AS entropy_drop, round(psi, 4) AS psi, {SHIFT_COLUMNS}
FROM drift d JOIN gone g ON d."column" = g."column" LEFT JOIN shifts s ON d."column" = s."column" """))
    def d11(spark, folder, bins=_bins):
        clean = staged(apps(spark, folder).select("id", *q.NAMES), "applications")
        return rounded(drift.report(clean, corrupted(spark, folder), TEXTS + NUMS, bins), 4)
