"""Two scores that need no training, so that evaluation can be checked in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MODELS = ("by_quantity", "by_lines")


def scored(df: DataFrame, keep=("id",)) -> DataFrame:
    """(keep, model, label, prediction, score), one row per application and model."""
    quantity, lines = F.coalesce("total_qty", F.lit(0.0)), F.coalesce("n_lines", F.lit(0))
    label = (F.col("category") - 1).cast("int")
    one = lambda name, score, hit: F.struct(
        F.lit(name).alias("model"), label.alias("label"), hit.cast("int").alias("prediction"), score.alias("score"))
    return df.select(*keep, F.inline(F.array(
        one(MODELS[0], quantity / 400.0, quantity > 80), one(MODELS[1], lines / 20.0, lines >= 4))))


def scored_sql(source: str, keep=("id",)) -> str:
    kept = ", ".join(keep)
    return f"""scored AS (
  SELECT {kept}, 'by_quantity' AS model, category - 1 AS label, CAST(coalesce(total_qty, 0) > 80 AS INTEGER) AS prediction,
         coalesce(total_qty, 0) / 400.0 AS score FROM {source}
  UNION ALL SELECT {kept}, 'by_lines', category - 1, CAST(coalesce(n_lines, 0) >= 4 AS INTEGER), coalesce(n_lines, 0) / CAST(20 AS DOUBLE)
  FROM {source})"""


def metrics_sql(source: str, groups=()) -> list[str]:
    """CTEs up to ``metrics``: per group and model all five metrics and the confusion cells."""
    keys = ", ".join([*groups, "model"])
    r = "coalesce({} / CAST(nullif({}, 0) AS DOUBLE), 0)".format
    cells = ", ".join(f"count(*) FILTER (WHERE label = {y} AND prediction = {p}) AS n{y}{p}" for y in (0, 1) for p in (0, 1))
    return [
        scored_sql(source, [*groups]) if groups else scored_sql(source),
        f"cells AS (SELECT {keys}, {cells} FROM scored GROUP BY ALL)",
        f"""parts AS (SELECT *, n00 + n01 AS s0, n10 + n11 AS s1, {r('n00', '(n00 + n10)')} AS p0, {r('n11', '(n01 + n11)')} AS p1,
            {r('n00', '(n00 + n01)')} AS r0, {r('n11', '(n10 + n11)')} AS r1 FROM cells)""",
        "parts2 AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1_1 FROM parts)",
        f"""auc AS (SELECT {keys}, (sum(rank) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
            / nullif(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0), 0) AS roc_auc
            FROM (SELECT {keys}, label, rank() OVER (PARTITION BY {keys} ORDER BY score)
                  + (count(*) OVER (PARTITION BY {keys}, score) - 1) / 2.0 AS rank FROM scored) GROUP BY ALL)""",
        f"""metrics AS (SELECT {keys}, (n00 + n11) / CAST(s0 + s1 AS DOUBLE) AS accuracy, (p0 * s0 + p1 * s1) / (s0 + s1) AS precision,
            (r0 * s0 + r1 * s1) / (s0 + s1) AS recall, (f0 * s0 + f1_1 * s1) / (s0 + s1) AS f1, roc_auc, n00, n01, n10, n11
            FROM parts2 JOIN auc USING ({keys}))""",
    ]
