"""Isolation forest (Liu, Ting and Zhou, 2008): trees grown in parallel on small samples,
rows scored in Arrow batches against the broadcast forest.

What a tree sees is bounded by design (256 rows), so growing never depends on the table's
size; the sample is taken by ticket, hence the same on every run.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.functions.draws import key_of, ticket, with_key
from plumbline.operators import stats
from plumbline.sources.staging import staged

TREE_ROWS = 256
TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, length array<double>"


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    """One tree as parallel lists; leaves point at themselves and carry their path length."""
    tree: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "length": []}

    def node(part: np.ndarray, depth: int) -> int:
        at = len(tree["feature"])
        for name, value in (("feature", 0), ("threshold", 0.0), ("left", at), ("right", at),
                            ("length", depth + expected_path(len(part)))):
            tree[name].append(value)
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else []
        if depth >= limit or not len(spread):
            return at
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] <= cut
        tree["feature"][at], tree["threshold"][at] = f, cut
        tree["left"][at] = node(part[left], depth + 1)
        tree["right"][at] = node(part[~left], depth + 1)
        return at

    node(rows, 0)
    return tree


def _values(df: DataFrame, columns: Sequence[str], fills: dict[str, float]) -> list:
    return [F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c] or 0.0))).alias(c) for c in columns]


def fit(df: DataFrame, columns: Sequence[str], *, key: str = "id", seed: int = 42, trees: int = 100) -> dict:
    """Grow the forest. Tree t takes rows t, t + s, t + 2s, ... of a shuffled pool of at most
    ``trees * 256`` rows, with a stride s that repeats no row."""
    about = stats.scalars(df, {"n": F.count(F.lit(1)), **{c: F.avg(c) for c in columns}})
    n = about.pop("n")
    if n == 0:
        raise ValueError("an isolation forest needs rows")
    size = min(TREE_ROWS, n)
    pool_rows = min(n, trees * TREE_ROWS)
    k, draw = key_of(df, key), ticket("isolation", seed)
    df = with_key(df, key)
    taken = stats.ticket_cuts(df, {"pool": (draw, [pool_rows])}, F.expr(k))["pool"][0]
    pool = (
        df.filter(taken).select(draw.alias("draw"), F.expr(k).alias("key"), *_values(df, columns, about))
        .withColumn("rank", F.row_number().over(Window.orderBy("draw", "key")) - 1)  # at most pool_rows rows
    )
    # positions of every tree: distinct within a tree, since its stride shares no factor with the pool
    steps = [s for s in range(1, pool_rows + 1) if math.gcd(s, pool_rows) == 1][:trees] or [1]
    spots = (
        df.sparkSession.range(trees * size)
        .select((F.col("id") % trees).cast("int").alias("tree"), F.floor(F.col("id") / trees).alias("slot"))
        .withColumn("rank", (F.col("tree") * size + F.col("slot") * F.element_at(
            F.array(*[F.lit(s) for s in steps]), F.col("tree") % len(steps) + 1)) % pool_rows)
    )
    limit = max(1, math.ceil(math.log2(size)))
    names = list(columns)

    def grow_one(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, number, zlib.crc32(b"isolation")])
        part = pdf.sort_values("slot")[names].to_numpy(dtype=float)
        return pd.DataFrame([{"tree": number, **grow(part, rng, limit)}])

    grown = spots.join(pool, "rank").groupBy("tree").applyInPandas(grow_one, TREE_SCHEMA)
    rows = sorted(grown.collect(), key=lambda r: r["tree"])  # trees * 511 nodes at most
    width = max(len(r["feature"]) for r in rows)

    def stack(name, kind):
        out = np.zeros((len(rows), width), dtype=kind)
        for i, r in enumerate(rows):
            out[i, : len(r[name])] = r[name]
        return out

    return {
        "columns": names, "fills": about, "depth": limit, "norm": expected_path(size) or 1.0,
        "feature": stack("feature", np.int32), "threshold": stack("threshold", float),
        "left": stack("left", np.int32), "right": stack("right", np.int32), "length": stack("length", float),
    }


def perfect(forest: dict) -> tuple[list, np.ndarray, np.ndarray]:
    """The trees as perfect ones, children of i at 2i + 1 and 2i + 2: per feature the forest's own thresholds,
    per tree and inner node its feature and the place of its threshold, per tree and lowest node its length.
    What hangs below a leaf repeats its length."""
    trees, depth = len(forest["feature"]), forest["depth"]
    edges = [np.unique(forest["threshold"][(forest["feature"] == f) & (forest["left"] != np.arange(forest["left"].shape[1]))])
             for f in range(len(forest["columns"]))]
    each, at = np.arange(trees)[:, None], np.zeros((trees, 1), np.int64)
    nodes = []
    for _ in range(depth):
        feature, threshold = forest["feature"][each, at], forest["threshold"][each, at]
        left, right = forest["left"][each, at], forest["right"][each, at]
        place = np.zeros(at.shape, np.int64)
        for f, own in enumerate(edges):
            place = np.where(feature == f, np.searchsorted(own, threshold), place)
        nodes.append(feature.astype(np.int64) << 32 | place)
        at = np.stack([left, right], axis=2).reshape(trees, -1)
    return edges, np.concatenate(nodes, axis=1) if nodes else np.zeros((trees, 0), np.int64), forest["length"][each, at]


def path_scores(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1], higher is more isolated. Rows go down all trees as places among the thresholds."""
    edges, nodes, lengths = perfect(forest)
    n, width = x.shape
    bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1).astype(np.int32).ravel()
    first, total = np.arange(n) * width, np.zeros(n)
    for node, length in zip(nodes, lengths):
        at = np.zeros(n, np.int64)
        for _ in range(forest["depth"]):
            here = node.take(at)
            at = 2 * at + 1 + (bins.take(first + (here >> 32)) > (here & 0xFFFFFFFF))
        total += length.take(at - len(node))
    return 2.0 ** (-(total / len(nodes)) / forest["norm"])


def score(df: DataFrame, forest: dict, output: str = "anomaly_score") -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(path_scores(shared.value, batch.to_numpy(dtype=float)))

    return df.withColumn(output, scored(F.struct(*_values(df, forest["columns"], forest["fills"]))))


def flag(df: DataFrame, columns: Sequence[str], *, key: str = "id", seed: int = 42, contamination: float = 0.1,
         trees: int = 100, output: str = "is_outlier") -> DataFrame:
    """Mark the ``contamination`` share of rows with the highest scores."""
    forest = fit(df, columns, key=key, seed=seed, trees=trees)
    scored = staged(score(df, forest, "_score"), "scored")
    cut = stats.quantiles(scored, {"s": (-F.col("_score"), [contamination])})["s"][0]
    return scored.withColumn(output, -F.col("_score") < F.lit(cut)).drop("_score")
