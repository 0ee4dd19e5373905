"""Drift metrics against numpy and pandas on small frames, in both bin modes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import drift

E = 1e-8


def entropy(p, q=None):
    p = np.asarray(p, dtype=float) / np.sum(p)
    if q is None:
        return -np.sum(p * np.log(p))
    q = np.asarray(q, dtype=float) / np.sum(q)
    return np.sum(p * np.log(p / q))


def frames(spark, before, after, kind):
    make = lambda v: spark.createDataFrame([(float(x) if kind == "double" and x is not None else x,) for x in v], f"x {kind}")
    return make(before), make(after)


CASES = {
    "same ends": ([0.0, 1, 2, 3, 5, 8, 10, 10, None], [0.0, 0, 0, 4, 4, 9, 10]),
    "other ends": ([1.0, 2, 3, 4, 5, 6, 7, 8, 9, 10], [1.5, 2, 3, 4, 5, 60, None]),
    "constant": ([3.0, 3, 3], [3.0, 3, 3, 3]),
    "small fractions": ([0.01, 0.02, 0.035, 0.08], [0.01, 0.01, 0.05, 0.08]),
}


@pytest.mark.parametrize("name", CASES)
def test_numeric_own_bins(spark, name):
    before, after = CASES[name]
    b, a = (pd.Series(v, dtype=float) for v in (before, after))
    got = drift.divergences(*frames(spark, before, after, "double"), ["x"], "own").first()
    hb, ha = (np.histogram(s.dropna(), bins=20, density=True)[0] + E for s in (b, a))
    cb, ca = (pd.cut(s, bins=10).value_counts(normalize=True, sort=False) for s in (b, a))
    gap = cb.rename(str) - ca.rename(str)
    psi = np.sum(gap * np.log((cb.rename(str) + E) / (ca.rename(str) + E)))
    assert got["kl_divergence"] == pytest.approx(entropy(hb, ha), abs=1e-9)
    assert got["entropy_before"] == pytest.approx(entropy(hb), abs=1e-9)
    assert got["entropy_after"] == pytest.approx(entropy(ha), abs=1e-9)
    assert got["psi"] == pytest.approx(psi, abs=1e-9)
    assert got["dominant_growth"] is None


@pytest.mark.parametrize("name", CASES)
def test_numeric_shared_bins(spark, name):
    before, after = CASES[name]
    b, a = (np.array([v for v in s if v is not None]) for s in (before, after))
    got = drift.divergences(*frames(spark, before, after, "double"), ["x"]).first()
    edges = np.array(drift.histogram_edges(b.min(), b.max(), 20))
    width = edges[1] - edges[0]
    count = lambda v: np.bincount(np.searchsorted(edges[1:-1], v, side="right"), minlength=20) / len(v)
    hb, ha = count(b) / width + E, count(a) / width + E
    assert got["kl_divergence"] == pytest.approx(entropy(hb, ha), abs=1e-7)
    cuts = np.array(drift.cut_edges(b.min(), b.max(), 10))
    share = lambda v: np.bincount(np.searchsorted(cuts[1:-1], v, side="left"), minlength=10) / len(v)
    p, q = share(b), share(a)
    assert got["psi"] == pytest.approx(np.sum((p - q) * np.log((p + E) / (q + E))), abs=1e-7)


def test_categorical_with_one_sided_values(spark):
    before, after = ["a", "a", "b", "c", None], ["a", "b", "b", "d"]
    dfs = frames(spark, before, after, "string")
    b, a = (pd.Series(v).value_counts(normalize=True) for v in (before, after))
    index = sorted(set(b.index) | set(a.index))
    bb, aa = b.reindex(index, fill_value=0), a.reindex(index, fill_value=0)
    shared, own = drift.divergences(*dfs, ["x"]).first(), drift.divergences(*dfs, ["x"], "own").first()
    for got in (shared, own):
        assert got["kl_divergence"] == pytest.approx(entropy(bb + E, aa + E), abs=1e-9)
        assert got["entropy_before"] == pytest.approx(entropy(bb + E), abs=1e-9)
        assert got["entropy_after"] == pytest.approx(entropy(aa + E), abs=1e-9)
        assert got["dominant_growth"] == pytest.approx(a.max() - b.max())
    assert shared["psi"] == pytest.approx(np.sum((bb - aa) * np.log((bb + E) / (aa + E))))
    assert own["psi"] == pytest.approx(np.sum((b - a) * np.log((b + E) / (a + E))))


@pytest.mark.parametrize("bins", ["shared", "own"])
def test_a_table_does_not_drift_from_itself(spark, bins):
    df = spark.range(500).select((F.col("id") % 37 * 1.5).alias("x"), (F.col("id") % 5).cast("string").alias("s"),
                                 F.lit(None).cast("double").alias("none"))
    rows = {r["column"]: r for r in drift.report(df, df, ["x", "s", "none"], bins).collect()}
    for c in ("x", "s"):
        assert rows[c]["psi"] == 0 and abs(rows[c]["kl_divergence"]) < 1e-12 and rows[c]["entropy_drop"] == 0
    assert rows["none"]["missing_before"] == 1.0 and rows["none"]["p50_before"] is None and rows["none"]["psi"] is None
    assert drift.alerts(drift.report(df, df, ["x", "s", "none"], bins)).count() == 0


def test_alerts_name_each_exceeded_limit(spark):
    before, after = frames(spark, ["a"] * 5 + ["b"] * 5, ["a"] * 9 + ["b"], "string")
    got = {(r["column"], r["alert"]) for r in drift.alerts(drift.report(before, after, ["x"])).collect()}
    assert got == {("x", "dominant_growth"), ("x", "psi"), ("x", "kl_divergence")}


def test_bad_mode_is_refused(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("x"))
    with pytest.raises(ValueError):
        drift.divergences(df, df, ["x"], "other")
