"""A forest is grown on all training rows, whatever their number, order and parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import forest, models
from plumbline.plans import training

N = 12_000  # more training rows than a forest once saw


@pytest.fixture(scope="module")
def many(spark):
    """The label follows from ``a`` and ``b`` and from a share of noise; some keys are missing or come twice."""
    rng = np.random.default_rng(11)
    a, b, noise = rng.normal(size=N), rng.integers(0, 9, N), rng.random(N)
    keys = [None if i in (5, 6) else i - 1 if i == 77 else i for i in range(N)]
    rows = [(k, float(x), int(y), "uvw"[y % 3], int((x + y / 9 > 0.5) ^ (z < 0.1)), i % 6 == 0, i % 3)
            for i, (k, x, y, z) in enumerate(zip(keys, a, b, noise))]
    return spark.createDataFrame(rows, "id long, a double, b int, s string, label int, is_test boolean, fold int").cache()


def in_memory(df, trees):
    """Scores of the test rows by trees grown on all training rows at once."""
    pdf = df.toPandas().sort_values(["id", "label", "a"], kind="stable")
    x = np.column_stack([pdf["a"], pdf["b"], *[(pdf["s"] == c) for c in "uvw"]]).astype(float)
    y, test = pdf["label"].to_numpy(float), pdf["is_test"].to_numpy()
    share = [(y[~test] == v).mean() for v in (0, 1)]
    g = forest.group(x[~test], y[~test], np.where(y[~test] == 1, 0.5 / share[1], 0.5 / share[0]))
    made = [forest.grow(g.binned, g.label, g.weight, g.edges, t, 42) for t in range(trees)]
    return dict(zip(pdf["a"][test], forest.ForestModel.of(made, 5).scores(x[test])))


def test_all_training_rows_are_seen(many):
    assert models.random_forest().fit_rows is None
    found = training.fit_and_score(many, [training.held_out()], ["random_forest"], ["a", "b", "s"], ["id", "a"], {"random_forest": {"trees": 5}})
    want = in_memory(many, 5)
    got = {r["a"]: r["score"] for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_runs_and_parts_change_nothing(many):
    runs = [training.held_out(), *training.cross_validation(3)]
    both = {"random_forest": {"trees": 3}}
    one = training.fit_and_score(many, runs, list(models.MODELS), ["a", "b", "s"], ["id", "a"], both)
    other = training.fit_and_score(many.repartition(11, "b"), runs[1:3], ["random_forest"], ["a", "b", "s"], ["id", "a"], both)
    one = {(r["run"], r["a"]): r["score"] for r in one.where("model = 'random_forest'").collect()}
    other = {(r["run"] + 1, r["a"]): r["score"] for r in other.collect()}
    assert len(one) == N + N // 6 and other.items() <= one.items() and len(other) == 2 * N // 3


def test_thresholds_of_all_values(spark):
    """Many, few, one and negative values, in several fits and parts: the thresholds of all rows in memory."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=3000), rng.integers(-3, 3, 3000), np.ones(3000), np.where(rng.random(3000) < 0.7, 0.0, rng.random(3000).round(3))])
    trains = np.column_stack([rng.random(3000) < 0.8, np.arange(3000) < 200, np.ones(3000, bool)])
    rows = spark.createDataFrame([(r.tolist(), t.tolist()) for r, t in zip(x, trains)], "features array<double>, trains array<boolean>").repartition(5)
    for bins in (256, 16):
        found = forest.edges_of_all(rows, 3, 4, bins)
        for i in range(3):
            for j in range(4):
                assert found[i][j].tolist() == forest.bin_edges(x[trains[:, i], j], bins).tolist()
    with pytest.raises(ValueError):
        forest.edges_of_all(rows.withColumn("trains", F.array(F.lit(True), F.lit(False))), 2, 4)


def test_trees_in_pieces(monkeypatch):
    """Nodes of more rows than are split together, and levels cut anywhere."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 9, (3000, 4))]).astype(float)
    y = (x[:, 0] + x[:, 1] / 9 + rng.normal(0, 0.5, 3000) > 0.5).astype(float)
    g = forest.group(x, y, np.where(y == 1, 0.7, 1.3))
    whole = [forest.grow(g.binned, g.label, g.weight, g.edges, t, 42) for t in range(3)]
    monkeypatch.setattr(forest, "CHUNK", 101)
    monkeypatch.setattr(forest, "DRAWN", 300)
    for t, want in enumerate(whole):
        made = forest.grow(g.binned, g.label, g.weight, g.edges, t, 42)
        assert all((made[k] == want[k]).all() for k in want) and len(made["feature"]) > 100
