"""Trees against a plain grower, the forest's invariants, and Newton's method at its optimum."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import forest, logistic
from plumbline.plans import training


def data(n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.random(n).round(2), rng.integers(0, 2, n), rng.normal(size=n), rng.integers(0, 5, n)]).astype(float)
    y = ((x[:, 0] + 0.4 * x[:, 1] + rng.normal(0, 0.3, n)) > 0.8).astype(float)
    return x, y, np.where(y == 1, 1.5, 0.8)


def plain(g, tree, seed, depth):
    """The same tree node by node: rows, then the best of all cuts of the drawn features."""
    n, d = g.binned.shape
    rng = np.random.default_rng([seed, tree])
    times = np.bincount(rng.integers(0, n, n), minlength=n)
    level = [(np.flatnonzero(times), None)]
    out = []
    for step in range(depth + 1):
        drawn = np.argsort(rng.random((len(level), d)), axis=1) if step < depth else None
        following = []
        for k, (rows, _) in enumerate(level):
            w = g.weight[rows] * times[rows]
            one = (w * g.label[rows]).sum() / w.sum()
            best = (0.0, None, None)
            if step < depth and 0 < one < 1:
                looked = 0
                for f in drawn[k]:
                    cuts = []
                    for b in range(int(g.binned.max())):
                        low = g.binned[rows, f] <= b
                        if low.any() and not low.all():
                            part = lambda m: (w[m] * g.label[rows][m]).sum() ** 2 / w[m].sum()
                            cuts.append((round((part(low) + part(~low) - (w * g.label[rows]).sum() ** 2 / w.sum()) / w.sum(), 9), b))
                    if cuts:
                        looked += 1
                        gain, b = max(cuts, key=lambda c: (c[0], -c[1]))
                        if gain > best[0]:
                            best = (gain, f, b)
                    if looked == max(1, int(math.sqrt(d))):
                        break
            out.append((-1 if best[1] is None else int(best[1]), one))
            if best[1] is not None:
                low = g.binned[rows, best[1]] <= best[2]
                following += [(rows[low], None), (rows[~low], None)]
        level = following
        if not level:
            break
    return out


@pytest.mark.parametrize("depth", [1, 3, 30])
def test_plain_grower(depth):
    g = forest.group(*data())
    for tree in range(5):
        made = forest.grow(g.binned, g.label, g.weight, g.edges, tree, 42, depth)
        want = plain(g, tree, 42, depth)
        assert made["feature"].tolist() == [f for f, _ in want]
        assert made["value"] == pytest.approx([v for _, v in want])


def test_edges_part_the_values():
    values = np.array([3.0, 1.0, 1.0, 2.0])
    assert forest.bin_edges(values).tolist() == [1.5, 2.5] and forest.bin_edges(np.ones(5)).tolist() == []
    many = np.random.default_rng(1).random(5000)
    edges = forest.bin_edges(many, 16)
    assert len(edges) == 15 and np.bincount(np.searchsorted(edges, many)).min() > 250


def test_constant_features_and_one_class():
    for x, y in ((np.ones((20, 3)), np.arange(20) % 2), (np.random.default_rng(1).random((20, 3)), np.zeros(20))):
        g = forest.group(x, y.astype(float), np.ones(20))
        assert len(forest.grow(g.binned, g.label, g.weight, g.edges, 0, 1)["feature"]) == 1


@pytest.fixture(scope="module")
def ready(spark):
    x, y, _ = data(400)
    rows = [(i, *map(float, r), "abc"[i % 3], int(v), i % 5 == 0, i % 4) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, s string, label int, is_test boolean, fold int").cache()


COLUMNS = ["a", "b", "c", "d", "s"]


def test_all_runs_at_once(spark, ready):
    runs = [training.held_out(), *training.cross_validation(4)]
    both = ["logistic_regression", "random_forest"]
    params = {"random_forest": {"trees": 20}}
    found = training.fit_and_score(ready, runs, both, COLUMNS, ["id"], params)
    counts = {(r["model"], r["run"]): r["count"] for r in found.groupBy("model", "run").count().collect()}
    assert counts == {(m, r): 80 if r == 0 else 100 for m in both for r in range(5)}
    alone = training.fit_and_score(ready, runs[2:3], both, COLUMNS, ["id"], params)
    one = {(r["id"], r["model"]): r["score"] for r in alone.collect()}
    other = {(r["id"], r["model"]): r["score"] for r in found.where("run = 2").collect()}
    assert one.keys() == other.keys() and all(one[k] == pytest.approx(other[k], abs=1e-6) for k in one)
    assert found.where("(prediction = 1) <> (score > 0.5) OR score < 0 OR score > 1").count() == 0


def test_fit_rows_bound_the_sample(spark, ready):
    few = training.fit_and_score(ready, [training.held_out()], ["random_forest"], COLUMNS, ["id"], {"random_forest": {"trees": 10, "fit_rows": 50}})
    again = training.fit_and_score(ready.repartition(7), [training.held_out()], ["random_forest"], COLUMNS, ["id"], {"random_forest": {"trees": 10, "fit_rows": 50}})
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, again.collect())) and few.count() == 80


def test_newton_reaches_the_optimum(spark, ready):
    rows = ready.select("id", F.array("a", "b", "c", "d").alias("features"), "label", F.array(~F.col("is_test"), F.lit(True)).alias("trains"))
    scales = [logistic.Scale([0.5, 0.0], [0.3, 1.0], {0: 0.8, 1: 1.4}), logistic.Scale([], [], {0: 1.0, 1: 1.0})]
    models = logistic.LogisticRegression(c=2.0).fit_all(rows, scales, 4)
    pdf = rows.toPandas()
    for i, (scale, model) in enumerate(zip(scales, models)):
        mine = pdf[[t[i] for t in pdf["trains"]]]
        x, y = np.stack(mine["features"].to_list()), mine["label"].to_numpy(float)
        w = np.where(y == 1, scale.weight[1], scale.weight[0])
        z = scale.apply(x)
        error = w * (model.scores(x) - y)
        assert np.abs(z.T @ error + model.coefficients / 2.0).max() < 1e-6 and abs(error.sum()) < 1e-6


def test_separable_classes_end(spark):
    rows = spark.createDataFrame([(i, [float(i)], int(i > 50), [True]) for i in range(100)], "id long, features array<double>, label int, trains array<boolean>")
    model, = logistic.LogisticRegression().fit_all(rows, [logistic.Scale([50.0], [29.0], {0: 1.0, 1: 1.0})], 1)
    assert np.isfinite(model.coefficients).all() and model.scores(np.array([[99.0]]))[0] > 0.9


def test_no_rows(spark, ready):
    with pytest.raises(ValueError):
        training.fit_and_score(ready.limit(0), [training.held_out()], ["random_forest"], COLUMNS, ["id"])


def walked(trees, points):
    """Every row down every tree, node by node."""
    out = np.zeros(len(points))
    for t in trees:
        for i, x in enumerate(points):
            at = 0
            while t["feature"][at] >= 0:
                at = t["left"][at] + (x[t["feature"][at]] > t["threshold"][at])
            out[i] += t["value"][at]
    return out / len(trees)


def test_scores_are_those_of_a_plain_walk():
    x, y, w = data(3000)
    g = forest.group(x, y, w)
    for depth in (0, 1, 6, 30):
        trees = [forest.grow(g.binned, g.label, g.weight, g.edges, t, 42, depth) for t in range(6)]
        points = np.vstack([x[:200], np.where(x[:200] > x.mean(axis=0), np.nan, x[:200]), [[e[0] for e in g.edges], [np.inf] * 4, [-np.inf] * 4]])
        assert (forest.ForestModel.of(trees, 4).scores(points) == walked(trees, points)).all()


def test_preparing_reads_its_input_once(spark, ready, monkeypatch):
    """The counts, cuts and medians of a training run over what was written, not over the query before it."""
    from plumbline.domain import CREDIT
    n = 300
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    names = {c: t for c, t in CREDIT.columns.items()}
    columns = [(F.lit(None).cast("string") if t == "string" else (F.col("id") % 7 + 1).cast(t)).alias(c) for c, t in names.items() if c != CREDIT.target]
    rows = spark.range(n).select("id", *columns, (F.col("id") % 2 + 1).cast(names[CREDIT.target]).alias(CREDIT.target))
    made = training.prepare(rows.mapInPandas(count, rows.schema), CREDIT)
    assert made.count() == n and seen.value == n


def test_many_rows_are_scored_without_walking(monkeypatch):
    """Leaves of one class and of both, trees of one node, NaN: the scores of the walk to the last bit, and no walk."""
    draw = np.random.default_rng(5)
    n = 600
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 4, n), draw.integers(0, 2, (n, 2))]).astype(float)
    label = (x[:, 0] + x[:, 2] + draw.normal(size=n) > 0).astype(float)
    label[x[:, 1] == 3] = 1
    many = np.column_stack([draw.normal(size=forest.MANY + 77), draw.integers(0, 5, (forest.MANY + 77, 3))]).astype(float)
    many[draw.random(many.shape) < 0.01] = np.nan
    for columns, y in ((4, label), (2, label), (4, np.ones(n)), (4, np.zeros(n))):
        own = x if columns == 4 else np.column_stack([np.round(x[:, :1]), x[:, 1:2], np.zeros((n, 2))])
        g = forest.group(own, y, np.where(y == 1, 0.7, 1.3))
        trees = [forest.grow(g.binned, g.label, g.weight, g.edges, i, 7) for i in range(12)]
        mixed = [((t["feature"] < 0) & (t["value"] > 0) & (t["value"] < 1)).sum() for t in trees]
        assert max(mixed) <= forest.MIXED and (columns == 4 or min(mixed) > 0)
        model = forest.ForestModel.of(trees, 4)
        with monkeypatch.context() as patch:
            patch.setattr(forest.ForestModel, "_walk", None)
            scores = model.scores(many)
        assert (scores == walked(trees, many)).all()
