"""Registered queries call the operators with their defaults: no smaller forest, fewer folds or trees."""

import inspect

import pytest

from catalog import flow, modelling, repairs
from plumbline.operators import isolation, models
from plumbline.plans import flows, training


class Called(Exception):
    pass


def recorded(monkeypatch, module, name):
    bound = inspect.signature(getattr(module, name))

    def call(*args, **kwargs):
        got = bound.bind(*args, **kwargs)
        raise Called(got.arguments)

    monkeypatch.setattr(module, name, call)


@pytest.mark.parametrize("catalog, query, module, name", [
    (modelling, "m14", training, "run_training"), (flow, "f5", training, "train_and_score"),
    (repairs, "r9a", isolation, "flag"), (repairs, "r9", repairs.repair, "multivariate_outliers"), (repairs, "r14_all", flows, "remediate")])
def test_defaults(spark, monkeypatch, catalog, query, module, name):
    folder = "/root/testdata/sf0.001"
    recorded(monkeypatch, module, name)
    with pytest.raises(Called) as raised:
        getattr(catalog, query)(spark, folder)
    given = raised.value.args[0]
    cuts = {"params", "folds", "trees"} & (set(given) | {k for v in given.values() if isinstance(v, dict) for k in v})
    assert not cuts


def test_forest_of_m7(spark, monkeypatch):
    class Stop(Exception):
        pass

    def forest(**params):
        raise Stop(params)

    monkeypatch.setitem(models.MODELS, "random_forest", forest)
    from catalog import QUERIES
    with pytest.raises(Stop) as raised:
        QUERIES["m7_random_forest"](spark, "/root/testdata/sf0.001").collect()
    assert raised.value.args[0] == {}
