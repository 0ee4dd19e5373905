"""Draws, exact order statistics and cuts against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.draws import ticket, uniform, with_key
from plumbline.operators import stats


@pytest.fixture(scope="module")
def numbers(spark):
    # a third of the rows hold one value, the rest is spread out; some are missing
    return spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7.0)).when(F.col("id") % 101 == 0, None)
        .otherwise((F.col("id") * 7919 % 10007) / 3.0).alias("x"),
        (F.col("id") % 5).cast("double").alias("few"), F.lit(None).cast("double").alias("none"),
    ).cache()


def test_quantiles_match_numpy(numbers):
    shares = [0.0, 0.1, 1 / 3, 0.5, 0.95, 1.0]
    got = stats.quantiles(numbers, {"x": (F.col("x"), shares), "few": (F.col("few"), [0.25, 0.75]), "none": (F.col("none"), [0.5])})
    x = np.array([r["x"] for r in numbers.select("x").collect() if r["x"] is not None])
    assert np.allclose(got["x"], np.quantile(x, shares), rtol=0, atol=1e-9)
    assert got["few"] == [1.0, 3.0]
    assert got["none"] == [None]


SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 2.0, np.nextafter(2.0, 0), np.nextafter(2.0, 3), 1e-300, 1e300,
           1.7976931348623157e308, float("inf"), float("-inf"), 4503599627370497.5, 9007199254740993.0, 0.1, -0.1, 1024.0, np.nextafter(1024.0, 0)]


def test_keys_keep_every_bit(spark):
    rng = np.random.default_rng(5)
    values = SPECIAL + [float(v) for v in rng.integers(0, 2**63, 3000, dtype=np.int64).view(np.float64) if np.isfinite(v)] + [2.0 ** e for e in range(-1074, 1024, 7)]
    values += [-v for v in values]
    df = spark.createDataFrame([("v", float(v)) for v in values], "name string, value double")
    rows = df.select("name", "value").rdd.map(tuple).collect()
    keys = [r["key"] for r in stats._ordered_key(df).collect()]
    assert [stats._from_key(k) for k in keys] == [v for _, v in rows]
    found = stats.order_statistics(df, {"v": (F.col("value"), lambda n: range(0, n, 7))})["v"]
    order = sorted(values)
    assert all(found[r].value == order[r] for r in range(0, len(values), 7))
    assert all(found[r].below == np.searchsorted(order, order[r]) and found[r].equal == order.count(order[r]) for r in range(0, len(values), 91))


def test_three_scans_at_most(spark, monkeypatch):
    scans = []
    kept = stats.staged
    monkeypatch.setattr(stats, "staged", lambda df, name: scans.append(name) or kept(df, name))
    df = spark.range(5000).select((F.sin("id") * 1e6).alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.exp(F.cos("id")).alias("c"))
    stats.quantiles(df, {c: (F.col(c), [0.1, 0.5, 0.9]) for c in "abc"})
    assert len(scans) <= 3
    scans.clear()
    stats.quantiles(df, {"b": (F.col("b"), [0.1, 0.5, 0.9])})
    assert len(scans) == 1


@pytest.mark.parametrize("k", [0, 1, 17, 1000, 29999, 30000, 50000])
def test_cuts_take_exactly_k_rows(numbers, k):
    df = with_key(numbers, "id")
    cut = stats.ticket_cuts(df, {"t": (ticket("cut"), [k])}, F.col("id"))["t"][0]
    assert df.filter(cut).count() == min(k, 30000)


@pytest.mark.parametrize("k", [1, 500, 9999, 10000, 10001, 20000])
def test_ties_are_split_by_key(numbers, k):
    draw = F.col("id") % 3  # three values for thirty thousand rows
    cut = stats.ticket_cuts(numbers, {"t": (draw, [k])}, F.col("id"))["t"][0]
    got = sorted(r["id"] for r in numbers.filter(cut).select("id").collect())
    assert got == sorted(sorted(range(30000), key=lambda i: (i % 3, i))[:k])


def test_top_values_break_ties_low_and_skip_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "x string, y string")
    tops = stats.top_values(df, {"x": F.col("x"), "y": F.col("y")})
    assert tops["x"] == stats.TopValue("a", 2, 4, 2)
    assert "y" not in tops


def test_draws_are_uniform_repeatable_and_independent(spark):
    df = with_key(spark.range(200000), "id")
    a, b = uniform("one"), uniform("two")
    shifted = with_key(spark.range(200000).withColumn("id", F.col("id") + 1), "id")
    got = df.agg(F.avg(a), F.stddev(a), F.corr(a, b), F.corr(a, F.col("id")), F.count_if(a < 0.07), F.count_if((a < 0.1) & (b < 0.1)),
                 F.count_distinct(ticket("t"))).first()
    assert abs(got[0] - 0.5) < 0.003 and abs(got[1] - 0.288675) < 0.003
    assert abs(got[2]) < 0.01 and abs(got[3]) < 0.01
    assert abs(got[4] / 200000 - 0.07) < 0.003 and abs(got[5] / 200000 - 0.01) < 0.001
    assert got[6] == 200000
    assert df.repartition(7).agg(F.sum(ticket("t") % 1000)).first() == df.agg(F.sum(ticket("t") % 1000)).first()
    x = [r[0] for r in df.select(a).limit(50000).collect()]
    y = [r[0] for r in shifted.select(a).limit(50000).collect()]
    assert abs(np.corrcoef(x, y)[0, 1]) < 0.02


def test_draws_use_high_key_bits(spark):
    df = spark.range(20000).select((F.col("id") * 4294967296).alias("id"))
    got = with_key(df, "id").agg(F.avg(uniform("one")), F.count_distinct(ticket("t"))).first()
    assert abs(got[0] - 0.5) < 0.01 and got[1] == 20000


def test_later_passes_key_the_open_cells_only(numbers, monkeypatch):
    """After the first pass only values in the cells that are still searched get a key."""
    sizes, plain = [], stats._ordered_key
    monkeypatch.setattr(stats, "_ordered_key", lambda rows: sizes.append(rows.count()) or plain(rows))
    x = numbers.select((F.col("id") * 7919 % 30011 - F.lit(15000) + F.lit(0.123)).alias("x"))
    for p in (0.001, 0.3, 0.97):
        sizes.clear()
        got = stats.quantiles(x, {"x": (F.col("x"), [p])})["x"][0]
        assert got == pytest.approx(np.quantile([r["x"] for r in x.collect()], p))
        assert sizes[0] == 30000 and len(sizes) > 1 and max(sizes[1:]) < 300
