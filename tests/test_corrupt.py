"""Corruptors change what they say, nothing else, and the same on every run."""

import pytest
from pyspark.sql import functions as F

from plumbline.domain import CREDIT, LEVELS
from plumbline.operators import corrupt


@pytest.fixture(scope="module")
def credit(spark):
    cells = []
    for c, t in CREDIT.columns.items():
        if t == "string":
            cells.append(F.lit("A11").alias(c))
        elif c == "category":
            cells.append((F.col("id") % 2 + 1).cast("int").alias(c))
        else:
            cells.append(F.lit(1000 if c == "credit_amount" else 20 if c == "duration_in_month" else 3).alias(c))
    return spark.range(5000).select("id", *cells).cache()


def changed(before, after, column):
    joined = before.select("id", F.col(column).alias("b")).join(after.select("id", F.col(column).alias("a")), "id")
    return joined.filter(~F.col("a").eqNullSafe(F.col("b"))).count()


@pytest.mark.parametrize("level", LEVELS)
def test_missing_counts_are_exact(credit, level):
    out = corrupt.missing_values(credit, level)
    counts = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in CREDIT.columns]).first().asDict()
    assert {c: n for c, n in counts.items() if n} == CREDIT.missing_counts[level]
    assert out.columns == credit.columns


def test_missing_needs_more_rows_than_the_count(credit):
    few = credit.filter("id < 30").cache()
    out = corrupt.missing_values(few, "severe")
    counts = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in CREDIT.columns]).first().asDict()
    assert {c for c, n in counts.items() if n} == {"checking_account_status", "credit_amount"}
    assert corrupt.missing_values(credit.filter("id < 0"), "light").count() == 0
    assert corrupt.missing_values(credit.drop("credit_amount"), "light").columns == credit.drop("credit_amount").columns


@pytest.mark.parametrize("step,columns,share", [
    (corrupt.outliers, CREDIT.outliers["severe"].probability, None),
    (corrupt.categorical_errors, CREDIT.category_errors["severe"][1], 0.08),
    (corrupt.label_errors, ["category"], 0.08),
    (corrupt.relationship_violations, ["duration_in_month"], 0.08)])
def test_only_its_columns_and_about_its_share(credit, step, columns, share):
    out = step(credit, "anything else")
    for c in CREDIT.columns:
        n = changed(credit, out, c)
        if c in columns:
            p = share or columns[c]
            assert abs(n / 5000 - p) < 0.02, c
        else:
            assert n == 0, c
    assert out.columns == credit.columns


def test_labels_flip_back_and_keep_their_type(credit):
    once = corrupt.label_errors(credit, "medium")
    assert dict(once.dtypes)["category"] == "int"
    assert changed(credit, corrupt.label_errors(once, "medium"), "category") == 0
    assert changed(credit, once, "category") > 2000
    assert changed(credit, corrupt.label_errors(credit, "light", prob=0.0), "category") == 0


def test_violations_exceed_the_amount_and_skip_null(credit):
    gaps = credit.withColumn("credit_amount", F.when(F.col("id") % 2 == 0, F.col("credit_amount")))
    out = corrupt.relationship_violations(gaps, "severe")
    hit = out.filter("duration_in_month <> 20")
    assert hit.filter("id % 2 = 1").count() == 0
    assert hit.filter("duration_in_month < credit_amount * 1.1 or duration_in_month > credit_amount * 2").count() == 0


def test_an_extreme_fills_a_null_and_a_multiple_does_not(credit):
    gaps = credit.withColumn("credit_amount", F.lit(None).cast("int"))
    out = corrupt.outliers(gaps, "severe")
    values = {r[0] for r in out.select("credit_amount").distinct().collect()}
    assert values == {None, 50000.0, 100000.0, 250000.0}


@pytest.mark.parametrize("name", list(corrupt.CORRUPTORS))
def test_same_result_under_another_partitioning(credit, name):
    step = corrupt.CORRUPTORS[name]
    a, b = step(credit, "severe"), step(credit.repartition(13, "purpose"), "severe")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    other = step(credit, "severe", seed=7)
    assert a.exceptAll(other).count() > 0


def test_text_keys_work(credit):
    named = credit.withColumn("id", F.concat(F.lit("row-"), "id"))
    assert corrupt.missing_values(named, "light").filter("credit_history is null").count() == 30
