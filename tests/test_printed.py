"""Numbers as text: the exact binary value decides, as in SQL's printf."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog.check import check, connect
from plumbline.functions.cleaning import printed

FOLDER = "/root/testdata/sf0.001"
VALUES = [0.25, 0.35, 24567.25, 24567.35, 474766.65, 249938.24999999, -0.25, -3.35, 0.0, 1e-9, 123456789.05, 4.5e11, 2.00005]


@pytest.mark.parametrize("digits", [1, 4])
def test_printed_as_in_sql(spark, digits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v double").select("i", printed(F.col("v"), digits).alias("t"))
    want = [duckdb.sql(f"SELECT printf('%.{digits}f', CAST({v!r} AS DOUBLE))").fetchall()[0][0] for v in VALUES]
    assert [r["t"] for r in df.orderBy("i").collect()] == want


def test_what_is_no_number_stays_text(spark):
    df = spark.sql("SELECT double('NaN') a, double('infinity') b, cast(null as double) c").select(*[printed(F.col(c), 4).alias(c) for c in "abc"])
    assert tuple(df.first()) == ("NaN", "Infinity", "null")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("amount", [24567.25, 24567.35, 249938.249996])
def test_quantiles_between_two_decimals(spark, tmp_path, amount):
    """Quantiles next to the middle of two printed values."""
    for name in os.listdir(FOLDER):
        source, target = os.path.join(FOLDER, name), tmp_path / name
        changed = f"* REPLACE (CAST({amount!r} AS DOUBLE) AS o_totalprice)" if name == "orders.parquet" else "*"
        duckdb.sql(f"COPY (SELECT {changed} FROM '{source}') TO '{target}' (FORMAT parquet)")
    assert check(spark, connect(str(tmp_path)), str(tmp_path), "e5_quantiles") is None
