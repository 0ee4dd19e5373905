"""A view of orders as applications: one row per order, with the roles of a credit table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.domain import CREDIT
from plumbline.operators.expectations import Suite, load_suite

COLUMNS = {
    "status": "string", "priority": "string", "segment": "string", "region": "string",
    "amount": "double", "total_qty": "double", "avg_qty": "double", "n_lines": "int",
    "avg_discount": "double", "category": "int",
}
ROLES = {
    "checking_account_status": "status", "credit_history": "priority", "purpose": "segment",
    "savings_account_bonds": "region", "credit_amount": "amount", "duration_in_month": "total_qty",
    "age_in_years": "avg_qty", "installment": "n_lines", "residence": "avg_discount", "category": "category",
}
APPLICATIONS = CREDIT.renamed(ROLES, COLUMNS, {
    "amount": (1000000, 2000000, 5000000), "total_qty": (1000, 1500, 2000), "avg_qty": (100, 120, 150),
    "avg_discount": (15, 20, 25),
})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def applications(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer's segment and region and aggregates of their lines.

    The lines are aggregated per order before the join, and both sides then meet on the
    order key; customer joins by key, nation and region are small enough for Spark to
    broadcast by their file size.
    """
    read = lambda name: table(spark, folder, name)
    lines = read("lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("total_qty"),
        F.avg("l_quantity").alias("avg_qty"),
        F.count(F.lit(1)).cast("int").alias("n_lines"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
    )
    places = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        read("orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"), F.col("o_totalprice").alias("amount"),
            "total_qty", "avg_qty", "n_lines", "avg_discount",
            (F.lit(1) + F.coalesce("returned", F.lit(0))).cast("int").alias("category"),
            F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        )
    )


def suite() -> Suite:
    return load_suite(os.path.join(os.path.dirname(os.path.dirname(__file__)), "suites", "order_applications.yaml"))
