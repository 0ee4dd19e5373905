"""Inputs shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.sqltext import NAMES, TEXTS
from plumbline.operators import corrupt
from plumbline.sources.applications import APPLICATIONS, applications, suite, table  # noqa: F401
from plumbline.sources.staging import staged

DOMAIN = APPLICATIONS
SUITE = suite()


def apps(spark: SparkSession, folder: str) -> DataFrame:
    return applications(spark, folder)


def corrupted(spark: SparkSession, folder: str, scenario: str = "severe") -> DataFrame:
    """The conjoined corruption, written once for the several passes of what follows."""
    clean = staged(applications(spark, folder).select("id", *NAMES), "applications")
    return staged(corrupt.conjoined(clean, scenario, DOMAIN), "corrupted")


def shown(df: DataFrame, digits: int | None = None, columns=("id", *NAMES)) -> DataFrame:
    def one(c):
        if c == "id" or c in TEXTS:
            return F.col(c)
        v = F.col(c).cast("double")
        places = 6 if c == "avg_discount" else digits
        return (F.round(v, places) if digits is not None else v).alias(c)
    return df.select(*[one(c) for c in columns])


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
