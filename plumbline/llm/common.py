"""Helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed: bytes A-Z to lower case, nothing else changed.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def per_value(function: Callable, schema: str, deterministic: bool = True):
    """A column function that calls ``function`` on every value of an Arrow batch.

    ``function`` gets a str and returns a dict of ``schema``. Only the text goes to Python, so a
    table keeps all its columns, and a batch is bounded by ``spark.sql.execution.arrow``'s limits.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(schema))

    def run(values: pa.Array) -> pa.Array:
        return pa.array([function(v.as_py() or "") for v in values], kind)

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    made = F.arrow_udf(run, schema)
    return made if deterministic else made.asNondeterministic()
