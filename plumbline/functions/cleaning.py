"""Cleaning projections: NaN, textual nulls, coercion, truncation, column names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

TEXT_NULLS = ("NaN", "[null]")


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def is_fractional(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def numeric_columns(df: DataFrame, among: Iterable[str] | None = None) -> list[str]:
    names = set(df.columns if among is None else among)
    return [f.name for f in df.schema.fields if f.name in names and is_numeric(f)]


def text_columns(df: DataFrame, among: Iterable[str] | None = None) -> list[str]:
    names = set(df.columns if among is None else among)
    return [f.name for f in df.schema.fields if f.name in names and isinstance(f.dataType, T.StringType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark; the operators treat it as missing."""
    return df.withColumns(
        {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema.fields if is_fractional(f)}
    )


def text_nulls(df: DataFrame, tokens: Iterable[str] = TEXT_NULLS) -> DataFrame:
    """Textual stand-ins for a missing value become NULL in every string column."""
    tokens = list(tokens)
    return df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in text_columns(df)})


def to_number(column: Column) -> Column:
    """Number, or NULL where the text is not one."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def truncated_int(column: Column, dtype: str = "int") -> Column:
    """Toward zero, NaN and NULL to NULL."""
    number = column.cast("double")
    return F.when(~F.isnan(number), number).cast(dtype)


def printed(number: Column, digits: int) -> Column:
    """A number with a fixed count of decimals, as C and SQL print it: the exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal text half up instead. It still writes what is not finite."""
    number = number.cast("double")
    text = F.call_function("format_number", number, F.lit("0." + "0" * digits))
    return F.when(F.abs(number) < float("inf"), text).otherwise(F.format_string(f"%.{digits}f", number))


def normalize_name(name: str) -> str:
    text = re.sub(r"[ \t\r\n/\\-]+", "_", str(name).strip().lower())
    words = (re.sub(r"[^a-z0-9]", "", part) for part in text.split("_"))
    return "_".join(word for word in words if word)


def normalize_names(df: DataFrame) -> DataFrame:
    names = [normalize_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide once normalised: {sorted(names)}")
    return df.toDF(*names)
