"""Delimited text files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.cleaning import normalize_name, normalize_names

# What counts as missing besides an empty field (fixed values, the usual reader defaults).
MISSING = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

PLACES = ("_file", "_block", "_order")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, sep: str = ";", encoding: str = "UTF-8",
             na_values: Iterable[str] = (), dtype: Mapping[str, str] | None = None, normalize: bool = True, places: bool = False) -> DataFrame:
    """Read with a given schema (inference would read the file twice).

    Columns are found by their names in the header, as they stand or normalised; one that is
    missing raises. A quote within quotes is doubled. Fields are read as text first, so that every missing token becomes NULL whatever the
    column's type; then each column takes its type from ``dtype`` or the schema."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.options(sep=sep, encoding=encoding, header=True, quote='"', escape='"')
    header = reader.csv(path).columns  # the first line only
    named = {normalize_name(name): name for name in header} | {name: name for name in header}
    missing = [f.name for f in schema.fields if f.name not in named and normalize_name(f.name) not in named]
    if missing:
        raise ValueError(f"not in the header: {missing}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    found = reader.schema(text).csv(path)
    block = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    extra = [c.alias(name) for c, name in zip(block, PLACES)] if places else []
    raw = found.select(*[F.col(f"`{named.get(f.name, named.get(normalize_name(f.name)))}`").alias(f.name) for f in schema.fields], *extra)
    tokens = [*MISSING, *na_values]
    types = {**{f.name: f.dataType.simpleString() for f in schema.fields}, **(dtype or {})}
    df = raw.select(*[
        F.when(~F.col(f"`{f.name}`").isin(tokens), F.col(f"`{f.name}`")).cast(types[f.name]).alias(f.name)
        for f in schema.fields
    ], *(PLACES if places else ()))
    if not normalize:
        return df
    names = normalize_names(df.drop(*PLACES)).columns
    return df.toDF(*names, *(PLACES if places else ()))
