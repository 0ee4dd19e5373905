"""Repeatable pseudo-random draws as plain integer arithmetic on a row key.

``rand()`` gives other numbers when a task is retried or the partitioning changes.
These draws depend on the key, a tag and a seed only, so a lost executor, another
cluster size or a second scan of the same table all see the same value. They need no
shuffle and stay inside whole-stage codegen.

The key is mixed once per row into two 32-bit halves (``with_key``); every draw is then a
dozen operations on them. That keeps the generated methods small enough for the JIT even
with some dozens of draws per row.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, functions as F

MASK32 = 0xFFFFFFFF
# Odd multipliers below 2**31, so a 32-bit value times one stays inside a signed 64-bit integer.
MUL_HIGH = 0x2C1B3C6D
MUL_FIRST = 0x7FEB352D
MUL_SECOND = 0x31848BAB

HALVES = ("_key_a", "_key_b")


def salts(tag: str, seed: int) -> tuple[int, int]:
    text = f"{seed}:{tag}"
    return zlib.crc32(text.encode()), zlib.crc32(text[::-1].encode())


def integer_key(name: str, dtype: str = "bigint") -> str:
    """SQL of an integer key: integers as they are, anything else through a 64-bit hash."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return f"coalesce(cast(`{name}` as bigint), 0L)"
    return f"xxhash64(`{name}`)"


def key_of(df: DataFrame, name: str) -> str:
    return integer_key(name, df.schema[name].dataType.simpleString())


def _half(key: str, first: int, second: int) -> str:
    x = f"(({key} & {MASK32}L) ^ ((shiftright({key}, 32) & {MASK32}L) * {MUL_HIGH}L & {MASK32}L))"
    x = f"({x} * {first}L & {MASK32}L)"
    return f"(({x} ^ shiftright({x}, 15)) * {second}L & {MASK32}L)"


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Add the mixed halves of the key; draws on the frame refer to them."""
    if HALVES[0] in df.columns:
        return df
    text = key_of(df, key)
    return df.withColumns({
        HALVES[0]: F.expr(_half(text, MUL_FIRST, MUL_SECOND)), HALVES[1]: F.expr(_half(text, MUL_SECOND, MUL_HIGH)),
    })


def without_key(df: DataFrame) -> DataFrame:
    return df.drop(*HALVES)


def hash32_sql(tag: str, seed: int = 42) -> str:
    """Well-mixed 32-bit hash of the key's halves, as a non-negative bigint."""
    first, second = salts(tag, seed)
    a, b = HALVES
    x = f"((({a} ^ {first}L) * {MUL_FIRST}L ^ {b}) & {MASK32}L)"
    return f"(((({x} ^ shiftright({x}, 15)) + {second}L) & {MASK32}L) * {MUL_SECOND}L & {MASK32}L)"


def uniform(tag: str, seed: int = 42) -> Column:
    """Uniform draw in [0, 1) for a frame with a mixed key."""
    return F.expr(f"{hash32_sql(tag, seed)} / 4294967296.0D")


def ticket(tag: str, seed: int = 42) -> Column:
    """53-bit draw to order rows by; ties are possible but rare, break them by key."""
    high, low = hash32_sql(tag + "|hi", seed), hash32_sql(tag + "|lo", seed)
    return F.expr(f"{high} * 2097152L + shiftright({low}, 11)")


def pick(choices: list, draw: Column) -> Column:
    """One of ``choices``, evenly, from a uniform draw."""
    options = F.array(*[F.lit(c) for c in choices])
    return F.element_at(options, (F.floor(draw * F.lit(float(len(choices)))) + 1).cast("int"))


def between(lo: float, hi: float, draw: Column) -> Column:
    return F.lit(float(lo)) + F.lit(float(hi) - float(lo)) * draw
