"""Benchmark decontamination: a hash set of normalised benchmark n-grams, scanned by word windows.

The set goes to every task while its text is within ``BROADCAST_BYTES``; a larger benchmark is cut
into slices of that size, and the documents are scanned for one slice after the other: what a slice
hits is written, and its set is taken back from the tasks, before the next one is sent. Hits are
verified word by word, so there are no false ones.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import LOWER, fresh, per_value, text_of
from plumbline.sources.staging import staged

WINDOW = 10
BROADCAST_BYTES = 32 << 20

# Fixed: a word is a run of digits, lower-cased ASCII letters and all that is not ASCII.
_TO_WORDS = bytes(LOWER[b] if b >= 128 or 48 <= b <= 57 or 97 <= LOWER[b] <= 122 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class NGrams(NamedTuple):
    """Ids of the benchmark's words, and its windows (tuples of ids) with the items that hold them."""

    ids: dict[bytes, int]
    windows: dict[tuple[int, ...], tuple[str, ...]]
    sizes: tuple[int, ...]


def ngrams(items: list[tuple[object, str]], window: int = WINDOW) -> NGrams:
    ids: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        own = [ids.setdefault(w, len(ids)) for w in words_of(text or "")]
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            found.setdefault(tuple(own[i:i + size]), set()).add(str(item))
    windows = {k: tuple(sorted(v)) for k, v in found.items()}
    return NGrams(ids, windows, tuple(sorted({len(k) for k in windows})))


def scan(words: list[bytes], grams: NGrams) -> tuple[list[int], set[str]]:
    """Starts of hit words (their numbers) and the items found.

    A window needs as many words of the benchmark in a row; only such runs are looked at.
    """
    get = grams.ids.get
    ids = [get(w, -1) for w in words]
    hit: set[int] = set()
    items: set[str] = set()
    if not grams.sizes:
        return [], items
    at, n, least = 0, len(ids), grams.sizes[0]
    while at < n:
        if ids[at] < 0:
            at += 1
            continue
        end = at + 1
        while end < n and ids[end] >= 0:
            end += 1
        if end - at >= least:
            for size in grams.sizes:
                for i in range(at, end - size + 1):
                    owners = grams.windows.get(tuple(ids[i:i + size]))
                    if owners:
                        items.update(owners)
                        hit.update(range(i, i + size))
        at = end + 1
    return sorted(hit), items


def _slices(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """The benchmark whole if its text is within the limit, else in parts by a hash of the item."""
    text = text_of(benchmark)
    size = benchmark.agg(F.sum(F.octet_length(text) + F.octet_length(F.coalesce(F.col("item_id").cast("string"), F.lit(""))) + 64)).first()[0] or 0
    parts = 1 + int(size) // limit
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text.alias("text")).distinct()
    if parts == 1:
        return [rows]
    # a margin for uneven parts; one item is never cut
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * parts)) == i) for i in range(2 * parts)]


_MARKS = "struct<n_words:bigint,hit:array<int>,items:array<string>>"


def _scanner(grams):
    """Marks of a text by the broadcast n-grams ``grams``."""
    def marks(text: str) -> dict:
        words = words_of(text)
        hit, items = scan(words, grams.value)
        return {"n_words": len(words), "hit": hit, "items": sorted(items)}

    return per_value(marks, _MARKS, deterministic=False)


def _broadcast(spark, part: DataFrame, window: int):
    return spark.sparkContext.broadcast(ngrams([(r[0], r[1]) for r in part.toLocalIterator()], window))  # at most BROADCAST_BYTES of text


def _marked(docs: DataFrame, benchmark: DataFrame, window: int, limit: int, text: str, name: str) -> DataFrame:
    """``docs`` with the struct column ``name``: n_words, numbers of hit words, items."""
    spark, parts = docs.sparkSession, _slices(benchmark.where(F.col("item_id").isNotNull()), limit)
    if len(parts) == 1:
        return docs.withColumn(name, _scanner(_broadcast(spark, parts[0], window))(text_of(docs, text)))
    row, of = fresh(docs, "row"), fresh(docs, "of_row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents")  # the numbers stay
    found = None
    for part in parts:
        grams = _broadcast(spark, part, window)
        hits = rows.select(F.col(row).alias(of), _scanner(grams)(text_of(rows, text)).alias(name)).where(F.size(f"{name}.hit") > 0)
        hits = staged(hits.select(of, f"{name}.hit", f"{name}.items"), "hits")
        grams.destroy()
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy(of).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hit", "items")])  # a row per slice
    count = per_value(lambda t: len(words_of(t)), "bigint", deterministic=False)(text_of(rows, text))
    joined = rows.join(found, rows[row] == found[of], "left")
    none = {"hit": "array<int>", "items": "array<string>"}
    marks = F.struct(count.alias("n_words"), *[F.coalesce(found[c], F.array().cast(kind)).alias(c) for c, kind in none.items()])
    return joined.select(*[rows[c] for c in docs.columns], marks.alias(name))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null text has no words. Benchmark rows without text, words or item_id give no windows; repeated
    items count once. Repeated documents stay. Empty tables give no rows or no hits. No other
    column is read.
    """
    marked = _marked(docs.select("doc_id", "text"), benchmark, window, limit, "text", "m")
    return marked.select(
        "doc_id", F.col("m.n_words").alias("n_words"), F.size("m.hit").cast("long").alias("n_hit"),
        F.size("m.items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "m.items"), 256).alias("items_sha256"),
        (F.size("m.hit") > 0).alias("contaminated"))


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


_RUN = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def without_words(text: str, hit: list[int]) -> str:
    """The text without the hit words and what stands between them."""
    if not hit:
        return text
    gone, out, at, last = set(hit), [], 0, -2
    for i, m in enumerate(_RUN.finditer(text)):
        if i in gone:
            if last != i - 1:
                out.append(text[at:m.start()])
            at, last = m.end(), i
    out.append(text[at:])
    return "".join(out)


def _cutter():
    import pyarrow as pa

    def run(texts: pa.Array, hits: pa.Array) -> pa.Array:
        return pa.array([t if t is None else without_words(t, h) for t, h in zip(texts.to_pylist(), hits.to_pylist())], pa.string())

    run.__annotations__ = {"texts": pa.Array, "hits": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string")


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", window: int = WINDOW,
                  limit: int = BROADCAST_BYTES, text: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, or without the hit spans of their texts.

    ``action="documents"`` drops every row with a hit; ``"spans"`` cuts the hit words out of the
    text and keeps the row. Columns and clean rows stay as they are.
    """
    if action not in ("documents", "spans"):
        raise ValueError(f"unknown action: {action}")
    name = fresh(docs, "marks")
    marked = _marked(docs, benchmark, window, limit, text, name)
    if action == "documents":
        left = marked.where(F.size(f"{name}.hit") == 0)
        return left.select(*[F.col(f"`{c}`") for c in docs.columns])
    dirty = F.size(f"{name}.hit") > 0  # clean rows send a null to Python and keep their text
    cut = _cutter()(F.when(dirty, F.col(text)), F.array_sort(f"{name}.hit"))
    new = F.when(dirty, cut).otherwise(F.col(text))
    return marked.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
