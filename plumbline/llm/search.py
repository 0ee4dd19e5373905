"""Ranked lexical search with geometrically blocked posting lists.

Documents are written once as their terms that any query holds, clustered by similarity: a one-
permutation sketch of the terms gives every document eight nibbles, and documents that share most
terms share leading nibbles. The posting list of a term is cut into blocks by the leading bits of
that sketch, so many that a block has about ``BLOCK`` documents; so every list has blocks of its
own. The summary of a block holds, for each coordinate, the greatest impact that any of its documents
has there. Of the coordinates of a list only those count that a query holds together with its term,
as no others enter a bound.

A query is answered in three passes over the clustered documents, for a block of queries at a time:

1. Some good documents are scored in full: the tenth best is a lower bound of the tenth place. Terms
   whose greatest impacts together stay below it can't lift a document there alone, so their lists
   are not opened.
2. Summaries of the lists that are opened, as grouped maxima. A block's bound for a query is the
   weighted sum of its summary; the block is skipped only when that bound is below the tenth place.
3. Documents of the blocks left are scored exactly, the ten best kept per task, then over all.

What goes to every task is bounded whatever the tables: a block of queries (``QUERY_TERMS``), and
bitmaps of a fixed size for the queries' terms and the blocks left. A bitmap may let more pass than
it should, which costs time only: terms are joined exactly, and whatever passes is scored exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any
import zlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import per_value, text_of
from plumbline.sources.staging import staged

K = 10
BLOCK = 32  # documents in a block, about
PROBES = 8  # terms of a query that find the first documents
QUERY_TERMS = 50_000  # terms of the queries that are answered together
TERM_BITS, BLOCK_BITS = 20, 24  # sizes of the bitmaps, powers of two
POSTINGS = 1_000_000  # postings that a task works on at once
NIBBLES = 8
NO_ID = -(1 << 63)  # stands for a null doc_id, first in order

# Fixed by the contract: ASCII letters and digits and all beyond ASCII are parts of terms.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
_PLACE = 16_777_213  # greatest prime below 2**24


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _item_terms(items: DataFrame, text: str) -> DataFrame:
    """``(item_id, term)``, each once. Rows of one item_id are one item."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.split(F.translate(text_of(items, text), upper, upper.lower()), SEPARATORS)
    return items.select("item_id", F.explode(words).alias("term")).where("term <> ''").distinct()


def _bitmap(df: DataFrame, place: Column, bits: int):
    """A bitmap of 2**bits places, folded in Spark: at most 2**bits / 64 rows reach the driver."""
    import numpy as np

    words = df.select(place.alias("place")).groupBy(F.expr("place div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))").alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out


def clustered(docs: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """``(doc, n, terms, tfs, sketch)`` of the documents with any term, in the order of their sketches."""
    mask = (1 << TERM_BITS) - 1
    known = _bitmap(vocabulary, F.crc32(F.col("term")).bitwiseAND(F.lit(mask).cast("long")), TERM_BITS).tobytes()

    def read(value: str) -> dict:
        words = terms_of(value)
        counts = Counter(words)
        crc, kept, least = zlib.crc32, [], {}
        for term in counts:
            code = crc(term)
            place = code & mask
            if known[place >> 3] >> (place & 7) & 1:
                kept.append(term)
                nibble = code >> 29
                if least.get(nibble, code) >= code:
                    least[nibble] = code
        sketch = 0
        for nibble in range(NIBBLES):
            sketch = sketch << 4 | (least.get(nibble, 0) * 0x9E3779B1 >> 24 & 15)
        return {"n": len(words), "terms": [t.decode("utf-8", "replace") for t in kept], "tfs": [counts[t] for t in kept], "sketch": sketch}

    found = per_value(read, "struct<n: bigint, terms: array<string>, tfs: array<bigint>, sketch: bigint>", deterministic=False)(text_of(docs, text))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), found.alias("f")).select("doc", "f.*").where("n > 0")
    rows = staged(rows, "terms")  # read twice by the range cuts
    return staged(rows.repartitionByRange("sketch", "doc").sortWithinPartitions("sketch", "doc"), "clustered")


@dataclass
class Queries:
    """A block of queries as arrays: items' terms, and each term's items, one after the other."""

    items: list
    terms: list
    weight: Any
    df: Any
    of_item: Any  # term numbers, item after item
    item_starts: Any
    n: int = 0
    total: int = 0
    opened: Any = None  # whether a place of of_item is a list that is opened
    probes: Any = None
    left: Any = None
    tuning: dict = field(default_factory=dict)

    def by_term(self, chosen):
        """For each term the items where ``chosen`` holds: starts and items."""
        import numpy as np

        owner = np.repeat(np.arange(len(self.items)), np.diff(self.item_starts))[chosen]
        term = self.of_item[chosen]
        order = np.argsort(term, kind="stable")
        return np.searchsorted(term[order], np.arange(len(self.terms) + 1)), owner[order]


def _expand(starts, ends):
    """Which range each place belongs to, and the places of all ranges one after the other."""
    import numpy as np

    sizes = ends - starts
    which = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return which, np.arange(len(which)) - first[which] + starts[which]


def _slices(sizes, limit):
    """Ranges of places whose sizes add up to about ``limit``."""
    import numpy as np

    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield at, until
        at = until


class _Postings:
    """The postings of some documents: sorted by document and term, with impacts."""

    def __init__(self, batch, queries: Queries, value_set):
        import numpy as np
        import pyarrow.compute as pc

        terms, tfs = batch.column("terms"), batch.column("tfs")
        self.docs = batch.column("doc").to_numpy()
        self.sketch = batch.column("sketch").to_numpy()
        sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
        number = pc.fill_null(pc.index_in(terms.flatten(), value_set=value_set), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.repeat(np.arange(len(self.docs)), sizes)
        tf = tfs.flatten().to_numpy(zero_copy_only=False)
        m = 10 + 90 * batch.column("n").to_numpy() * queries.n // queries.total
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[at])
        held = number >= 0
        self.width = len(queries.terms)
        key = at[held] * self.width + number[held]
        order = np.argsort(key)
        self.key, self.impact = key[order], impact[held][order]
        self.at, self.term = np.divmod(self.key, self.width)

    def impacts(self, at, term):
        import numpy as np

        key = at * self.width + term
        place = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        return np.where(self.key[place] == key, self.impact[place], 0) if len(self.key) else np.zeros(len(key), np.int64)

    def scores(self, queries: Queries, at, item):
        """Exact scores of (document, item) pairs."""
        import numpy as np

        out = np.zeros(len(at), np.int64)
        starts, ends = queries.item_starts[item], queries.item_starts[item + 1]
        for lo, hi in _slices(ends - starts, POSTINGS):
            which, place = _expand(starts[lo:hi], ends[lo:hi])
            term = queries.of_item[place]
            parts = queries.weight[term] * self.impacts(at[lo:hi][which], term)
            sums = np.concatenate(([0], np.cumsum(parts)))
            stops = np.cumsum(ends[lo:hi] - starts[lo:hi])
            out[lo:hi] = sums[stops] - sums[stops - (ends[lo:hi] - starts[lo:hi])]
        return out

    def block(self, queries: Queries, at, term):
        """The block of a posting: leading bits of the document's sketch, more for longer lists."""
        import numpy as np

        bits = np.clip(np.ceil(np.log2(np.maximum(queries.df[term], 1) / queries.tuning["block"])), 0, 4 * NIBBLES).astype(np.int64)
        return self.sketch[at] >> (4 * NIBBLES - bits)


def _read(batches: Iterator, queries: Queries) -> Iterator[_Postings]:
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    value_set = pa.array(queries.terms, pa.string())
    for batch in batches:
        sizes = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in _slices(sizes, POSTINGS):
            yield _Postings(batch.slice(lo, hi - lo), queries, value_set)


def _best(item, score, doc, k=K):
    """The k best of each item, ties by document."""
    import numpy as np

    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return item[place < k], score[place < k], doc[place < k]


def _rows(kind, a, b, c, d):
    import numpy as np
    import pyarrow as pa

    columns = [np.full(len(a), kind, np.int64), a, b, c, d]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["kind", "a", "b", "c", "d"])


_ROWS = "kind bigint, a bigint, b bigint, c bigint, d bigint"


def _pairs(p: _Postings, queries: Queries, chosen):
    """Postings of chosen lists with the items that chose them: (place of the posting, item)."""
    import numpy as np

    starts, items = queries.by_term(chosen)
    which, place = _expand(starts[p.term], starts[p.term + 1])
    return which, items[place] if len(items) else np.zeros(0, np.int64)


def _first_pass(queries: Queries):
    """Greatest impact of each term (kind 0), and full scores of each item's likely best documents (kind 1)."""
    def run(batches):
        import numpy as np

        most = np.zeros(len(queries.terms), np.int64)
        best = tuple(np.zeros(0, np.int64) for _ in range(3))
        for p in _read(batches, queries):
            np.maximum.at(most, p.term, p.impact)
            which, item = _pairs(p, queries, queries.probes)
            pair, inverse = np.unique(p.at[which] * len(queries.items) + item, return_inverse=True)
            part = np.bincount(inverse, queries.weight[p.term[which]] * p.impact[which], len(pair)).astype(np.int64)
            at, item = np.divmod(pair, len(queries.items))
            item, _, at = _best(item, part, at)
            best = _best(*(np.concatenate(x) for x in zip(best, (item, p.scores(queries, at, item), p.docs[at]))))
        some = np.flatnonzero(most)
        yield _rows(0, some, most[some], some, some)
        yield _rows(1, best[0], best[1], best[2], best[2])
    return run


def _summary_pass(queries: Queries):
    """Partial maxima (term, block, coordinate, impact) of the lists that are opened."""
    def run(batches):
        import numpy as np

        held, size = [], 0

        def folded():
            term, block, other, impact = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((other, block, term))
            term, block, other, impact = term[order], block[order], other[order], impact[order]
            new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1]) | (other[1:] != other[:-1]))))
            return term[new], block[new], other[new], np.maximum.reduceat(impact, new)

        for p in _read(batches, queries):
            which, item = _pairs(p, queries, queries.opened)
            sizes = queries.item_starts[item + 1] - queries.item_starts[item]
            for lo, hi in _slices(sizes, POSTINGS):
                part, place = _expand(queries.item_starts[item[lo:hi]], queries.item_starts[item[lo:hi] + 1])
                posting = which[lo:hi][part]
                other = queries.of_item[place]
                impact = p.impacts(p.at[posting], other)
                some = impact > 0
                posting, other, impact = posting[some], other[some], impact[some]
                held.append((p.term[posting], p.block(queries, p.at[posting], p.term[posting]), other, impact))
                held = [folded()]
                if len(held[0][0]) > 2 * POSTINGS:
                    yield _rows(0, *held[0])
                    held = []
        if held:
            yield _rows(0, *held[0])
    return run


def _place(item, term, block):
    """Where a block of a query's list stands in the bitmap; the same sums as columns and as arrays."""
    return (((item * 131_072 + term) % 1_000_003) * 2_654_435 + block * 40_503) % _PLACE


def _score_pass(queries: Queries):
    """The best documents of each item in this task's part: (item, score, document)."""
    def run(batches):
        import numpy as np

        best = tuple(np.zeros(0, np.int64) for _ in range(3))
        for p in _read(batches, queries):
            which, item = _pairs(p, queries, queries.opened)
            term = p.term[which]
            place = _place(item, term, p.block(queries, p.at[which], term))
            left = (queries.left[place >> 6] >> (place & 63)) & 1 == 1
            at, item = np.divmod(np.unique(p.at[which[left]] * len(queries.items) + item[left]), len(queries.items))
            score = p.scores(queries, at, item)
            some = score > 0
            best = _best(*(np.concatenate(x) for x in zip(best, (item[some], score[some], p.docs[at[some]]))))
        yield _rows(0, best[0], best[1], best[2], best[2])
    return run


def _block_of(items: DataFrame, terms: int) -> DataFrame:
    """``(item_id, term, part)``: parts of at most about QUERY_TERMS terms, or one item."""
    sizes = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    dealt = sizes.withColumn("deal", F.pmod(F.xxhash64("item_id"), F.lit(total // terms + 1)))
    so_far = F.sum("size").over(Window.partitionBy("deal").orderBy("item_id").rowsBetween(Window.unboundedPreceding, 0))
    part = F.struct("deal", F.expr("cast((so_far - size) div {} AS bigint)".format(terms)).alias("step"))
    dealt = dealt.withColumn("so_far", so_far).select(F.col("item_id").alias("item"), part.alias("part"))
    return items.join(dealt, F.col("item_id").eqNullSafe(F.col("item"))).drop("item")


def _queries(rows, tuning: dict) -> Queries:
    """Arrays of a block of queries from its rows (item_id, term, weight, df)."""
    import numpy as np

    rows = sorted(rows, key=lambda r: (r["item_id"] is not None, r["item_id"], -r["weight"], r["term"]) if r["item_id"] is not None else (False, 0, -r["weight"], r["term"]))
    numbers: dict[str, int] = {}
    weight, df, of_item, starts, items = [], [], [], [0], []
    for r in rows:
        if r["term"] not in numbers:
            numbers[r["term"]] = len(numbers)
            weight.append(r["weight"])
            df.append(r["df"])
        if not items or items[-1] != r["item_id"]:
            items.append(r["item_id"])
            starts.append(starts[-1])
        of_item.append(numbers[r["term"]])
        starts[-1] += 1
    out = Queries(items, list(numbers), np.array(weight, np.int64), np.array(df, np.int64), np.array(of_item, np.int64), np.array(starts, np.int64), tuning=tuning)
    # terms stand by falling weight within an item
    out.probes = np.arange(len(of_item)) - np.repeat(out.item_starts[:-1], np.diff(out.item_starts)) < PROBES
    return out


def _answer(rows: DataFrame, queries: Queries, k: int) -> tuple[DataFrame, dict]:
    import numpy as np

    spark = rows.sparkSession
    first = staged(rows.mapInArrow(_first_pass(queries), _ROWS), "search_first")
    most = np.zeros(len(queries.terms), np.int64)
    for r in first.where("kind = 0").groupBy("a").agg(F.max("b").alias("b")).collect():  # one row per term of the block
        most[r["a"]] = r["b"]
    tenth = np.zeros(len(queries.items), np.int64)
    order = Window.partitionBy("a").orderBy(F.desc("b"), "c")
    for r in first.where("kind = 1").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).where(F.col("place") == k).collect():
        tenth[r["a"]] = r["b"]

    # Lists are left closed, least impact first, while together they stay below the tenth place.
    owner = np.repeat(np.arange(len(queries.items)), np.diff(queries.item_starts))
    reach = (queries.weight * most)[queries.of_item]
    order = np.lexsort((reach, owner))
    sums = np.cumsum(reach[order])
    before = np.concatenate(([0], sums))[queries.item_starts[:-1]]
    queries.opened = np.zeros(len(owner), bool)
    queries.opened[order] = sums - before[owner[order]] >= tenth[owner[order]]

    opened = np.flatnonzero(queries.opened)
    lists = spark.createDataFrame(list(zip(queries.of_item[opened].tolist(), owner[opened].tolist(), tenth[owner[opened]].tolist())) or [(-1, -1, 0)],
                                  "term bigint, item bigint, tenth bigint")
    coordinates = spark.createDataFrame(list(zip(owner.tolist(), queries.of_item.tolist(), queries.weight[queries.of_item].tolist())), "item bigint, other bigint, weight bigint")
    summaries = rows.mapInArrow(_summary_pass(queries), _ROWS).groupBy(F.col("a").alias("term"), F.col("b").alias("block"), F.col("c").alias("other")).agg(
        F.max("d").alias("impact"))
    bounds = summaries.join(F.broadcast(lists), "term").join(F.broadcast(coordinates), ["item", "other"]).groupBy("item", "term", "block").agg(
        F.sum(F.col("weight") * F.col("impact")).alias("bound"), F.first("tenth").alias("tenth"))
    bounds = staged(bounds.select("item", "term", "block", (F.col("bound") >= F.col("tenth")).alias("left")), "search_bounds")
    queries.left = _bitmap(bounds.where("left"), _place(F.col("item"), F.col("term"), F.col("block")), BLOCK_BITS)
    figures = bounds.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum(F.col("left").cast("long")), F.lit(0)).alias("left")).first().asDict()
    figures |= {"lists": len(owner), "opened": int(len(opened))}

    scored = rows.mapInArrow(_score_pass(queries), _ROWS).select(F.col("a").alias("item"), F.col("b").alias("score"), F.col("c").alias("doc"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc"))).where(F.col("rank") <= k)
    return ranked, figures


def search(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", k: int = K, block: int = BLOCK,
           query_terms: int = QUERY_TERMS, report: list | None = None) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's k best documents with a score above 0.

    Null or empty texts hold no terms: such documents count nowhere, such items get no rows. Rows with
    one item_id are one item with the terms of all; a null item_id is an item too. Every row of
    ``docs`` is a document, so repeated rows are found as often; a null doc_id comes before all others
    among equal scores. Other columns are not read. ``report`` gets, for each block of queries, how many
    lists were opened and blocks left. An item's own terms are held by a task whole.
    """
    spark = docs.sparkSession
    wanted = staged(_block_of(_item_terms(items, item_text), query_terms), "queries")
    vocabulary = wanted.select("term").distinct()
    rows = clustered(docs, vocabulary, text)
    n, total = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    rows = rows.where(F.size("terms") > 0)
    df = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2 * (n or 0) + 2) / (2 * F.col("df") + 1)))
    weighed = staged(wanted.join(df, "term").select("part", "item_id", "term", "df", weight.alias("weight")), "weights")
    out = []
    id_type = items.schema["item_id"].dataType.simpleString()
    for (part,) in weighed.select("part").distinct().collect():  # one row per block of queries
        queries = _queries(weighed.where((F.col("part.deal") == part["deal"]) & (F.col("part.step") == part["step"])).collect(), {"block": block})
        queries.n, queries.total = n, total
        ranked, figures = _answer(rows, queries, k)
        names = spark.createDataFrame(list(enumerate(queries.items)), f"item bigint, item_id {id_type}")
        out.append(staged(ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "score"), "found"))
        if report is not None:
            report.append(figures)
    if not out:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
