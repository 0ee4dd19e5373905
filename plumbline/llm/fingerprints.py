"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

Every shingle of five words is hashed once. The top bits of its hash name one of ``BINS`` bins, and a
bin keeps its least hash: after one sort of a text's hashes these are the first of each run of equal
top bits. Empty bins borrow from occupied ones by optimal densification: bin b tries the bins that
its own random sequence names until one is occupied; two texts walk the same sequence, so they agree
in a borrowed bin as often as in an own one. After ``TRIES`` steps the sequence goes on through the
occupied bins in an order of its own, so it always ends.

Of each bin's hash the low ``bits`` bits are kept, packed as hex digits. Unrelated bins agree by
chance once in 2**bits, which the likeness takes off: ``(agreed / BINS - c) / (1 - c)``, at least 0.
"""

from __future__ import annotations

from collections.abc import Callable
import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import text_of
from plumbline.sources.staging import staged

WORDS = 5
BINS = 128  # a power of two
BITS = 8
TRIES = 8
ROWS = 2_000  # rows in a block of neighbouring documents
CUTS = 1_000
NO_ID = -(1 << 63)  # stands for a null doc_id, first in order

_WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often a nested function names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashes(text: Column, words: int) -> Column:
    """The hash of every shingle; fewer words than a shingle's are one shingle, none are none."""
    def shingles(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(words)]))
        return F.when(F.size(w) >= words, each).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)), lambda w: F.xxhash64(w)), shingles)


def _bin(value: Column, bins: int) -> Column:
    return F.shiftrightunsigned(value, 65 - bins.bit_length())


def _bin_minima(hashes: Column, bins: int) -> Column:
    """The least hash of every occupied bin, bin after bin."""
    def firsts(s: Column) -> Column:
        return F.filter(s, lambda v, i: (i == 0) | (_bin(v, bins) != _bin(F.get(s, i - 1), bins)))

    return _let(F.sort_array(hashes), firsts)


def _densified(minima: Column, bins: int) -> Column:
    """One hash per bin: the bin's own, else that of the first occupied bin in its sequence."""
    def fill(m: Column, held: Column) -> Column:
        def tried(b: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("bigint"),
                               lambda got, t: F.coalesce(got, held[_bin(F.xxhash64(b, t), bins)]))

        def ordered(b: Column) -> Column:
            marked = F.transform(m, lambda v, i: F.xxhash64(_bin(v, bins), b).bitwiseAND(F.lit(-bins)).bitwiseOR(i.cast("bigint")))
            return F.get(m, F.array_min(marked).bitwiseAND(F.lit(bins - 1)).cast("int"))

        every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")), lambda b: F.coalesce(held[b], tried(b), ordered(b)))
        return F.when(F.size(m) > 0, every).otherwise(F.array().cast("array<bigint>"))

    return _let(minima, lambda m: _let(F.map_from_arrays(F.transform(m, lambda v: _bin(v, bins)), m), lambda held: fill(m, held)))


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS, words: int = WORDS) -> Column:
    """``bins * bits / 4`` hex digits; the empty string for a text without words. ``bits`` is a multiple of 4."""
    if bins & (bins - 1) or bits % 4 or not 4 <= bits <= 32:
        raise ValueError("bins must be a power of two, bits a multiple of 4 up to 32")
    low = F.lit((1 << bits) - 1).cast("bigint")
    packed = F.transform(_densified(_bin_minima(_hashes(text, words), bins), bins), lambda v: F.lpad(F.lower(F.hex(v.bitwiseAND(low))), bits // 4, "0"))
    return F.array_join(packed, "")


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated share of common shingles, from two fingerprints; two empty ones are alike, an empty and another are not."""
    digits, chance = bits // 4, 2.0 ** -bits

    def part(x: Column, i: Column) -> Column:
        return F.substring(x, i * digits + 1, F.lit(digits))

    # bytes are found by their place, letters only by counting
    same = _let(F.struct(F.encode(a, "US-ASCII").alias("a"), F.encode(b, "US-ASCII").alias("b")),
                lambda s: F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: part(s["a"], i) == part(s["b"], i))))
    estimate = F.greatest(F.lit(0.0), (same / float(bins) - chance) / (1.0 - chance))
    return F.when(a == b, 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(estimate)


def _placed(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` with (bucket, sub): blocks of neighbouring (pos, digest), in that order.

    Buckets lie between approximate quantiles of ``pos``, at most CUTS of them; a bucket is cut evenly
    into blocks, and rows with the bucket's first ``pos``, which may be many, by their digests.
    """
    n = rows.count()
    wanted = max(1, math.ceil(n / block_rows))
    k = min(wanted, CUTS)
    cuts = rows.agg(F.percentile_approx("pos", [i / k for i in range(k)], 20 * CUTS)).first()[0] if n else None
    starts: dict[float, int] = {}
    for cut in cuts or [0]:
        starts[float(cut)] = starts.get(float(cut), 0) + 1
    splits = list(starts)
    subs = math.ceil(wanted / k)
    bucketed = rows.withColumn("place", F.col("pos").cast("double"))
    if len(splits) == 1:
        bucketed = bucketed.withColumn("bucket", F.lit(0))
    else:
        bucketed = Bucketizer(splits=[-math.inf, *splits[1:], math.inf], inputCol="place", outputCol="bucket", handleInvalid="error").transform(bucketed)
    at = F.col("bucket").cast("int")

    def of_bucket(values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), at)

    low, high = of_bucket(splits), of_bucket([*splits[1:], splits[-1]])
    heavy = of_bucket([subs * times for times in starts.values()])
    share = F.conv(F.substring("digest", 1, 12), 16, 10).cast("double") / float(1 << 48)
    # beyond the last cut there is no end to measure by: blocks double in width
    last = F.floor(F.log2(F.col("place") - low + 1))
    within = F.when(high > low, F.least(F.floor((F.col("place") - low) / (high - low) * subs), F.lit(subs - 1).cast("long"))).otherwise(last)
    sub = F.when(F.col("place") <= low, F.floor(share * heavy)).otherwise(heavy + within)
    return bucketed.withColumn("bucket", at).withColumn("sub", sub.cast("long")).drop("place")


def _heads(placed: DataFrame) -> DataFrame:
    """``(bucket, sub, pos, digest)``: for every block the first document of the block after it, the last block's being the first."""
    firsts = staged(placed.groupBy("bucket", "sub").agg(F.min(F.struct("pos", "digest")).alias("first")), "firsts")
    before = firsts.select("bucket", F.lag("sub").over(Window.partitionBy("bucket").orderBy("sub")).alias("sub"), "first")
    ends = firsts.groupBy("bucket").agg(F.max("sub").alias("last"), F.min(F.struct("sub", "first")).alias("head")).orderBy("bucket").collect()  # at most CUTS rows
    between = [(ends[i - 1]["bucket"], ends[i - 1]["last"], end["head"]["first"]["pos"], end["head"]["first"]["digest"]) for i, end in enumerate(ends)]
    between = placed.sparkSession.createDataFrame(between, "bucket int, sub bigint, pos bigint, digest string")
    return before.where("sub IS NOT NULL").select("bucket", "sub", "first.*").unionByName(between)


def with_next(docs: DataFrame, text: str = "text", block_rows: int = ROWS) -> DataFrame:
    """``(doc_id, text, fingerprint, next_text, next_fingerprint)`` by ascending doc_id; after the last comes the first.

    Texts are dealt out once, to blocks of neighbours; each block also gets the first document of the next.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("pos"), text_of(docs, text).alias("text"))
    placed = _placed(rows.withColumn("digest", F.md5("text")), block_rows)
    heads = staged(_heads(placed), "heads").withColumnsRenamed({"bucket": "to_bucket", "sub": "to_sub"})
    lent = placed.join(heads, ["pos", "digest"]).groupBy("to_bucket", "to_sub").agg(*[F.first(c).alias(c) for c in ("pos", "digest", "text")])
    lent = lent.select(F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"), "pos", "text", "digest",
                       F.col("to_bucket").alias("bucket"), F.col("to_sub").alias("sub"), F.lit(True).alias("lent"))
    every = placed.withColumn("lent", F.lit(False)).unionByName(lent).withColumn("fingerprint", fingerprint(F.col("text")))
    order = Window.partitionBy("bucket", "sub").orderBy("lent", "pos", "digest")
    every = every.select("doc_id", "text", "fingerprint", "lent", F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint"))
    return every.where("NOT lent").drop("lent")


def fingerprints(docs: DataFrame, text: str = "text", block_rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its second half, floor(n_chars / 2) code points, replaced by as many
    first ones of the next document. Null text counts as empty, and a text without words has the empty
    fingerprint. Documents with one doc_id follow each other by the digest of their texts, so repeated
    rows have each other as next but for the last; a null doc_id comes first. An empty table gives no
    rows. No other column is read. Copies of one row with the same doc_id stay in one block, which
    sorts and spills.
    """
    rows = with_next(docs, text, block_rows).withColumn("n_chars", F.length("text"))
    half = F.expr("n_chars div 2").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
