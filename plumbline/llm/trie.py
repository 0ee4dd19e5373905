"""The trie of conversation prefixes, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Its key is a pair of 64-bit sums over hashed
(position, turn), so all keys of a conversation come from one running sum, and its members are
counted by a grouped sum that is combined before the shuffle.

Totals go from the leaves to the root as in external-memory graph algorithms: nodes are sorted by
reverse level order (Spark's sort, which spills), every node takes what its children sent from a
priority queue and sends its own totals to its parent, which comes later in the order. The queue
spills sorted runs beyond ``QUEUE`` messages.

Shards: the nodes with at most ``SHARD`` members whose parents have more are the roots of the first
round's shards; a shard holds at most ``SHARD`` nodes of a depth. The totals of its root are passed
on, summed per parent, to the second round, where the nodes with up to ``SHARD ** 2`` members form
shards of their own, and so on up to the root of all. No round gathers more than that in a task,
however many conversations begin alike.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.sources.staging import staged

SHARD = 512  # members a shard's root has at most, and nodes a shard has of one depth
QUEUE = 100_000  # messages held in memory
SALTS = 32
PIECE = 4096  # neighbouring conversation ids in a piece of a node's list


class SpillingQueue:
    """Least first. Beyond ``limit`` messages in memory, a sorted run goes to an unnamed file of the task."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            import tempfile

            run = tempfile.TemporaryFile()
            for held in sorted(self.heap):
                pickle.dump(held, run)
            run.seek(0)
            self.heap, self.runs = [], [*self.runs, run]
            self._advance(len(self.runs) - 1)

    def _advance(self, i: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(self.runs[i]), i))
        except EOFError:
            self.runs[i].close()

    def peek(self) -> tuple | None:
        tops = ([self.heap[0]] if self.heap else []) + ([self.heads[0][0]] if self.heads else [])
        return min(tops, default=None)

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] <= self.heap[0]):
            message, i = heapq.heappop(self.heads)
            self._advance(i)
            return message
        return heapq.heappop(self.heap)


def numbered(rows: DataFrame) -> DataFrame:
    """``(conv_id, pos, digest, bytes)``: turns in order, from 0, without their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    light = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return light.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame, every: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: ``(conv_id, depth, digest, bytes)`` and ``(conv_id, length)``."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
                         (F.crc32(F.col("conv_id").cast("string")) % modulus).alias("h"))
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = staged(convs.withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    own = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("head") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "bytes")
    lent = convs.select(F.col("conv_id").alias("taker"), F.col("base").alias("conv_id"), "h").where("h > 0")
    lent = turns.where(F.col("pos") < modulus).join(lent, "conv_id").where("pos < h")
    lent = lent.select(F.col("taker").alias("conv_id"), (F.col("pos") + 1).alias("depth"), "digest", "bytes")
    return own.unionByName(lent), convs.select("conv_id", "length")


def _paths(turns: DataFrame) -> DataFrame:
    """Every conversation's nodes: key (k1, k2) and the parent's key (p1, p2); the root's key is (0, 0)."""
    order = Window.partitionBy("conv_id").orderBy("depth")
    mixed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest"))

    def half(start: int) -> Column:
        part = F.conv(F.substring(mixed, start, 16), 16, 10).cast("decimal(20,0)")
        return F.sum(part).over(order.rowsBetween(Window.unboundedPreceding, 0))

    keys = turns.select("conv_id", "depth", "bytes", half(1).alias("a"), half(17).alias("b"))
    keys = keys.select("conv_id", "depth", "bytes", *[F.xxhash64(F.col(c), "depth").alias(k) for c, k in (("a", "k1"), ("b", "k2"))])
    return keys.select("*", *[F.lag(k, 1, 0).over(order).alias(p) for k, p in (("k1", "p1"), ("k2", "p2"))])


def _level(n: Column, shard: int, top: int) -> Column:
    out = F.lit(top)
    for level in range(top - 1, 0, -1):
        out = F.when(n <= shard ** level, level).otherwise(out)
    return out


def _salted(df: DataFrame, hot: Column, salts: int) -> DataFrame:
    """Hot rows once for each salt, the others with salt 0."""
    return df.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))


def _salt(key: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(salts)).cast("int")


_TOTALS = "n_children bigint, n_leaves bigint, saved_tokens bigint"


def _time_forward(nodes: DataFrame, queue: int) -> DataFrame:
    """Totals of all nodes of the shards (s1, s2); ``sent_*`` is what came from shards below."""
    out = f"k1 bigint, k2 bigint, {_TOTALS}"
    ordered = nodes.select("s1", "s2", F.col("depth").cast("long"), "k1", "k2", "p1", "p2", "saved", "sent_children", "sent_leaves", "sent_saved")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pending, shard = SpillingQueue(queue), None
        for batch in batches:
            rows, totals = zip(*[c.to_pylist() for c in batch.columns]), []
            for s1, s2, depth, k1, k2, p1, p2, saved, children, leaves, below in rows:
                if (s1, s2) != shard:
                    if pending.peek() is not None:
                        raise ValueError("a node's parent is not in its shard")
                    shard = (s1, s2)
                saved += below
                while (first := pending.peek()) is not None and first[:3] == (-depth, k1, k2):
                    message = pending.pop()
                    children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                leaves = leaves or 1
                totals.append((children, leaves, saved))
                if (k1, k2) != shard:
                    pending.push((1 - depth, p1, p2, leaves, saved))
            columns = [batch.column(3), batch.column(4), *[pa.array(c, pa.int64()) for c in zip(*totals)]]
            if totals:
                yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n_children", "n_leaves", "saved_tokens"])
        if pending.peek() is not None:
            raise ValueError("a node's parent is not in its shard")

    ordered = ordered.repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.desc("depth"), "k1", "k2")
    return ordered.mapInArrow(run, out)


def _ends(paths: DataFrame, convs: DataFrame, piece: int) -> DataFrame:
    """``(k1, k2, ends_sha256)`` of the nodes where conversations end: pieces of neighbouring ids, digested one after the other."""
    last = convs.where("length > 0").select("conv_id", F.col("length").alias("depth")).join(paths, ["conv_id", "depth"]).select("k1", "k2", "conv_id")
    none = convs.where("length = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv_id")
    pieces = last.unionByName(none).withColumn("piece", F.floor(F.col("conv_id") / piece)).groupBy("k1", "k2", "piece").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        def made(done):
            k1, k2, digests = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(digests, pa.string())], ["k1", "k2", "ends_sha256"])

        node, digest, done = None, None, []
        for batch in batches:
            for k1, k2, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if (k1, k2) == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (k1, k2), hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield made(done)
                done = []
        if node is not None:
            yield made([(*node, digest.hexdigest())])

    dealt = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece").select("k1", "k2", "ids")
    return dealt.mapInArrow(run, "k1 bigint, k2 bigint, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD, queue: int = QUEUE, piece: int = PIECE, salts: int = SALTS) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, depth (1, 2, ... without gaps), digest and bytes; ``convs`` has every
    conv_id once with its length. Without conversations there is no node, not even a root.
    """
    paths = staged(_paths(turns), "paths")
    n_all, least = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    top = 1
    while shard ** top < n_all:
        top += 1
    attributes = [F.max(c).alias(c) for c in ("depth", "bytes", "p1", "p2")]
    nodes = paths.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), *attributes)
    nodes = staged(nodes.withColumn("level", _level(F.col("n_convs"), shard, top)), "nodes")
    # Nodes with more members than a shard's root are few; every conversation finds its own, and the first below each round's limit.
    crown = _salted(nodes.where("level > 1").select("k1", "k2", "level"), F.lit(True), salts)
    along = paths.withColumn("salt", _salt("conv_id", salts)).join(crown, ["k1", "k2", "salt"], "left")
    along = along.withColumn("level", F.coalesce("level", F.lit(1)))
    firsts = [F.min_by(F.when(F.col("level") <= level, F.col(k)), F.when(F.col("level") <= level, F.col("depth"))).alias(f"{k}_{level}")
              for level in range(1, top) for k in ("k1", "k2")]
    firsts += [F.min(F.when(F.col("level") == 1, F.col("depth"))).alias("own")]
    nodes = nodes.join(along.groupBy("conv_id").agg(*firsts), "conv_id")

    def of_shard(k):
        out = F.lit(0).cast("long")
        for level in range(1, top):
            out = F.when(F.col("level") == level, F.col(f"{k}_{level}")).otherwise(out)
        return out

    nodes = nodes.select("k1", "k2", "p1", "p2", "conv_id", "depth", "n_convs", "level", of_shard("k1").alias("s1"), of_shard("k2").alias("s2"),
                         ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                         (F.lit(top > 1) & (F.col("depth") <= F.coalesce("own", F.lit(1 << 62)))).alias("under_crown"))
    spark = paths.sparkSession
    zero = F.lit(0).cast("long")
    root = spark.range(1 if n_all else 0).select(
        zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(least).cast("long").alias("conv_id"),
        zero.alias("depth"), F.lit(n_all).cast("long").alias("n_convs"), F.lit(top).alias("level"), zero.alias("s1"), zero.alias("s2"), zero.alias("saved"),
        F.lit(False).alias("under_crown"))
    nodes = staged(nodes.unionByName(root), "trie_nodes")

    totals = None
    for level in range(1, top + 1):
        here = nodes.where(F.col("level") == level)
        if totals is None:
            here = here.withColumns({f"sent_{c}": zero for c in ("children", "leaves", "saved")})
        else:  # what the roots of the shards below have sent, summed per parent
            sent = nodes.where((F.col("level") < level) & (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2"))).join(totals, ["k1", "k2"])
            sent = sent.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
                F.count(F.lit(1)).alias("sent_children"), F.sum("n_leaves").alias("sent_leaves"), F.sum("saved_tokens").alias("sent_saved"))
            here = here.join(sent, ["k1", "k2"], "left").fillna(0, [f"sent_{c}" for c in ("children", "leaves", "saved")])
        done = staged(_time_forward(here, queue), f"totals_{level}")
        totals = done if totals is None else totals.unionByName(done)

    parents = _salted(nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "level"), F.col("level") > 1, salts)
    named = nodes.withColumn("salt", F.when(F.col("under_crown"), _salt("k1", salts)).otherwise(0)).join(parents.drop("level"), ["p1", "p2", "salt"], "left")
    every = named.join(totals, ["k1", "k2"]).join(_ends(paths, convs, piece), ["k1", "k2"], "left")
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(rows: DataFrame, **options) -> DataFrame:
    """The trie of ``conversations`` rebuilt so that neighbours share their first turns.

    Turns are ordered by turn (null first), equal turns by a digest of role and text, so the order of
    rows means nothing. A null role or text is empty. Rows without a conv_id belong to no conversation
    and give nothing. Repeated rows are turns of their own. Other columns are not read.
    """
    turns, convs = rebuilt(staged(numbered(rows), "turns"))
    return trie(turns, convs, **options)
