"""SimHash near-duplicates by covering locality-sensitive hashing.

Every fingerprint is hashed under structured bit masks. Each bit position has a nonzero vector of
``RADIUS + 1`` bits, and each nonzero vector ``v`` gives the mask of the positions whose vector has
an odd product with it. The vectors of up to ``RADIUS`` differing positions never span the space,
so some ``v`` has an even product with all of them: that mask skips every differing bit and the
pair meets in that table. No pair within the radius is missed, by construction.

A bucket with more than ``BUCKET`` fingerprints is hashed again, by masks over the bits its own
mask skips; the same argument holds, and after three levels a bucket has few free bits left. What
remains is small enough to be linked exactly in one task, which returns a spanning forest and
never all pairs.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import LOWER, fresh, per_value, text_of
from plumbline.llm.components import components
from plumbline.sources.staging import staged

BITS, RADIUS, WORDS, SEED = 64, 3, 3, 42
BUCKET = 1024
LEVELS = 3


def fingerprint(text: str) -> int:
    """Majority of each bit over the XXH64 of all word shingles; no words give zero."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    if len(words) < WORDS:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - WORDS + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[WORDS - 1:].tolist())]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bits of a bounded block
        block = np.array(hashes[at:at + (1 << 16)], np.uint64)
        ones += np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    value = int("".join("1" if 2 * n > len(hashes) else "0" for n in ones.tolist()), 2)
    return value - (1 << 64) if value >> 63 else value


def covering_masks(positions: list[int], seed: int) -> list[int]:
    """Masks over ``positions``: two values that differ in up to RADIUS of them agree under one mask."""
    vectors = 1 << (RADIUS + 1)
    order = positions[:]
    random.Random(seed).shuffle(order)
    own = {p: 1 + i % (vectors - 1) for i, p in enumerate(order)}
    return [sum(1 << p for p in positions if bin(own[p] & v).count("1") & 1) for v in range(1, vectors)]


def mask_paths(levels: int = LEVELS) -> list[list[tuple[int, int, int]]]:
    """Per level the (path, parent path, mask of all levels so far)."""
    out, above = [], [(0, 0)]
    for level in range(levels):
        here = []
        for path, mask in above:
            free = [p for p in range(BITS) if not mask >> p & 1]
            here += [(path * 16 + i + 1, path, mask | m) for i, m in enumerate(covering_masks(free, level))]
        out.append(here)
        above = [(path, mask) for path, _, mask in here]
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(values) -> list[tuple[int, int]]:
    """Spanning edges of the values (distinct) within RADIUS bits of each other."""
    import numpy as np

    values, edges = np.asarray(values, np.int64), []
    bits = values.view(np.uint64)  # the count of a signed number is that of its absolute value
    left = np.arange(len(values))
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(bits[left] ^ bits[at]) <= RADIUS
            if near.any():
                found = left[near]
                edges += [(int(values[at]), int(values[i])) for i in found]
                reached += found.tolist()
                left = left[~near]
    return edges


def link_sorted(batches: Iterator) -> Iterator:
    """Edges from Arrow batches sorted by path and key; holds one bucket at a time."""
    import numpy as np
    import pyarrow as pa

    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    kept = None
    for batch in batches:
        part = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        kept = part if kept is None else np.concatenate((kept, part), axis=1)
        cuts = np.flatnonzero((kept[:2, 1:] != kept[:2, :-1]).any(axis=0)) + 1
        if len(cuts):
            yield _edges(kept[:, :cuts[-1]], cuts[:-1], kind)
            kept = kept[:, cuts[-1]:]
    if kept is not None and kept.shape[1]:
        yield _edges(kept, np.flatnonzero((kept[:2, 1:] != kept[:2, :-1]).any(axis=0)) + 1, kind)


def _edges(rows, cuts, kind):
    import numpy as np
    import pyarrow as pa

    starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [rows.shape[1]]))
    sizes, values = ends - starts, rows[2]
    pairs = starts[sizes == 2]  # the usual bucket
    near = pairs[np.bitwise_count((values[pairs] ^ values[pairs + 1]).view(np.uint64)) <= RADIUS]
    a, b = [values[near]], [values[near + 1]]
    for s, e in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
        if found := forest(values[s:e]):
            x, y = zip(*found)
            a.append(np.array(x, np.int64))
            b.append(np.array(y, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=kind)


def links(values: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct ``fp`` of ``values`` within RADIUS bits."""
    spark, out = values.sparkSession, None
    todo = values.select("fp").withColumn("path", F.lit(0).cast("long"))
    levels = mask_paths()
    for level, paths in enumerate(levels):
        if level:
            masks = spark.createDataFrame([(p, up, _signed(m)) for p, up, m in paths], "next long, path long, mask long")
            tagged = todo.join(F.broadcast(masks), "path").select(F.col("next").alias("path"), F.expr("fp & mask").alias("key"), "fp")
        else:
            keys = [F.struct(F.lit(p).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for p, _, m in paths]
            tagged = todo.select("fp", F.explode(F.array(*keys)).alias("t")).select("t.path", "t.key", "fp")
        counts = staged(tagged.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
        last = level == len(levels) - 1
        small = tagged.join(counts if last else counts.where(F.col("n") <= bucket), ["path", "key"]).select("path", "key", "fp")
        found = small.repartition("path", "key").sortWithinPartitions("path", "key").mapInArrow(link_sorted, "a long, b long")
        out = found if out is None else out.union(found)
        large = counts.where(F.col("n") > bucket)
        if last or large.isEmpty():
            return out
        todo = staged(tagged.join(large, ["path", "key"]).select("fp", "path"), "dense")
    return out


def classes(marked: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(fp, root, rep)`` of every fingerprint of ``marked(doc_id, fp)``: its component and the component's least doc_id."""
    values = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(values, bucket))
    member = values.join(roots, values["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    member = staged(member, "members")
    least = member.groupBy("root").agg(F.min("least").alias("rep"))
    return member.join(least, "root").select("fp", "root", "rep")


def _fingerprints(df: DataFrame, text: str):
    return per_value(fingerprint, "bigint")(text_of(df, text))


def near_duplicates(docs: DataFrame, text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Null text counts as empty; texts without words have fingerprint zero and are linked like any
    other. Repeated rows stay, each with its own result row. A null doc_id is never the least of a
    component unless all are null. An empty table gives no rows. Other columns are not read.
    """
    marked = staged(docs.select("doc_id", _fingerprints(docs, text).alias("fp")), "marked")
    joined = marked.join(classes(marked, bucket), "fp")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("rep").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, with all its columns.

    Rows that share that doc_id and fingerprint are repeats; one of them stays. A component whose
    doc_ids are all null keeps one row.
    """
    fp = fresh(docs, "fp")
    marked = staged(docs.withColumn(fp, _fingerprints(docs, text)), "marked")
    keys = marked.select("doc_id", F.col(fp).alias("fp"))
    chosen = keys.join(classes(keys, bucket), "fp").where(F.col("doc_id").eqNullSafe(F.col("rep")))
    chosen = chosen.groupBy("root").agg(F.min("fp").alias("first"), F.count("*").alias("rows"), F.first("rep").alias("id"))
    chosen = staged(chosen, "chosen")

    def of(which):
        same = marked["doc_id"].eqNullSafe(chosen["id"]) & (marked[fp] == chosen["first"])
        return marked.join(chosen.where(which), same, "left_semi")

    repeated = of("rows > 1").dropDuplicates(["doc_id", fp])
    return of("rows = 1").unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
