"""A random forest of deep trees, grown on all training rows, a share of the trees per task.

A row is a byte per feature: its place among at most ``BINS - 1`` thresholds between neighbouring
distinct values, at even ranks where there are more. The thresholds come from the counts of all
values, in range partitions. Rows are ordered by key once, so a tree is the same on any cluster. A
task takes the rows of one fit as bytes in a file it maps, some 12 bytes a row beside it, draws its
trees' bootstraps from the tree's number and grows each level by level: counts by class over
(node, bin), or over sorted rows where nodes are small, for each drawn feature. It scores the rows
to score with each tree as it is grown and gives up sums, so that trees, which grow with the table,
leave no task. ``fit_rows`` bounds the rows a fit sees, by ticket; by default it is None, all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
import math
import os
import tempfile

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.functions.draws import key_of, ticket, with_key
from plumbline.operators import stats
from plumbline.operators.logistic import matrix
from plumbline.sources.staging import staged

PLACE = "_place"  # the column that numbers the rows
TASKS = 3  # tasks a core: each takes all rows of a fit
BINS = 256
DEEPEST = 30
LEAF = 0xFFFF  # the place of a node without a threshold
CHUNK = 131_072  # rows whose nodes are split together: a node's number among them, a bin and a mark are 32 bits
DRAWN = 1_048_576  # rows of a bootstrap drawn at once
BLOCK = 8_192  # rows walked at once: their bins and places stay in a core's cache
BITS, MANY = 131_072, 4_096  # rows whose answers to a test are kept as bits; fewer than MANY are walked
MIXED = 64  # leaves of both classes that a tree may have to be scored in bits
FORMULA = 65_536  # nodes of a tree that may be scored in bits
HELD = 1 << 20  # nodes grown before rows are scored with them


def bin_edges(values, bins: int = BINS):
    """Thresholds between neighbouring distinct values, ``bins - 1`` at most."""
    import numpy as np

    distinct = np.unique(values)
    if len(distinct) > bins:
        places = np.unique(np.searchsorted(distinct, np.sort(values)[(np.arange(1, bins) * len(values)) // bins]))
        places = places[places > 0]
    else:
        places = np.arange(1, len(distinct))
    return (distinct[places - 1] + distinct[places]) / 2


def grow(binned, label, weight, edges, tree: int, seed: int, max_depth: int = DEEPEST, features: int | None = None) -> dict:
    """One tree of rows in memory; ``weight`` is the same for all rows of a class."""
    import numpy as np

    label = np.asarray(label).astype(np.uint8)
    made = grow_tree(np.ascontiguousarray(binned, np.uint8), np.arange(len(label), dtype=np.uint32), label,
                     [weight[label == v].max(initial=0.0) for v in (0, 1)], tree, seed, max_depth, features)
    made["threshold"] = np.array([edges[f][p] if f >= 0 else 0.0 for f, p in zip(made["feature"], made.pop("place"))])
    return made


def grow_tree(binned, train, label, weights, tree: int, seed: int, max_depth: int = DEEPEST, features: int | None = None) -> dict:
    """One tree by Gini gain on a bootstrap of the rows ``binned[train]``; ``value`` is the weighted share of class 1.

    A level's rows lie node by node, and nodes are split ``CHUNK`` rows at a time. A row is its place and a mark of
    its class and how often it was drawn, 15 times at most, more often as several rows; sums are counts by class, so
    they are exact in any order.
    """
    import numpy as np

    d = binned.shape[1]
    rng = np.random.default_rng([seed, tree])
    times = np.zeros(len(train), np.uint8)
    for start in range(0, len(train), DRAWN):
        np.add.at(times, rng.integers(0, len(train), min(DRAWN, len(train) - start)), np.uint8(1))
    drawn = np.flatnonzero(times)
    rows, mark = train[drawn], label[drawn] << 4 | np.minimum(times[drawn], 15)
    while times.max(initial=0) > 15:
        times = np.where(times > 15, times - 15, 0).astype(np.uint8)
        drawn = np.flatnonzero(times)
        rows, mark = np.append(rows, train[drawn]), np.append(mark, label[drawn] << 4 | np.minimum(times[drawn], 15))
    del times, drawn
    tried = features or max(1, int(math.sqrt(d)))
    sizes, counts = np.array([len(rows)]), _counts(mark)[None, :]
    feature, place, left, value = [], [], [], []
    base = 1
    for level in range(max_depth + 1):
        k = len(sizes)
        feature.append(np.full(k, -1, np.int32))
        place.append(np.zeros(k, np.int32))
        left.append(np.full(k, -1, np.int32))
        weighted = counts * weights
        value.append(weighted[:, 1] / (weighted[:, 0] + weighted[:, 1]))
        if level == max_depth:
            break
        ends = np.cumsum(sizes)
        first, put, next_sizes, next_counts = 0, 0, [], []
        while first < k:
            begin = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
            nodes, span = slice(first, last), slice(int(begin), int(ends[last - 1]))
            order = rng.random((last - first, d))
            chosen, at = _best(binned, rows[span], mark[span], sizes[nodes], counts[nodes], weights, order, tried)
            feature[-1][nodes], place[-1][nodes] = chosen, at
            split = chosen >= 0
            left[-1][nodes][split] = base + 2 * np.arange(split.sum())
            base += 2 * int(split.sum())
            if split.any():
                kept, kept_mark, new_sizes, new_counts = _parted(binned, rows[span], mark[span], sizes[nodes], chosen, at)
                rows[put:put + len(kept)], mark[put:put + len(kept)] = kept, kept_mark  # never beyond the rows just read
                put += len(kept)
                next_sizes.append(new_sizes)
                next_counts.append(new_counts)
            first = last
        if not next_sizes:
            break
        rows, mark = rows[:put], mark[:put]
        sizes, counts = np.concatenate(next_sizes), np.concatenate(next_counts)
    return {"feature": np.concatenate(feature), "place": np.concatenate(place), "left": np.concatenate(left), "value": np.concatenate(value)}


def _counts(mark):
    """How often rows of class 0 and of class 1 were drawn."""
    import numpy as np

    return np.array([(mark[mark < 16]).sum(dtype=np.int64), (mark[mark >= 16] & 15).sum(dtype=np.int64)])


def _first(values):
    """Which of some ordered values begin a run of equal ones."""
    import numpy as np

    out = np.empty(len(values), bool)
    out[:1] = True
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return np.flatnonzero(out)


def _best(binned, rows, mark, sizes, counts, weights, order, tried: int):
    """The feature and place that split each of some neighbouring nodes best, -1 for none."""
    import numpy as np

    k, d = order.shape
    best, place, chosen = np.zeros(k), np.zeros(k, np.int32), np.full(k, -1, np.int32)
    found = np.zeros(k, np.int64)  # features with a split that were looked at, as many as asked for
    open_nodes = np.flatnonzero((counts > 0).all(axis=1))
    drawn = np.argsort(order[open_nodes], axis=1)
    whole = len(rows) > CHUNK  # one node
    cells = None if whole else binned.take(rows, axis=0).ravel()
    looked = None
    for turn in range(d):
        if turn:
            more = found[open_nodes] < tried
            if not more.all():
                open_nodes, drawn, looked = open_nodes[more], drawn[more], None
        if not len(open_nodes):
            break
        f, n = drawn[:, turn], len(open_nodes)
        if whole:
            sums = np.zeros(512)
            for i in range(0, len(rows), CHUNK):
                own = mark[i:i + CHUNK]
                sums += np.bincount((binned[rows[i:i + CHUNK], f[0]].astype(np.uint16) << 1) | (own >> 4), own & 15, 512)
            cell, ones, every = _filled(sums)
        else:
            if looked is None:
                own = sizes[open_nodes]
                if n == k:
                    looked, marks = np.arange(len(rows)), mark
                else:
                    begin = (np.cumsum(sizes) - sizes)[open_nodes]
                    looked = np.arange(own.sum()) + (begin - (np.cumsum(own) - own)).repeat(own)
                    marks = mark[looked]
                looked *= d
                dense = n * 512 <= 4 * len(looked)
                number = np.arange(n, dtype=np.uint32).repeat(own)
                if dense:
                    key, times = number << 9 | marks >> 4, (marks & 15).astype(float)
                else:
                    key = number << 13 | marks
            bins = cells.take(looked + f.repeat(own)).astype(np.uint32)
            if dense:
                cell, ones, every = _filled(np.bincount(key | bins << 1, times, n * 512))
            else:
                cell, ones, every = _run_ends(key | bins << 5)
        # running counts up to each cell, within its node; a node's last cell splits nothing
        node = cell >> 8
        inner = np.flatnonzero(node[1:] == node[:-1])
        if not len(inner):
            continue
        node = node[inner]
        own_counts = counts[open_nodes]
        total, all1 = own_counts.sum(axis=1), own_counts[:, 1] * weights[1]
        all_ = own_counts[:, 0] * weights[0] + all1
        below1 = ones[inner] - (np.cumsum(own_counts[:, 1]) - own_counts[:, 1])[node]
        below = every[inner] - (np.cumsum(total) - total)[node] - below1
        below1 = below1 * weights[1]
        below = below * weights[0] + below1
        every_ = all_[node]
        above1, above = all1[node] - below1, every_ - below
        gain = below1 * below1 / below + above1 * above1 / above - (all1 * all1 / all_)[node]
        # rounded, so that equal gains are equal whatever the order of the sums
        gain = np.rint(gain / every_ * 1e9)
        start = _first(node)
        which, top = node[start], np.maximum.reduceat(gain, start)
        lengths = np.diff(start, append=len(node))
        hit = np.flatnonzero(gain == top.repeat(lengths))
        hit = hit[_first(node[hit])]
        some = open_nodes[which]
        found[some] += 1
        better = top > best[some]
        some = some[better]
        best[some], place[some], chosen[some] = top[better], cell[inner[hit[better]]] & 255, f[which[better]]
    return chosen, place


def _filled(sums):
    """The cells that hold rows and running counts (of class 1, of both) up to them, from a table of (node, bin, class)."""
    import numpy as np

    ones, every = sums[1::2], sums[0::2] + sums[1::2]
    cell = np.flatnonzero(every)
    return cell, np.cumsum(ones[cell]), np.cumsum(every[cell])


def _run_ends(key):
    """The same from rows as whole numbers of node, bin and mark."""
    import numpy as np

    key.sort()
    cell = key >> 5
    end = np.append(np.flatnonzero(cell[1:] != cell[:-1]), len(key) - 1)
    times = np.arange(32) % 16 << 32 | np.where(np.arange(32) >= 16, np.arange(32) % 16, 0)  # of both classes and of class 1
    counts = np.cumsum(times.take(key & 31))[end]
    return cell[end].astype(np.int64), counts & 0xFFFFFFFF, counts >> 32


def _parted(binned, rows, mark, sizes, chosen, at):
    """The rows of the nodes that were split, child by child, with the children's sizes and counts."""
    import numpy as np

    if len(rows) > CHUNK:  # one node
        above = np.concatenate([binned[rows[i:i + CHUNK], chosen[0]] > at[0] for i in range(0, len(rows), CHUNK)])
        parts = [~above, above]
        return (np.concatenate([rows[p] for p in parts]), np.concatenate([mark[p] for p in parts]),
                np.array([len(rows) - above.sum(), above.sum()]), np.stack([_counts(mark[p]) for p in parts]))
    split = chosen >= 0
    child = 2 * (np.cumsum(split) - 1)
    if not split.all():
        stay = split.repeat(sizes)
        rows, mark = rows[stay], mark[stay]
        chosen, at, child, sizes = chosen[split], at[split], child[split], sizes[split]
    above = binned[rows, chosen.repeat(sizes)] > at.repeat(sizes)
    child = child.repeat(sizes) + above
    order = child << 32 | np.arange(len(rows))
    order.sort()
    order &= 0xFFFFFFFF
    n = 2 * len(sizes)
    counts = np.bincount(child << 1 | mark >> 4, mark & 15, 2 * n).astype(np.int64).reshape(n, 2)
    return rows[order], mark[order], np.bincount(child, minlength=n), counts


@dataclass(frozen=True)
class Group:
    """Binned rows of one fit: a model of its own, grown beside the others."""

    binned: object
    label: object
    weight: object
    edges: list


def group(points, label, weight, bins: int = BINS) -> Group:
    import numpy as np

    edges = [bin_edges(points[:, j], bins) for j in range(points.shape[1])]
    binned = np.stack([np.searchsorted(e, points[:, j], "left") for j, e in enumerate(edges)], axis=1) if edges else np.zeros((len(points), 0))
    return Group(binned.astype(np.int16), label, weight, edges)


def placed(rows: DataFrame, key: str) -> DataFrame:
    """Rows in the order of their key, numbered; to be written before the numbers are used."""
    order = [F.col(key).asc_nulls_last(), *[F.col(c) for c in ("label", "features", "trains", "tests")]]
    return rows.orderBy(*order).withColumn(PLACE, F.monotonically_increasing_id())


def edges_of_all(rows: DataFrame, fits: int, width: int, bins: int = BINS) -> list[list]:
    """``bin_edges`` of every feature over the training rows of every fit, from counts per value.

    The counts are ordered in range partitions; running counts are taken within these, and the driver
    adds up the parts' totals."""
    import numpy as np

    sizes = F.array(*[F.count_if(F.col("trains")[i]) for i in range(fits)])
    counts = rows.select(F.posexplode("features").alias("feature", "value"), "trains").groupBy("feature", "value").agg(sizes.alias("sizes"))
    counts = counts.select("feature", "value", F.posexplode("sizes").alias("fit", "n")).where("n > 0")
    counts = staged(counts.orderBy("fit", "feature", "value").withColumn("part", F.spark_partition_id()), "values")
    parts = counts.groupBy("fit", "feature", "part").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.max("value").alias("last")).orderBy("fit", "feature", "part").collect()
    totals: dict = {}
    for r in parts:
        n, values = totals.get((r["fit"], r["feature"]), (0, 0))
        totals[r["fit"], r["feature"]] = n + r["n"], values + r["values"]
    if len(totals) < fits * width:
        raise ValueError("no rows to fit on")
    starts, before = [], {}
    for r in parts:
        below, previous = before.get((r["fit"], r["feature"]), (0, None))
        starts.append((r["fit"], r["feature"], r["part"], below, previous, *totals[r["fit"], r["feature"]]))
        before[r["fit"], r["feature"]] = below + r["n"], r["last"]
    starts = rows.sparkSession.createDataFrame(starts, "fit int, feature int, part int, below bigint, previous double, total bigint, values bigint")
    within = Window.partitionBy("fit", "feature", "part").orderBy("value")  # a range partition at most
    upto = counts.withColumns({"upto": F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)), "prior": F.lag("value").over(within)})
    upto = upto.join(F.broadcast(starts), ["fit", "feature", "part"]).withColumns({
        "prior": F.coalesce("prior", "previous"), "upto": F.col("upto") + F.col("below")})
    # how many of the ranks k * total // bins, k from 1 to bins - 1, lie below so many rows
    ranks = lambda n: F.least(F.expr(f"(({n}) * {bins}L + total - 1) div total - 1"), F.lit(bins - 1))
    chosen = upto.where("prior IS NOT NULL").where((F.col("values") <= bins) | (ranks("upto") > ranks("upto - n")))
    out = [[[] for _ in range(width)] for _ in range(fits)]
    for r in chosen.select("fit", "feature", "prior", "value").collect():  # fits x width x (bins - 1) rows at most
        out[r["fit"]][r["feature"]].append((r["prior"] + r["value"]) / 2)
    return [[np.sort(np.array(e, float)) for e in own] for own in out]


@dataclass(frozen=True)
class Forest:
    """Settings of a fit; all training rows are seen unless ``fit_rows`` bounds them."""

    trees: int
    max_depth: int = DEEPEST
    seed: int = 42
    fit_rows: int | None = None
    key: str = "id"

    def score_all(self, rows: DataFrame, scales: list, width: int) -> DataFrame:
        """``(PLACE, run, score)``: the rows that each run tests, scored by the forest of its training rows.

        Takes ``rows(PLACE, key, features array, label, trains array<boolean>, tests array<boolean>)``. All trees of
        all runs grow in one job. Scores are sums of whole numbers, so they do not depend on the tasks."""
        import numpy as np
        import pyarrow as pa

        fits, seed, max_depth, trees = len(scales), self.seed, self.max_depth, self.trees
        if self.fit_rows is not None:
            keyed = with_key(rows, self.key)
            draw = ticket("forest", seed)
            cuts = stats.ticket_cuts(
                keyed, {str(i): (F.when(F.col("trains")[i], draw), [self.fit_rows]) for i in range(fits)}, F.expr(key_of(rows, self.key)))
            rows = keyed.withColumn("trains", F.array(*[cuts[str(i)][0] for i in range(fits)]))
        edges = edges_of_all(rows, fits, width)
        shares = max(1, min(trees, -(-TASKS * rows.sparkSession.sparkContext.defaultParallelism // fits)))  # tasks a fit
        weights = [[s.weight[0], s.weight[1]] for s in scales]
        unit = 1 << (62 - trees.bit_length())

        def pack(batches: Iterator) -> Iterator:
            for batch in batches:
                if not batch.num_rows:
                    continue
                points, place = matrix(batch["features"], width), batch[PLACE].to_numpy()
                label = batch["label"].to_numpy(zero_copy_only=False).astype(np.uint8)
                trains, tests = matrix(batch["trains"], fits), matrix(batch["tests"], fits)
                ends = np.append(np.flatnonzero(np.diff(place) != 1) + 1, len(place))
                blocks = [slice(a, b) for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
                out = []
                for i in range(fits):
                    bins = np.stack([np.searchsorted(e, points[:, j], "left").astype(np.uint8) for j, e in enumerate(edges[i])], axis=1)
                    mark = label | trains[:, i].astype(np.uint8) << 1 | tests[:, i].astype(np.uint8) << 2
                    out += [(i, int(place[b.start]), bins[b].tobytes(), mark[b].tobytes()) for b in blocks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["fit", "first", "bins", "mark"])

        def run(batches: Iterator) -> Iterator:
            for task, table in _tables(batches, width):
                fit = task // shares
                for place, share in _grown(table, edges[fit], weights[fit], range(task % shares, trees, shares), seed, max_depth, unit):
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.full(len(place), fit, np.int32)), pa.array(share)], [PLACE, "run", "share"])

        packed = rows.select(PLACE, "features", "label", "trains", "tests").mapInArrow(pack, "fit int, first bigint, bins binary, mark binary")
        to = F.explode(F.sequence(F.col("fit") * shares, F.col("fit") * shares + shares - 1)).alias("task")
        dealt = packed.select(to, "first", "bins", "mark").repartitionById(fits * shares, F.col("task")).sortWithinPartitions("task", "first")
        parts = staged(dealt.mapInArrow(run, f"{PLACE} bigint, run int, share bigint"), "shares")
        return parts.groupBy(PLACE, "run").agg((F.sum("share").cast("double") / float(unit) / float(trees)).alias("score"))


@dataclass
class _Table:
    """The rows of a task: bytes in a file, and for each run of neighbouring places its first and its marks."""

    file: object
    first: list
    mark: list


def _tables(batches: Iterator, width: int) -> Iterator:
    """``(task, rows)`` from blocks ordered by task and first place; a file ends with its task."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
    task, table = None, None
    for batch in batches:
        for i, own in enumerate(batch["task"].to_pylist()):
            if own != task:
                if table is not None:
                    yield task, table
                    table.file.close()
                task, table = own, _Table(tempfile.TemporaryFile(dir=folder), [], [])
            table.file.write(batch["bins"][i].as_buffer())
            table.first.append(batch["first"][i].as_py())
            table.mark.append(batch["mark"][i].as_py())
    if table is not None:
        yield task, table
        table.file.close()


def _grown(table: _Table, edges: list, weights: list, numbers, seed: int, max_depth: int, unit: int) -> Iterator:
    """Places of the rows to score and the sums of their shares over some trees, in units."""
    import numpy as np

    table.file.flush()
    lengths = [len(m) for m in table.mark]
    starts = np.cumsum([0, *lengths[:-1]])
    mark = np.frombuffer(b"".join(table.mark), np.uint8)
    table.mark.clear()
    binned = np.memmap(table.file, np.uint8, "r", shape=(len(mark), len(edges))).view(np.ndarray)
    rows = np.uint32 if len(mark) < 1 << 32 else np.int64
    train, test = np.flatnonzero(mark & 2).astype(rows), np.flatnonzero(mark & 4).astype(rows)
    label = mark[train] & 1
    if not len(test):
        return
    sums = np.zeros(len(test), np.int64)
    waiting: list = []

    def score():
        model = ForestModel(edges, [_packed(t["feature"], t["place"], t["left"]) for t in waiting], [t["value"] for t in waiting])
        for i in range(0, len(test), BITS):
            for found in model.each(binned[test[i:i + BITS]]):
                sums[i:i + BITS] += np.rint(found * unit).astype(np.int64)
        waiting.clear()

    for number in numbers:
        waiting.append(grow_tree(binned, train, label, weights, number, seed, max_depth))
        if sum(len(t["feature"]) for t in waiting) >= HELD:
            score()
    score()
    for i in range(0, len(test), BITS):
        own = test[i:i + BITS].astype(np.int64)
        block = np.searchsorted(starts, own, "right") - 1
        yield np.array(table.first, np.int64)[block] + own - starts[block], sums[i:i + BITS]


def _packed(feature, place, left):
    """Nodes as one whole number each."""
    import numpy as np

    inner = feature >= 0
    left = np.where(inner, left, np.arange(len(feature))).astype(np.int64)
    return left << 32 | np.maximum(feature, 0).astype(np.int64) << 16 | np.where(inner, place, LEAF).astype(np.int64)


@dataclass(frozen=True)
class ForestModel:
    """Trees for scoring. Thresholds are places among the forest's own ones per feature, ``BINS - 1`` at
    most, and a node is one whole number: left child, feature and place. A leaf is its own left child."""

    edges: list
    nodes: list
    values: list

    @classmethod
    def of(cls, trees: list[dict], width: int) -> "ForestModel":
        import numpy as np

        edges = [np.unique(np.concatenate([t["threshold"][t["feature"] == f] for t in trees])) for f in range(width)]
        if max((len(e) for e in edges), default=0) >= LEAF:
            raise ValueError("too many thresholds")
        nodes = []
        for t in trees:
            place = np.zeros(len(t["feature"]), np.int64)
            for f in np.unique(t["feature"][t["feature"] >= 0]):
                mine = t["feature"] == f
                place[mine] = np.searchsorted(edges[f], t["threshold"][mine])
            nodes.append(_packed(t["feature"], place, t["left"]))
        return cls(edges, nodes, [t["value"] for t in trees])

    def scores(self, points):
        """Mean share of class 1 over the trees for every row of ``points``.

        Most leaves hold one class, so for many rows a tree is a formula over the rows' answers to its tests,
        each a word of bits for 64 rows. Few rows, and trees with many mixed leaves, walk from node to node."""
        import numpy as np

        parts = [self._scores(points[i:i + BITS]) for i in range(0, len(points), BITS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _scores(self, points):
        import numpy as np

        out = np.zeros(len(points))
        for found in self.each(self._bins(points)):
            out += found
        return out / max(len(self.nodes), 1)

    def each(self, bins):
        """Every tree's share of class 1 for rows given as their places among the thresholds, ``BITS`` at most."""
        import numpy as np

        tests = None
        for nodes, value in zip(self.nodes, self.values):
            found = None
            if len(bins) >= MANY and len(nodes) <= FORMULA:
                tests = tests or _Tests(bins, [len(e) for e in self.edges])
                found = tests.share(nodes, value)
            if found is None:
                found = np.concatenate([self._walk(bins[i:i + BLOCK], nodes, value) for i in range(0, max(len(bins), 1), BLOCK)])
            yield found

    def _bins(self, points):
        """The place of every cell among its feature's thresholds."""
        import numpy as np

        bins = np.zeros(points.shape, np.uint8 if max((len(e) for e in self.edges), default=0) < 256 else np.uint16)
        for f, edges in enumerate(self.edges):
            bins[:, f] = np.where(np.isnan(points[:, f]), 0, np.searchsorted(edges, points[:, f], "left"))  # NaN is below every threshold
        return bins

    @staticmethod
    def _walk(bins, nodes, value):
        import numpy as np

        n, width = bins.shape
        bins = bins.ravel()
        at, start, rows, level = np.zeros(n, np.int64), np.arange(n) * width, None, 0
        while True:
            node = nodes.take(at)
            place = node & LEAF
            if level % 2 == 0 and (level >= 10 or len(nodes) < 1024):  # most rows of a deep tree end below
                inner = np.flatnonzero(place != LEAF)
                if rows is None:
                    end, rows = at, inner
                else:
                    end[rows] = at
                    rows = rows.take(inner)
                if not len(inner):
                    break
                node, place, start = node.take(inner), place.take(inner), start.take(inner)
            at = (node >> 32) + (bins.take(start + (node >> 16 & LEAF)) > place)
            level += 1
        return value.take(end)


class _Tests:
    """The answers of some rows to every test of a forest, as bits."""

    def __init__(self, bins, sizes: list[int]):
        import numpy as np

        self.rows, self.first = len(bins), np.append(0, np.cumsum(sizes))
        self.below, self.above = [], []
        for f, size in enumerate(sizes):
            column = np.zeros(-(-len(bins) // 64) * 64, bins.dtype)
            column[:len(bins)] = bins[:, f]
            for place in range(size):
                below = np.packbits(column <= place).view(np.uint64)
                self.below.append(below)
                self.above.append(~below)

    def share(self, nodes, value):
        """The share of class 1 in every row's leaf, None if too many leaves hold both classes."""
        import numpy as np

        inner = np.flatnonzero((nodes & LEAF) != LEAF)
        leaf = np.ones(len(nodes), bool)
        leaf[inner] = False
        mixed = np.flatnonzero(leaf & (value != 0) & (value != 1))
        if len(mixed) > MIXED:
            return None
        child = (nodes[inner] >> 32).tolist()
        test = (self.first[nodes[inner] >> 16 & LEAF] + (nodes[inner] & LEAF)).tolist()
        # whether rows that come to a node end in class 1: True and False at leaves, bits above them
        holds: list = (leaf & (value == 1)).tolist()
        for node, left, t in zip(reversed(inner.tolist()), reversed(child), reversed(test)):  # children have greater numbers
            a, b, below, above = holds[left], holds[left + 1], self.below[t], self.above[t]
            if a is False:
                holds[node] = False if b is False else above if b is True else b & above
            elif a is True:
                holds[node] = below if b is False else True if b is True else b | below
            elif b is False:
                holds[node] = a & below
            elif b is True:
                holds[node] = a | above
            else:
                holds[node] = (a & below) | (b & above)
            holds[left] = holds[left + 1] = None
        if isinstance(holds[0], bool):
            out = np.full(self.rows, float(holds[0]))
        else:
            out = np.unpackbits(holds[0].view(np.uint8), count=self.rows).astype(float)
        parent = {c + side: (node, side, t) for node, c, t in zip(inner.tolist(), child, test) for side in (0, 1)} if len(mixed) else {}
        for end in mixed.tolist():
            node, here = end, None
            while node:
                node, side, t = parent[node]
                answer = self.above[t] if side else self.below[t]
                here = answer if here is None else here & answer
            out[slice(None) if here is None else np.flatnonzero(np.unpackbits(here.view(np.uint8), count=self.rows))] = value[end]
        return out
