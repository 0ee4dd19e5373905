"""Cross-entropy difference of two n-gram language models.

The target model is learned from documents labelled good, the background model from all documents.
They are matched: one vocabulary (every word of the corpus and one unknown word), the same order, the
same smoothing. A word's context is the word before it:

    p(w) = (c(w) + 1) / (n + V)        p(w | c) = (c(c, w) + PRIOR p(w)) / (c(c) + PRIOR)

Each token's loss under the background less its loss under the target is its difference; a document
scores the mean. Vocabulary and counts come from every word of every document.

The models grow with the corpus and stay distributed. Words travel as 64-bit keys. The counts of the
at most 2 ``HOT`` words with a ``1 / HOT`` part of the tokens, and of pairs of the ``TOP`` first of them,
go to the tasks. Other pairs of hot words are dealt out by the pair, and every word that is not hot once
by itself, with its neighbours: its pairs with them, the word and the context are all counted where it
lies, and no key holds much. What is dealt out is sorted and packed per bucket, a few bytes a token.

``words`` and ``contexts``, if given, bound the models instead: the ``words`` most frequent words, the
``contexts`` most frequent of them as contexts of their own and the others in as many classes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import text_of
from plumbline.sources.staging import staged

PRIOR = 200.0
HOT, TOP = 20_000, 1_024  # what is broadcast; the results do not depend on it
SLICE = 2_000_000  # characters that a task works on at once
BUCKET = 1_000_000  # tokens of the corpus for each bucket, whose counts are settled at once
PARTS = 32  # tasks that settle buckets: a text has a partial sum in each, so their number is the same at every size
HELD = 1_000_000  # partial sums that a task adds up before it passes them on
TARGET_IDS = 2_000_000  # up to so many ids travel to the documents, more are joined by a shuffle


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _count_words(batches: Iterator) -> Iterator:
    import pyarrow as pa

    kind = pa.schema([("word", pa.string()), ("n", pa.int64())])
    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column(0):
            seen.update(words_of(text.as_py() or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=kind)


def vocabulary(docs: DataFrame, words: int, text: str = "text") -> list[str]:
    """The most frequent words of all documents, ties in the order of the words."""
    counted = docs.select(text_of(docs, text).alias("t")).mapInArrow(_count_words, "word string, n long")
    best = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [r["word"] for r in best.collect()]


def _numbers(text: str, ids: dict, contexts: int):
    """Word numbers, and the context of each; 0 is the unknown word, context 0 the start of a text."""
    import numpy as np

    words = words_of(text)
    number = np.fromiter(map(lambda w: ids.get(w, 0), words), np.int64, len(words))
    before = np.concatenate(([-1], number[:-1]))[:len(words)]
    # 1..contexts: the most frequent words alone; then as many shared classes
    context = np.where(before < 0, 0, np.where((before > 0) & (before <= contexts), before, contexts + 1 + before % contexts))
    return number, context


def _count_cells(shared, contexts: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ids = shared.value
        size = len(ids) + 1
        kind = pa.schema([("cell", pa.int64()), ("target", pa.int64()), ("background", pa.int64())])
        for batch in batches:
            cells: list[list] = [[], []]
            for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
                number, context = _numbers(text.as_py() or "", ids, contexts)
                cells[bool(good)].append(context * size + number)
            parts = [np.unique(np.concatenate(c) if c else np.zeros(0, np.int64), return_counts=True) for c in cells]
            keys = np.union1d(parts[0][0], parts[1][0])
            n = np.zeros((2, len(keys)), np.int64)
            for i, (k, c) in enumerate(parts):
                n[i, np.searchsorted(keys, k)] = c
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[1]), pa.array(n[0] + n[1])], schema=kind)
    return run


def _log_table(counts, prior: float):
    """Log probabilities of a (contexts, words) table of counts."""
    import numpy as np

    alone = counts.sum(axis=0)
    one = (alone + 1.0) / (alone.sum() + len(alone))
    return np.log((counts + prior * one) / (counts.sum(axis=1, keepdims=True) + prior)).astype(np.float32)


def _marked(docs: DataFrame, labels: DataFrame, text: str) -> DataFrame:
    """doc_id, text and whether a label calls the document good (null if none does)."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id", F.lit(True).alias("good")).distinct()
    good = F.broadcast(good) if good.count() <= TARGET_IDS else good
    return docs.select("doc_id", text_of(docs, text).alias("t")).join(good, "doc_id", "left")


def models(docs: DataFrame, labels: DataFrame, words: int, contexts: int, prior: float = PRIOR, text: str = "text"):
    """Word numbers and the table of log target less log background, with both tables."""
    import numpy as np

    spark = docs.sparkSession
    ids = {w: i for i, w in enumerate(vocabulary(docs, words, text), 1)}
    shared = spark.sparkContext.broadcast(ids)
    marked = _marked(docs, labels, text).select("t", "good")
    cells = marked.mapInArrow(_count_cells(shared, contexts), "cell long, target long, background long")
    cells = cells.groupBy("cell").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    found = cells.toArrow()  # at most (2 * contexts + 1) * (words + 1) rows, whatever the corpus
    shape = (2 * contexts + 1, len(ids) + 1)
    tables = []
    for name in ("target", "background"):
        flat = np.zeros(shape[0] * shape[1])
        flat[found["cell"].to_numpy()] = found[name].to_numpy()
        tables.append(_log_table(flat.reshape(shape), prior))
    return ids, tables


def _keys(words: list[str]):
    """64-bit keys of words, the same in every process; 0 is the start of a text."""
    import numpy as np
    from pandas.util import hash_array

    key = hash_array(np.array(words, object), categorize=False).view(np.int64) if words else np.zeros(0, np.int64)
    return np.where(key == 0, 1, key)


def _slices(batches: Iterator) -> Iterator:
    """The tokens of neighbouring rows, some ``SLICE`` characters at a time: the first row, words, each token's place
    among the texts, tokens of each text, which texts are good, which tokens are first and last of theirs."""
    import numpy as np

    for batch in batches:
        texts, rows = batch.column(0).to_pylist(), batch.column(2).to_numpy()
        good = np.array([bool(x) for x in batch.column(1).to_pylist()], bool)
        part = np.cumsum([len(t) for t in texts]) // SLICE
        starts = np.flatnonzero(np.append(True, (np.diff(rows) != 1) | (np.diff(part) != 0)))[:len(texts)]
        for a, b in zip(starts, np.append(starts[1:], len(texts))):
            split = [words_of(t) for t in texts[a:b]]
            size = np.array([len(w) for w in split], np.int64)
            word = _keys(list(chain.from_iterable(split)))
            first, last = np.zeros(len(word), bool), np.zeros(len(word), bool)
            ends = np.cumsum(size)[size > 0]
            first[ends - size[size > 0]], last[ends - 1] = True, True
            yield int(rows[a]), word, np.repeat(np.arange(len(size)), size), size, good[a:b], first, last


def _pair(word, other):
    """Keys of pairs."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (other.astype(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _place(keys, values):
    """Places of values in the sorted keys, -1 for those not there."""
    import numpy as np

    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def _contexts(place, first, start: int):
    """Places of the words before, ``start`` for the first of a text."""
    import numpy as np

    before = np.append(start, place)[:len(place)]
    before[first] = start
    return before


def _count_keys(batches: Iterator) -> Iterator:
    """Per key of a slice: its counts as a word and as a context, in the target and in all."""
    import numpy as np
    import pyarrow as pa

    for _, word, text, size, good, _, last in _slices(batches):
        keys, at = np.unique(word, return_inverse=True)
        own = good[text]
        counts = [np.bincount(at[x], minlength=len(keys)) for x in (own, slice(None), own & ~last, ~last)]
        begun = [0, 0, int((good & (size > 0)).sum()), int((size > 0).sum())]
        columns = [np.append(0, keys), *[np.append(n, c) for n, c in zip(begun, counts)]]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=("key", "t", "b", "ct", "cb"))


def _count_top(shared):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        top = shared.value
        start = int(_place(top, np.zeros(1, np.int64))[0])
        for _, word, text, _, good, first, _ in _slices(batches):
            w = _place(top, word)
            c = _contexts(w, first, start)
            both = (w >= 0) & (c >= 0)
            cells, at = np.unique((c * len(top) + w)[both], return_inverse=True)
            own = good[text][both]
            counts = [np.bincount(x, minlength=len(cells)).astype(np.int64) for x in (at[own], at)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cells, *counts)], names=("cell", "t", "b"))
    return run


def _planes(values):
    """Whole numbers as rows of bytes, least significant first, as many as the greatest needs."""
    import numpy as np

    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.copy()


def _numbers_of(planes: bytes, n: int):
    import numpy as np

    out = np.zeros((n, 8), np.uint8)
    out[:, :len(planes) // n] = np.frombuffer(planes, np.uint8).reshape(-1, n).T
    return out.view("<u8").ravel()


_DEALT = "bucket int, kind int, first long, n int, base long, key binary, before binary, far binary, next binary, text binary"
_HOT_PAIRS, _OTHERS, _SUMS = range(3)


def _deal(shared, prior: float, buckets: int):
    """What a slice knows of its texts' sums, and its tokens whose counts are not at hand, packed by bucket.

    Pairs of hot words go by the pair, every other word goes by itself with its neighbours: the place of a
    hot one, ``len(hot)`` for another and ``len(hot) + 1`` for none. Keys are sorted and kept as differences;
    ``far`` holds the keys before that are not hot, ``text`` twice the place of the text, and 1 if it is good.
    """
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        m = shared.value
        size_of_hot, tops, start = len(m["key"]), len(m["top"]), int(_place(m["key"], np.zeros(1, np.int64))[0])
        rank = np.full(size_of_hot + 1, -1)  # the last is for words that are not hot, at place -1
        rank[m["top"]] = np.arange(tops)
        cells = {x: np.zeros(tops * tops) for x in "tb"}
        for x in "tb":
            cells[x][m["cell"]] = m["cell_" + x]
        for row, word, text, size, good, first, last in _slices(batches):
            w = _place(m["key"], word)
            c = _contexts(w, first, start)
            cell = np.where((rank[w] >= 0) & (rank[c] >= 0), rank[c] * tops + rank[w], -1)
            known, hot, sums = cell >= 0, c >= 0, []
            for x in "tb":
                pair = np.log(cells[x][cell[known]] + prior * (m[x][w[known]] + 1.0) / m["n" + x])
                context = np.log(m["c" + x] + prior)[c[hot]]
                sums.append((np.bincount(text[known], pair, len(size)) - np.bincount(text[hot], context, len(size))).astype("<f8"))
            records = [(row % buckets, _SUMS, row, len(size), 0, sums[0].tobytes(), sums[1].tobytes(), b"", b"", _planes(size).tobytes())]
            mark = 2 * text + good[text]

            at = np.flatnonzero((w >= 0) & hot & ~known)
            key = (c[at] * size_of_hot + w[at]).astype(np.uint64)
            bucket = _pair(key, np.zeros(1, np.uint64)) % np.uint64(buckets)
            order = np.argsort((bucket << np.uint64(40)) | key)
            parts = _parts(bucket[order], key[order], mark[at][order])
            records += [(b, _HOT_PAIRS, row, j - i, base, delta, b"", b"", b"", marks) for b, i, j, base, delta, marks in parts]

            at = np.flatnonzero(w < 0)
            key = word[at].view(np.uint64)
            order = np.argsort(key)
            key, at = key[order], at[order]
            bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            before = np.where(c[at] < 0, size_of_hot, c[at])
            behind = np.append(w, 0)[at + 1]
            behind = np.where(last[at], size_of_hot + 1, np.where(behind < 0, size_of_hot, behind))
            is_far = before == size_of_hot
            far, places = word[at[is_far] - 1].astype("<i8"), np.append(0, np.cumsum(is_far))
            planes = _planes(before), _planes(behind)
            for b, i, j, base, delta, marks in _parts(bucket, key, mark[at]):
                records.append((b, _OTHERS, row, j - i, base, delta, planes[0][:, i:j].tobytes(),
                                far[places[i]:places[j]].tobytes(), planes[1][:, i:j].tobytes(), marks))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5)
            names = ("bucket", "kind", "first", "n", "base", "key", "before", "far", "next", "text")
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*records), kinds)], names=names)
    return run


def _parts(bucket, key, mark) -> Iterator[tuple]:
    """Of sorted tokens per bucket: the bucket, where it begins and ends, its first key, the differences and the marks."""
    import numpy as np

    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))[:len(bucket)]
    delta = np.append(key[:1], np.diff(key))
    delta[starts] = 0
    delta, marks = _planes(delta), _planes(mark)
    for i, j in zip(starts.tolist(), np.append(starts[1:], len(bucket)).tolist()):
        yield int(bucket[i]), i, j, int(key[i:i + 1].view(np.int64)[0]), delta[:, i:j].tobytes(), marks[:, i:j].tobytes()


def _settle(shared, prior: float):
    """Per row of a bucket: its tokens, and the sums of the log probabilities' parts that the bucket knows.

    Buckets come in order and are worked off one by one; their sums are added up before they leave the task."""
    def settled(dealt):
        import numpy as np

        m, found = shared.value, [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0))]
        records: dict[int, list] = {kind: [] for kind in (_HOT_PAIRS, _OTHERS, _SUMS)}
        for record in zip(*(dealt[c].to_pylist() for c in ("kind", "first", "n", "base", "key", "before", "far", "next", "text"))):
            records[record[0]].append(record[1:])

        def share(x, word):
            return prior * (m[x][word] + 1.0) / m["n" + x]

        def counts(keys, good):
            _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
            return {"b": n[at], "t": np.bincount(at, good, len(n))[at]}

        def rows_of(own):
            marks = [_numbers_of(r[7], r[1]).astype(np.int64) for r in own]
            return np.concatenate([r[0] + (x >> 1) for r, x in zip(own, marks)]), np.concatenate(marks) & 1

        def keys_of(own):
            with np.errstate(over="ignore"):
                return np.concatenate([np.array([r[2]], np.int64).view(np.uint64) + np.cumsum(_numbers_of(r[3], r[1])) for r in own])

        for first, n, _, t, b, _, _, size in records[_SUMS]:
            found.append((first + np.arange(n), _numbers_of(size, n).astype(float), np.frombuffer(t, "<f8"), np.frombuffer(b, "<f8")))
        if own := records[_HOT_PAIRS]:
            (row, good), key = rows_of(own), keys_of(own)
            n, word = counts(key, good), (key % np.uint64(len(m["key"]))).astype(np.int64)
            found.append((row, np.zeros(len(row)), *[np.log(n[x] + share(x, word)) for x in "tb"]))
        if own := records[_OTHERS]:
            (row, good), key, hot = rows_of(own), keys_of(own), len(m["key"])
            before, behind = (np.concatenate([_numbers_of(r[i], r[1]) for r in own]).astype(np.int64) for i in (4, 6))
            before[before == hot] = np.frombuffer(b"".join(r[5] for r in own), "<i8")
            followed, to_hot = behind <= hot, behind < hot
            word, pair = counts(key, good), counts(_pair(key, before), good)
            context = counts(key[followed], good[followed])
            ahead = counts(_pair(key[to_hot], behind[to_hot]), good[to_hot])
            sums = []
            for x in "tb":
                own_sum = np.log(pair[x] + prior * (word[x] + 1.0) / m["n" + x])
                own_sum[followed] -= np.log(context[x] + prior)
                own_sum[to_hot] += np.log(ahead[x] + share(x, behind[to_hot]))
                sums.append(own_sum)
            found.append((row, np.zeros(len(row)), *sums))
        return added(found)

    def added(found):
        import numpy as np

        row, *sums = (np.concatenate(x) for x in zip(*found))
        rows, at = np.unique(row, return_inverse=True)
        return rows, *(np.bincount(at, x, len(rows)) for x in sums)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(rows, size, t, b):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows, size.astype(np.int64), t, b)], names=("row", "n_tokens", "t", "b"))

        held: list = []
        for dealt in _whole_buckets(batches):
            held.append(settled(dealt))
            if sum(len(x[0]) for x in held) > HELD:
                held = [added(held)]
                if len(held[0][0]) > HELD // 2:
                    yield out(*held.pop())
        if held:
            yield out(*added(held))
    return run


def _whole_buckets(batches: Iterator) -> Iterator:
    """A table per bucket from batches in the order of the buckets."""
    import numpy as np
    import pyarrow as pa

    waiting: list = []
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.append(True, np.diff(bucket) != 0))[:len(bucket)]
        for i, j in zip(starts.tolist(), np.append(starts[1:], len(bucket)).tolist()):
            if waiting and waiting[-1].column(0)[0].as_py() != bucket[i]:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(i, j - i))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _score_whole(docs: DataFrame, labels: DataFrame, prior: float, text: str) -> DataFrame:
    import numpy as np

    spark = docs.sparkSession
    rows = staged(_marked(docs, labels, text).withColumn("row", F.monotonically_increasing_id()), "lm_rows", "zstd")
    texts = rows.select("t", "good", "row")
    sums = [F.sum(x).alias(x) for x in ("t", "b", "ct", "cb")]
    words = staged(texts.mapInArrow(_count_keys, "key long, t long, b long, ct long, cb long").groupBy("key").agg(*sums), "lm_words")
    total = words.agg(F.sum("t").alias("t"), F.sum("b").alias("b"), F.expr("count_if(b > 0)").alias("words")).first()
    n = total["b"] or 0
    if not n:
        return docs.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), *[F.lit(0.0).alias(x) for x in ("target_loss", "background_loss", "score")])
    hot = words.where((F.greatest("b", "cb") >= max(1, n // HOT)) | (F.col("key") == 0)).orderBy("key").toArrow()  # at most 2 HOT rows and the start
    m = {x: hot[x].to_numpy() for x in hot.column_names}
    m["nt"], m["nb"] = ((total[x] or 0) + total["words"] + 1 for x in "tb")
    m["top"] = np.sort(np.argsort(-np.maximum(m["b"], m["cb"]), kind="stable")[:TOP])
    cells = texts.mapInArrow(_count_top(spark.sparkContext.broadcast(m["key"][m["top"]])), "cell long, t long, b long")
    cells = cells.groupBy("cell").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).toArrow()  # at most TOP ** 2 rows
    m.update(cell=cells["cell"].to_numpy(), cell_t=cells["t"].to_numpy(), cell_b=cells["b"].to_numpy())
    shared = spark.sparkContext.broadcast(m)
    buckets = max(n // BUCKET, min(4 * PARTS, 1 + 1000 * n // BUCKET))
    dealt = texts.mapInArrow(_deal(shared, prior, buckets), _DEALT).repartition(PARTS, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_settle(shared, prior), "row long, n_tokens long, t double, b double")
    found = found.groupBy("row").agg(*[F.sum(x).alias(x) for x in ("n_tokens", "t", "b")])
    scored = rows.select("doc_id", "row").join(found, "row")  # every row has its sums
    loss = {x: 0.0 - F.col(x) / F.greatest(F.lit(1), "n_tokens") for x in "tb"}
    return scored.select("doc_id", "n_tokens", loss["t"].alias("target_loss"), loss["b"].alias("background_loss"), (loss["b"] - loss["t"]).alias("score"))


def score(docs: DataFrame, labels: DataFrame, words: int | None = None, contexts: int | None = None, prior: float = PRIOR,
          text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, target_loss, background_loss, score.

    Losses are mean nats per token; ``score`` is background less target, above 0 for text nearer to
    the target. Null and empty texts have no tokens and 0 everywhere. Repeated rows stay. Labels
    without doc_id or for no document teach nothing; without target documents both models are even
    over words not counted. An empty table gives no rows. Other columns are not read.
    """
    import pyarrow as pa

    if words is None:
        return _score_whole(docs, labels, prior, text)
    ids, tables = models(docs, labels, words, words if contexts is None else contexts, prior, text)
    shared = docs.sparkSession.sparkContext.broadcast((ids, tables))

    def run(values: pa.Array) -> pa.Array:
        ids, (target, background) = shared.value
        out = []
        for v in values:
            number, context = _numbers(v.as_py() or "", ids, contexts)
            n = len(number)
            a, b = (-float(t[context, number].sum(dtype="float64")) / max(1, n) for t in (target, background))
            out.append({"n_tokens": n, "target_loss": a + 0.0, "background_loss": b + 0.0, "score": b - a})
        return pa.array(out, pa.struct([("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("score", pa.float64())]))

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    scored = F.arrow_udf(run, "struct<n_tokens:bigint,target_loss:double,background_loss:double,score:double>").asNondeterministic()
    return docs.select("doc_id", scored(text_of(docs, text)).alias("s")).select("doc_id", "s.*")
