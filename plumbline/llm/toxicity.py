"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

The instances are units of text: words (or parts of very long words, runs of single letters written
apart, or a scrap of one or two letters joined to its neighbour), without marks inside words. The kernel works on letters of
any script: sequences of a to z have a table cell each, others share ``HASHED`` cells by a hash. Two units are compared by their
common subsequences of ``ORDER`` letters, each weighted by ``DECAY`` to the length it spans in both,
so inserted letters and gaps cost weight and not the match. A document is as toxic as its worst
unit.

Training uses a bounded sample of labelled documents (``FIT_ROWS``). In a toxic document the units
with the strongest evidence over all sampled documents stand for their sentences; units of clean
documents are the other class, and those the first machine finds worst are added before the second
is trained. The machine is linear in the landmarks' kernel values, so it folds into one weight per
letter sequence, and scoring is exact without visiting a landmark.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
import uuid

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import per_value, text_of
from plumbline.sources.staging import staged

ORDER, SPAN, DECAY = 4, 7, 0.6
FIT_ROWS = 20_000
# Bounds of the fit, parameters of ``score`` and ``train`` like FIT_ROWS: units of toxic and of clean sentences, clean ones nearest to the boundary, landmarks.
POSITIVES, NEGATIVES, HARD, LANDMARKS = 3_000, 12_000, 6_000, 240
SEEN, PURE = 4, 0.8  # documents in which a toxic unit must be met, and the toxic share of all that hold it
CLOSE = 0.5  # units of a document with so large a share of its strongest evidence stand for it too
LONGEST, STEP = 24, 12
LETTERS = 32
EXACT = LETTERS ** ORDER  # cells of the sequences of a to z
HASHED = EXACT  # cells of all other sequences
SCRAP, JOINED = 2, 8  # letters of the shorter part of a word written in two, and of the whole
MEMO = 400_000
TEXTS = 1_024  # texts whose units are held at once

# Fixed: look-alikes of letters.
_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


class _Fold(dict):
    """For str.translate: base letters, look-alikes, white space; other marks vanish, other letters stay."""

    def __missing__(self, code):
        c = chr(code)
        if c.isspace():
            out = " "
        elif c in _ALIKE:
            out = _ALIKE[c]
        else:
            out = "".join(x for x in unicodedata.normalize("NFKD", c.lower()) if x.isalnum())
        self[code] = out
        return out


_FOLD = _Fold()
_APART = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")


def units(text: str) -> set[str]:
    """Different units of a whole text."""
    words = text.translate(_FOLD).split()
    out = set(words)
    for w in [w for w in out if len(w) > LONGEST]:
        out.discard(w)
        out.update(w[i:i + LONGEST] for i in range(0, max(1, len(w) - STEP), STEP))
    size = list(map(len, words))  # an insult cut in two; single letters are joined below
    for i in [i for i, n in enumerate(size) if n <= SCRAP]:
        for j in (i - 1, i):
            if 0 <= j < len(size) - 1 and 4 < size[j] + size[j + 1] <= JOINED:
                out.add(words[j] + words[j + 1])
    if sum(1 for w in words if len(w) == 1) >= 3:
        for run in _APART.findall(" ".join(words)):
            whole = run.replace(" ", "")
            out.update(whole[i:i + LONGEST] for i in range(0, max(1, len(whole) - STEP), STEP))
    return out


def _codes(words: list[str]):
    """Letter codes of words of one length, with a mark before the word."""
    import numpy as np

    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
    # a to z are 1 to 26, 27 is the mark, others keep their code points beyond
    codes = np.where((raw >= 97) & (raw <= 122), raw - 96, raw + LETTERS).astype(np.int64)
    return np.concatenate((np.full((len(words), 1), 27, np.int64), codes), axis=1)


@functools.cache
def _places(length: int):
    """Places of every subsequence within SPAN and its weight, scaled to unit length over the places."""
    import numpy as np

    found = [(i, *(i + d for d in rest)) for i in range(length) for rest in itertools.combinations(range(1, SPAN), ORDER - 1) if i + rest[-1] < length]
    weights = np.array([DECAY ** (p[-1] - p[0] + 1) for p in found])
    return found, weights / np.sqrt((weights ** 2).sum()) if found else weights


def _by_length(words):
    """Words of one length and kind: their numbers, codes, places, weights, and whether letters beyond a to z occur."""
    groups: dict[tuple[int, bool], list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault((len(w), not (w.isascii() and w.isalpha())), []).append(i)
    for (length, strange), rows in groups.items():
        found, weights = _places(length + 1)
        if found:
            yield rows, _codes([words[i] for i in rows]), found, weights, strange


def _sequence(codes, places, strange: bool):
    """The table cell of the letters at some places, for every word."""
    import numpy as np

    letters = [codes[:, p] for p in places]
    at = letters[0]
    for x in letters[1:]:
        at = at * LETTERS + x
    if strange:
        beyond = np.zeros(len(codes), bool)
        h = np.zeros(len(codes), np.uint64)
        for x in letters:
            beyond |= x >= LETTERS
            h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        at = np.where(beyond, EXACT + (h % np.uint64(HASHED)).astype(np.int64), at)
    return at


def margins(words: list[str], table, bias: float):
    """The machine's value for each word."""
    import numpy as np

    out = np.full(len(words), bias)
    for rows, codes, found, weights, strange in _by_length(words):
        total = np.zeros(len(rows))
        for places, weight in zip(found, weights):
            total += weight * table[_sequence(codes, places, strange)]
        out[rows] += total
    return out


def features(words: list[str]):
    """Explicit kernel features: a sparse vector for each word, as (sequence, weight) dictionaries."""
    out: list[dict[int, float]] = [{} for _ in words]
    for rows, codes, found, weights, strange in _by_length(words):
        for places, weight in zip(found, weights):
            for row, s in zip(rows, _sequence(codes, places, strange).tolist()):
                own = out[row]
                own[s] = own.get(s, 0.0) + weight
    return out


def kernel(words: list[str], landmarks: list[str]):
    """Kernel values of words (rows) and landmarks (columns)."""
    import numpy as np

    marks, where = features(landmarks), {}
    for j, own in enumerate(marks):
        for s, w in own.items():
            where.setdefault(s, []).append((j, w))
    slots = {s: k for k, s in enumerate(where)}
    dense = np.zeros((len(slots) + 1, len(landmarks)))
    for s, k in slots.items():
        for j, w in where[s]:
            dense[k, j] = w
    lookup = np.full(EXACT + HASHED, len(slots), np.int32)
    lookup[list(slots)] = np.arange(len(slots))
    out = np.zeros((len(words), len(landmarks)))
    for rows, codes, found, weights, strange in _by_length(words):
        for places, weight in zip(found, weights):
            out[rows] += weight * dense[lookup[_sequence(codes, places, strange)]]
    return out


def fit_machine(words: list[str], labels, weights, landmarks: list[str], cost: float = 20.0):
    """Squared-hinge support vector machine on Nystroem features; returns (table of weights, bias)."""
    import numpy as np

    y, c = np.where(np.asarray(labels) > 0, 1.0, -1.0), np.asarray(weights, float)
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    x = np.concatenate((kernel(words, landmarks) @ root, np.ones((len(words), 1))), axis=1)
    c = cost * c / c.mean()
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(50):  # Newton steps on the active rows
        active = y * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve(ridge + (xa.T * c[active]) @ xa, (xa.T * c[active]) @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    alpha = root @ w[:-1]
    table = np.zeros(EXACT + HASHED, np.float32)
    for a, own in zip(alpha, features(landmarks)):
        for s, v in own.items():
            table[s] += a * v
    return table, float(w[-1])


def spread(words: list[str], n: int) -> list[str]:
    """Up to n words: the first third as they come, then each the farthest from those before it."""
    import numpy as np

    if len(words) <= n:
        return list(words)
    size = np.array([sum(v * v for v in f.values()) for f in features(words)])
    out = list(words[:n // 3])
    far = (size[:, None] - 2 * kernel(words, out) + size[None, :len(out)]).min(axis=1)
    while len(out) < n:
        at = int(far.argmax())
        if far[at] <= 1e-9:
            break
        out.append(words[at])
        far = np.minimum(far, size - 2 * kernel(words, [words[at]])[:, 0] + size[at])
    return out


def calibrate(values, labels):
    """Logistic scale and shift of document values, by Newton's method with smoothed targets."""
    import numpy as np

    v, y = np.asarray(values, float), np.asarray(labels, float)
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.stack((v, np.ones(len(v))), axis=1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w = w - np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def boundary(values, labels) -> float:
    """The value that parts the classes with the fewest errors, the lowest if several do.

    Within the gap it keeps near the clean side: insults written around lie between the classes.
    """
    import numpy as np

    order = np.argsort(values, kind="stable")
    v, y = np.asarray(values, float)[order], np.asarray(labels)[order]
    errors = np.concatenate(([0], np.cumsum(y == 1))) + np.concatenate((np.cumsum((y == 0)[::-1])[::-1], [0]))
    cuts = [0, *(np.flatnonzero(v[1:] > v[:-1]) + 1).tolist(), len(v)]
    best = min(cuts, key=lambda k: (errors[k], k))
    low = v[best - 1] if best else v[0] - 1.0
    high = v[best] if best < len(v) else v[-1] + 1.0
    return float(low + (high - low) / 4)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """About ``rows`` labelled documents outside the held-out fifth, chosen by a hash: text digest, units, toxic."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND NOT (crc32(CAST(doc_id AS string)) % 5 = 0)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    found = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(known), "doc_id")  # bounded by ``rows``
    split = per_value(lambda t: sorted(units(t)), "array<string>", deterministic=False)
    return staged(found.select(F.md5("text").alias("key"), split("text").alias("units"), "toxic"), "toxic_rows")


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, positives: int = POSITIVES, negatives: int = NEGATIVES, hard_units: int = HARD,
          landmarks: int = LANDMARKS) -> dict | None:
    """The model, or None where one of the classes is missing."""
    import numpy as np

    found = training_rows(docs, labels, rows)
    # copies count once
    once = found.groupBy("key").agg(F.first("units").alias("units"), F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in once.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    n1, n0 = float(sizes[1]), float(sizes[0])
    words = once.select("key", "toxic", F.explode("units").alias("unit")).where(F.length("unit") >= 3)
    counts = words.groupBy("unit").agg(F.sum("toxic").cast("double").alias("t"), F.sum(1 - F.col("toxic")).cast("double").alias("c"))
    odds = F.log((F.col("t") / n1) / ((F.col("c") + 0.5) / n0))
    counts = staged(counts.withColumn("evidence", F.col("t") * odds), "toxic_units")
    strong = counts.where((F.col("t") >= min(SEEN, n1)) & (F.col("t") >= PURE * (F.col("t") + F.col("c"))) & (odds >= 1.0))
    toxic = words.where("toxic = 1").join(strong.select("unit", "evidence"), "unit")
    most = toxic.groupBy("key").agg(F.max("evidence").alias("most"))
    chosen = toxic.join(most, "key").where(F.col("evidence") >= CLOSE * F.col("most")).groupBy("unit").agg(F.count("*").alias("n"))
    positive = [(r["unit"], float(r["n"])) for r in chosen.orderBy(F.desc("n"), "unit").limit(positives).collect()]
    clean = counts.where((F.col("c") > 0) & (odds < 0.7))
    negative = [r["unit"] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(negatives).collect()]
    if not positive or not negative:
        return None
    marks = spread([u for u, _ in positive], landmarks * 3 // 4)

    bent = [(v, n / 8) for u, n in positive if len(u) >= 4 for v in inserted(u)]

    def machine(negative, marks):
        toxic = positive + bent
        weights = [n ** 0.5 for _, n in toxic]
        scale = sum(weights) / len(negative)
        return fit_machine([u for u, _ in toxic] + negative, [1] * len(toxic) + [0] * len(negative), weights + [scale] * len(negative), marks)

    table, bias = machine(negative, marks + spread(negative[:2000], landmarks // 4))
    worst = per_value_margin(found.sparkSession, table, bias)
    hard = [r["unit"] for r in clean.withColumn("m", worst("unit")).orderBy(F.desc("m"), "unit").limit(hard_units).collect()]
    negative = list(dict.fromkeys(hard + negative))
    table, bias = machine(negative, marks + spread(hard, landmarks // 4))
    model = {"table": table, "bias": bias, "scale": 1.0, "shift": 0.0, "token": uuid.uuid4().hex}
    value = margin_udf(found.sparkSession, model)
    pairs = once.select(value("units").alias("v"), "toxic").collect()  # two numbers for each sampled row
    values, toxic = [r["v"] for r in pairs], [r["toxic"] for r in pairs]
    model["scale"], _ = calibrate(values, toxic)
    model["shift"] = -model["scale"] * boundary(values, toxic)
    return model


def inserted(unit: str) -> list[str]:
    """Three variants of a toxic unit with one strange letter inside, so that training rewards gapped matches."""
    places = sorted({2, len(unit) // 2 + 1, len(unit) - 1})
    return [unit[:at] + letter + unit[at:] for at, letter in zip(places, "xqz") if 0 < at < len(unit)]


def per_value_margin(spark, table, bias):
    shared = spark.sparkContext.broadcast((table, bias))
    import pyarrow as pa

    def run(values: pa.Array) -> pa.Array:
        return pa.array(margins(values.to_pylist(), *shared.value), pa.float64())

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double").asNondeterministic()


_memo: dict = {}


def worst(sets, model):
    """The highest margin of each set of units; margins are remembered within a worker process."""
    token = model["token"]
    if _memo.get("token") != token or len(_memo.get("known", ())) > MEMO:
        _memo.update(token=token, known={})
    known = _memo["known"]
    new = list({u for own in sets for u in own if u not in known})
    known.update(zip(new, margins(new, model["table"], model["bias"]).tolist()))
    get, bias = known.__getitem__, model["bias"]
    return [max(map(get, own)) if own else bias for own in sets]


def margin_udf(spark, model):
    import pyarrow as pa

    shared = spark.sparkContext.broadcast(model)

    def run(values: pa.Array) -> pa.Array:
        return pa.array(worst(values.to_pylist(), shared.value), pa.float64())

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double").asNondeterministic()


def score_udf(spark, model):
    import pyarrow as pa

    shared = spark.sparkContext.broadcast(model)

    def run(values: pa.Array) -> pa.Array:
        import numpy as np

        m, out = shared.value, []
        for at in range(0, len(values), TEXTS):  # units of few texts at a time
            out += worst([units(v.as_py() or "") for v in values[at:at + TEXTS]], m)
        return pa.array(1 / (1 + np.exp(-np.clip(m["scale"] * np.array(out) + m["shift"], -50, 50))), pa.float64())

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double").asNondeterministic()


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, **bounds) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    ``held_out`` marks documents whose label is never learned from (crc32 of the id as text divides
    by 5). Null and empty texts have no units and score the machine's bias. Repeated rows stay; a
    document labelled twice counts as toxic if one label says so. Rows without doc_id or label teach
    nothing; a null doc_id is not held out. Without both classes every score is the share of toxic
    labels, 0 if there are none. An empty table gives no rows. Other columns are not read.
    """
    model = train(docs, labels, rows, **bounds)
    text = text_of(docs)
    if model is None:
        share = labels.where("NOT (crc32(CAST(doc_id AS string)) % 5 = 0)").agg(F.avg("toxic")).first()[0] or 0.0
        value = F.lit(float(share))
    else:
        value = score_udf(docs.sparkSession, model)(text)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    out = docs.select("doc_id", held.alias("held_out"), value.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
