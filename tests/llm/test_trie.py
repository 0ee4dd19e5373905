"""The prefix trie against SQL and a plain walk over all prefixes."""

import hashlib
import random
import zlib

import pytest

from plumbline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, level string, saved int"


def brute(rows):
    held = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1]))] for c, v in held.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, members in nodes.items():
        below = [n for n in nodes if n[:len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in nodes)]
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(node))))
        out.add((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), sum(len(n) == len(node) + 1 for n in below),
                 len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made(seed, convs=60, alike=0):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for turn in range(rng.randrange(1, 9)):
            said = "same" if c < alike else rng.choice(["ja", "né", "", None, "oh"])
            rows.append((c * rng.choice([1, 1, 3]) if c % 7 == 0 else c, turn if turn else None, rng.choice(["user", None]) if c >= alike else "user", said, "x", 1))
    seen = {}
    return [r for r in rows if seen.setdefault((r[0], r[1]), r) is r]  # one row a turn: the order of equal turns is ours alone


@pytest.mark.parametrize("shard, queue, alike", [(4096, 100_000, 0), (2, 2, 0), (3, 1, 30)])
def test_brute_force(spark, shard, queue, alike):
    rows = made(shard, alike=alike)
    got = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), shard=shard, queue=queue, piece=7, salts=3).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows)


def test_empty_and_null_ids(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x", "", 0)], SCHEMA)).count() == 0


def test_conversation_without_turns(spark):
    c = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 3)
    rows = [(c, 0, "user", "only", "", 0)]
    got = [tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_repeated_and_tied_rows(spark):
    rows = [(0, 1, "user", t, "", 0) for t in ("b", "a", "a")] * 2
    one, two = (trie.conversation_trie(spark.createDataFrame(r, SCHEMA)).orderBy("depth").collect() for r in (rows, rows[::-1]))
    assert one == two and [r["depth"] for r in one] == list(range(7))


def test_long_text(spark):
    rows = [(0, 0, "user", "é" * 500_000, "", 0), (0, 1, "user", "x", "", 0), (1, 0, "user", "y", "", 0)]
    assert set(map(tuple, trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_queue_spills():
    queue, rng = trie.SpillingQueue(10), random.Random(1)
    values = [(rng.randrange(50), i) for i in range(500)]
    out = []
    for v in values[:300]:
        queue.push(v)
    out += [queue.pop() for _ in range(100)]
    assert out == sorted(values[:300])[:100]
    for v in values[300:]:
        queue.push(v)
    rest = []
    while queue.peek() is not None:
        rest.append(queue.pop())
    assert rest == sorted(sorted(values[:300])[100:] + values[300:]) and queue.runs


def test_sql(agrees):
    assert agrees("op11_conversation_prefix_trie") is None
