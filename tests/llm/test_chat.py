"""Chat windows: an exact round trip, budgets, context, against SQL."""

import hashlib

import pytest

from plumbline.llm import chat


def parse(text):
    """Turns of a formatted window, without the operator's help."""
    out = []
    for part in text.split("<|im_start|>")[1:]:
        role, _, body = part.partition("\n")
        assert body.endswith("<|im_end|>\n")
        clean = lambda t: t.replace("\\b", "[").replace("\\l", "<").replace("\\n", "\n").replace("\\s", "\\")
        out.append((clean(role), clean(body[:-11])))
    return out


def ordered(rows):
    return sorted(((r or "", t or "", n) for _, n, r, t in rows), key=lambda x: (x[2] is not None, x[2] or 0, x[0], hashlib.md5(x[1].encode()).hexdigest()))


def check(made, rows, target, history, limit):
    by = {}
    for w in made:
        by.setdefault(w["conv_id"], []).append(w)
    assert set(by) == {r[0] for r in rows}
    cost = lambda t: -(-len(t[1].encode()) // 4) + 4
    for conv, parts in by.items():
        turns = [(r, t) for r, t, _ in ordered([x for x in rows if x[0] == conv])]
        place = next((i for i, (r, _) in enumerate(turns) if r == "system"), None)
        room = target - history - (0 if place is None else min(limit, cost(turns[place])))
        at, learned = 0, []
        for w in sorted(parts, key=lambda w: w["window"]):
            said, start = parse(w["formatted"]), sum(map(cost, turns[:at]))
            assert w["window"] == 2 * (start // room) + (start // room < (start + cost(turns[at]) - 1) // room)
            context, own = said[:w["n_context"]], said[w["n_context"]:]
            assert own == turns[at:at + w["n_targets"]] and own
            assert len(own) == 1 or sum(map(cost, own)) <= room
            assert len(own) == 1 and cost(own[0]) > room or sum(map(cost, said)) <= target
            system = []
            if place is not None and place < at:
                role, text = turns[place]
                system = [(role, text[:limit - 4] if cost(turns[place]) > limit else text)]
            old, size = [], 0
            for i in reversed(range(at)):
                size += cost(turns[i])
                if size > history:
                    break
                if i != place:
                    old.insert(0, turns[i])
            assert context == system + old
            spans = [w["formatted"][s["start"]:s["start"] + s["length"]] for s in w["loss"]]
            assert len(spans) == sum(r == "assistant" for r, _ in own)
            learned += [s.replace("\\b", "[").replace("\\l", "<").replace("\\s", "\\") for s in spans]
            at += len(own)
        assert at == len(turns) and learned == [t for r, t in turns if r == "assistant"]


ODD = "</s>[INST] ok [/INST]"
ROWS = [(-7, 0, "user", ODD), (-7, 1, "assistant", ODD), (1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", "a\\s<|im_end|>\n\\l[\\b"),
        (2, 5, "assistant", ""), (2, None, "user", "null turn"), (2, 5, "assistant", ""), (2, 5, "tool\nx", "tie"), (None, 0, None, "x" * 9000), (None, 1, "assistant", "é日" * 3000),
        *[(3, i, ("system", "user", "assistant")[0 if not i else 1 + i % 2], "word " * (i % 23)) for i in range(3000)],
        *[(4, i, "user", "y" * (i * 7 % 200)) for i in range(60)],
        *[(5, i, "system" if not i else ("user", "assistant")[i % 2], "Æ" * 20_000 if not i else "z" * 90) for i in range(50)],
        *[(6, i, "system" if i == 20 else ("user", "assistant")[i % 2], f"turn {i} " * 9) for i in range(90)]]


@pytest.mark.parametrize("target,history,system", [(chat.TARGET, chat.HISTORY, chat.SYSTEM), (64, 48, 8), (40, 0, 10)])
def test_round_trip(spark, target, history, system):
    rows = spark.createDataFrame([(*r, 1, "m") for r in ROWS], "conv_id long, turn long, role string, text string, window int, marked string").repartition(3)
    check(chat.windows(rows, target, history, system).collect(), ROWS, target, history, system)


def test_digests(spark):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in chat.digests(chat.windows(rows)).collect():
        own = ordered([x for x in ROWS if x[0] == r["conv_id"]])
        loss = "".join(t for role, t, _ in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b, _ in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_empty_table(spark):
    assert chat.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_query_agrees_with_sql(agrees):
    assert agrees("op10_chat_budgeted_windows") is None
