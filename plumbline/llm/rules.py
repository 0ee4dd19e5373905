"""Quality rules as a ledger: every rule is judged once and kept as a bit beside its measurements.

Policies are versioned sets of bits. Applying one is ``failed & policy = 0``, so a new policy or an
ablation reads the ledger only and never the texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import fresh, per_value, text_of

WINDOW = 5
SYMBOLS = re.compile(r"[#*$%&|<>]")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[^\W_]")
LONG_WORD = 40  # code points
# Fixed: letters of scripts written without blanks between words (Thai, Lao, Tibetan, Myanmar, Khmer, Kana, Han), as ranges of code points.
NO_BLANKS = [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
_NO_BLANKS = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NO_BLANKS) + "]")

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, n_marked_words bigint, longest_word bigint, n_long_words bigint")

# Name and condition of each rule; its place is its bit and never changes, new rules go to the end.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("long_words", "word_chars > 20 * n_words"),
    ("few_letters", "10 * n_marked_words < 8 * n_words"),
    ("huge_word", "longest_word > 1000"),
    ("long_word_share", "10 * n_long_words > n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]

# A policy once published keeps its bits; a change is a new version.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["long_words"] | BIT["few_letters"] | BIT["huge_word"],
    # word length as a share of the words, and only where words are set apart by blanks: one long address
    # or a text in Han letters is no fault
    "v2": BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["few_letters"] | BIT["long_word_share"],
}
CURRENT = "v2"


def measure(text: str) -> dict:
    """All measurements of a whole text."""
    words = _WORDS.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(SYMBOLS.findall(text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "n_marked_words": sum(1 for w in words if _MARK.search(w)),
        "longest_word": max(map(len, words), default=0),
        "n_long_words": sum(1 for w in words if len(w) > LONG_WORD and "://" not in w and not _NO_BLANKS.search(w)),
    }


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of five words found at least twice."""
    last = len(words) - WINDOW
    if last < 1:
        return 0
    line, at, starts = " ".join(words), 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    windows = [line[s:e] for s, e in zip(starts, [*(s - 1 for s in starts[WINDOW:]), len(line)])]
    if len(set(windows)) == len(windows):
        return 0
    first: dict[str, int] = {}
    twice = set()
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            twice.add(i)
            twice.add(j)
    hit, until = 0, 0
    for i in sorted(twice):
        hit += i + WINDOW - max(i, until)
        until = i + WINDOW
    return hit


def failed_bits(measures: str) -> Column:
    """The bits of all rules that fail, from the struct column ``measures``."""
    def of(condition):
        return re.sub(r"\b([a-z_]+)\b", rf"{measures}.\1", condition)
    return F.expr(" + ".join(f"if({of(rule)}, {BIT[name]}L, 0L)" for name, rule in RULES))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, all measurements and ``failed`` (bigint bitmask) for every row.

    Null text counts as empty, which has no words and fails ``few_words``. Repeated rows stay. An
    empty table gives no rows. No other column is read.
    """
    m = per_value(measure, f"struct<{MEASURES}>", deterministic=False)(text_of(docs, text))
    return docs.select("doc_id", m.alias("m")).select("doc_id", "m.*", failed_bits("m").alias("failed"))


def judged(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with the verdict of a policy: ``kept``."""
    return rows.withColumn("kept", F.expr(f"failed & {POLICIES[policy]}L = 0"))


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: rows failing it, rows only it rejects, rows kept without it.

    One aggregate over the ledger's bits; every figure is a sum of bitwise tests.
    """
    bits = [(name, BIT[name]) for name, _ in RULES if POLICIES[policy] & BIT[name]]
    active = f"(failed & {POLICIES[policy]}L)"
    sums = [F.expr(f"count_if({active} & {bit}L != 0)").alias(f"f{bit}") for _, bit in bits]
    sums += [F.expr(f"count_if({active} = {bit}L)").alias(f"o{bit}") for _, bit in bits]
    total = rows.agg(F.expr(f"count_if({active} = 0)").alias("kept"), *sums)
    each = [F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit"), F.col(f"f{bit}").alias("n_failed"),
                     F.col(f"o{bit}").alias("n_only"), (F.col("kept") + F.col(f"o{bit}")).alias("n_kept_without")) for name, bit in bits]
    return total.select(F.explode(F.array(*each)).alias("r")).select("r.*")


def keep_good(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their columns."""
    name = fresh(docs, "measures")
    m = per_value(measure, f"struct<{MEASURES}>", deterministic=False)(text_of(docs, text))
    good = docs.withColumn(name, m).where((failed_bits(name).bitwiseAND(F.lit(POLICIES[policy]).cast("long"))) == 0)
    return good.select(*[F.col(f"`{c}`") for c in docs.columns])
