"""Chat formatting in budgeted windows, with DataFrame functions only.

Every turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n`` with control characters escaped. A window
has ``target`` tokens at most. It repeats the conversation's first system turn, wherever that stands,
and the turns of the last ``history`` tokens before it as context; what these leave of the budget is
for new turns. Prefix sums of the turns' tokens cut a conversation at multiples of that rest: turns
that lie between two cuts form a window, a turn across a cut forms its own. Only assistant texts that
are targets of their window are under the loss mask, so every one of them is learned once.

A system turn of more than ``system`` tokens is repeated by its beginning only; where it stands it is
whole. One turn longer than the budget's rest makes a window of its own that is longer than ``target``.

A conversation of any length is spread out: prefix sums are taken in ranges of ``RANGE`` turn
numbers and over the ranges' totals, and context is found by a join on (conversation, cut range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TARGET, HISTORY, SYSTEM = 1024, 256, 256
RANGE = 1024
TURN_TOKENS = 4  # of the marks around a text
START, STOP = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    """No ``<``, ``[`` or line end of a role is left; every backslash starts a pair."""
    for plain, code in (("\\", "\\s"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for code, plain in (("\\b", "["), ("\\l", "<"), ("\\n", "\n"), ("\\s", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def tokens_of(text: Column) -> Column:
    """Tokens without a tokenizer: four bytes each, and the marks."""
    return (F.ceil(F.octet_length(text) / 4) + TURN_TOKENS).cast("long")


def _turns(rows: DataFrame, target: int, history: int, system: int) -> DataFrame:
    """Turns with their text, first token, budget and window, in the order of turn, role and the text's digest."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    t = rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("digest", F.md5("text"))
    t = t.withColumn("tokens", tokens_of(F.col("text"))).withColumn("part", F.floor(F.coalesce("turn", F.lit(-1)) / RANGE))
    totals = t.groupBy("conv_id", "part").agg(F.sum("tokens").alias("total"))
    before = F.sum("total").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("conv_id", "part", F.coalesce(before, F.lit(0)).alias("before"))
    first = t.where("role = 'system'").groupBy("conv_id").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "digest", "tokens")).alias("s"))
    totals = totals.join(first.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    own = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "digest").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("ahead", F.coalesce(F.sum("tokens").over(own), F.lit(0)))
    t = t.alias("t").join(totals.alias("s"), F.col("t.conv_id").eqNullSafe(F.col("s.conv_id")) & F.col("t.part").eqNullSafe(F.col("s.part")))
    is_system = F.coalesce((F.col("role") == "system") & F.col("turn").eqNullSafe(F.col("s.s.turn")) & (F.col("digest") == F.col("s.s.digest")), F.lit(False))
    t = t.select("t.conv_id", "role", "text", "tokens", (F.col("before") + F.col("ahead")).alias("start"), is_system.alias("is_system"),
                 (target - history - F.least(F.coalesce("s.s.tokens", F.lit(0)), F.lit(system))).alias("room"))
    first, last = F.floor(F.col("start") / F.col("room")), F.floor((F.col("start") + F.col("tokens") - 1) / F.col("room"))
    return t.select("conv_id", "role", "text", "is_system", "room", "start", (F.col("start") + F.col("tokens")).alias("stop"), first.alias("cut"),
                    (2 * first + F.when(first < last, 1).otherwise(0)).alias("window"))


def _marked(text: Column) -> list[Column]:
    """A turn's marked text, and the length of the part before its own text."""
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    return [F.concat(head, escaped(text), F.lit(STOP)).alias("marked"), F.length(head).alias("head")]


def windows(rows: DataFrame, target: int = TARGET, history: int = HISTORY, system: int = SYSTEM) -> DataFrame:
    """One row per window: conv_id, window, n_context, n_targets, formatted, loss.

    ``loss`` holds the spans ``(start, length)``, in code points of ``formatted``, of the escaped
    assistant texts to learn. The first ``n_context`` turns of a window are repeated from before.
    A window has at most ``target`` tokens with its context, but for a window of one long turn.

    Null texts and roles count as empty; rows without conv_id form one conversation, a null turn
    comes first. Rows that share a turn number are ordered by role and the text's digest, and repeated
    rows stay turns of their own; repeats of the system turn are no history. An empty table gives no
    rows. Other columns are not read.
    """
    if history < 0 or system < TURN_TOKENS or history + system >= target:
        raise ValueError("history and system must be within the target, and system hold a turn's marks")
    t = _turns(rows, target, history, system)
    heads = t.groupBy("conv_id", "window").agg(F.min("start").alias("from"), F.max("room").alias("room"))
    # The cut ranges that hold the turns which a window may repeat.
    need = F.sequence(F.floor(F.greatest(F.col("from") - history, F.lit(0)) / F.col("room")), F.floor((F.col("from") - 1) / F.col("room")))
    wanted = heads.where("from > 0").select("conv_id", F.col("window").alias("into"), "from", F.explode(need).alias("cut"))
    a, b = t.where("NOT is_system").alias("a"), wanted.alias("b")
    old = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.cut") == F.col("b.cut")))
    old = old.where((F.col("a.stop") <= F.col("b.from")) & (F.col("a.start") >= F.col("b.from") - history))
    old = old.select("a.conv_id", F.col("b.into").alias("window"), F.lit(1).alias("kind"), "start", *_marked(F.col("text")), F.lit(False).alias("learn"))
    first = t.where("is_system").groupBy("conv_id").agg(F.min("window").alias("own"), F.min("start").alias("start"), F.first("role").alias("role"), F.first("text").alias("text"))
    short = F.when(tokens_of(F.col("text")) > system, F.left("text", F.lit(system - TURN_TOKENS))).otherwise(F.col("text"))
    first = first.select("conv_id", "own", "start", *_marked(short)).alias("y")
    later = heads.alias("h").join(first, F.col("h.conv_id").eqNullSafe(F.col("y.conv_id")) & (F.col("h.window") > F.col("y.own")))
    later = later.select("h.conv_id", "h.window", F.lit(0).alias("kind"), "y.start", "y.marked", "y.head", F.lit(False).alias("learn"))
    now = t.select("conv_id", "window", F.lit(2).alias("kind"), "start", *_marked(F.col("text")), (F.col("role") == "assistant").alias("learn"))
    turns = F.array_sort(F.collect_list(F.struct("kind", "start", "marked", "head", "learn")))
    parts = now.unionByName(old).unionByName(later).groupBy("conv_id", "window").agg(turns.alias("turns"))
    spans = F.expr(f"""
        aggregate(turns, struct(0L AS at, cast(array() AS array<struct<start:bigint,length:bigint>>) AS spans),
          (a, x) -> struct(a.at + length(x.marked) AS at,
            if(x.learn, array_append(a.spans, struct(a.at + x.head AS start,
               cast(length(x.marked) - x.head - {len(STOP)} AS bigint) AS length)), a.spans) AS spans)).spans""")
    return parts.select(
        "conv_id", "window", F.expr("size(filter(turns, x -> x.kind < 2))").alias("n_context"),
        F.expr("size(filter(turns, x -> x.kind = 2))").alias("n_targets"),
        F.concat_ws("", F.col("turns.marked")).alias("formatted"), spans.alias("loss"))


def read_back(made: DataFrame) -> DataFrame:
    """Per window what the formatted text says: its target turns as role, text lines, and the text to learn."""
    each = F.slice(F.split("formatted", r"<\|im_start\|>"), F.col("n_context") + 2, F.col("n_targets"))
    lines = F.transform(each, lambda x: F.concat(
        unescaped(F.substring_index(x, "\n", 1)), F.lit("\n"),
        unescaped(x.substr(F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x) - F.length(F.substring_index(x, "\n", 1)) - 1 - len(STOP))), F.lit("\n")))
    learned = F.transform("loss", lambda s: unescaped(F.col("formatted").substr(s["start"].cast("int") + 1, s["length"].cast("int"))))
    return made.select("conv_id", "window", "n_targets", F.concat_ws("", lines).alias("lines"), F.concat_ws("", learned).alias("learned"),
                       F.length("formatted").alias("chars"))


def digests(made: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows; repeated context counts as characters only.

    A digest of a whole conversation needs its whole text in one row, which Spark bounds at 2 GB;
    the windows themselves have no such bound.
    """
    parts = read_back(made).groupBy("conv_id").agg(
        F.sum("n_targets").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "lines", "learned"))).alias("w"))
    loss = F.concat_ws("", F.col("w.learned"))
    return parts.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(F.concat_ws("", F.col("w.lines")), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
