"""Personal data and the terms that give it away, with DataFrame functions only.

Base spans come from patterns. On top, information-theoretic sanitisation: a protected entity (an
address, a number) held by ``df_entity`` of ``N`` different texts carries ``log(N / df_entity)`` of
information. A term that ``df_pair`` of its ``df_term`` texts share with the entity reveals
``log(N * p / df_entity)`` of that, where ``p`` is the lower end of Wilson's 95 % interval for the share
``df_pair / df_term``. Terms with ``p`` of at least ``EVEN`` whose part of the entity's information
exceeds ``GENERALISE`` are generalised, beyond ``REMOVE`` removed, in every text that holds the entity.

The interval makes evidence count: of one meeting p is 0.27, of two 0.43, of three 0.53, in a corpus of
any size. So a word that stands in one or two texts only is left alone, and so are all words around an
entity of one or two texts. Texts are told apart by digest: copies are one text and prove nothing.

Within a text, entities and terms do not meet one by one: entities that are held by the same texts form
a class, terms too, and classes meet, so a list of thousands of addresses is one class. All counts are
grouped sums over all documents with map-side combine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import fresh, text_of
from plumbline.sources.staging import staged

KINDS = ("email", "ip", "card", "phone")
Z = 1.6448536269514722  # of a one-sided interval of 95 %
EVEN = 0.5
GENERALISE, REMOVE = 0.8, 0.95
LEAST_TEXTS = math.ceil(Z * Z * EVEN / (1 - EVEN))  # fewer meetings never reach EVEN

# Fixed by the contract. Possessive forms find the same leftmost matches without going back, in
# linear time: a local part or a digit run can only begin where the run begins or the last match
# ended; a run of under 14 digits can be no card, whatever part of it is tried.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LUHN = """aggregate(sequence(1, length(d)), 0, (s, i) -> s + if(i % 2 = 1, int(substring(d, -i, 1)),
    if(int(substring(d, -i, 1)) > 4, 2 * int(substring(d, -i, 1)) - 9, 2 * int(substring(d, -i, 1))))) % 10 = 0"""
_DIGITS = "regexp_replace(x.found, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": rf"x.found rlike '^{_PART}(?:[.]{_PART}){{3}}$'",
    "card": f"length({_DIGITS}) between 14 and 19 and exists(array({_DIGITS}), d -> {_LUHN})",
    "phone": f"length({_DIGITS}) between 10 and 15",
}
# Cheap signs without which a pattern cannot match.
_SIGN = {"email": "contains({t}, '@')", "ip": "{t} rlike '[0-9][.][0-9]'", "card": "{t} rlike '[0-9](?:[ -]?[0-9]){{13}}'", "phone": "contains({t}, '+')"}

_SPAN = "struct<start:bigint,kind_no:int,stop:bigint,kind:string,found:string>"


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _placed(kind: str, m: str, p: str) -> str:
    """Valid spans of one kind from its matches ``m`` and the pieces ``p`` between them.

    There is one more piece than there are matches, and one after the other they are the text, so
    the folded lengths are the places.
    """
    return f"""
      filter(aggregate(if(size({m}) = 0, cast(array() AS array<int>), sequence(0, size({m}) - 1)),
        struct(0L AS at, cast(array() AS array<{_SPAN}>) AS spans),
        (a, i) -> struct(a.at + length({p}[i]) + length({m}[i]) AS at,
          array_append(a.spans, struct(a.at + length({p}[i]) AS start, {KINDS.index(kind)} AS kind_no, a.at + length({p}[i]) + length({m}[i]) AS stop,
            '{kind}' AS kind, {m}[i] AS found)) AS spans)).spans,
        x -> {VALID[kind]})"""


def detected(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with the sorted base spans of its column ``text`` (null counts as empty) in the column ``into``."""
    t, columns = fresh(df, "pii_text"), df.columns
    found = {kind: fresh(df, f"pii_m_{kind}") for kind in KINDS}
    pieces = {kind: fresh(df, f"pii_p_{kind}") for kind in KINDS}
    none = "cast(array() AS array<string>)"
    df = df.withColumn(t, text_of(df, text))
    df = df.withColumns({found[k]: F.expr(f"if({_SIGN[k].format(t=t)}, regexp_extract_all({t}, {_quoted(PATTERNS[k])}, 0), {none})") for k in KINDS})
    df = df.withColumns({pieces[k]: F.expr(f"if(size({found[k]}) > 0, split({t}, {_quoted(PATTERNS[k])}, -1), {none})") for k in KINDS})
    every = F.array_sort(F.expr(f"concat({', '.join(_placed(k, found[k], pieces[k]) for k in KINDS)})"))
    return df.select(*[F.col(f"`{c}`") for c in columns], every.alias(into))


def _entity(x: str) -> str:
    """An entity's name: its kind with the address in lower case or the digits alone."""
    return f"concat({x}.kind, ':', if({x}.kind = 'email' or {x}.kind = 'ip', lower({x}.found), regexp_replace({x}.found, '[^0-9]', '')))"


def evidence(docs: DataFrame, text: str = "text") -> DataFrame:
    """Written once: doc_id, base spans, and for documents with any: the text, its key and its entities.

    The key of a text is its digest, so copies share what is found in them.
    """
    found = detected(docs.select("doc_id", text_of(docs, text).alias("text")), "text", "base")
    some = F.size("base") > 0
    base = F.expr("transform(base, x -> struct(x.start AS start, x.kind_no AS kind_no, x.stop AS stop, x.kind AS kind))")
    entities = F.expr(f"array_distinct(transform(base, x -> {_entity('x')}))")
    return staged(found.select("doc_id", base.alias("base"), F.when(some, F.md5("text")).alias("key"), F.when(some, F.col("text")).alias("text"),
                               F.when(some, entities).alias("entities")), "evidence")


def _words(text: Column) -> Column:
    return F.explode(F.filter(F.array_distinct(F.split(F.lower(text), r"\P{L}+")), lambda w: F.length(w) >= 3))


def _lower_bound(hits: Column, of: Column) -> Column:
    """The lower end of Wilson's interval for ``hits`` of ``of``."""
    share, zz = hits / of, Z * Z
    return (share + zz / (2 * of) - Z * F.sqrt(share * (1 - share) / of + zz / (4 * of * of))) / (1 + zz / of)


def _classes(df: DataFrame, name: str) -> DataFrame:
    """``df(key, name)`` with ``texts``, the number of keys of each name, and ``class``, equal for names with the same keys."""
    sets = df.groupBy(name).agg(F.count(F.lit(1)).alias("texts"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("one"),
                                F.bit_xor(F.xxhash64("key", F.lit(1))).alias("two"))
    return sets.select(name, "texts", F.xxhash64("texts", "one", "two").alias("class"), F.col("two").alias("class2"))


def disclosed(docs: DataFrame, found: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(key, term, action)``: per different text that holds an entity, its terms that reveal more of one than allowed.

    Also ``(key, text)`` of these texts, their base spans blanked out."""
    total = docs.select(F.md5(text_of(docs, text))).distinct().count()
    n = F.lit(float(total))
    held = staged(found.where("key IS NOT NULL").select("key", F.explode("entities").alias("entity")).distinct(), "held")
    # Entities of fewer texts reach no evidence, whatever stands beside them.
    of_entity = _classes(held, "entity").where((F.col("texts") >= LEAST_TEXTS) & (F.col("texts") < total))
    held = held.join(of_entity, "entity").select("key", F.col("class").alias("e1"), F.col("class2").alias("e2"), F.col("texts").alias("df_entity")).distinct()
    held = staged(held, "held_classes")
    # one row of each text that matters, its entities blanked out
    most = held.groupBy("key").agg(F.max("df_entity").alias("most"))
    outside = F.expr("""
      aggregate(base, struct(0L AS at, '' AS done),
        (a, x) -> if(x.start >= a.at, struct(x.stop AS at, concat(a.done, substring(text, int(a.at) + 1, int(x.start - a.at)), repeat(' ', int(x.stop - x.start))) AS done),
                     struct(greatest(a.at, x.stop) AS at, concat(a.done, repeat(' ', int(greatest(0, x.stop - a.at)))) AS done)),
        a -> concat(a.done, substring(text, int(a.at) + 1)))""")
    texts = found.where("key IS NOT NULL").join(most, "key").groupBy("key").agg(F.first("text").alias("text"), F.first("base").alias("base"), F.first("most").alias("most"))
    texts = staged(texts.select("key", "most", outside.alias("text")), "held_texts")
    terms = staged(texts.select("key", "most", _words(F.col("text")).alias("term")), "held_terms")
    # What is counted over all texts joins what is wanted: both hold every term once.
    once = docs.select(text_of(docs, text).alias("text")).groupBy(F.md5("text").alias("key")).agg(F.first("text").alias("text"))
    df_term = once.select(_words(F.col("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_term"))
    limits = terms.groupBy("term").agg(F.max("most").alias("limit"))
    wanted = limits.join(df_term, "term").where(F.col("df_term") * EVEN <= F.col("limit"))  # else no entity of these texts reaches EVEN
    wanted = staged(wanted.join(_classes(terms, "term"), "term").select("term", "df_term", F.xxhash64("class", "df_term").alias("t1"), F.col("class2").alias("t2")), "terms")
    terms = staged(terms.select("key", "term").join(wanted, "term"), "rare_terms")
    pairs = terms.select("key", "t1", "t2", "df_term").distinct().join(held, "key").where(F.col("df_term") * EVEN <= F.col("df_entity"))
    pairs = staged(pairs, "pairs")
    judged = pairs.groupBy("e1", "e2", "t1", "t2").agg(F.count(F.lit(1)).alias("df_pair"), F.max("df_term").alias("df_term"), F.max("df_entity").alias("df_entity"))
    # df_term counts a text in which the term stands within an entity only, df_pair does not
    judged = judged.withColumn("p", _lower_bound(F.col("df_pair"), F.col("df_term"))).where(F.col("p") >= EVEN)
    judged = judged.withColumn("share", F.log(n * F.col("p") / F.col("df_entity")) / F.log(n / F.col("df_entity"))).where(F.col("share") >= GENERALISE)
    action = F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise")
    risky = pairs.join(judged.select("e1", "e2", "t1", "t2", action.alias("action")), ["e1", "e2", "t1", "t2"]).groupBy("key", "t1", "t2").agg(F.max("action").alias("action"))
    return terms.join(risky, ["key", "t1", "t2"]).select("key", "term", "action"), texts


def revealed(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """``(key, extra)``: per different text the spans of its revealing terms outside of base spans."""
    hits, texts = disclosed(docs, found, text)
    hits = staged(hits, "disclosed")
    tokens = texts.join(hits.select("key").distinct(), "key").select("key", F.expr(r"regexp_extract_all(text, r'\p{L}+', 0)").alias("m"), F.expr(r"split(text, r'\p{L}+', -1)").alias("p"))
    # a token's place is the length of all before it: a running sum over rows, so a long text stays linear
    tokens = tokens.select("key", "m", F.expr("slice(p, 1, size(m))").alias("p")).select("key", F.posexplode(F.arrays_zip("m", "p")).alias("i", "x"))
    tokens = tokens.select("key", "i", F.length("x.p").cast("long").alias("gap"), F.length("x.m").cast("long").alias("size"), F.lower("x.m").alias("term"))
    stop = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("key").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    spans = tokens.withColumn("stop", stop).join(hits, ["key", "term"])
    gone = F.col("action") == "remove"
    span = F.struct((F.col("stop") - F.col("size")).alias("start"), (F.lit(len(KINDS)) + gone.cast("int")).alias("kind_no"), "stop",
                    F.when(gone, "removed_term").otherwise("term").alias("kind"))
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(span)).alias("extra"))


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.stop)), ',')"


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms.

    ``spans`` lists all spans by start as kind:start:end in code points, the end exclusive.

    Null text counts as empty. Repeated rows stay. An empty table gives no rows. No other column is
    read. A null doc_id is kept and means nothing to the method.
    """
    found = evidence(docs, text)
    extra = staged(revealed(docs, found, text), "extra")
    # rows without findings have no key and need no join, where they would all meet
    some = found.where("key IS NOT NULL").select("doc_id", "base", "key").join(extra, "key", "left")
    none = found.where("key IS NULL").select("doc_id", "base").withColumn("extra", F.lit(None).cast(extra.schema["extra"].dataType))
    both = some.select("doc_id", "base", "extra").unionByName(none).withColumn("extra", F.expr("coalesce(extra, array())"))
    every = F.array_sort(F.concat("base", "extra"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) AS bigint)").alias(f"n_{kind}") for kind in KINDS]
    return both.withColumn("every", every).select(
        "doc_id", *counts, F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"), F.expr(_joined("every")).alias("spans"),
        F.size("extra").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by ``[KIND]``, revealing terms by ``[TERM]`` or nothing.

    Rows, order of columns and texts without findings stay as they are; a null text stays null.
    """
    key, extra, base = fresh(docs, "pii_key"), fresh(docs, "pii_extra"), fresh(docs, "pii_base")
    found = evidence(docs, text)
    terms = staged(revealed(docs, found, text).select(F.col("key").alias(key), F.col("extra").alias(extra)), "extra")
    # texts without findings are spread by their own digest
    marked = detected(docs, text, base).withColumn(key, F.coalesce(F.md5(text), F.lit(""))).join(terms, key, "left")
    plain = f"transform(`{base}`, x -> struct(x.start AS start, x.kind_no AS kind_no, x.stop AS stop, x.kind AS kind))"
    every = f"array_sort(concat({plain}, coalesce(`{extra}`, array())))"
    label = "case x.kind when 'removed_term' then '' else concat('[', upper(x.kind), ']') end"
    # A span that begins inside what is already replaced only moves the end.
    clean = F.expr(f"""
      aggregate({every}, struct(0L AS at, '' AS done),
        (a, x) -> if(x.start >= a.at, struct(x.stop AS at, concat(a.done, substring(`{text}`, int(a.at) + 1, int(x.start - a.at)), {label}) AS done),
                     struct(greatest(a.at, x.stop) AS at, a.done AS done)),
        a -> concat(a.done, substring(`{text}`, int(a.at) + 1)))""")
    touched = (F.size(base) > 0) | F.col(extra).isNotNull()
    return marked.select(*[F.when(touched, clean).otherwise(F.col(f"`{text}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
