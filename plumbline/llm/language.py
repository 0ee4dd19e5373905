"""Language of web pages by Bayesian fusion of evidence.

A page's text, its declared markup language, its address (suffix of the host, language code in the
path) and its host speak for languages independently:

    log p(l | page) = log prior(l | host) + text(l) + log p(declared | l) + log p(suffix | l) + log p(path | l)

The text's likelihood comes from byte trigrams counted over all documents of known language, scaled
as if a page held ``EVIDENCE`` independent trigrams at most. How far declarations and addresses can
be trusted is counted from the pages themselves, weighted by what their texts say. Priors of hosts
are smoothed to those of their domain, and these to the corpus; a page's own weight is taken out of
its host's and domain's counts. All counts are grouped sums.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import LOWER, text_of
from plumbline.llm.extract import main_text
from plumbline.sources.staging import staged

CELLS = 1 << 15
EVIDENCE, STRENGTH, SMOOTH = 40.0, 5.0, 0.5
SIGNS = ("declared", "suffix", "path")


def trigrams(text: str):
    """Cells of all byte trigrams of a text, ASCII letters in lower case."""
    import numpy as np

    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _count(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    kind = pa.schema([("lang", pa.string()), ("cell", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        sums: dict = {}
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            own = sums.setdefault(lang, np.zeros(CELLS, np.int64))
            own += np.bincount(trigrams(text.as_py() or ""), minlength=CELLS)
        for lang, own in sums.items():
            cells = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells), pa.string()), pa.array(cells), pa.array(own[cells])], schema=kind)


def text_model(docs: DataFrame):
    """Languages in order and their log trigram probabilities, (languages, CELLS)."""
    import numpy as np

    rows = docs.where("lang IS NOT NULL").select(text_of(docs).alias("t"), F.col("lang").cast("string").alias("lang"))
    sums = rows.mapInArrow(_count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # CELLS rows a language at most
    langs = sorted(set(found["lang"].to_pylist()))
    place = {lang: i for i, lang in enumerate(langs)}
    table = np.full((len(langs), CELLS), 0.5)
    table[[place[x] for x in found["lang"].to_pylist()], found["cell"].to_numpy()] += found["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)) if langs else table


def _evidence(pages: DataFrame, langs: list[str], table) -> DataFrame:
    """Page rows with text likelihoods (a mean trigram's, scaled), what text alone says, and the signs. Written once."""
    import numpy as np
    import pyarrow as pa

    shared = pages.sparkSession.sparkContext.broadcast(table)

    def run(values: pa.Array) -> pa.Array:
        out = []
        for v in values:
            cells = trigrams(main_text(v.as_py() or ""))
            n = len(cells)
            own = shared.value[:, cells].mean(axis=1) * min(n, EVIDENCE) if n else np.zeros(len(shared.value))
            out.append((own - own.max()).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    likely = F.arrow_udf(run, "array<double>").asNondeterministic()
    url, html = F.lower(F.coalesce(pages["url"].cast("string"), F.lit(""))), text_of(pages, "html")
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)

    def code(value):  # short codes only: a bounded set of values
        return F.when(value.rlike("^[a-z]{2,3}$"), value).otherwise("")

    rows = pages.select(
        "page_id", "url", host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        code(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))).alias("declared"),
        code(F.regexp_extract(host, r"\.([^.]+)$", 1)).alias("suffix"),
        code(F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/]*/([a-z]{2,3})(?:[/?#_-]|$)", 1)).alias("path"), likely(html).alias("likely"))
    rows = rows.withColumn("e", F.transform("likely", F.exp))
    rows = rows.withColumn("says", F.expr("transform(e, x -> x / aggregate(e, 0D, (a, y) -> a + y))"))
    return staged(rows.drop("e"), "language")


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, lang, confidence, text_lang, declared, suffix, path.

    Languages are those of ``docs.lang``. A null address has the empty host, a null or empty page no
    text evidence; what is missing speaks for no language beyond what its own absence tells. Equal
    posteriors go to the first language in order. Documents without text or language teach nothing;
    without any language the result is null with confidence 0. Repeated rows stay. An empty table
    gives no rows. Other columns are not read.
    """
    langs, table = text_model(docs)
    signs = ("declared", "suffix", "path")
    if not langs:
        none = F.lit(None).cast("string")
        return pages.select("page_id", "url", none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), *[F.lit("").alias(s) for s in signs])
    rows, n = _evidence(pages, langs, table), range(len(langs))

    def sums(by, name):
        found = rows.groupBy(*by).agg(*[F.sum(F.col("says")[i]).alias(f"s{i}") for i in n])
        return found.select(*by, F.array(*[F.col(f"s{i}") for i in n]).alias(name))

    total = rows.agg(*[F.sum(F.col("says")[i]) for i in n]).first()
    if total[0] is None:
        total = [0.0 for _ in n]
    every = sum(total)
    corpus = F.array(*[F.lit((total[i] + SMOOTH) / (every + SMOOTH * len(langs))) for i in n])
    for sign in signs:
        values = sums([sign], f"of_{sign}")
        kinds = max(1, values.count())
        spread = [total[i] + SMOOTH * kinds for i in n]
        value = F.array(*[F.log((F.col(f"of_{sign}")[i] + SMOOTH) / spread[i]) for i in n])
        # at most 26 * 26 * 27 codes and the empty one
        rows = rows.join(F.broadcast(values.select(sign, value.alias(f"of_{sign}"))), sign)
    hosts, domains = sums(["host"], "of_host"), sums(["domain"], "of_domain")
    rows = rows.join(hosts, "host").join(domains, "domain")
    corpus_prior = "of_corpus"
    rows = rows.withColumn(corpus_prior, corpus)

    def smoothed(counts, above):
        """Counts without the page's own weight, drawn to the level above."""
        left = f"zip_with({counts}, says, (c, s) -> greatest(c - s, 0D))"
        return F.expr(f"transform(zip_with({left}, {above}, (c, p) -> c + {STRENGTH}D * p), x -> x / (aggregate({left}, 0D, (a, y) -> a + y) + {STRENGTH}D))")

    rows = rows.withColumn("prior_domain", smoothed("of_domain", corpus_prior))
    rows = rows.withColumn("prior", smoothed("of_host", "prior_domain"))
    fused = F.array(*[F.log(F.col("prior")[i]) + F.col("likely")[i] + sum(F.col(f"of_{s}")[i] for s in signs) for i in n])
    rows = rows.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    names = F.array(*[F.lit(x) for x in langs])

    def first_of(values, top):
        return F.element_at(names, F.array_position(values, top).cast("int"))

    rows = rows.withColumn("confidence", F.expr("1 / aggregate(fused, 0D, (a, x) -> a + exp(x - top))"))
    return rows.select("page_id", "url", first_of(F.col("fused"), F.col("top")).alias("lang"), "confidence",
                       first_of(F.col("likely"), F.array_max("likely")).alias("text_lang"), *signs)
