"""Language fusion against the same sums in plain Python, and on all pages."""

import math

from plumbline.llm import language
from plumbline.llm.extract import main_text

DOCS = [(1, "the cat and the dog were here with that thing", "en"), (2, "der hund und die katze sind nicht hier", "de"), (3, "le chat et le chien ne sont pas ici", "fr"),
        (4, None, "en"), (5, "no language", None)]
PAGE = '<html lang="{}"><body><p>{}</p></body></html>'
PAGES = [(1, "http://a.x.de/de/1", PAGE.format("de-DE", "der hund ist nicht die katze")), (2, "http://a.x.de/en/2", PAGE.format("en", "the dog and that cat")),
         (3, "http://b.x.de/", PAGE.format("de", "der")), (4, None, None), (4, None, None), (5, "not a url", "<p>le chien et le chat</p>"), (None, "https://y.fr?q", PAGE.format("xx9", "le")),
         (6, "http://a.x.de/3", PAGE.format("de", "und die " * 20_000)), (7, "http://z.com:80/fr/", PAGE.format("fr", ""))]
SIGNS = {1: ("de", "", "de"), 2: ("en", "", "en"), 3: ("de", "", ""), 6: ("de", "", ""), 7: ("fr", "com", "fr"), None: ("xx", "fr", ""), 4: ("", "", ""), 5: ("", "", "")}


def test_against_plain_sums(spark):
    docs = spark.createDataFrame([(*r, 1) for r in DOCS], "doc_id long, text string, lang string, says int")
    pages = spark.createDataFrame([(*r, "h", "l") for r in PAGES], "page_id long, url string, html string, host string, lang string").repartition(3)
    got = sorted(map(tuple, language.identify(pages, docs).collect()), key=str)
    langs = ["de", "en", "fr"]
    counts = {x: [0.5] * language.CELLS for x in langs}
    for _, t, x in DOCS:
        for c in language.trigrams(t or "") if x else ():
            counts[x][c] += 1
    logs = {x: [math.log(v / sum(c)) for v in c] for x, c in counts.items()}
    rows = []
    for page, url, source in PAGES:
        cells = language.trigrams(main_text(source or "")).tolist()
        own = [sum(logs[x][c] for c in cells) / max(1, len(cells)) * min(len(cells), language.EVIDENCE) for x in langs]
        own = [v - max(own) for v in own]
        says = [math.exp(v) / sum(map(math.exp, own)) for v in own]
        host = {1: "a.x.de", 2: "a.x.de", 3: "b.x.de", 6: "a.x.de", 7: "z.com", None: "y.fr"}.get(page, "")
        declared, suffix, path = SIGNS[page]
        suffix = host.rsplit(".", 1)[1] if host else ""
        rows.append((page, url, host, ".".join(host.split(".")[-2:]), (declared, suffix, path), own, says))
    total = [sum(r[6][i] for r in rows) for i in range(3)]
    s, k = language.SMOOTH, language.STRENGTH
    corpus = [(t + s) / (sum(total) + 3 * s) for t in total]
    want = []
    for page, url, host, domain, signs, own, says in rows:
        prior = corpus
        for same in ([r for r in rows if r[3] == domain], [r for r in rows if r[2] == host]):
            left = [max(0.0, sum(r[6][i] for r in same) - says[i]) for i in range(3)]
            prior = [(left[i] + k * prior[i]) / (sum(left) + k) for i in range(3)]
        fused = [math.log(prior[i]) + own[i] for i in range(3)]
        for j in range(3):
            kinds = len({r[4][j] for r in rows})
            for i in range(3):
                fused[i] += math.log((sum(r[6][i] for r in rows if r[4][j] == signs[j]) + s) / (total[i] + s * kinds))
        top = max(fused)
        want.append((page, url, langs[fused.index(top)], 1 / sum(math.exp(f - top) for f in fused), langs[own.index(max(own))], *signs))
    for a, b in zip(got, sorted(want, key=str), strict=True):
        assert a[:3] == b[:3] and a[4:] == b[4:] and math.isclose(a[3], b[3], abs_tol=1e-9)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert language.identify(pages.limit(0), docs).collect() == []
    assert {r["lang"] for r in language.identify(pages, docs.limit(0)).collect()} == {None}


def test_all_pages_follow_their_articles(spark, small):
    pages, docs = spark.read.parquet(f"{small}/pages.parquet"), spark.read.parquet(f"{small}/documents.parquet")
    rows = language.identify(pages, docs).collect()
    assert len(rows) == pages.count() and all(0 < r["confidence"] <= 1 + 1e-12 for r in rows)
    assert sum(r["lang"] == r["text_lang"] for r in rows) > 0.9 * len(rows)
