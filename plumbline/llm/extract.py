"""Main text of web pages by tree scoring.

The page becomes a tree. Boilerplate by element (menus, footers, forms, scripts) or by name (class,
id, role) goes first. Every block with text of its own earns a point, one for each comma and up to
three for its length, less its share of linked text. The points go whole to its parent, by half to
the grandparent and thinner above. The container with the best score, itself discounted by its
links, is kept with those siblings that score well; a container within an article stands for it.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import per_value

# Fixed: element names of HTML by what they mean here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math nobr q rp rt ruby s samp small span "
             "strike strong sub sup svg time tt u var wbr mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover "
             "munderover mfenced menclose semantics".split())
NEVER = set("head script style noscript template iframe object embed svg annotation nav footer aside form button select option input textarea "
            "dialog menu canvas audio video map noembed noframes xmp title".split())
WRAPPERS = {"form", "aside", "dialog"}  # of these, those that may be around the page's text
MAIN = ("article", "main")
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
               "header hgroup hr main menu nav ol p pre search section summary table ul".split())
# Fixed: which open elements an opening tag ends, and where the search for them stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
        "option": ({"option"}, {"select"})}
SCOPE = set("html body article main section div nav header footer aside td th li ul ol table blockquote form figure dd dl".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"'<]|"[^"<]*+"|'[^'<]*+')*+)>
    |<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)""", re.S | re.X)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role|itemprop|aria-label|aria-hidden|style|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# Fixed: words in class, id or role that mark boilerplate.
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising advertorial adsense adbox adslot banner banners bio breadcrumb breadcrumbs byline comment "
    "comments commentlist disqus consent cookie cookies gdpr notice notices alert footer foot footnote-nav header masthead menu menus nav navbar "
    "navigation navi newsletter subscribe subscription signup login paywall popup modal overlay promo promotion promoted sponsor sponsored "
    "sponsors related recommended recommendations share sharing sharebar social sidebar sidebars side rail widget widgets pager pagination "
    "paging tags taglist toolbar tool tools skip skiplink search searchbox respond replies reply reader outbrain taboola complementary "
    "contentinfo form dialog copyright legal disclaimer hidden teaser teasers".split())
# Of these, words that prose within an article may bear too: there they count only where links or controls agree.
WEAK = set("alert bio byline copyright disclaimer form legal paging rail reader reply search searchbox side skip tags taglist tool toolbar tools widget widgets".split())
GOOD = set("article articlebody body content entry hentry main page post text blog story".split())
PROSE = 40  # code points from which text counts as prose
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Page:
    """Elements as parallel lists in page order, and pieces of text with their element.

    Where open elements of a name stand in the stack is kept per name, so an end tag finds its element,
    or that there is none, without a walk: reading is linear in the page.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.bad, self.good = ["#root"], [-1], [""], [False]
        self.pieces: list[tuple[int, str]] = []
        self.stack = [0]
        self.places: dict[str, list[int]] = {}  # by name, places in the stack
        self.blocks = [0]  # places of elements that are not inline
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        low = None
        while at < end:
            m = _TOKEN.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                self._text(self.stack[-1], source[at:stop])
            if not m:
                break
            at = m.end()
            name = m["tag"] or m["tag2"]
            if not name:
                continue
            name = name.lower()
            if m["end"] or m["end2"]:
                self._close(name)
                continue
            rest = m["rest"] or m["rest2"] or ""
            self._open(name, rest)
            if name in RAW:
                low = low if low is not None else source.lower()
                close = low.find("</" + name, at) if len(low) == end else source.find("</" + name, at)
                close = end if close < 0 else close
                at = close
            elif name not in VOID and rest.endswith("/") and name in ("svg", "path"):
                self._cut(len(self.stack) - 1)

    def _text(self, node: int, text: str) -> None:
        self.pieces.append((node, html.unescape(text) if "&" in text else text))

    def _open(self, name: str, rest: str) -> None:
        if name in ("html", "body") and self.places.get(name):
            return
        if name in CLOSES_P:
            self._end({"p"}, SCOPE)
        if name in ENDS:
            self._end(*ENDS[name])
        if name == "body" or name in CLOSES_P:
            self._end({"head"}, {"body"})
        node = len(self.tag)
        good, bad = _marks(name, rest) if rest else (False, "")
        self.tag.append(name)
        self.parent.append(self.stack[-1])
        self.good.append(good)
        self.bad.append(bad)
        if name not in INLINE:
            self.pieces.append((node, " "))
        if name not in VOID:
            self.places.setdefault(name, []).append(len(self.stack))
            if name not in INLINE:
                self.blocks.append(len(self.stack))
            self.stack.append(node)

    def _cut(self, place: int) -> None:
        """Close everything from a place of the stack on."""
        for node in reversed(self.stack[place:]):
            self.places[self.tag[node]].pop()
            if self.tag[node] not in INLINE:
                self.blocks.pop()
        del self.stack[place:]

    def _nearest(self, names: set[str]) -> int:
        return max((p[-1] for p in map(self.places.get, names) if p), default=0)

    def _end(self, names: set[str], scope: set[str]) -> None:
        while True:
            place = self._nearest(names)
            if not place or place < self._nearest(scope - names):
                return
            tag = self.tag[self.stack[place]]
            self._cut(place)
            if not (tag in ("tr", "td", "th") and len(names) > 2):
                return

    def _close(self, name: str) -> None:
        place = self._nearest({name})
        if place and not (name in INLINE and self.blocks[-1] > place):  # a stray end of an inline element ends no block
            if name not in INLINE:
                self.pieces.append((self.parent[self.stack[place]], " "))
            self._cut(place)
        elif name == "p" or name == "br":
            self.pieces.append((self.stack[-1], " "))


def _marks(name: str, rest: str) -> tuple[bool, str]:
    """Whether attributes name an element as content, and how they name it as boilerplate: "", "weak" or "strong"."""
    good, bad = False, ""
    for m in _NAMES.finditer(rest):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" and (value in ("", "hidden", "true")) or key == "aria-hidden" and value == "true" or key == "style" and _HIDES.search(value):
            bad = "strong"
        elif key in ("class", "id", "role", "itemprop"):
            parts = set(_PARTS.findall(value))
            good = good or bool(parts & GOOD)
            if parts & BOILERPLATE:
                bad = "strong" if bad == "strong" or parts & BOILERPLATE - WEAK else "weak"
            if key == "role" and value in ("main", "article") or value == "articlebody":
                return True, ""
    return good, bad


def main_text(source: str) -> str:
    """The article's text; blocks and runs of white space are parted by one blank."""
    if not source:
        return ""
    page = Page(source)
    tag, parent, n = page.tag, page.parent, len(page.tag)
    holds = [t in MAIN or t == "h1" for t in tag]  # an element with the article or its title is no boilerplate by name
    for i in range(n - 1, 0, -1):
        if holds[i]:
            holds[parent[i]] = True
    # A form with the article, or what holds most of the page's plain text, is no boilerplate; only its controls are.
    control, around = [False] * n, [0] * n
    for i in range(1, n):
        control[i] = control[parent[i]] or tag[i] in NEVER and tag[i] not in WRAPPERS or tag[i] in ("a", "label")
    for node, text in page.pieces:
        around[node] += 0 if control[node] else len(text.strip())
    for i in range(n - 1, 0, -1):
        around[parent[i]] += around[i]
    # Text and links of every element as they stand, and whether it holds controls, for names that prose may bear too.
    plain, linking, controls = [0] * n, [0] * n, [t in ("form", "input", "select", "textarea", "button") for t in tag]
    link = [False] * n
    for i in range(1, n):
        link[i] = link[parent[i]] or tag[i] == "a"
    for node, text in page.pieces:
        plain[node] += len(text.strip())
        linking[node] += len(text.strip()) if link[node] else 0
    for i in range(n - 1, 0, -1):
        plain[parent[i]] += plain[i]
        linking[parent[i]] += linking[i]
        controls[parent[i]] = controls[parent[i]] or controls[i]
    wraps = [t in WRAPPERS and (t == "form" and holds[i] or 2 * around[i] > around[0]) for i, t in enumerate(tag)]
    held = [False] * n  # within a form that wraps the page
    inside, content, dropped = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        up = parent[i]
        inside[i] = inside[up] or tag[i] in MAIN
        content[i] = content[up] or inside[i] or page.good[i]
        prose = page.bad[i] == "weak" and content[up] and plain[i] >= PROSE and 4 * linking[i] < plain[i] and not controls[i]
        named = page.bad[i] and not prose and not holds[i] and tag[i] not in ("html", "body", "article", "main")
        page_header = tag[i] == "header" and not inside[i]
        held[i] = held[up] or wraps[i] and tag[i] == "form"
        never = tag[i] in NEVER and not wraps[i] or tag[i] == "label" and held[i]
        dropped[i] = dropped[up] or never or named and not wraps[i] or page_header
    block, linked = [0] * n, [False] * n
    for i in range(1, n):
        up = parent[i]
        block[i] = block[up] if tag[i] in INLINE else i
        linked[i] = linked[up] or tag[i] == "a"
    size, links, commas = [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        if not dropped[node]:
            long = len(text.strip())
            if long:
                b = block[node]
                size[b] += long
                links[b] += long if linked[node] else 0
                commas[b] += text.count(",") + text.count("、") + text.count("，")
    score = [0.0] * n
    whole, whole_links = size[:], links[:]
    for i in range(n - 1, 0, -1):
        whole[parent[i]] += whole[i]
        whole_links[parent[i]] += whole_links[i]
        if not size[i]:
            continue
        points = (min(1.0, size[i] / 25) + commas[i] + min(3.0, size[i] / 100)) * (1 - links[i] / size[i])
        up, level = parent[i], 1
        score[i] += points / 4  # text of its own makes an element a container too
        while up >= 0 and level <= 6:
            score[up] += points if level == 1 else points / 2 if level == 2 else points / (3 * level)
            up, level = parent[up], level + 1
    best, top = -1, 0.0
    for i in range(n):
        if dropped[i] or not whole[i]:
            continue
        now = score[i] * (1 - whole_links[i] / whole[i]) + (5 * page.good[i] + 25 * (tag[i] in MAIN) - 5 * (tag[i] in HEADINGS) if score[i] > 0 else 0)
        if tag[i] in INLINE or tag[i] in ("p", "li"):
            continue
        if now > top:
            best, top = i, now
    if best < 0:
        best = 0  # no block with points: whatever is no boilerplate
    article = best
    while article > 0 and tag[article] not in MAIN:
        article = parent[article]
    keep = {article if article > 0 else best}
    chosen = next(iter(keep))
    if article > 0:  # a page may have several articles side by side
        for i in range(1, n):
            if parent[i] == parent[chosen] and tag[i] == tag[chosen] and not dropped[i] and page.bad[i] != "strong" and whole[i]:
                density = whole_links[i] / whole[i]
                if density < 0.5 and score[i] * (1 - density) >= max(3.0, 0.2 * score[chosen] * (1 - whole_links[chosen] / max(1, whole[chosen]))):
                    keep.add(i)
    elif chosen > 0:
        for i in range(1, n):
            if parent[i] == parent[chosen] and i != chosen and not dropped[i] and whole[i]:
                density = whole_links[i] / whole[i]
                own = score[i] * (1 - density)
                prose = tag[i] == "p" and (whole[i] > 80 and density < 0.25 or density == 0 and commas[i] > 0)
                if own >= max(3.0, 0.2 * top) or prose or tag[i] in ("h1", "h2") and i < chosen and density < 0.5:
                    keep.add(i)
    kept = [False] * n
    page_wide = tag[chosen] in ("html", "body") or chosen == 0  # else all of the article is kept, also its lists of sources
    lists = ("ul", "ol", "div", "section", "table", "p")
    for i in range(n):
        if dropped[i]:
            continue
        kept[i] = i in keep or i > 0 and kept[parent[i]]
        if page_wide and kept[i] and i not in keep and tag[i] in lists and whole[i] and whole_links[i] > 0.8 * whole[i] and not page.good[i] and tag[i] != "p":
            kept[i] = False  # a list of links outside any article is a menu
    return " ".join("".join([text for node, text in page.pieces if kept[node]]).split())


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    A null or empty page has the empty text. Broken markup is read as far as it goes: unclosed
    elements end with what holds them. Repeated rows stay. An empty table gives no rows. Other
    columns are not read.
    """
    text = per_value(main_text, "string", deterministic=False)(F.coalesce(pages[column].cast("string"), F.lit("")))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
