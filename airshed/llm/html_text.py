"""Main text of web pages by consensus host paths.

Each page is read into its containers (block elements), boilerplate elements left out. A class or id marks boilerplate only if one of
its tokens names it by its head word (`post-comments`, `sidebar-left`, not `has-sidebar` or `legal-analysis`) and no token names an
article; an element so marked that holds most of the page's text outside links stays in. A container's path
is generalised: tags with their classes, digits and order dropped. Every page scores its containers and votes for
the best path, widened to the ancestor that holds the other parts of a split body; Spark adds the votes up per host, and each page is extracted again from the container with its
host's winning path. A page without that path takes its own best container.

A host may hold any share of the pages: votes are partial sums by (host, path), and winners are joined with pages
salted by page, so no host is gathered in one task.

Formulas keep their text (not their annotations). What a browser shows only in place of something else (`noscript`, `object`, `canvas`) or
not at all (`template`) goes.

Defined cases: null or empty html gives empty text; null url is host ''; pages without any container are read as a
whole; unclosed, crossed and stray tags are read as a browser would roughly read them; repeated pages vote once each; an empty
table gives no row.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

SALTS = 32  # parts into which every host's pages are split for the join with the winners
MIN_SHARE = 0.2  # of a host's votes that a path needs to win; else pages keep their own choice
PROSE = 40  # characters that paragraphs have on average in a further part of the body, unlike notes and labels

# HTML element kinds
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "svg"}
DROPPED = RAW | {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "object", "canvas", "audio", "video",
                 "annotation", "annotation-xml"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "math", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom",
          "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr",
          "munder", "munderover", "semantics", "annotation", "annotation-xml"}
CONTAINERS = {"article", "main", "section", "div", "td", "body", "center", "blockquote"}
PARAGRAPHS = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "dd", "dt", "figcaption"}
CLOSES_P = PARAGRAPHS | CONTAINERS | {"ul", "ol", "dl", "table", "hr", "address", "fieldset", "figure", "details", "form", "nav",
                                      "header", "footer", "aside"}
GONE, MARKED = 2, 3  # kinds of left-out elements: whatever they hold, by their names
# Words of class and id that mark what isn't the article
BOILERPLATE = {"nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "side",
               "aside", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
               "cookie", "cookies", "consent", "notice", "notices", "gdpr", "popup", "modal", "newsletter", "subscribe", "signup",
               "share", "sharing", "social", "related", "recommended", "comment", "comments", "reply", "replies", "disqus",
               "discussion", "respond", "login", "search", "pager", "pagination", "toolbar", "widget", "copyright", "legal", "alert"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
ARTICLE_WORDS = {"article", "content", "post", "entry", "story", "main", "body", "text", "page"}
SHAPE_WORDS = {"list", "link", "links", "left", "right", "top", "bottom", "wrap", "wrapper", "box", "area", "container", "block", "section",
               "inner", "outer", "item", "items", "bar", "panel", "group", "row", "col", "column"}  # say nothing of what an element holds
STATE_WORDS = {"has", "with", "without", "no", "is", "show", "hide"}  # what follows is beside the element, not it
IN_ARTICLES = {"legal", "side"}  # say what a part of an article is about, or where it stands
OFTEN_LONG = {"comment", "comments", "reply", "replies", "disqus", "discussion", "respond", "cookie", "cookies", "consent", "gdpr",
              "popup", "modal"}  # may hold more text than the article, and still go

# A quote opens a value only right after "="; comments and CDATA sections are cut out by hand
_TAG = re.compile(r"<!--|<!\[CDATA\[|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)"
                  r"((?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)>")
_ATTR = re.compile(r"(?i)(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _marks(token: str) -> str | None:
    """The boilerplate word that a class or id token names, if any."""
    words = _WORDS.findall(token)
    while len(words) > 1 and words[-1] in SHAPE_WORDS:
        words.pop()
    if not words or words[-1] not in BOILERPLATE or STATE_WORDS & set(words):
        return None
    if words[-1] == "header" and ARTICLE_WORDS & set(words):
        return None  # an article's own heading
    return words[-1]


@lru_cache(maxsize=4096)
def _attributes(tag: str, raw: str) -> tuple[str, bool, bool, bool, bool, bool]:
    """Generalised path step, whether it goes, whether its names mark it, whether it may stay for its text, whether they speak for an article,
    and whether their marks count outside articles only."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)} if raw else {}
    names = entities.unescape(f"{found.get('class', '')} {found.get('id', '')}")
    tokens = [_CAMEL.sub("-", t).lower() for t in names.split()]
    words = {w for t in tokens for w in _WORDS.findall(t)}
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    strong = bool(words & ARTICLE_WORDS)
    drop = tag in DROPPED or hidden or found.get("role", "").lower() in BOILERPLATE_ROLES
    marks = {_marks(t) for t in tokens} - {None}
    article = any(w and set(w) <= ARTICLE_WORDS for w in map(_WORDS.findall, tokens))
    marked = bool(marks) and not article and tag not in ("html", "body", "article", "main")
    classes = sorted({re.sub(r"\d+|/", "", c).strip("-_").lower() for c in found.get("class", "").split()} - {""})
    return ".".join([tag, *classes]), drop, marked, not marks & OFTEN_LONG, strong, marks <= IN_ARTICLES


class Paths:
    """Generalised paths of a page by number, each a step below another: a page of any depth holds each step once."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.above, self.step = [0], [""]

    def below(self, path: int, step: str) -> int:
        number = self.known.setdefault((path, step), len(self.step))
        if number == len(self.step):
            self.above.append(path)
            self.step.append(step)
        return number

    def text(self, path: int) -> str:
        steps = []
        while path:
            steps.append(self.step[path])
            path = self.above[path]
        return "".join(f"/{step}" for step in reversed(steps))

    def number(self, text: str) -> int:
        """The number of a path as text; 0 if the page hasn't got it."""
        path = 0
        for step in text.split("/")[1:]:
            path = self.known.get((path, step), 0)
            if not path:
                break
        return path


class Container:
    __slots__ = ("path", "tag", "first", "last", "own", "links", "blocks", "strong", "depth", "above", "size", "far", "prose", "parts")

    def __init__(self, path: int, tag: str, first: int, strong: bool, depth: int, above: Container | None = None):
        self.path, self.tag, self.first, self.last, self.strong, self.depth = path, tag, first, None, strong, depth
        self.own = self.links = self.blocks = 0
        self.above = above
        self.size = self.far = self.prose = self.parts = 0  # with all in it: text, text of links, of paragraphs outside links, paragraphs

    def score(self) -> float:
        """Text outside links in its own paragraphs, more for article-like elements."""
        boost = {"article": 2.0, "main": 1.5}.get(self.tag, 1.25 if self.strong else 1.0)
        return boost * max(0, self.own - 2 * self.links) * (1 + min(self.blocks, 10) / 10)


def read(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[str], list[Container], Paths]:
    """Text pieces in page order (None-free; a space piece parts blocks), containers with their piece ranges, and their paths.

    Time and memory follow the page's length, however deep, crossed or unclosed its elements are.

    `spared`: where elements begin that stay in although they are marked; the page is read again with those that hold most of its text.
    """
    pieces: list[str] = []
    root = Container(0, "", 0, False, 0)
    containers, paths = [root], Paths()
    stack: list[tuple[str, int, Container | None, bool | int]] = []  # tag, path, container opened, paragraph or what is left out
    places: dict[str, list[int]] = {}  # of the open elements of each tag
    not_inline: list[int] = []  # places of open elements that aren't inline
    articles = 0  # open article and main elements
    unended: set[str] = set()  # raw elements of which no end tag follows
    home = [root]  # open containers
    skip = 0  # depth inside a boilerplate element
    links = paragraphs = 0
    gone = 0  # depth inside elements that go whatever they hold, and inside links of left-out ones
    marked_out: list[list] = []  # open marked elements inside a left-out one: place, whether it may stay, text
    held: dict[int, int] = {}  # text outside links of marked elements that may stay
    left_out = 0  # text outside links of all marked elements
    at, n = 0, len(page)
    last_tag = page.rfind(">") + 1  # no tag ends behind it

    def text(raw: str) -> None:
        if not raw or (skip and (gone or links)):
            return
        shown = entities.unescape(raw) if "&" in raw else raw
        size = len(shown) - shown.count(" ") if len(shown) < 4 else len(shown)
        if skip:
            if marked_out and shown.strip():
                marked_out[-1][2] += size
            return
        pieces.append(shown)
        if shown.strip():
            home[-1].own += size
            home[-1].size += size
            if links:
                home[-1].links += size
                home[-1].far += size
            elif paragraphs:
                home[-1].prose += size

    def close(upto: int) -> None:
        nonlocal skip, links, paragraphs, gone, left_out, articles
        while len(stack) > upto:
            tag, _, container, paragraph = stack.pop()
            places[tag].pop()
            if tag not in INLINE:
                not_inline.pop()
            if skip:
                skip -= 1
                gone -= paragraph == GONE
                if paragraph == MARKED:
                    begin, may_stay, size = marked_out.pop()
                    if may_stay:
                        held[begin] = size
                    if marked_out:
                        marked_out[-1][2] += size
                    else:
                        left_out += size
                if not skip:
                    pieces.append(" ")
                continue
            if tag == "a":
                links -= 1
            paragraphs -= paragraph
            if container is not None:
                articles -= tag in ("article", "main")
                container.last = len(pieces)
                home.pop()
                parent = home[-1]
                parent.size += container.size
                parent.far += container.far
                parent.prose += container.prose
                parent.parts += container.parts
                if container.tag in ("blockquote", "center", "section"):  # flows into its parent
                    parent.own += container.own
                    parent.links += container.links
                    parent.blocks += container.blocks

    def push(tag: str, path: int, container: Container | None, kind: bool | int) -> None:
        places.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            not_inline.append(len(stack))
        stack.append((tag, path, container, kind))

    while at < n:
        m = _TAG.search(page, at, last_tag)
        if m is None:
            text(page[at:].split("<!--", 1)[0])
            break
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<!--":
                end = page.find("-->", at - 2)
                at = end + 3 if end >= 0 else n
            elif m[0] == "<![CDATA[":
                end = -1 if "]]" in unended else page.find("]]>", at)
                if end < 0:  # without its end it goes up to the tag's
                    unended.add("]]")
                    at = page.find(">", at) + 1
                else:
                    text(page[at:end].replace("&", "&amp;"))
                    at = end + 3
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag closes up to its element, an inline one never past an element of another kind
            place = places[tag][-1] if places.get(tag) else -1
            if place < 0:
                if tag in ("p", "br") and not skip:
                    pieces.append(" ")
            elif tag not in INLINE or not not_inline or not_inline[-1] < place:
                if tag not in INLINE and tag not in VOID and not skip:
                    pieces.append(" ")
                close(place)
            continue
        if tag not in INLINE and not skip:
            pieces.append(" ")
        if tag in CLOSES_P and not_inline:  # an open paragraph ends here, with the inline elements in it
            place = not_inline[-1]
            opened = stack[place][0]
            if opened == "p" or (tag == "li" and opened == "li") or (tag in ("dd", "dt") and opened in ("dd", "dt")):
                close(place)
        if tag in VOID:
            continue
        if tag in RAW and not m[3].endswith("/"):
            end = None if tag in unended else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end is None:
                unended.add(tag)
            at = end.end() if end else (n if tag in ("script", "style", "svg") else at)
            continue
        if m[3].endswith("/") and tag not in CONTAINERS and tag not in PARAGRAPHS:
            continue
        step, drop, marked, may_stay, strong, outside = _attributes(tag, m[3])
        above = stack[-1][1] if stack else 0
        if tag == "header" and home[-1].tag in ("article", "main") and not skip:
            drop = marked = False  # an article's own heading
        path = paths.below(above, step) if tag not in INLINE else above
        marked = marked and not (outside and articles) and m.start() not in spared
        if skip or drop or marked:
            skip += 1
            kind = GONE if drop or tag == "a" else MARKED if marked else False
            gone += kind == GONE
            if kind == MARKED:
                marked_out.append([m.start(), may_stay, 0])
            push(tag, path, None, kind)
            continue
        container = None
        if tag in CONTAINERS:
            container = Container(path, tag, len(pieces), strong, len(stack), home[-1])
            containers.append(container)
            home.append(container)
            articles += tag in ("article", "main")
        elif tag in PARAGRAPHS:
            home[-1].blocks += 1
        home[-1].parts += tag in PARAGRAPHS
        paragraphs += tag in PARAGRAPHS
        if tag == "a":
            links += 1
        push(tag, path, container, tag in PARAGRAPHS)
    close(0)
    most = frozenset(k for k, size in held.items() if 2 * size > root.size - root.far + left_out)
    if most and not spared:
        return read(page, most)
    root.last = len(pieces)
    return pieces, containers, paths


def widened(top: Container) -> Container:
    """The outermost ancestor reached by steps whose further text is mostly paragraphs of prose outside links."""
    c = top
    while (c := c.above) is not None and c.path:  # the page as a whole has no path to vote for
        size, prose, parts = c.size - top.size, c.prose - top.prose, c.parts - top.parts
        if 2 * prose > size and prose >= PROSE * parts:
            top = c
        elif size:
            break
    return top


def best(containers: list[Container]) -> Container:
    """Highest score; of equals the outermost first one. Widened to an enclosing article or main element, else over a split body."""
    top = max(containers, key=lambda c: (c.score(), -c.depth, -c.first))
    around = [c for c in containers if c.tag in ("article", "main") and c.first <= top.first and c.last >= top.last]
    return min(around, key=lambda c: (c.tag != "article", -c.depth)) if around else widened(top)


def text_of(pieces: list[str], spans: list[tuple[int, int]]) -> str:
    return " ".join(" ".join("".join(pieces[a:b]) for a, b in spans).split())


def extract(page: str | None, path: str | None) -> str:
    """Main text: all containers with the winning path that don't lie in one another, else the page's best container."""
    if not page:
        return ""
    pieces, containers, paths = read(page)
    chosen: list[tuple[int, int]] = []
    wanted = paths.number(path) if path else 0
    for c in containers if wanted else ():
        if c.path == wanted and (not chosen or c.first >= chosen[-1][1]) and c.last > c.first:
            chosen.append((c.first, c.last))
    text = text_of(pieces, chosen) if chosen else ""
    if not text:
        c = best(containers)
        text = text_of(pieces, [(c.first, c.last)])
    return text


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, scores = [], [], []
        pages = batch.column("html")
        for i, host in enumerate(batch.column("host").to_pylist()):
            page = pages[i].as_py()
            if page:
                _, containers, known = read(page)
                c, score = best(containers), max(x.score() for x in containers)
                if score > 0 and c.path:
                    hosts.append(host)
                    paths.append(known.text(c.path))
                    scores.append(score)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
                                         names=["host", "path", "score"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, texts = batch.column("html"), []
        for i, path in enumerate(batch.column("path").to_pylist()):
            texts.append(extract(pages[i].as_py(), path))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("path")],
                                         names=["page_id", "url", "text", "path"])


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host.alias("host"))


def host_paths(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, path): each host's path with most votes, if it has enough of them."""
    ship(pages.sparkSession)
    votes = _with_host(pages).select("host", "html").mapInArrow(_votes, "host string, path string, score double")
    tally = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"))
    won = tally.groupBy("host").agg(F.sum("n").alias("all"), F.max(F.struct("n", "score", "path")).alias("best"))
    return won.where(F.col("best.n") >= min_share * F.col("all")).select("host", F.col("best.path").alias("path"))


def main_text(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per page: page_id, url, text, path (the host's winning path, null without one)."""
    ship(pages.sparkSession)
    winners = written(host_paths(pages, min_share), "host-paths")
    salted = winners.select(F.col("host").alias("_host"), "path", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt2"))
    rows = _with_host(pages).withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = rows.join(salted, (F.col("host") == F.col("_host")) & (F.col("_salt") == F.col("_salt2")), "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(_extracted, "page_id long, url string, text string, path string")
