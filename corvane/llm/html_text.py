"""Main text of web pages by consensus of host paths.

Each page's containers are scored by the text below them that is neither boilerplate nor link, and the page votes for the
smallest container that holds nearly all of it, under its generalised path: tags with classes from the root down, numbers
folded. An article (<article> or <main>) is left for a container in it only if that holds all of its text. Votes are counted
per host in Spark, and each page is extracted from the container on the most voted path of its host that it has, or the whole
of the article around it; its own best container serves where it has none.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import Cuts, ship, table, whole

#: The share of a page's text that a container outside an article must hold to be taken, and of what is around it one with an article.
HOLD = 0.8
#: A path counts for a host from this share of its votes on, so a host has 20 paths at most.
MIN_SHARE = 0.05
#: Winning paths are broadcast up to so many characters, and joined by a shuffle beyond.
BROADCAST_CHARS = 16_000_000

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
ARTICLES, HEADINGS = frozenset(["article", "main"]), frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is never text of the page, and those that are never part of an article.
OPAQUE = frozenset("script style noscript template textarea svg math iframe object canvas audio video select button title".split())
APART = frozenset("nav footer aside form head dialog menu search".split())
#: Words in a class, id or role that mark what stands beside an article.
MARKS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promotions banner banners cookie cookies consent gdpr notice notices alert alerts popup modal overlay"
    " newsletter subscribe subscription paywall sidebar sidebars rail widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs masthead topbar toolbar footer footers comment comments disqus reply"
    " replies respond discussion share sharing social related recommended recommendations pagination pager login signin signup skip complementary contentinfo".split()
)
#: Those that do so only outside an article, where they may name its own heading.
OUTER = frozenset(["header", "banner", "headers"])
#: A start tag of these closes an open element of the second, unless one of the third stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
CAMEL, NUMBERS, WORDS = re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"\d+"), re.compile(r"[a-z]+")
ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in OPAQUE}


class Page:
    """The block elements of a page (parent, path, whether boilerplate) and its blocks of text with the element they are in."""

    def __init__(self, source: str):
        self.parent, self.tag, self.name, self.apart, self.in_article, self.container = [-1], ["#"], [""], [False], [False], [0]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.stack = [(0, "#")]  # of each open tag the element it is or is in
        self.places: dict[str, list[int]] = {}  # where in the stack each tag stands, and under "" where blocks other than <p> do
        self.text: list[tuple[str, bool]] = []
        self.links = 0
        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            if m is None:
                self._add(source[at:])
                break
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._close(tag)
            elif tag in OPAQUE and not m[0].endswith("/>"):
                if tag in BLOCKS:
                    self._break()
                found = ENDS[tag].search(source, at)
                at = found.end() if found else (at if tag in ("svg", "math", "button", "select", "object", "audio", "video", "canvas") else end)
            else:
                self._open(tag, m[3] or m[6] or "")
        self._break()

    def _add(self, text: str) -> None:
        self.text.append((text, self.links > 0))

    def _break(self) -> None:
        if self.text:
            if len(self.text) == 1:
                text, link = self.text[0]
                text = " ".join((entities.unescape(text) if "&" in text else text).split())
                linked = len(text) if link else 0
            else:
                parts = [(entities.unescape(t) if "&" in t else t, link) for t, link in self.text]
                text = " ".join("".join([t for t, _ in parts]).split())
                linked = sum(len(t.strip()) for t, link in parts if link)
            if text:
                self.blocks.append((self.stack[-1][0], text, linked))
            self.text = []

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text.append((" ", False))
            return
        block = tag in BLOCKS
        if block:
            self._break()
            if tag in CLOSES:
                self._pop(*CLOSES[tag])
            else:
                self._pop(("p",), ("",))
        if tag in VOID:
            return
        above = index = self.stack[-1][0]
        marks = ATTRIBUTE.findall(attributes) if "=" in attributes else ()
        if block or marks:
            values = {a.lower(): b or c or d for a, b, c, d in marks}
            words = set()
            for v in values.values():
                words.update(WORDS.findall(CAMEL.sub(" ", v).lower()))
            inside = self.in_article[above]
            apart = self.apart[above] or tag in APART or bool(words & MARKS) or (not inside and (tag == "header" or bool(words & OUTER)))
            if tag in ("html", "body", "article", "main") and tag not in APART:
                apart = self.apart[above] or (tag in ("article",) and bool(words & {"comment", "comments", "reply", "related", "ad", "sponsored", "promo", "widget"}))
            if block or apart:
                index = len(self.parent)
                label = NUMBERS.sub("0", ".".join([tag, *sorted(set(values.get("class", "").lower().split()))]))
                self.parent.append(above)
                self.tag.append(tag)
                self.name.append((label + ("#" + NUMBERS.sub("0", values["id"].lower()) if values.get("id") else "")).replace("/", "|"))
                self.container.append(index if tag in CONTAINERS else self.container[above])
                self.apart.append(apart)
                self.in_article.append(inside or tag in ("article", "main"))
        if tag == "a":
            self.links += 1
        self.places.setdefault(tag, []).append(len(self.stack))
        if block and tag != "p":
            self.places.setdefault("", []).append(len(self.stack))
        self.stack.append((index, tag))

    def _last(self, tag: str) -> int:
        """Where in the stack the innermost open tag of this name stands; 0 if there is none."""
        at = self.places.get(tag)
        return at[-1] if at else 0

    def _leave(self, to: int) -> None:
        for _, t in self.stack[to:]:
            self.places[t].pop()
            if t == "a":
                self.links -= 1
            elif t != "p" and t in BLOCKS:
                self.places[""].pop()
        del self.stack[to:]

    def _pop(self, tags, barrier) -> None:
        first = max(map(self._last, tags))
        if first <= max(map(self._last, barrier)):
            return
        while first > 1 and self.stack[first - 1][1] in tags:
            first -= 1
        self._leave(first)

    def _close(self, tag: str) -> None:
        if tag == "br":
            self.text.append((" ", False))
            return
        block, k = tag in BLOCKS, self._last(tag)
        if not k:
            if block:
                self._break()
        elif block or k > max(self._last(""), self._last("p")):
            if block or self.stack[-1][0] != self.stack[k - 1][0]:
                self._break()
            self._leave(k)

    def totals(self) -> list[int]:
        """For each element, the characters of text below it, boilerplate and links left out."""
        out = [0] * len(self.parent)
        for element, text, linked in self.blocks:
            if not self.apart[element]:
                out[element] += max(0, len(text) - linked)
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out

    def standing(self) -> tuple[list[int], list[bool]]:
        """For each element, the blocks below it that are text of the page (headings, and what is not all link), and whether one has it for its container."""
        out, direct = [0] * len(self.parent), [False] * len(self.parent)
        for element, text, linked in self.blocks:
            if not self.apart[element] and (linked < len(text) or self.tag[element] in HEADINGS):
                out[element] += 1
                direct[self.container[element]] = True
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out, direct

    def best(self, totals: list[int]) -> int:
        """The smallest container with nearly all of the text, and all of its article's; 0, the page, without any."""
        children: dict[int, list[int]] = {}
        holds = [False] * len(self.parent)
        for i in range(len(self.parent) - 1, 0, -1):
            if self.tag[i] in CONTAINERS and not self.apart[i]:
                children.setdefault(self.parent[i], []).append(i)
                holds[i] = holds[i] or self.tag[i] in ARTICLES
            holds[self.parent[i]] = holds[self.parent[i]] or holds[i]
        stands, direct = self.standing()
        at = 0
        while at in children:
            top = max(reversed(children[at]), key=totals.__getitem__)
            if totals[top] == 0:
                break
            if self.in_article[at]:
                if stands[top] < stands[at]:
                    break
            elif holds[top]:
                if totals[top] < HOLD * totals[at]:
                    break
            elif direct[at] or totals[top] < HOLD * totals[0]:
                break
            at = top
        return at

    def widen(self, root: int) -> int:
        """The smallest container around root, or root, that leaves no text of its article beside, nor any that stands in a container around it other than the body."""
        stands, direct = self.standing()
        at = root
        while at > 0:
            at = self.parent[at]
            if self.tag[at] in CONTAINERS and stands[at] > stands[root]:
                if self.in_article[at]:
                    root = at
                elif self.in_article[root] or self.tag[at] in ("html", "body") or not direct[at]:
                    break
                else:
                    root = at
        return root

    def path(self, i: int) -> str:
        out = []
        while i > 0:
            out.append(self.name[i])
            i = self.parent[i]
        return "/".join(reversed(out))

    def extract(self, paths: list[str]) -> str:
        """The text of the first path that the page has with text (of several places the one with most), else of its best container."""
        totals = self.totals()
        root = self.best(totals)
        if paths and self.path(root) not in paths[:1]:
            # paths as numbers: of each number and name below it the number of the longer path
            longer: dict[tuple[int, str], int] = {}
            number, places = [0] * len(self.parent), {}
            for i in range(1, len(self.parent)):
                number[i] = p = longer.setdefault((number[self.parent[i]], self.name[i]), len(longer) + 1)
                if self.tag[i] in CONTAINERS and not self.apart[i] and totals[i] and (p not in places or totals[i] > totals[places[p]]):
                    places[p] = i
            for path in paths:
                p = 0
                for name in path.split("/"):
                    p = longer.get((p, name), -1)
                if p in places:
                    root = self.widen(places[p])
                    break
        inside = [False] * len(self.parent)
        for i in range(len(self.parent)):
            inside[i] = i == root or (i > 0 and inside[self.parent[i]])
        return "\n".join([text for element, text, _ in self.blocks if inside[element] and not self.apart[element]])


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; empty if there is none."""
    at = F.regexp_extract(F.lower(whole(url)), r"^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\\]*)", 1)
    return F.regexp_replace(F.regexp_replace(at, r"^.*@", ""), r":\d*$", "")


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(_host, _paths): the paths of each host, the most voted first; ties in order of the paths."""

    def votes(batches):
        for b in batches:
            count: dict[tuple[str, str], int] = {}
            for h, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if source:
                    page = Page(source)
                    totals = page.totals()
                    if p := page.path(page.best(totals)):
                        count[h, p] = count.get((h, p), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.string()), pa.array(list(count.values()), pa.int64())], names=["_host", "_path", "_votes"])

    cast = pages.select(host(F.col(url_col)).alias("_host"), F.col(html_col)).mapInArrow(votes, "_host string, _path string, _votes long")
    # salted by the path: one host may have a third of all pages
    counted = cast.groupBy("_host", "_path").agg(F.sum("_votes").alias("_votes"))
    counted = Cuts(pages.sparkSession).cut(counted, "host-votes", narrow=True)
    total = counted.groupBy("_host").agg(F.sum("_votes").alias("_total"))
    kept = counted.join(total, "_host").where(F.col("_votes") >= MIN_SHARE * F.col("_total"))
    listed = F.sort_array(F.collect_list(F.struct((-F.col("_votes")).alias("v"), F.col("_path").alias("p"))))
    return kept.groupBy("_host").agg(F.transform(listed, lambda x: x["p"]).alias("_paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each row of pages.

    Null html is empty, and its text is empty, as is that of a page without an article. Work is linear in a page's length, however
    deep or broken its markup. Paths with as many votes go in order of their names. Null and odd addresses share a
    host without a name. Broken and cut-off markup is read as far as it goes. Repeated rows each vote and each get a
    row; an empty table gives an empty result. Other columns are not read.
    """
    spark = ship(pages.sparkSession)
    winners = Cuts(spark).cut(host_paths(pages, url_col, html_col), "host-paths", narrow=True)
    chars = winners.agg(F.sum(F.length("_host") + F.length(F.concat_ws("", "_paths")) + 64)).first()[0] or 0
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col), host(F.col(url_col)).alias("_host"))
    rows = rows.join(F.broadcast(winners) if chars <= BROADCAST_CHARS else winners, "_host", "left")

    def run(batches):
        for b in batches:
            out = [Page(source).extract(paths or []) if source else "" for source, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    return rows.select(id_col, url_col, html_col, "_paths").mapInArrow(run, f"`{id_col}` {kind[id_col]}, `{url_col}` {kind[url_col]}, text string, n_chars long")


def op10_html_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))
