"""Main text of web pages by consensus paths per host.

Each page's containers are scored by the text that stands in them. A page's own container is the best
one if that is an article, else the lowest one around it and all whose own text reaches ``HIGH`` of the
longest, so that an article in several siblings stays whole. The page votes for the generalised tag-class
paths of its own and its best containers, none around its own, by the share of its text that they hold. Spark adds the votes up
per host, and each page is extracted again with the winning path of its host that comes first and holds
``MIN_HELD`` of the text of the page's own container; where none does, its own container is
taken, and a page without a container gives all its text.

Menus, headers, footers, asides, adverts, notices, forms, comments, scripts and styles are left
out by tag, role, hidden state and the words of class and id. A block is the text between two
starts or ends of block-level elements; references are decoded, white space in a block is one
space, blocks are joined by one line feed.

Nulls, empties and ties: a null or empty page has an empty text; a null address is a host of its
own; unclosed tags, comments and quotes are read as far as they go; equal votes are ordered by
path; repeated rows are extracted each. Elements hold their parent and a number for their path, so that
time and memory grow with the page also where it is nested very deeply.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from starloom.llm.common import whole
from starloom.session import stage

VOTES_PER_PAGE = 3
PATHS_PER_HOST = 3
HIGH = 0.2  # of the longest own text, for a container to belong to the article
MIN_HELD = 0.8  # of the text of the page's own container, for a path of the host

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>?", re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math select object canvas".split())
_BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address header footer nav aside form fieldset details summary hr center hgroup".split()
)
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre ul ol dl table thead tbody tfoot figure figcaption caption details summary".split())
_SKIP = frozenset("head nav header footer aside form button input label menu dialog audio video".split()) | _RAW
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_JUNK = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement advertising banner promo "
    "sponsor sponsored cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup share "
    "sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus reply replies "
    "respond widget toolbar login search masthead copyright disclaimer alert".split()
)
_NEVER_SKIPPED = frozenset(("html", "body", "main"))
_GOOD = frozenset("article main content post entry story text body".split())
# An opening tag ends what is open above it, up to the given boundary.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}), "body": ({"head"}, {"html"}),
}
_P_BOUNDARY = frozenset("html body main article section div td th li table aside nav header footer form blockquote".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Page:
    """Elements and text pieces of a page; an element is an index into the lists."""

    def __init__(self, source: str):
        self.tag, self.parent, self.skip, self.link, self.good = ["#"], [-1], [False], [False], [0]
        self.path, self.article, self.holder = [0], [0], [0]  # number of the path, nearest article, nearest container
        self._paths: dict[tuple[int, str], int] = {}  # path around, step: path
        self._steps: list[tuple[int, str]] = [(0, "")]
        self._held: dict[str, int] = {}  # open elements by tag
        self.pieces: list[tuple[int, int, str]] = []  # block number, element, raw text
        self._block, self._open = 0, [0]
        self._read(source)

    def _read(self, source: str) -> None:
        at, low, size = 0, None, len(source)
        while at < size:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                return
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._close(name)
                continue
            attributes = m[3] if m[2] else m[6]
            self._start(name, attributes or "")
            if name in _RAW and not (attributes or "").endswith("/"):
                if low is None:
                    low = source.lower() if len(source.lower()) == size else re.sub("[A-Z]+", lambda x: x[0].lower(), source)
                end = low.find("</" + name, at)
                at = size if end < 0 else end
                self._close(name) if end < 0 else None

    def _text(self, text: str) -> None:
        top = self._open[-1]
        if not self.skip[top]:
            self.pieces.append((self._block, top, text))

    def _pop_to(self, depth: int) -> None:
        while len(self._open) > depth:
            tag = self.tag[self._open.pop()]
            self._held[tag] -= 1
            if tag in _BLOCK:
                self._block += 1

    def _start(self, name: str, raw: str) -> None:
        if name in _CLOSES:
            ends, limit = _CLOSES[name]
            self._end_open(ends, limit)
        if name in _BLOCK:
            self._block += 1
            self._end_open({"p"}, _P_BOUNDARY)
            if name[0] == "h" and name[1:].isdigit():
                self._end_open({"h1", "h2", "h3", "h4", "h5", "h6"}, _P_BOUNDARY)
        if name == "br" or name == "wbr":
            self._text(" " if name == "br" else "")
        if name in _VOID:
            return
        parent = self._open[-1]
        attributes = {}
        if raw.strip(" /\t\r\n\f"):
            for k, v in _ATTRIBUTE.findall(raw):
                attributes.setdefault(k.lower(), html.unescape(v.strip("\"'")))
        classes = attributes.get("class", "").split()
        self.tag.append(name)
        self.parent.append(parent)
        self.skip.append(self.skip[parent] or self._junk(name, attributes, classes))
        self.link.append(self.link[parent] or name == "a")
        step = name + "".join("." + c for c in sorted({re.sub(r"\d+", "#", c) for c in classes})[:2])
        self.path.append(self._step(self.path[parent], step.replace(">", "#")) if name in _BLOCK else self.path[parent])
        this = len(self.tag) - 1
        self.article.append(this if name == "article" else self.article[parent])
        self.holder.append(this if name in _BLOCK and name not in _LEAF else self.holder[parent])
        names = set(classes) | {attributes.get("id", ""), attributes.get("itemprop", "")}
        found = any(w.lower() in _GOOD for n in names for w in _WORDS.findall(n))
        self.good.append(2 if name in ("article", "main") or attributes.get("role") in ("main", "article") else int(found))
        if not raw.endswith("/") or name in _BLOCK or name in _RAW:
            self._open.append(this)
            self._held[name] = self._held.get(name, 0) + 1

    def _step(self, around: int, step: str) -> int:
        found = self._paths.setdefault((around, step), len(self._steps))
        if found == len(self._steps):
            self._steps.append((around, step))
        return found

    def path_name(self, number: int) -> str:
        steps = []
        while number:
            number, step = self._steps[number]
            steps.append(step)
        return ">".join(reversed(steps))

    def path_number(self, name: str) -> int:
        """Number of a path, -1 if the page has none such."""
        number = 0
        for step in name.split(">"):
            number = self._paths.get((number, step), -1)
            if number < 0:
                break
        return number

    @staticmethod
    def _junk(name: str, attributes: dict, classes: list[str]) -> bool:
        if name in _SKIP:
            return True
        if name in _NEVER_SKIPPED:
            return False
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in _ROLES:
            return True
        if "display:none" in attributes.get("style", "").replace(" ", "").lower():
            return True
        for value in (*classes, attributes.get("id", "")):
            parts = [w.lower() for w in _WORDS.findall(value)]
            if parts and parts[0] not in ("has", "no", "with", "without") and (parts[0] in _JUNK or parts[-1] in _JUNK):
                return True
        return False

    def _end_open(self, ends: set, limit) -> None:
        if not any(self._held.get(e) for e in ends):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag in ends:
                self._pop_to(depth)
                return
            if tag in limit:
                return

    def _close(self, name: str) -> None:
        if name in _BLOCK:
            self._block += 1
        for depth in range(len(self._open) - 1 if self._held.get(name) else 0, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag == name:
                if name not in ("body", "html"):
                    self._pop_to(depth)
                return
            if tag in _BLOCK and name not in _BLOCK:
                return

    def scores(self) -> dict[int, float]:
        """Score of each container: its text outside links, half of that for the container around it."""
        found: dict[int, float] = {}
        for _, element, text in self.pieces:
            n = len(text.strip())
            if not n or self.link[element]:
                continue
            holder = self.holder[element]
            for share in (1.0, 0.5):
                if holder <= 0:
                    break
                found[holder] = found.get(holder, 0.0) + share * n
                holder = self.holder[self.parent[holder]]
        best: dict[int, float] = {}
        for element, score in found.items():
            target = self.article[element] or element
            best[target] = max(best.get(target, 0.0), score * (1 + 0.5 * self.good[target]))
        return best

    def own(self, scores: dict[int, float]) -> int:
        """The page's own container, 0 if none."""
        if not scores:
            return 0
        first = min(scores, key=lambda e: (-scores[e], e))
        if self.article[first]:
            return first
        direct: dict[int, int] = {}
        for _, element, text in self.pieces:
            holder = self.holder[element]
            if holder and not self.link[element] and not self.article[holder]:
                direct[holder] = direct.get(holder, 0) + len(text.strip())
        longest = max(direct.values(), default=0)
        high = {first} | {e for e, n in direct.items() if n and n >= HIGH * longest}
        inside = [int(e in high) for e in range(len(self.tag))]
        for e in range(len(self.tag) - 1, 0, -1):  # an element comes after the one around it
            if inside[e] == len(high):
                return self.holder[e]
            inside[self.parent[e]] += inside[e]
        return 0

    def _inside(self, path: int) -> list[bool]:
        """Whether each element is inside one of the path; 0 is the whole page."""
        inside = [path == 0] * len(self.tag)
        for e in range(1, len(self.tag)):
            inside[e] = inside[e] or inside[self.parent[e]] or (self.path[e] == path and self.tag[e] in _BLOCK)
        return inside

    def held(self, path: int) -> int:
        """Characters outside links inside the elements of a path."""
        inside = self._inside(path)
        return sum(len(text.strip()) for _, e, text in self.pieces if inside[e] and not self.link[e])

    def votes(self) -> list[tuple[str, float]]:
        """The paths of the page's own and its best containers, with the share of its text that they hold."""
        scores = self.scores()
        own = self.own(scores)
        paths, around = [self.path[own]] if own else [], set()
        up = self.parent[own]
        while up > 0:
            around.add(up)
            up = self.parent[up]
        for e in sorted(scores, key=lambda e: (-scores[e], e)):
            if e not in around and self.path[e] not in paths and len(paths) < VOTES_PER_PAGE:
                paths.append(self.path[e])
        total = self.held(0) or 1
        return [(self.path_name(p), self.held(p) / total) for p in paths]

    def text(self, path: int) -> str:
        """Blocks inside the elements of a path, or of the whole page."""
        inside = self._inside(path)
        blocks: dict[int, list[str]] = {}
        for block, element, text in self.pieces:
            if inside[element]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks.values())
        return "\n".join(line for line in lines if line)


def extract(source: str, paths) -> str:
    """Main text of one page, given its host's winning paths."""
    page = Page(source)
    own = page.path[page.own(page.scores())]
    least = MIN_HELD * page.held(own)
    for name in paths if paths is not None else ():
        path = page.path_number(name)
        if path > 0 and page.held(path) >= least and (text := page.text(path)):
            return text
    return page.text(own) or page.text(0)


def main_text(pages: DataFrame, page_html: str = "html", url: str = "url", to: str = "main_text") -> DataFrame:
    """``pages`` plus the main text as column ``to``, which replaces one of that name."""

    @F.pandas_udf("array<struct<path:string,share:double>>")
    def votes(sources: pd.Series) -> pd.Series:
        return pd.Series([[{"path": p, "share": share} for p, share in Page(s).votes()] for s in sources])

    @F.pandas_udf("string")
    def again(sources: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(s, p) for s, p in zip(sources, paths)], dtype=object)

    host = F.lower(F.regexp_extract(whole(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    # One struct carries the row, so that its column names cannot clash with those used here.
    rows = pages.select(F.struct(*pages.columns).alias("_row"), host.alias("_host"), whole(page_html).alias("_html"))
    cast = rows.select("_host", F.explode(votes("_html")).alias("v"))
    ballot = cast.groupBy("_host", "v.path").agg(F.sum("v.share").alias("votes"))
    best = Window.partitionBy("_host").orderBy(F.round("votes", 6).desc(), "path")
    ranked = ballot.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= PATHS_PER_HOST)
    winners = ranked.groupBy("_host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("p"))
    # Written, so that its size is known: Catalyst broadcasts it below its threshold only, and above
    # it adaptive execution can split a host with very many pages.
    winners = stage(winners.select("_host", F.col("p.path").alias("_paths")), "host_paths")
    joined = rows.join(winners, "_host", "left").withColumn("_main", again("_html", "_paths"))
    return joined.select(*[F.col("_row")[c].alias(c) for c in pages.columns if c != to], F.col("_main").alias(to))
