"""Main text of a page as the maximum-scoring run of its words and tags.

A page is a sequence of words and tags. Words score positive and tags negative; words inside elements that never hold
an article (menus, adverts, forms ...) score negative as well. One linear scan finds the run with the highest sum: the
content region. What of the region lies in such elements is left out, and the rest becomes one line per block.

Tag scores are learned from labelled pages: pages whose markup names the article itself (an article or main element).
A tag costs the more words, the more surely it stands outside of articles. At most
``max_labelled`` such pages, taken by the hash of their id, are read for it; every page is extracted.

What marks boilerplate is an element's name, or a class, id or role all of whose words are marks or say nothing of a
role (``sidebar-left``; not ``no-sidebar``, ``comments-open``, ``search-history``). A class never marks an article or main
element, nor an element with over nine tenths of the words of the page.

Cases: null and empty html, and pages without words, give an empty text. Unclosed elements end with their parent, a
marked paragraph, item or cell with its next sibling, an unclosed comment, script or style with the page. A < that
begins no tag is text. Rows of equal ids are extracted each by itself. Tags beyond the ``max_tags`` most frequent ones of
the labelled pages, and those never seen there, have the default cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role, and the words in class, id and role that mark boilerplate.
RAW = frozenset(("script", "style", "noscript", "iframe", "textarea", "title"))  # without an end they reach to the end of the page
SILENT = RAW | {"template", "select", "svg", "object"}
BOILERPLATE = frozenset(("nav", "footer", "aside", "form", "button", "menu", "dialog"))
MARKED = frozenset((
    "ad", "ads", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright",
    "dialog", "disclaimer", "discussion", "disqus", "footer", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo",
    "recommended", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
))
#: marks that also hold for an article element inside; other marks on a wrapper do not reach into it
HARD = frozenset(("ad", "ads", "advert", "advertisement", "adverts", "comment", "comments", "discussion", "disqus", "promo", "recommended", "related", "replies", "reply", "sponsor", "sponsored"))
#: beginnings of words that mark like the words above; the first three hold for articles inside too
STEMS = ("comment", "advert", "sponsor", "sidebar", "cookie", "newsletter", "breadcrumb", "subscri")
#: words that say nothing of an element's role: with one of them beside it a mark still marks, with any other it does not
GENERIC = frozenset((
    "area", "article", "articles", "bar", "block", "blocks", "blog", "body", "bottom", "box", "boxes", "btn", "button", "buttons", "col", "column", "component", "container", "desktop", "entry", "fixed", "form", "global",
    "group", "hero", "holder", "icon", "icons", "inner", "item", "items", "js", "label", "left", "link", "links", "list", "lower", "main", "mobile", "module", "more", "news", "outer", "page", "panel", "policy", "post",
    "posts", "primary", "region", "right", "row", "secondary", "section", "site", "slot", "space", "spot", "sticky", "stories", "story", "text", "thread", "title", "top", "unit", "upper", "us", "user", "view", "wrap", "wrapper", "zone",
))
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr", "math", "mi", "mn", "mo", "mrow", "msup", "msub", "mfrac", "mtext",
))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
#: often left unclosed: on the stack only if they are marked, and what else than an end tag ends them
LOOSE = {
    "p": None, "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "tbody", "tfoot"), "td": ("td", "th", "tr"), "th": ("td", "th", "tr"), "option": ("option",),
    "thead": ("tbody", "tfoot"), "tbody": ("tbody", "tfoot"), "tfoot": ("tbody",), "html": (), "body": (),
}
CONTENT = frozenset(("article", "main"))

NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
STOP = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")  # words, those written together in mixed case too
SPACE = re.compile(r"\s+")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)

#: the cost, in words, of tags that were never seen, the largest cost, and the largest within an article
DEFAULT_COST, LARGEST_COST, INSIDE_COST = 2.0, 60.0, 0.3
#: an element with a larger share of the words of a page is no boilerplate, whatever its class says
MOST_WORDS = 0.9


def _marks(value: str) -> set[str]:
    """The marks of a class, id or role: all words of one of its names are marks or say nothing, and one is a mark."""
    found: set[str] = set()
    for name in value.split():
        parts = [p.lower() for p in PART.findall(name)]
        marks = {p for p in parts if p in MARKED} | {"comment" if p.startswith(STEMS[:3]) else "sidebar" for p in parts if p.startswith(STEMS) and p != "commentary"}
        if marks and all(p in MARKED or p in GENERIC or p.startswith(STEMS) for p in parts):
            found |= marks
    return found


def _marked(name: str, rest: str, in_content: bool) -> tuple[bool, bool]:
    """Whether the element is boilerplate by its attributes: for all in it, and for all but articles in it."""
    hard = soft = False
    for key, value in ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDDEN.search(value)):
            hard = True
        elif key in ("class", "id", "role") and name not in CONTENT:
            words = _marks(value)
            hard |= bool(words & HARD)
            soft |= bool(words - HARD - {"header", "masthead"} if in_content else words - HARD)
    return hard, soft


class Tags:
    """Tags of a page from left to right: (start, end, name, closes, attributes). Each look ahead either consumes what it
    passed or is made once for a page, so the time is linear. A < that begins no tag is text."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.last_end = page.rfind(">")
        self.endless: set[str] = set()

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        page, at = self.page, 0
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                end = len(page) if end < 0 else end + 3
                yield at, end, "", False, ""
                at = end
                continue
            if at > self.last_end:
                return
            closes = page.startswith("/", at + 1)
            named = NAME.match(page, at + 1 + closes)
            if named is None:
                if page[at + 1 : at + 2] not in ("!", "?", "/"):
                    at += 1
                    continue
                end = page.find(">", at) + 1
                yield at, end, "", False, ""
                at = end
                continue
            name, end = named.group().lower(), self._end(named.end())
            rest, start = page[named.end() : end - 1], at
            at = end
            if name not in SILENT or closes:
                yield start, end, name, closes, rest
            elif not (name in ("svg", "object") and rest.endswith("/")):
                at = self._after(name, end)
                yield start, at, "", False, ""

    def _end(self, at: int) -> int:
        """Behind the > of a tag; a > within quotes does not count, unless the quotes leave none."""
        first = self.page.find(">", at) + 1
        while self.quotes and (stop := STOP.search(self.page, at)):
            if stop.group() == ">":
                return stop.end()
            if stop.start() >= self.last[stop.group()]:
                break
            at = self.page.find(stop.group(), stop.end()) + 1
        self.quotes = False  # once quotes do not add up, they are not trusted any more
        return first

    def _after(self, name: str, at: int) -> int:
        """Behind the end tag of an element whose content is no text of the page."""
        if name not in self.endless:
            closing = re.compile(f"</{name}\\s*>", re.I).search(self.page, at)
            if closing:
                return closing.end()
            self.endless.add(name)
        return len(self.page) if name in RAW else at


def parse(page: str) -> list[tuple[str | None, str, bool, bool]]:
    """(tag, text, in boilerplate, in content element); a tag is its name, with / in front where it closes, None for text."""
    tokens: list[tuple[str | None, str]] = []
    words = [0]  # before each token
    opened: list[tuple[int, str, bool, bool, bool]] = []  # first token, name, marks; in the order of opening
    closed: dict[int, int] = {}  # element -> the token behind it
    stack: list[int] = []
    on_stack: Counter = Counter()
    inside = at = 0

    def add(tag: str | None, text: str = ""):
        tokens.append((tag, text))
        words.append(words[-1] + (len(text.split()) if tag is None else 0))

    def text(piece: str):
        if piece:
            add(None, " " if piece.isspace() else html.unescape(piece))

    def pop() -> str:
        nonlocal inside
        element = stack.pop()
        closed[element] = len(tokens)
        name = opened[element][1]
        on_stack[name] -= 1
        inside -= name in CONTENT
        return name

    for start, end, name, closes, rest in Tags(page):
        text(page[at:start])
        at = end
        if not name:
            continue
        if closes:
            if on_stack[name]:
                while pop() != name:
                    pass
            add("/" + name)
            continue
        while stack and (top := opened[stack[-1]][1]) in LOOSE and (name in LOOSE[top] if LOOSE[top] is not None else name not in INLINE):
            pop()
        if name not in VOID and not rest.endswith("/") and name not in ("html", "body"):
            by_name = name in BOILERPLATE or (name == "header" and inside == 0)
            hard, soft = _marked(name, rest, inside > 0)
            if by_name or hard or soft or not (name in INLINE or name in LOOSE):
                stack.append(len(opened))
                opened.append((len(tokens), name, by_name, hard, soft))
                on_stack[name] += 1
                inside += name in CONTENT
        add(name)
    text(page[at:])
    while stack:
        pop()
    return _placed(tokens, words, opened, closed)


def _placed(tokens: list, words: list[int], opened: list, closed: dict[int, int]) -> list[tuple[str | None, str, bool, bool]]:
    """The tokens with what holds for them; marks on an element with most of the words are void."""
    out, stack, ends = [], [], []
    hard = soft = inside = following = 0
    for i, (tag, text) in enumerate(tokens):
        while ends and ends[-1] <= i:
            ends.pop()
            hard, soft, inside = stack.pop()
        while following < len(opened) and opened[following][0] == i:
            _, name, by_name, is_hard, is_soft = opened[following]
            end = closed[following]
            if words[end] - words[i] > MOST_WORDS * words[-1]:
                by_name, is_hard, is_soft = by_name and name != "form", False, False
            stack.append((hard, soft, inside))
            ends.append(end)
            hard, soft, inside = hard + (by_name or is_hard), (0 if name in CONTENT else soft) + is_soft, inside + (name in CONTENT)
            following += 1
        out.append((tag, text, hard + soft > 0, inside > 0))
    return out


def count_tags(page: str) -> Counter:
    """(tag or word, inside the named article) -> times, outside of boilerplate, which the scan knows without them."""
    found: Counter = Counter()
    for tag, text, dead, inside in parse(page):
        if dead:
            continue
        if tag is None:
            found["", inside] += len(text.split())
        else:
            found[tag, inside and tag not in CONTENT] += 1
    return found


def tag_costs(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """What a tag costs, in words: the square of the log odds that it stands outside of articles; little if it is inside."""
    costs = {}
    for tag in {t for t, _ in counts if t}:
        inside, outside = (counts.get((tag, side), 0) + 0.5 for side in (True, False))
        costs[tag] = min(LARGEST_COST, max(0.3, math.log2(outside / inside)) ** 2)
    return costs


def _score(tag: str | None, text: str, dead: bool, inside: bool, costs: dict[str, float]) -> float:
    """Words of boilerplate count against a run, but for those within the article itself, which are only left out; there
    tags cost little, and it is the article's own tags that hold a run back."""
    if tag is None:
        return float(len(text.split())) if not dead else 0.0 if inside else -float(len(text.split()))
    if inside and tag.lstrip("/") not in CONTENT:
        return 0.0 if dead else -min(INSIDE_COST, costs.get(tag, INSIDE_COST))
    return -costs.get(tag, DEFAULT_COST)


def main_text(page: str | None, costs: dict[str, float]) -> str:
    if not page:
        return ""
    tokens = parse(page)
    best, best_span, run, start = 0.0, (0, 0), 0.0, 0
    for i, (tag, text, dead, inside) in enumerate(tokens):
        run += _score(tag, text, dead, inside, costs)
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, best_span = run, (start, i + 1)
    blocks, line = [], []

    def close():
        joined = SPACE.sub(" ", "".join(line)).strip()
        if joined:
            blocks.append(joined)
        line.clear()

    for tag, text, dead, _ in tokens[slice(*best_span)]:
        if tag is None:
            if not dead:
                line.append(text)
        elif tag.lstrip("/") == "br":
            line.append(" ")
        elif tag.lstrip("/") not in INLINE:
            close()
    close()
    return "\n".join(blocks)


def _learn(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()
    for batch in part:
        for page in batch.column(0).to_pylist():
            found.update(count_tags(page))
    rows = sorted(found.items())
    yield pa.RecordBatch.from_arrays([pa.array([t for (t, _), _ in rows], pa.string()), pa.array([s for (_, s), _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())], names=["tag", "inside", "n"])


def learn_costs(pages: DataFrame, max_labelled: int = 1000, max_tags: int = 500, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Costs of the most frequent tags, from labelled pages."""
    named = pages.where(F.lower(html_col).rlike("<(article|main)[ >]")).select(F.col(id_col), F.col(html_col))
    chosen = named.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(id_col), id_col).limit(max_labelled)
    sample = named.join(F.broadcast(chosen), id_col).select(html_col)
    counts = sample.mapInArrow(_learn, "tag string, inside boolean, n long").groupBy("tag").agg(F.sum(F.when(F.col("inside"), F.col("n"))).alias("i"), F.sum(F.when(~F.col("inside"), F.col("n"))).alias("o"))
    rows = counts.orderBy(F.desc(F.coalesce("i", F.lit(0)) + F.coalesce("o", F.lit(0))), "tag").limit(max_tags + 1).collect()
    return tag_costs({(r["tag"], side): r[k] or 0 for r in rows for side, k in ((True, "i"), (False, "o"))}) if rows else {}


def _extract(part: Iterator[pa.RecordBatch], costs: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in part:
        texts = [main_text(p, costs) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, costs: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    costs = learn_costs(pages, id_col=id_col, html_col=html_col) if costs is None else costs
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return narrow.mapInArrow(partial(_extract, costs=costs), "page_id long, url string, text string, n_chars long")
