"""Main text of web pages: flat text blocks, their neighbours, and a decision tree.

A page is cut into blocks at block-level tags.  A block's features are the word counts and link densities
of itself and of the blocks before and after it, and the kinds of containers it stands in.  A decision tree
that is grown on the small labelled pages below says which blocks are main text.
"""

from __future__ import annotations

import bisect
import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "select", "textarea", "canvas"}
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
QUOTED = re.compile(r"(?:[^'\">]|\"[^\"]*\"|'[^']*')*>")
COMMENT_END = re.compile(r"--!?>")
HINT = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD_IN_HINT = re.compile(r"[a-z]+")

#: Elements whose content is code, and ends with the page at the latest; other raw elements without an end tag end
#: where a block begins or ends.
CODE = {"script", "style"}
BREAK = (r"(?=</?(?:address|article|aside|blockquote|body|center|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|"
         r"p|pre|section|table|td|th|tr|ul)[\s/>])")
RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "iframe", "object", "select",
                                                       "textarea", "canvas", "title")}
SVG_STEP = re.compile(rf"(?P<foreign><foreignobject[\s/>])|</svg\s*>|{BREAK}", re.I)
FOREIGN_END = re.compile(r"</foreignobject\s*>", re.I)
BLOCK_EDGE = re.compile(BREAK, re.I)
#: What a head may hold; any other tag ends it.
HEAD_TAGS = {"head", "title", "meta", "link", "base", "basefont", "bgsound", "noframes"}

INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "nobr", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr",
          "math", "mi", "mo", "mn", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom",
          "mspace", "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts",
          "mprescripts", "none", "mtable", "mtr", "mlabeledtr", "mtd", "maction", "semantics", "annotation", "annotation-xml"}
CONTAINERS = {"article", "aside", "blockquote", "body", "dialog", "div", "fieldset", "footer", "form", "header", "main",
              "menu", "nav", "ol", "section", "table", "ul"}
MAIN_TAGS = {"article", "main"}
SIDE_TAGS = {"nav", "aside", "footer", "form", "dialog", "fieldset", "menu", "button"}
#: Words of class, id and role that name what is not the article.
SIDE_HINTS = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
              "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "header", "login", "masthead",
              "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager", "pagination", "popup",
              "promo", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
              "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
MAIN_HINTS = {"article", "content", "entry", "main", "post", "story", "text"}
#: A name is that of a side part if its last word is such a word, or all others are of these (``comment-list``), but not
#: if it says what a layout has or has not (``has-sidebar``).
FILLERS = MAIN_HINTS | {
    "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "column", "container", "group", "icons", "inner",
    "item", "items", "left", "links", "list", "module", "outer", "page", "panel", "posts", "region", "right", "row", "section", "site",
    "slot", "sticky", "stories", "this", "thread", "top", "unit", "wrap", "wrapper"}
EXCEPTIONS = {"has", "have", "hide", "hidden", "is", "no", "not", "with", "without"}
#: Words that make a header one of the article.
ARTICLE_WORDS = {"article", "content", "entry", "post", "story"}
#: Side tags that an article inside of them cannot be the main text of.
STRICT_SIDE = SIDE_TAGS - {"form", "fieldset"}

FEATURES = ("in_side", "in_main", "main_on_page", "in_main_hint", "link_density", "words", "link_density_before",
            "words_before", "link_density_after", "words_after", "is_heading", "in_list")


class Block:
    __slots__ = ("parts", "words", "linked", "flags")

    def __init__(self, parts: list[str], words: int, linked: int, flags: tuple):
        self.parts, self.words, self.linked, self.flags = parts, words, linked, flags

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def names_side(attributes: str, inside: bool) -> bool:
    """Whether class, id or role name a side part; ``inside`` of a main part a header is the article's own."""
    for kind, *values in HINT.findall(attributes):
        value = "".join(values).lower()
        for name in [value] if kind.lower() == "aria-label" else value.split():
            words = WORD_IN_HINT.findall(name)
            found = SIDE_HINTS.intersection(words)
            if not found or EXCEPTIONS.intersection(words):
                continue
            if words[-1] not in found and any(w not in found and w not in FILLERS and len(w) > 1 for w in words):
                continue
            if found != {"header"} or not (inside or ARTICLE_WORDS.intersection(words)):
                return True
    return False


class Tags:
    """Tags and comments of a page in order, in time that grows with its length, whatever is left open in it.

    A tag ends at the first ``>`` outside of quotes.  Where there is none, the ``<`` is text.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.name_end = 0  # up to here no name ends: a name may hold further ``<``
        self.ends: dict[int, int] | None = None
        self.specials: list[int] = []

    def end(self, at: int) -> int:
        """Behind the ``>`` that ends a tag whose attributes begin at ``at``, or -1."""
        if self.ends is None:
            found = QUOTED.match(self.page, at)
            if found:
                return found.end()
            self._all_ends()  # an open quote: work out all ends once instead of once per tag
        k = bisect.bisect_left(self.specials, at)
        return self.ends[k]

    def _all_ends(self) -> None:
        """For each quote and ``>`` where a tag ends that goes on in front of it."""
        self.specials = [m.start() for m in re.finditer("[\"'>]", self.page)]
        n = len(self.specials)
        self.ends = {n: -1}
        following = {"'": n, '"': n}  # the next such quote
        for k in range(n - 1, -1, -1):
            c = self.page[self.specials[k]]
            if c == ">":
                self.ends[k] = self.specials[k] + 1
            else:
                self.ends[k] = self.ends[following[c] + 1] if following[c] < n else -1
                following[c] = k

    def next(self, at: int) -> tuple[int, int, str, bool, int] | None:
        """Start, end, name (empty for comments), whether it closes, and where the attributes begin, of the next tag."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            at = i + 1
            if page.startswith("<!--", i):
                found = COMMENT_END.search(page, i + 4)
                return i, found.end() if found else len(page), "", False, i
            if page[at:at + 1] in ("!", "?"):
                end = page.find(">", at)
                return i, end + 1 if end >= 0 else len(page), "", False, i
            if i > self.last:
                continue
            closing = page[at:at + 1] == "/"
            first = at + closing
            if not (page[first:first + 1].isascii() and page[first:first + 1].isalpha()):
                continue
            if first >= self.name_end:
                self.name_end = NAME.match(page, i).end()
            begin = self.name_end
            if begin - first > 100:  # no name that means anything
                end = self.end(begin)
                if end >= 0:
                    return i, end, "x-long", closing, begin
                continue
            name = page[first:begin].lower()
            end = self.end(begin)
            if name in RAW and not closing and not (end >= 0 and page[end - 2] == "/"):
                end = page.find(">", begin) + 1 or -1
            if end >= 0:
                return i, end, name, closing, begin
        return None


def raw_end(page: str, name: str, at: int, endless: set[str]) -> int:
    """Where the raw element ends whose content begins at ``at``; ``endless`` are names without further end tags."""
    if name == "svg":
        while m := SVG_STEP.search(page, at):
            if not m["foreign"]:
                return m.end()
            at = m.end()
            end = None if "foreignobject" in endless else FOREIGN_END.search(page, at)
            if end:
                at = end.end()
            else:
                endless.add("foreignobject")
        return len(page)
    end = None if name in endless else RAW_END[name].search(page, at)
    if end:
        return end.end()
    endless.add(name)
    edge = None if name in CODE else BLOCK_EDGE.search(page, at)
    return edge.start() if edge else len(page)


class Place(NamedTuple):
    """An open container, and what holds for a block inside of it and of all that it stands in."""

    name: str = ""
    main: bool = False
    side: bool = False
    held_side: bool = False  # a side part that an article inside of it does not free
    strict: bool = False
    hint: bool = False
    listed: bool = False

    def open(self, name: str, main: bool, side: bool, hint: bool, frees: int) -> "Place":
        """``frees``: 2 takes back all side parts around, 1 all but strict ones if the page has no other main text."""
        before = (False, False, False) if frees == 2 else (self.side, self.strict if frees else self.held_side, self.strict)
        return Place(name, self.main or main, before[0] or side, before[1] or side, before[2] or (side and name in STRICT_SIDE),
                     self.hint or hint, self.listed or name in ("ul", "ol"))


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, without scripts, styles, comments and empty blocks."""
    out: list[Block] = []
    stack = [Place()]
    opened: Counter[str] = Counter()
    freed: list[bool] = []  # per block: whether it is no side block if there is no other main text
    held: list[str] = []
    words = linked = 0
    anchor, leaf = False, ""

    def flush() -> None:
        nonlocal held, words, linked
        if words:
            top = stack[-1]
            freed.append(top.side and not top.held_side)
            out.append(Block(held, words, linked, (top.side, top.main, top.hint, leaf[:1] == "h" and leaf != "header", top.listed)))
        held, words, linked = [], 0, 0

    def text(piece: str) -> None:
        nonlocal words, linked
        piece = html.unescape(piece)
        n = len(piece.split())
        held.append(piece)
        words += n
        linked += n if anchor else 0

    at = 0
    page = page or ""
    tags = Tags(page)
    endless: set[str] = set()
    head = False
    while tag := tags.next(at):
        start, end, name, closing, begin = tag
        if start > at:
            head = head and page[at:start].isspace()
            if not head:
                text(page[at:start])
        at = end
        if name in RAW and not closing:
            head = head and name not in ("iframe", "svg", "object", "select", "textarea", "canvas")
            if name in CODE or page[end - 2] != "/":
                at = raw_end(page, name, at, endless)
            continue
        if not name:
            continue
        if name == "head":
            head = not closing
        elif head and not closing:
            head = name in HEAD_TAGS
            if name == "title":
                at = raw_end(page, name, at, endless)
        if name in INLINE:
            if name == "a":
                anchor = not closing
            elif name == "br":
                held.append(" ")
            continue
        flush()
        anchor = False
        leaf = "" if closing else name
        if name not in CONTAINERS:
            continue
        attributes = page[begin:end - 1]
        if closing:
            while opened[name]:
                last = stack.pop().name
                opened[last] -= 1
                if last == name:
                    break
        elif not attributes.endswith("/"):
            found = HINT.findall(attributes)
            hints = {w for h in found for w in WORD_IN_HINT.findall("".join(h[1:]).lower())}
            inside = stack[-1].main
            named = names_side(attributes, inside)
            marked = name == "main" or any(h[0].lower() == "role" and "main" in "".join(h[1:]).lower().split() for h in found)
            side = name in SIDE_TAGS or (name == "header" and not inside) or (
                name not in ("body", "article") and not marked and named)
            stack.append(stack[-1].open(name, name in MAIN_TAGS or "main" in hints, side, bool(hints & MAIN_HINTS),
                                        2 if marked else 1 if name == "article" and not named else 0))
            opened[name] += 1
    if at < len(page):
        text(page[at:])
    flush()
    if not any(b.flags[1] and not b.flags[0] for b in out):
        for b, free in zip(out, freed):
            b.flags = (b.flags[0] and not free, *b.flags[1:])
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; a missing neighbour has no words."""
    n = len(found)
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked / b.words for b in found], float)
    out = np.zeros((n, len(FEATURES)))
    flags = np.array([b.flags for b in found], float)
    out[:, :2], out[:, 2], out[:, 3], out[:, 10:] = flags[:, :2], flags[:, 1].max(), flags[:, 2], flags[:, 3:]
    out[:, 4], out[:, 5] = density, words
    out[1:, 6], out[1:, 7] = density[:-1], words[:-1]
    out[:-1, 8], out[:-1, 9] = density[1:], words[1:]
    return out


#: Labelled pages: a block whose text starts with ``+`` is main text, one that starts with ``-`` is not.
LABELLED = (
    "<nav><ul><li><a>-home</a></li><li><a>-news and sport</a></li></ul></nav><div class=ad>-buy two now pay for one later</div>"
    "<article><h1>+a headline</h1><p>+a first paragraph with some more words in it than the headline has</p><p>+short.</p>"
    "<p>+<a>a paragraph that is a link and nothing else</a></p><ul><li>+one thing</li><li>+<a>another thing</a></li></ul>"
    "<aside>-about the writer of this long article who lives by the sea</aside><p>+the end of the article with a few words</p>"
    "<div class=comments><p>-first comment of a reader with quite a few words in it that go on and on for a while</p></div>"
    "</article><footer>-copyright and address</footer>",
    "<header><h1>-the name of the site</h1></header><main><h2>+title</h2><p>+text of the page that has a number of words in it</p>"
    "<blockquote>+quoted words</blockquote><form><label>-your name</label><p>-write to us and we will answer within a day or two</p>"
    "</form><table><tr><td>+cell</td><td>+another cell</td></tr></table></main><section class=sidebar><h3>-most read</h3>"
    "<p>-a teaser of another article with many words that could be text but is not part of it</p></section>",
    "<div id=menu><a>-one</a> <a>two</a></div><div id=content><h1>+what happened</h1><p>+it happened in the morning when nobody "
    "was looking and it was over before noon came</p><p>+yes.</p><p>+then a second long sentence follows with as many words as the "
    "first one had</p></div><div class=cookie-notice><p>-we use cookies to make this site work and to count how many visitors "
    "come here</p></div><div class=footer>-terms</div>",
    "<p><a>-start</a> | <a>archive</a> | <a>contact</a></p><p>+a page without any containers still has a text and this is its "
    "first paragraph with enough words to tell</p><p>+the second paragraph also has quite a number of words so that it "
    "looks like running text</p><p>+the third one closes the text and it is again a sentence of sensible length here</p>"
    "<p><a>-next page</a></p><p>-(c) us</p>",
    "<nav><a>-top</a></nav><p>-today is monday</p><article><h1>+a page that breaks off</h1><p>+its last block is in the article and",
    "<article><p>+nothing but a text</p></article>",
    "<main>+a word</main>",
    "+a page without any markup is a text as it stands and has no other blocks before or after it",
    "<p>-home</p><main><p>+short</p><p>+<a>linked words</a></p></main><p>-a line below the text that is not in it and has as many "
    "words as a paragraph of the text would have</p>",
    "<p><a>-a</a></p><p>+one more text without containers whose paragraphs are long enough to be told from lists of links</p>"
    "<p>+and it ends with a paragraph of some length after which there is nothing at all on the page</p>",
    "<div class=header>-welcome</div><article><p>+only one paragraph stands here</p></article><div class=related><p>-read this as "
    "well it is about the same thing and has a long text for a teaser</p></div><aside><p>-weather today is fine with some sun and "
    "little wind from the west all day long</p></aside><p>-all rights reserved</p>",
    "<div class='layout has-sidebar'><nav><a>-start</a></nav><article><div class=article-header><h1>+a text beside a sidebar</h1></div><p>+its "
    "first paragraph has as many words as others</p><section id=related-work><p>+what others wrote about it before</p></section>"
    "</article><div class=sidebar><article><p>-a teaser of something else that is longer than the paragraphs of the text</p></article></div></div>",
    "<div class=sticky-header><p>-the name of the site</p><main><p>+the text stands inside of a header that sticks</p></main></div>",
    "<div class=search><article><p>+the only article of the page</p><div class=comments><p>-a comment below it</p></div></article></div>",
)


#: Further labelled pages, made by ``plain_page``, in which nothing names the surroundings of the text.
PLAIN_PAGES, PLAIN_SEED = 150, 7


def plain_page(draw: random.Random) -> str:
    """A labelled page of divs and paragraphs, sometimes with the text marked: link lists and short lines around it.

    Menus are short and linked, teasers linked lines of some length, notices short lines next to them; the text is a
    heading and paragraphs, a few of which are short or mostly linked.
    """
    def words(low: int, high: int) -> str:
        return " ".join("word" for _ in range(draw.randint(low, high)))

    def link(text: str) -> str:
        return f"<a href=x>{text}</a>"

    def line(mark: str, inner: str) -> str:
        tag = draw.choice(["div", "p"])
        return f"<{tag}>{mark}{inner}</{tag}>"

    def around() -> list[str]:
        kinds = [lambda: link(words(1, 3)), lambda: " ".join(link(words(1, 2)) for _ in range(draw.randint(2, 8))), lambda: link(words(4, 12)),
                 lambda: words(1, 5), lambda: words(1, 2) + " " + link(words(1, 6)), lambda: words(2, 8) + " " + link(words(2, 5))]
        return [line("-", draw.choice(kinds)()) for _ in range(draw.randint(1, 7))]

    text = [f"<h1>+{words(3, 10)}</h1>", line("+", words(18, 60))]
    for _ in range(draw.randint(1, 8)):
        kind = draw.random()
        text.append(line("+", words(16, 70) if kind < 0.75 else words(10, 30) + " " + link(words(1, 5)) + " " + words(4, 20) if kind < 0.9 else words(3, 9)))
    text.append(line("+", words(18, 60)))
    before, after = (around() if draw.random() < 0.8 else [] for _ in range(2))
    if draw.random() < 0.4:  # a marked text may hold links and short lines, and what is outside of it may be long
        before.append(line("-", words(12, 50)))
        after[:0] = [line("-", words(12, 50))] * draw.randint(0, 1)
        for _ in range(6):
            more = [line("+", words(1, 9)), line("+", link(words(1, 9))), f"<ul><li>+{words(1, 3)}</li></ul>", f"<aside>{line('-', words(1, 50))}</aside>",
                    f"<aside>{line('-', link(words(1, 20)))}</aside>"]
            text.insert(draw.randint(0, len(text)), draw.choice(more))
        tag = draw.choice(["article", "main"])
        text = [f"<{tag}>", *text, line("+", words(1, 60)) if draw.random() < 0.5 else "", f"</{tag}>"]
    inner = "".join(text)
    return "".join(before) + (f"<div>{inner}</div>" if draw.random() < 0.5 else inner) + "".join(after)


def labelled_pages() -> list[str]:
    draw = random.Random(PLAIN_SEED)
    return [*LABELLED, *(plain_page(draw) for _ in range(PLAIN_PAGES))]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1: main text) of the blocks of the labelled pages."""
    rows, labels = [], []
    for page in labelled_pages():
        found = blocks(page)
        rows.append(features(found))
        labels += [int(b.text[0] == "+") for b in found]
    return np.concatenate(rows), np.array(labels)


class Tree:
    """A decision tree on numbers: splits that lower the Gini impurity most, until leaves are pure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 10):
        self.value = float(y.mean())
        self.split: tuple[int, float, Tree, Tree] | None = None
        best = None
        if depth and 0 < self.value < 1:
            for f in range(x.shape[1]):
                for low, high in zip(np.unique(x[:, f]), np.unique(x[:, f])[1:]):
                    cut = (low + high) / 2
                    left = x[:, f] <= cut
                    impurity = sum(s.sum() * y[s].mean() * (1 - y[s].mean()) for s in (left, ~left))
                    if best is None or impurity < best[0] - 1e-12:
                        best = impurity, f, cut, left
        if best is not None:
            _, f, cut, left = best
            self.split = f, cut, Tree(x[left], y[left], depth - 1), Tree(x[~left], y[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.split is None:
            return np.full(len(x), self.value)
        f, cut, low, high = self.split
        left = x[:, f] <= cut
        out = np.empty(len(x))
        out[left], out[~left] = low.predict(x[left]), high.predict(x[~left])
        return out


@lru_cache(1)
def tree() -> Tree:
    return Tree(*labelled_table())


def main_blocks(page: str | None) -> list[Block]:
    found = blocks(page)
    if not found:
        return []
    return [b for b, p in zip(found, tree().predict(features(found))) if p >= 0.5]


def main_text(page: str | None) -> str:
    """White space inside a block is one space; blocks are joined by a line break."""
    return "\n".join(b.text for b in main_blocks(page))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_main`` per row; nothing is shuffled.

    A null page, and one without main text, gives an empty text.  Pages may be cut off anywhere: what is open
    at the end counts as closed.  Repeated rows and null ids are kept; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, main = [], [], []
            for page in batch.column(2):
                found = blocks(page.as_py())
                kept = [b for b, p in zip(found, tree().predict(features(found))) if p >= 0.5] if found else []
                texts.append("\n".join(b.text for b in kept))
                total.append(len(found))
                main.append(len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 *(pa.array(v, pa.int64()) for v in (map(len, texts), total, main))],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html")).mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint, n_blocks bigint, n_main bigint")
