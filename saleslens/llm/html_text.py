"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks, each with its number of words and link density
(and those of the blocks before and after it), and what encloses it. A decision tree
tells article text from the rest; it is trained, in a moment, on the labelled blocks of
``LABELLED`` and of drawn pages: on some what encloses a block decides (``marked_page``),
on others only words, links and neighbours do (``plain_page``). Markup may be broken or cut off at any place.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saleslens.llm.rows import slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s>/][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?")
WORD = re.compile(r"[a-z]+")

# Elements by what they mean for text blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe xmp noembed noframes".split())  # to the end of the page if never closed
SKIPPED = set("noscript template svg object canvas select audio video".split())  # left out if closed
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
             "strong sub sup time tt u var wbr img br math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded "
             "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
             "none semantics annotation annotation-xml".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BOILER = set("nav aside form menu footer header button dialog fieldset head datalist".split())
MAIN = set("article main".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
               "hr main menu nav ol p pre section table ul".split())
# Words in class, id or role that name other things than an article.
HINTS = set("ad ads advert advertisement advertising adverts adsense banner banners sponsor sponsored promo promos promotion cookie "
            "cookies consent gdpr notice notices alert alerts notification popup modal overlay newsletter subscribe subscription sidebar "
            "widget widgets menu nav navigation navbar breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments "
            "commentlist disqus respond reply replies discussion responses related recommended share sharing social login signin signup "
            "search pagination pager legal copyright disclaimer complementary contentinfo tags byline meta skip".split())
# Of those, words of a page's layout, or of an article's own sections.
LAYOUT = set("banner banners notice notices alert alerts notification modal overlay sidebar widget widgets menu nav navigation navbar "
             "breadcrumb breadcrumbs footer header masthead topbar toolbar respond discussion responses related recommended share sharing "
             "social search pagination pager legal copyright disclaimer tags byline meta skip".split())
# Words that go with them in a name ("ad-slot", not "share-price").
BESIDES = set("area article bar block body bottom box button buttons card col container content form group header inner item items js left "
              "link links list main module outer page panel post posts right row section site slot small story strip text thread title "
              "top unit user wrap wrapper".split())
BESIDE = set("has with without no".split())  # class="with-sidebar" is no sidebar


def hints_at(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether the attributes name the element as other than an article.

    On <article> and <main> only a whole name that is not about layout does
    (class="comment", not "with-sidebar" or "has-comments"). Inside an article every word
    of a class name must be such a word or go with one (class="share-buttons", not
    "share-price"). Ids are also anchors: on headings they say nothing, inside an article
    only what is not about layout.
    """
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("hidden", "aria-hidden"):
            if value != "false":
                return True
        elif tag in MAIN:
            if name in ("class", "id", "role") and any(
                    "".join(WORD.findall(x)) in HINTS - LAYOUT and len(WORD.findall(x)) == 1 for x in value.split()):
                return True
        elif name == "id":
            if tag not in HEADINGS and not (HINTS - LAYOUT if in_main else HINTS).isdisjoint(WORD.findall(value)):
                return True
        elif name == "class":
            words = [WORD.findall(x) for x in value.split()]
            if any(x and x[0] not in BESIDE and not HINTS.isdisjoint(x) and (not in_main or HINTS.union(BESIDES).issuperset(x))
                   for x in words):
                return True
        elif name in ("role", "itemprop", "aria-label") and not HINTS.isdisjoint(WORD.findall(value)):
            return True
    return False


def closed_elements(page: str, tag: str) -> dict[int, int]:
    """Start of every ``tag`` element that is closed -> its end; elements may nest."""
    opened, out = [], {}
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?![^\s/>])[^>]*(?:>|\Z)", page, re.I):
        if not m[1]:
            if not m[0].endswith("/>"):
                opened.append(m.start())
        elif opened:
            out[opened.pop()] = m.end()
    return out


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: int
    boiler: int
    hint: int
    heading: int


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    open: list[tuple[str, int, int, int]] = field(default_factory=list)  # tag, main, boiler, hint
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def depth(self) -> tuple[int, int, int]:
        return self.open[-1][1:] if self.open else (0, 0, 0)

    def add(self, text: str) -> None:
        self.parts.append(text)
        if any(x[0] == "a" for x in self.open):
            self.linked += len(text.split())

    def flush(self) -> None:
        words = "".join(self.parts).split()
        if words:
            main, boiler, hint = self.depth()
            heading = int(any(x[0] in HEADINGS for x in self.open))
            self.blocks.append(Block(" ".join(words), len(words), min(self.linked, len(words)), main, boiler, hint, heading))
        self.parts, self.linked = [], 0

    def close(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                # an inline end tag does not close the blocks around it
                if tag in INLINE and any(x[0] not in INLINE for x in self.open[i + 1:]):
                    del self.open[i]
                else:
                    del self.open[i:]
                return

    def begin(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P and any(x[0] == "p" for x in self.open):
            self.close("p")
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            for x in reversed(self.open):
                if x[0] in ("ul", "ol", "dl", "table", "menu"):
                    break
                if x[0] == tag:
                    self.close(tag)
                    break
        elif tag == "a":
            self.close("a")
        main, boiler, hint = self.depth()
        hinted = bool(attributes) and hints_at(tag, attributes, main > 0)
        if tag in MAIN and not hinted:
            main += 1
        elif tag in BOILER and not (tag == "header" and main and not hinted):
            boiler += 1
        if hinted and tag not in ("html", "body"):
            hint += 1
        self.open.append((tag, main, boiler, hint))


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order; text is decoded, its white space single spaces."""
    state, at, page = _Page(), 0, page or ""
    closed: dict[str, dict[int, int]] = {}
    while at < len(page):
        m = TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            state.add(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        ends, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            state.parts.append(" ")
            continue
        if tag not in INLINE:
            state.flush()
        if ends:
            state.close(tag)
        elif tag in RAW and not attributes.endswith("/"):
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = found.end() if found else len(page)
        elif tag in SKIPPED:
            if tag not in closed:
                closed[tag] = closed_elements(page, tag)
            at = max(at, closed[tag].get(m.start(), at))
        elif tag not in VOID:
            state.begin(tag, attributes)
    state.flush()
    return state.blocks


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after",
            "main", "boiler", "hint", "heading", "page has main")


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block, columns as ``FEATURES``."""
    if not blocks:
        return np.empty((0, len(FEATURES)))
    own = np.array([[b.words, b.linked / b.words] for b in blocks], float)
    edge = np.zeros((1, 2))
    rest = np.array([[b.main > 0, b.boiler > 0, b.hint > 0, b.heading] for b in blocks], float)
    whole = np.full((len(blocks), 1), float(rest[:, 0].any()))
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), rest, whole])


# --- the labelled table: fragments of pages with 1 for article text, 0 for the rest,
# None for markup without text of its own

_LONG = "Under the old bridge the river runs slowly and the boats wait for the morning light to come."
_MORE = "They talked for an hour about the harvest, the price of grain and who would mend the mill."
_SHORT = "It rained."
_NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>World news</a></li><li><a href='/c'>Sport</a></li></ul></nav>"
_LINKS = "<ul><li><a href='/1'>First page of the list</a></li><li><a href='/2'>Another story to read</a></li></ul>"

LABELLED: list[list[tuple[str, int | None]]] = [
    [(_NAV, 0), (f"<div class='ad'>{_SHORT}</div>", 0), (f"<div class='ad'>{_LONG}</div>", 0), ("<article>", None),
     ("<h1>The bridge</h1>", 1), (f"<p>{_LONG}</p>", 1), (f"<p>{_SHORT}</p>", 1), (f"<p>{_MORE} <a href='/x'>mill</a></p>", 1),
     ("</article>", None), (f"<footer>&copy; All rights. {_SHORT}</footer>", 0)],
    [("<header><a href='/'>The Daily</a> <p>News since 1901</p></header>", 0), (_NAV, 0), ("<main>", None), ("<h1>Harvest</h1>", 1),
     (f"<p>{_MORE}</p>", 1), ("<h2>Later</h2>", 1), (f"<ul><li>{_SHORT}</li><li>{_MORE}</li></ul>", 1),
     (f"<blockquote>{_LONG}</blockquote>", 1), (f"<aside>{_MORE}</aside>", 0), (f"<p>{_LONG}</p>", 1),
     (f"<div class='comments'><p>{_LONG}</p><p>{_SHORT}</p></div>", 0), ("</main>", None), (f"<footer><p>{_MORE}</p></footer>", 0)],
    [(f"<div class='cookie-notice'>{_LONG}</div>", 0), ("<div id='menu'><a href='/'>Start</a> <a href='/n'>New</a></div>", 0),
     ("<div class='content'>", None), ("<h1>The mill</h1>", 1), (f"<p>{_LONG}</p>", 1), (f"<p>{_MORE}</p>", 1),
     (f"<div>{_LONG} {_MORE}</div>", 1), (f"<p>{_SHORT}</p>", 1), (f"<p>{_MORE}</p>", 1), ("</div>", None), (_LINKS, 0),
     (f"<form><p>{_SHORT}</p><label>Your name</label><button>Send</button></form>", 0), (f"<div class='sidebar'><p>{_MORE}</p></div>", 0)],
    [(_LINKS, 0), (f"<p>{_LONG}</p>", 1), (f"<p>{_MORE}</p>", 1), (f"<p>{_LONG} <a href='/y'>boats</a></p>", 1), (_LINKS, 0),
     ("<p><a href='/imprint'>Imprint</a> <a href='/p'>Privacy</a></p>", 0)],
    [("<article>", None), ("<header><h1>Boats</h1></header>", 1), (f"<p>{_SHORT}</p>", 1),
     (f"<div class='share'>{_SHORT}</div>", 0), (f"<p>{_SHORT}</p>", 1), ("<p><a href='/z'>A whole linked line of text</a></p>", 1),
     (f"<section class='related'><h2>More</h2>{_LINKS}</section>", 0), (f"<footer>{_SHORT}</footer>", 0), ("</article>", None),
     (f"<section id='comments'><p>{_MORE}</p><div>{_LONG}</div></section>", 0), (f"<aside><p>{_LONG}</p></aside>", 0),
     (f"<div>{_SHORT}</div>", 0), (_LINKS, 0), (f"<div>{_MORE}</div>", 0)],
    [(_LINKS, 0), (f"<div>{_LONG}</div>", 0), ("<main>", None), ("<h1>Grain</h1>", 1), (f"<p>{_MORE}</p>", 1), (f"<p>{_SHORT}</p>", 1)],
    [(_NAV, 0), ("<article>", None), (f"<p>{_LONG}</p>", 1), ("<p><a href='/q'>All of the line is a link</a></p>", 1), (f"<p>{_LONG}</p>", 1)],
    [(f"<p>{_LONG}</p>", 1), (f"<p>{_SHORT}</p>", 1), (f"<p>{_MORE}</p>", 1)],
    [(f"<p>{_SHORT}</p>", 1)],
    [(_LONG, 1)],
    [(f"<div>{_MORE}</div>", 0), (f"<p>{_LONG}</p>", 0), (f"<p>{_SHORT}</p>", 0), ("<article>", None), (f"<p>{_MORE}</p>", 1), (f"<p>{_LONG}</p>", 1),
     ("</article>", None), (f"<p>{_LONG}</p>", 0), (f"<p>{_MORE}</p>", 0), (f"<div>{_LONG} {_MORE}</div>", 0), (f"<p>{_SHORT}</p>", 0)],
    [(_NAV, 0), ("<article style='overflow:hidden' class='post with-sidebar'>", None), ("<h1 title='A hidden valley'>The river</h1>", 1),
     (f"<p>{_LONG} <math><mi>a</mi><mo>=</mo><mn>2</mn></math></p>", 1), ("<section id='discussion'>", None),
     ("<h2 id='related-work'>Related work</h2>", 1), (f"<p>{_MORE}</p>", 1), ("</section>", None), ("</article>", None),
     (f"<article class='comment depth-2'><p>{_MORE}</p></article>", 0), (f"<footer>{_SHORT}</footer>", 0)],
]


_WORDS = "the river of old mill and boats with grain over many years we heard a slow voice from bridge that went by night".split()


def _telling(draw: random.Random, inner: str) -> str:
    """What an element or a name tells to be other than an article."""
    tag = draw.choice([*sorted(BOILER - {"header", "head", "datalist"}), *["div", "section", "p"] * 2])
    name = "" if tag in BOILER else f" class='{draw.choice(sorted(HINTS - {'skip'}))}'"
    return f"<{tag}{name}>{inner}</{tag}>"


def marked_page(draw: random.Random) -> list[tuple[str, int | None]]:
    """A page with an <article> or <main>: what encloses a block decides, its size, links
    and neighbours say nothing."""

    def block() -> str:
        words = " ".join(draw.choices(_WORDS, k=draw.choice([1, 2, 4, 8, 16, 40, 90])))
        return f"<a href='/x'>{words}</a>" if draw.random() < 0.3 else words

    def beside() -> tuple[str, int | None]:
        return (f"<div>{block()}</div>" if draw.random() < 0.5 else _telling(draw, block())), 0

    tag = draw.choice(["article", "main"])
    page: list[tuple[str, int | None]] = [beside() for _ in range(draw.randint(0, 4))] + [(f"<{tag}>", None)]
    for _ in range(draw.randint(1, 8)):
        page.append((_telling(draw, block()), 0) if draw.random() < 0.25 else (f"<{(inner := draw.choice(['p', 'h2', 'div']))}>{block()}</{inner}>", 1))
    return page + [(f"</{tag}>", None)] + [beside() for _ in range(draw.randint(0, 4))]


def plain_page(draw: random.Random, named: float = 0.0) -> list[tuple[str, int | None]]:
    """A page of unnamed <div>, <p> and <li> blocks, labelled like those of ``LABELLED``.

    Link lists, short lines, teasers and a footer stand around the article; the article is a
    title, paragraphs of any length, some with links, short lines, headings and lists.
    With a share ``named``, blocks around it are of any length and told by name.
    """

    def text(least: int, most: int) -> str:
        return " ".join(draw.choices(_WORDS, k=draw.randint(least, most)))

    def link(least: int, most: int) -> str:
        return f"<a href='/x'>{text(least, most)}</a>"

    def links() -> list[tuple[str, int | None]]:
        if draw.random() < 0.5:
            return [("<div>" + " ".join(link(1, 4) for _ in range(draw.randint(2, 9))) + "</div>", 0)]
        return [("<ul>", None), *((f"<li>{link(1, 8)}</li>", 0) for _ in range(draw.randint(2, 6))), ("</ul>", None)]

    def around() -> list[tuple[str, int | None]]:
        out = links()
        for _ in range(draw.randint(0, 3)):
            kind = draw.randrange(3)
            line = (f"<div>{text(1, 5)}</div>", f"<h3>{text(1, 3)}</h3>", f"<div>{text(6, 14)}</div>")[kind]
            out += [(line, 0), *links()]
        if draw.random() < named:
            out.insert(draw.choice([0, len(out)]), (_telling(draw, text(1, 90)), 0))
        return out

    def paragraph() -> tuple[str, int | None]:
        with_link = f" {link(1, 4)} {text(8, 30)}" if draw.random() < 0.3 else ""
        tag = draw.choice(["p", "p", "div"])
        return f"<{tag}>{text(15, 90)}{with_link}</{tag}>", 1

    if draw.random() < 0.04:
        return [(f"<p>{text(1, 12)}</p>", 1)]
    page = around() if draw.random() < 0.9 else []
    if draw.random() < 0.8:
        if page and draw.random() < 0.4:
            page.append((f"<div>{text(3, 14)}</div>", 0))  # an advert, a date
        page.append((f"<{draw.choice(['h1', 'div'])}>{text(2, 8)}", 1))
    for _ in range(draw.randint(1, 6)):
        page.append(paragraph())
        extra = draw.randrange(6)
        if extra == 0:
            page += [(f"<p>{text(1, 6)}</p>", 1), paragraph()]
        elif extra == 1:
            page += [(f"<h2>{text(1, 5)}</h2>", 1), paragraph()]
        elif extra == 2:
            page += [("<ul>", None), *((f"<li>{text(3, 12)}</li>", 1) for _ in range(draw.randint(2, 4))), ("</ul>", None), paragraph()]
    if draw.random() < 0.8:
        page += around()
    if draw.random() < 0.5:
        page.append((f"<div>{text(2, 14)}</div>", 0))  # a footer
    return page


# Of each kind in the training table; enclosing elements are to outweigh all else where a page has them.
PAGES = [(marked_page, 800), (plain_page, 200), (lambda draw: plain_page(draw, 0.5), 200)]


def labelled_blocks(pages: list[list[tuple[str, int | None]]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of ``pages``; by default those of the training table."""
    if pages is None:
        draw = random.Random(1)
        pages = LABELLED + [make(draw) for make, n in PAGES for _ in range(n)]
    rows, labels = [], []
    for page in pages:
        own = [label for part, label in page if label is not None for _ in blocks_of(part)]
        made = blocks_of("".join(part for part, _ in page))
        assert len(made) == len(own), [b.text for b in made]
        rows.append(features(made))
        labels += own
    return np.vstack(rows), np.array(labels)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 4):
    """A decision tree by Gini impurity: (column, threshold, low, high), or a leaf's label.

    Every leaf holds at least ``least`` blocks, or is what was left of a smaller node.
    """
    if depth == 0 or len(set(y.tolist())) < 2:
        return int(y.mean() >= 0.5)
    best = None
    for column in range(x.shape[1]):
        order = np.argsort(x[:, column], kind="stable")
        values, ones = x[order, column], np.cumsum(y[order])
        n = np.arange(1, len(y))  # blocks below each cut
        low, high = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(y) - n)
        impurity = n * low * (1 - low) + (len(y) - n) * high * (1 - high)
        impurity[(values[1:] == values[:-1]) | (np.minimum(n, len(y) - n) < min(least, len(y) // 2))] = np.inf
        if len(n) and impurity.min() < (np.inf if best is None else best[0] - 1e-12):
            at = int(impurity.argmin())
            best = (impurity[at], column, (values[at] + values[at + 1]) / 2)
    if best is None:
        return int(y.mean() >= 0.5)
    _, column, threshold = best
    low = x[:, column] <= threshold
    return (column, float(threshold), train_tree(x[low], y[low], depth - 1, least), train_tree(x[~low], y[~low], depth - 1, least))


def is_article(tree, row) -> bool:
    while not isinstance(tree, int):
        column, threshold, low, high = tree
        tree = low if row[column] <= threshold else high
    return bool(tree)


def main_text(page: str | None, tree) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, row in zip(blocks, features(blocks).tolist(), strict=True) if is_article(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (empty if none), n_chars.

    Null and empty pages have no text. Blocks come in page order, joined by one \\n; each
    is whole. Repeated rows get a row each; other columns are ignored; an empty table
    gives an empty result.
    """
    tree = train_tree(*labelled_blocks())
    pages = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            texts = [main_text(page, tree) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
                                               T.StructField("n_chars", T.LongType())]))
