"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. Each block has its word count and link density, those of the blocks before
and after it, and what its enclosing elements say: whether it is in the article, whether it is in an element for
something else (such as nav or footer), in a hidden one, or below a class, id or role that names something else. An
article or main element inside the latter is the article all the same. A decision tree, grown on the blocks of the small
labelled pages below, decides which blocks are main text; many of these pages name nothing, so that words and links decide.

Cases: null and empty pages, and pages without main text, give the empty text. Unclosed and stray tags are tolerated;
an unclosed comment, script or style reaches to the end, a tag with an unclosed quote to the next ``>``, an unclosed link
to the end of the block it began in. Time is linear in the page, however deep its elements are nested. Repeated pages each give their row; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 512

# HTML element names by what they mean for the text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul button label".split()
)
SILENT_TAGS = "script|style|noscript|template|svg|iframe|object|textarea|math|canvas|audio|video"
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OTHER_TAGS = frozenset("nav footer aside form head title button select option label fieldset dialog menu".split())
# Words of a class, id or role that name something other than the article; a name counts by itself and by
# its parts between - and _.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion promoted banner "
    "sidebar side-bar widget widgets menu nav navbar navigation breadcrumb breadcrumbs pager pagination footer masthead "
    "comment comments commentlist reply replies respond disqus discussion cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing social "
    "related recommended toolbar copyright disclaimer skip complementary contentinfo dialog feedback reviews".split()
)
# Names that begin or end so say what a page has or what state it is in, not what an element is.
STATE_STARTS = ("no-", "has-", "with-", "is-")
STATE_ENDS = ("-open", "-closed", "-enabled")
PAGE_HEADERS = frozenset(["header", "banner", "topbar"])
# What has the article itself; their classes describe the page, as in "no-sidebar" or "comments-open".
WHOLE_TAGS = frozenset(["html", "body", "main", "article"])

_INSIDE = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT_TAGS})\b(?:{_INSIDE}>|[^>]*>).*?(?:</(?P=silent)\s*[^>]*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?:(?P<rest>{_INSIDE})(?:>|\Z)|(?P<cut>[^>]*)(?:>|\Z))|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
# Name and value of each attribute; a value's quotes are not part of it.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    in_article: bool
    other: bool
    heading: bool
    item: bool


@dataclass
class _Element:
    """What holds for all that is in it. ``named``: below a class, id or role that names something else."""

    tag: str
    article: bool = False
    other: bool = False
    named: bool = False
    heading: bool = False
    item: bool = False


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), "".join(values))
    return found


def _names(attributes: dict[str, str]) -> set[str]:
    """The words of class, id and role, whole and in parts, but for those that tell a state."""
    words = {w for a in ("class", "id", "role") for w in attributes.get(a, "").lower().replace("_", "-").split()}
    words = {w for w in words if not w.startswith(STATE_STARTS) and not w.endswith(STATE_ENDS)}
    return words.union(*(w.split("-") for w in words))


def _entered(tag: str, rest: str, outer: _Element) -> _Element:
    attributes = _attributes(rest) if rest else {}
    hidden = "hidden" in attributes and not attributes["hidden"].lower().startswith(("until", "false"))
    hidden = hidden or bool(_UNSEEN.search(attributes.get("style", "")))
    main = tag in ("article", "main") or attributes.get("role", "").lower() == "main"
    named = False
    if tag not in WHOLE_TAGS and not main:
        names = _names(attributes) if attributes else set()
        named = bool(names & OTHER_WORDS) or (not outer.article and bool(names & PAGE_HEADERS))
    return _Element(
        tag,
        article=outer.article or main,
        other=outer.other or hidden or tag in OTHER_TAGS or (tag == "header" and not outer.article),
        # An article in an article may be a reader's comment below the name of its list.
        named=named or (outer.named and not (main and not outer.article)),
        heading=outer.heading or (len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"),
        item=outer.item or tag == "li",
    )


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[_Element] = [_Element("")]
    open_tags: Counter[str] = Counter()
    pieces: list[str] = []
    linked: list[str] = []
    link_depth = 0  # the number of open elements where the open link began; 0: no link is open

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            n = len(text.split())
            links = len(html.unescape("".join(linked)).split())
            e = stack[-1]
            out.append(Block(text, n, min(1.0, links / n), e.article, e.other or e.named, e.heading, e.item))
        pieces.clear()
        linked.clear()

    def add(raw: str) -> None:
        pieces.append(raw)
        if link_depth:
            linked.append(raw)

    def leave(n: int) -> None:
        """Closes all but the first n elements."""
        nonlocal link_depth
        for e in stack[n:]:
            open_tags[e.tag] -= 1
        del stack[n:]
        if link_depth > n:
            link_depth = 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        rest = m["rest"] if m["rest"] is not None else m["cut"] or ""
        if tag == "br":
            add(" ")
            continue
        if tag == "a":
            link_depth = len(stack) if not m["end"] and _HREF.search(rest) else 0
            if link_depth:
                linked.append(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        flush()
        if m["end"]:
            if open_tags[tag]:
                n = len(stack) - 1
                while stack[n].tag != tag:
                    n -= 1
                leave(n)
        elif tag not in VOID_TAGS and not rest.endswith("/"):
            if tag in ("p", "li"):  # these end an open one of their kind
                n = len(stack) - 1
                while stack[n].tag in ("p", "li") and stack[n].tag != tag:
                    n -= 1
                if stack[n].tag == tag:
                    leave(n)
            stack.append(_entered(tag, rest, stack[-1]))
            open_tags[tag] += 1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """A row for each block: own, previous and next word count and link density, and the enclosing elements' flags."""
    n = len(blocks)
    words = np.array([0, *[b.words for b in blocks], 0], float)
    density = np.array([0, *[b.link_density for b in blocks], 0], float)
    flags = np.array([[b.in_article, b.other, b.heading, b.item] for b in blocks], float).reshape(n, 4)
    page_has_article = np.full((n, 1), float(any(b.in_article for b in blocks)))
    return np.hstack(
        [
            np.stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]], axis=1),
            flags,
            page_has_article,
        ]
    )


@dataclass
class Tree:
    """Grown by the Gini impurity; a leaf holds the share of main text."""

    share: float
    column: int = -1
    cut: float = 0.0
    below: Tree | None = field(default=None, repr=False)
    above: Tree | None = field(default=None, repr=False)

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray, depth: int = 9, least: int = 3) -> Tree:
        share = float(y.mean())
        best = (share * (1 - share) - 1e-9, -1, 0.0)
        if depth and len(y) >= 2 * least:
            for column in range(x.shape[1]):
                values = np.unique(x[:, column])
                for cut in (values[1:] + values[:-1]) / 2:
                    low = x[:, column] < cut
                    n = int(low.sum())
                    if min(n, len(y) - n) >= least:
                        p, q = y[low].mean(), y[~low].mean()
                        impurity = (n * p * (1 - p) + (len(y) - n) * q * (1 - q)) / len(y)
                        if impurity < best[0] - 1e-12:
                            best = (impurity, column, float(cut))
        if best[1] < 0:
            return cls(share)
        low = x[:, best[1]] < best[2]
        return cls(
            share, best[1], best[2], cls.grow(x[low], y[low], depth - 1, least), cls.grow(x[~low], y[~low], depth - 1, least)
        )

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.below is None or self.above is None:
            return np.full(len(x), self.share)
        out = np.empty(len(x))
        low = x[:, self.column] < self.cut
        out[low], out[~low] = self.below.predict(x[low]), self.above.predict(x[~low])
        return out


# The labelled table, as pages: {n} stands for n words, and main text begins with a plus sign. Each page comes in several
# sizes, with the numbers above three multiplied by these.
SIZES = (0.6, 1.0, 1.5)
LABELLED_PAGES = (
    "<head><title>{6}</title></head><body><nav><ul><li><a>{1}</a></li><li><a>{1}</a></li><li><a>{2}</a></li></ul></nav>"
    "<div class=ad>{9}</div><article><h1>+{7}</h1><p>+{40}</p><p>+{1}</p><p>+{2}</p><p>+{90}</p></article>"
    "<footer>{12}</footer>",
    "<body><header><a>{2}</a> {5}</header><main><h1>+{5}</h1><p>+{60} <a>{3}</a></p><ul><li>+{4}</li><li>+{9}</li></ul>"
    "<aside class=related><h3>{2}</h3><ul><li><a>{6}</a></li><li><a>{5}</a></li></ul></aside><p>+{30}</p><p>+{3}</p>"
    "<div class='comments'><h2>{1}</h2><p>{25}</p><p>{40}</p></div></main><footer><p>{20}</p></footer>",
    "<body><div id=cookie-notice>{30}</div><div class=menu><a>{1}</a> <a>{1}</a></div><article><header><h1>+{8}</h1>"
    "</header><p>+{25}</p><blockquote>+{15}</blockquote><pre>+{5}</pre><div class='share'><a>{1}</a><a>{1}</a></div>"
    "<p>+{70}</p><table><tr><td>+{2}</td><td>+{1}</td></tr></table></article><form><label>{2}</label><button>{1}</button>"
    "</form><section class='reader-comments'><p>{50}</p><p>{8}</p></section>",
    "<body><div><a>{1}</a></div><div><a>{1}</a></div><div><a>{2}</a></div><h1>+{9}</h1><p>+{45}</p><p>+{80}</p>"
    "<p>+{35}</p><p>+{22} <a>{2}</a></p><div><a>{4}</a></div><div><a>{3}</a></div><div><a>{5}</a></div><div>{3}</div>",
    "<body><ul><li><a>{2}</a></li><li><a>{1}</a></li></ul><div><h2>+{6}</h2><div>+{55}</div><div>+{28}</div>"
    "<div>+{110}</div></div><ul><li><a>{7}</a></li><li><a>{8}</a></li><li><a>{6}</a></li></ul><div>{4}</div><div>{2}</div>",
    "<body><div class=sidebar><p>{40}</p><p>{12}</p></div><div><h1>+{4}</h1><p>+{75}</p><p>+{64}</p><p>+{18}</p></div>"
    "<div class=newsletter><p>{15}</p></div><div class=footer><p>{30}</p></div>",
    "<body><nav><a>{1}</a><a>{1}</a></nav><div role=alert>{14}</div><article><p>+{3}</p></article><article><h2>+{3}</h2>"
    "<p>+{12}</p><footer>{6}</footer></article><div class=advert>{20}</div><footer>{3}</footer>",
    "<body><article><h1>+{2}</h1><p>+<a>{3}</a></p><p>+{1}</p><nav><a>{1}</a></nav><p>+{200}</p><form>{4}</form></article>"
    "<aside><p>{60}</p><p>{33}</p></aside><footer><a>{2}</a></footer>",
    "<body><article><h1>+{4}</h1><p>+{12}</p><p>+{2}</p></article>",
    "<body><nav><a>{2}</a></nav><article><p>+{60}</p><p>+<a>{4}</a></p></article>",
    "<body><p>+{50}</p><p>+{44}</p><p>+{61}</p>",
    "<body><h1>+{6}</h1><p>+{35}</p><p>+{120}</p><div>{3}</div>",
    "<body><div><a>{2}</a> <a>{1}</a></div><h1>+{3}</h1><p>+{28}</p><p>+{33}</p><div><a>{2}</a></div><div>{4}</div>",
    "<body><p>+{15}</p>",
    "<body><p>+{3}</p>",
    "<body><div><a>{1}</a></div><p>+{42}</p><div><a>{2}</a></div><p>+{30}</p><div><a>{9}</a></div>",
    "<body><ul><li><a>{3}</a></li></ul><p>+{90}</p><p>+{16}</p><p><a>{2}</a></p><p>+{25}</p>",
    "<body><div><a>{12}</a></div><h1>+{5}</h1><p>+{31}</p><div><a>{1}</a></div><h2>+{2}</h2><p>+{52}</p>",
    # Around an article, text of any length is something else; inside it, short lines and links are main text.
    "<body><div>{45}</div><article><p>+{2}</p><p>+<a>{4}</a></p><p>+{6}</p></article><p>{33}</p><div>{20}</div>",
    "<body><p>{22}</p><p>{70}</p><article><h2>+<a>{3}</a></h2><p>+{3}</p></article><article><p>+{2}</p></article>",
    "<body><article><p>+<a>{2}</a></p></article><div>{26}</div><p>{95}</p><p>{14}</p>",
    "<body><div>{30}</div><p>{12}</p><article><h1>+{2}</h1><p>+{1}</p><p>+{2}</p><p>+<a>{1}</a></p><p>+{9}</p>"
    "<p>+{4}</p><p>+{1}</p></article><div>{25}</div><p>{60}</p>",
    # Nothing is named: menus, lists of other pages and buttons are runs of short blocks that are links.
    "<body><main><div><a>{1}</a></div><div><a>{2}</a></div><div><a>{1}</a></div><h1>+{6}</h1><p>+{50}</p><p>+{40}</p>"
    "<p>+{3} <a>{2}</a> {20}</p><ul><li><a>{5}</a></li><li><a>{7}</a></li><li><a>{6}</a></li></ul></main>",
    "<body><article><h1>+{8}</h1><p><a>{1}</a></p><p><a>{1}</a></p><p><a>{1}</a></p><p>+{45}</p><p>+{3}</p><p>+{70}</p>"
    "<p><a>{4}</a></p><p><a>{6}</a></p><p><a>{5}</a></p></article>",
    "<body><article><h2>+{4}</h2><p>+{60}</p><p>+<a>{4}</a></p><p>+{55}</p><ul><li>+{6} <a>{2}</a></li><li>+{9}</li>"
    "<li>+{3} <a>{1}</a></li></ul><p>+{12}</p></article>",
    "<body><main><ul><li><a>{2}</a></li><li><a>{3}</a></li><li><a>{1}</a></li><li><a>{2}</a></li></ul><h1>+{9}</h1><h2>+{3}</h2>"
    "<p>+{1}</p><p>+{28} <a>{3}</a></p><p>+{2}</p><div><a>{8}</a></div><div><a>{7}</a></div><div><a>{9}</a></div></main>",
    "<body><div><a>{2}</a></div><div><a>{1}</a></div><div><a>{3}</a></div><article><h1>+{5}</h1><p>+{14}</p><p>+{2} <a>{1}</a></p>"
    "<p>+{33}</p><table><tr><td>+{1}</td><td>+{2}</td><td>+{1}</td></tr></table></article><div>{40}</div><div>{22}</div>",
    "<body><main><h1>+{7}</h1><p>+{20}</p><div><a>{3}</a></div><div><a>{2}</a></div><p>+{48}</p><p>+{6}</p><p>+{90}</p>"
    "<div><a>{1}</a> <a>{1}</a> <a>{2}</a></div><div><a>{4}</a></div></main>",
    "<body><ul><li><a>{1}</a></li><li><a>{2}</a></li></ul><h1>+{6}</h1><p>+{38}</p><ul><li><a>{6}</a></li><li><a>{5}</a></li>"
    "<li><a>{7}</a></li></ul><p>+{44}</p><p>+{52}</p><div>{2} <a>{3}</a></div><div><a>{2}</a></div>",
    "<body><main><p>+{65}</p><p>+{5}</p><p>+{1}</p><p>+{31}</p></main><div><p>{35}</p><p>{15}</p></div>",
    "<body><div>{2}</div><h1>+{5}</h1><p>+{40}</p><p>+{26}</p><div>{4}</div>",
    "<body><div>{1}</div><div>{2}</div><h1>+{2}</h1><p>+{60}</p><p>+{24}</p><div>{2}</div>",
    "<body><div>{3}</div><h1>+{2}</h1><p>+{20}</p><p>+{12}</p><p>+{30}</p><div>{4}</div>",
    "<body><article><p>+{9}</p><p>+{4} <a>{4}</a> {4}</p><p>+{2}</p><h3>+{3}</h3><p>+{18}</p></article><div><p>{28}</p></div>",
)


def labelled_pages() -> list[str]:
    def words(n: int, size: float) -> str:
        return " ".join(["word"] * (n if n <= 3 else max(4, round(n * size))))

    linked = [page.replace("<a>", "<a href=x>") for page in LABELLED_PAGES]
    return [re.sub(r"\{(\d+)\}", lambda m, size=size: words(int(m[1]), size), page) for page in linked for size in SIZES]


def labelled_blocks(pages: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of the labelled pages' blocks, and which are main text."""
    rows, labels = [], []
    for page in labelled_pages() if pages is None else pages:
        blocks = blocks_of(page)
        rows.append(features(blocks))
        labels.extend(b.text.startswith("+") for b in blocks)
    return np.vstack(rows), np.array(labels, float)


def main_text(page: str | None, tree: Tree) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    keep = tree.predict(features(blocks)) >= 0.5
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    tree = Tree.grow(*labelled_blocks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                texts = [main_text(h.as_py(), tree) for h in batch.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
