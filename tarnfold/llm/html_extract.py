"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import in_small_batches

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
NEVER = frozenset("script style textarea title noscript iframe xmp noembed noframes head nav footer aside button select option template svg canvas object menu dialog".split())
BLOCK = frozenset(
    "html body address article aside blockquote caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 div section article main body figcaption".split())
#: Names (class, id, role) that say by themselves what is no article, and words that may stand beside one in such a name.
UNLIKELY = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsors sponsored banner promo promos promotion sidebar side menu nav navbar navigation
    breadcrumb breadcrumbs header masthead footer comment comments disqus replies cookie cookies consent notice popup modal overlay newsletter subscribe
    signup login share sharing social related recommended widget toolbar pagination pager skip""".split()
)
#: Those of them that an article may use for parts of its own: within one they only lower the score.
LOWERING = frozenset("header masthead menu sharing share social related recommended widget skip".split())
#: What such a name costs; a plain paragraph has a point, one for each comma, and up to three for its length.
COST = 3
FOREIGN = frozenset(["svg", "math"])
BESIDE_UNLIKELY = frozenset(
    """bar box list item items wrap wrapper container block section area panel slot unit left right top bottom main site page global primary secondary
    inner outer link links post posts article articles story stories button buttons icon icons row col column content contents text title group form
    mobile desktop sticky fixed my the user reader gdpr privacy email mail inline body dialog""".split()
)
WORD_IN_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
#: An attribute: its name, and its value if there is one.
ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers that are left out beside the best one if they hold little but links.
LISTS = frozenset("ul ol dl table div section center".split())
SPACE = re.compile(r"\s+")


@lru_cache(4096)
def _unlikely(name: str) -> int:
    """0, unless all words of a name are about layout, and one of them about what is no article: cookie-notice, but not notice-period.

    1 if an article may use such a name for a part of its own, else 2.
    """
    words = [w.lower() for w in WORD_IN_NAME.findall(name)]
    bad = [w for w in words if w in UNLIKELY]
    if not bad or any(w not in UNLIKELY and w not in BESIDE_UNLIKELY for w in words):
        return 0
    return 1 if all(w in LOWERING for w in bad) else 2


class Node:
    __slots__ = ("tag", "parent", "parts", "skip", "lowered", "inside", "foreign", "score", "text", "links")

    def __init__(self, tag: str, parent: Node | None, skip: bool = False):
        self.tag, self.parent, self.skip = tag, parent, skip
        self.lowered = False
        #: within an article or main; within drawings or formulas, where a tag may close itself
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.foreign = tag in FOREIGN or (parent is not None and parent.foreign)
        self.parts: list[Node | str] = []
        self.score = 0.0
        self.text = self.links = 0


def parse(source: str) -> Node:
    """A tree of the elements. Open paragraphs, items and cells end where their next begins."""
    root = node = Node("#root", None)
    at, end = 0, len(source)

    def close(tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        nonlocal node
        up = node
        while up is not root and up.tag not in within:
            if up.tag in tags:
                node = up.parent
                return
            up = up.parent

    while at < end:
        m = TOKEN.search(source, at)
        if not m:
            node.parts.append(source[at:])
            break
        if m.start() > at:
            node.parts.append(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in BLOCK:
            close(("p",), ("table", "td", "button"))
        if tag == "li":
            close(("li",), ("ul", "ol", "menu"))
        elif tag in ("dd", "dt"):
            close(("dd", "dt"), ("dl",))
        elif tag in ("td", "th"):
            close(("td", "th"), ("tr", "table"))
        elif tag == "tr":
            close(("tr",), ("table",))
        attributes = {g[1].lower(): g[2] or g[3] or g[4] or "" for g in ATTRIBUTE.finditer(m[3]) if g[1]} if m[3] else {}
        named = " ".join(attributes[x] for x in ("class", "id", "role") if attributes.get(x))
        child = Node(tag, node)
        named_so = max(map(_unlikely, named.split()), default=0) if named and tag not in ("html", "body", "article", "main") else 0
        child.lowered = named_so == 1 and child.inside
        skip = node.skip or tag in NEVER or (named_so > 0 and not child.lowered) or "hidden" in attributes or bool(UNSEEN.search(attributes.get("style", "")))
        child.skip = skip or (tag == "header" and not child.inside)
        node.parts.append(child)
        if tag in VOID or (child.foreign and m[3].endswith("/")):
            continue
        if tag in RAW and not child.foreign:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else end
            continue
        node = child
    return root


def _measure(root: Node) -> list[Node]:
    """Sets text and links (code points in links) of each node, bottom up; nodes in page order."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(x for x in reversed(n.parts) if isinstance(x, Node) and not x.skip)
    for n in reversed(order):
        n.text = n.links = 0
        for x in n.parts:
            if isinstance(x, str):
                n.text += len(x.strip())
            elif not x.skip:
                n.text += x.text
                n.links += x.links
        if n.tag == "a":
            n.links = n.text
    return order


def _density(n: Node) -> float:
    return n.links / n.text if n.text else 0.0


def _skip_forms(root: Node) -> None:
    """Leaves out forms, but not those that a page or its article is wrapped in."""
    order = _measure(root)
    for form in [n for n in order if n.tag == "form"]:
        inside, stack = False, [form]
        while stack and not inside:
            x = stack.pop()
            inside = x.tag in ("article", "main", "h1")
            stack.extend(y for y in x.parts if isinstance(y, Node) and not y.skip)
        form.skip = not inside and 2 * form.text <= root.text


def _points(n: Node) -> float:
    """What a paragraph counts by its own text: nothing if that is mostly links."""
    text = _flow(n).strip() if n.tag in PARAGRAPH else ""
    return 1 + text.count(",") + min(len(text) / 100, 3) if text and _density(n) <= 0.5 else 0.0


def _skip_lowered(root: Node) -> None:
    """Leaves out boxes inside an article whose names lower them below nothing: buttons to share, but not a section on social policy."""
    for box in [n for n in _measure(root) if n.lowered]:
        points, stack = 0.0, [box]
        while stack:
            x = stack.pop()
            points += _points(x)
            stack.extend(y for y in x.parts if isinstance(y, Node) and not y.skip)
        box.skip = points < COST


def _menu(n: Node) -> bool:
    """A list or box of two links or more, mostly links and without a heading."""
    if n.tag not in LISTS or _density(n) <= 0.5:
        return False
    links, stack = 0, [n]
    while stack:
        x = stack.pop()
        if x.tag in HEADINGS:
            return False
        links += x.tag == "a"
        stack.extend(y for y in x.parts if isinstance(y, Node) and not y.skip)
    return links > 1


def _flow(n: Node) -> str:
    """The text that lies in n itself or in inline elements of it."""
    out, stack = [], [n]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is n or (not x.skip and x.tag not in BLOCK):
            stack.extend(reversed(x.parts))
    return "".join(out)


def _blocks(nodes: list[Node | str]) -> list[str]:
    """Texts of the blocks in page order, references decoded and white space made plain."""
    found, run = [], []

    def end() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(run))).strip()
        run.clear()
        if text:
            found.append(text)

    stack: list[Node | str | None] = [*reversed(nodes)]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif not x.skip:
            inner = list(reversed(x.parts))
            stack += [None, *inner, None] if x.tag in BLOCK else inner
    end()
    return found


def extract(source: str | None) -> str:
    """Main text of one page, empty if there is none.

    Each paragraph that is no menu, header, footer, form, advert, comment or the like (told by its
    element, or its class, id or role) gives a point, one for each comma, and up to three for its
    length to its parent, half of them to the grandparent, and a third of that further up. Points
    shrink with the share of a container's text in links. The best container is kept whole, and with
    it all else of the outermost article or main around it and that one's siblings, their parent's
    own text included, but lists of links. Without an article or main around the best container, the
    whole page is kept in this way. Within an article a name that an article may use for its own
    parts (social, related, header, ...) costs a box three points: it goes if it had fewer. A page of
    links and little else has no main text.
    """
    if not source:
        return ""
    root = parse(source)
    _skip_forms(root)
    _skip_lowered(root)
    order = _measure(root)
    for n in order:
        points = _points(n)
        if not points:
            continue
        up, level = n.parent, 0
        while up is not None and level < 5:
            up.score += points / (1, 2, 6, 9, 12)[level]
            up, level = up.parent, level + 1
    for n in order:
        if n.tag in ("article", "main") and n.text:
            n.score = n.score * 1.5 + 5
        n.score *= 1 - _density(n)
    best = max(order, key=lambda n: n.score, default=None)
    if best is None or best.score <= 0:
        return "" if _density(root) > 0.5 else "\n\n".join(_blocks([root]))
    around, up = None, best
    while up is not None:
        around, up = up if up.tag in ("article", "main") else around, up.parent
    inside, stack = set(), [best]
    while stack:
        x = stack.pop()
        inside.add(x)
        stack.extend(y for y in x.parts if isinstance(y, Node) and not y.skip)
    up = best
    above = set()
    while up is not None:
        above.add(up)
        up = up.parent
    for n in order:
        if n not in inside and n not in above and _menu(n):
            n.skip = True
    return "\n\n".join(_blocks([root] if around is None else around.parent.parts))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page, one narrow pass without a shuffle.

    Defined cases: null or empty html, and a page without text of its own, give an empty text;
    null ids and urls are carried along; broken markup ends at the end of the page; repeated rows
    give repeated rows; an empty table gives an empty result; further columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    columns = [F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")]
    return in_small_batches(pages).select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")
