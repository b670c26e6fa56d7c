"""Main text of web pages by minimum cut.

A page is a sequence of text blocks. A linear classifier over each block's place and form gives
the cost of calling it content and of calling it boilerplate; neighbours in page order and
blocks of one parent element pay for unlike labels. The cheapest labelling is a minimum cut
between a content and a boilerplate terminal, found by maximum flow.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements of HTML by what they mean for text.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video select datalist title textarea head".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption".split())
AWAY = frozenset("nav footer header aside form menu button dialog fieldset".split())
HOME = frozenset("article main".split())
CLOSES_P = BLOCKS - {"body", "html", "button"}
CONTROLS = frozenset("input select textarea button option label".split())
#: Parts of class and id names. A name that begins with a part of ABOUT speaks of what the page has elsewhere or has not.
HINTS_AWAY = re.compile(
    r"ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|footer|header|masthead|cookies?|consent|notice|"
    r"social|share|sharing|related|recommend\w*|newsletter|subscribe|signup|login|popup|modal|widget|pagination|pager|copyright|toolbar"
)
HINTS_REPLIES = re.compile(r"comments?|replies|disqus")
HINTS_HOME = re.compile(r"article|content|entry|post|story|main|body|text")
ABOUT = frozenset("no not non without with has have hide hidden show is js supports".split())
ALLOWED = frozenset("open closed count enabled disabled".split())
PART = re.compile(r"[_-]+")
#: Words for each control from which on a form holds more than its labels, and share of a page's words that no hint takes away.
WORDS_PER_CONTROL, MOST_OF_PAGE = 12, 0.6

#: The classifier's weights, towards content, in units of the smoothness costs.
BIAS = 0.4
IN_HOME, IN_AWAY, HINT_HOME, HINT_AWAY = 3.0, -8.0, 0.8, -6.0
LINKS, PER_WORD, MOST_WORDS, HEADING = -3.0, 0.06, 1.8, 0.6
#: Costs of unlike labels between neighbours in the page and between blocks of one parent.
ADJACENT, SAME_PARENT = 0.4, 1.0

#: Attributes as HTML reads them: only a value may be quoted and pass over >, a quote anywhere else is an ordinary character.
VALUE = r"\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*"
ATTRIBUTES = rf"(?:[\s/]+|(?:=[^\s/>=]*|[^\s/>=]+)(?:\s*=\s*(?:{VALUE})?)?)*"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})>?", re.S)
NAMED = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("text", "parent", "element", "home", "away", "hint_home", "hint_away", "heading", "linked")

    def __init__(self, text, parent, element, heading, linked):
        self.text, self.parent, self.element, self.heading, self.linked = text, parent, element, heading, linked
        self.home = self.away = self.hint_home = self.hint_away = False


class Element:
    """An element with what its own name, class and id say, and the words and controls inside."""

    __slots__ = ("above", "name", "hint_home", "hint_away", "replies", "words", "controls")

    def __init__(self, above: int, name: str) -> None:
        self.above, self.name, self.words, self.controls = above, name, 0, 0
        self.hint_home = self.hint_away = self.replies = False

    def read_names(self, attributes: str) -> None:
        for found in NAMED.findall(attributes):
            for name in "".join(found).lower().split():
                parts = [p for p in PART.split(name) if p]
                if not parts or len(parts) > 1 and parts[0] in ABOUT:
                    continue
                home = HINTS_HOME.fullmatch(parts[-1]) is not None  # the last part is the noun: related-content is content
                self.hint_home = self.hint_home or home or any(HINTS_HOME.fullmatch(p) for p in parts)
                self.replies = self.replies or parts[-1] not in ALLOWED and any(HINTS_REPLIES.fullmatch(p) for p in parts)
                self.hint_away = self.hint_away or not home and any(HINTS_AWAY.fullmatch(p) for p in parts)

    def is_away(self, home: bool, words: int) -> bool:
        if self.name in ("form", "fieldset"):
            return self.words < WORDS_PER_CONTROL * (self.controls + 1)
        if self.name in ("button", "dialog", "menu"):
            return self.words <= MOST_OF_PAGE * words
        return self.name in AWAY and not (self.name == "header" and home)


def _resolve(found: list[Block], elements: list[Element]) -> None:
    """Give every block what the elements around it say. A hint on most of the page, and a form that is mostly text, say nothing."""
    for e in reversed(elements[1:]):  # an element comes after those around it
        elements[e.above].words += e.words
        elements[e.above].controls += e.controls
    words = elements[0].words
    state = [(False, False, False, False)]
    for e in elements[1:]:
        home, away, hint_home, hint_away = state[e.above]
        is_away = e.name in BLOCKS and e.is_away(home, words)
        hinted = e.replies or e.hint_away and e.words <= MOST_OF_PAGE * words
        state.append((home or e.name in HOME, away or is_away, hint_home or e.hint_home, hint_away or hinted))
    for block in found:
        block.home, block.away, block.hint_home, block.hint_away = state[block.element]


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; unclosed and stray tags are taken as browsers mostly do."""
    out: list[Block] = []
    elements = [Element(0, "")]
    stack = [("", 0)]  # open elements: name and number
    pieces: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                k = len(stack) - 1
                while k and stack[k][0] not in BLOCKS:
                    k -= 1
                # A text block of its own belongs to the element around it, loose text to the element it is in.
                parent = stack[k - 1][1] if k and stack[k][0] in LEAVES else stack[k][1]
                words = text.count(" ") + 1
                elements[stack[-1][1]].words += words
                out.append(Block(text, parent, stack[-1][1], stack[k][0] in ("h1", "h2", "h3", "h4", "h5", "h6"), min(1.0, linked / len(text))))
        linked = 0

    at, end = 0, len(page)
    while at < end:
        opened = page.find("<", at)
        if opened < 0:
            opened = end
        if opened > at:
            piece = page[at:opened]
            pieces.append(piece)
            if links:
                linked += len(piece)
            at = opened
            continue
        found = TOKEN.match(page, at)
        if found is None:  # a bare < is text
            pieces.append("<")
            at += 1
            continue
        at = found.end()
        name = found[2]
        if name is None:
            if page.startswith("<![CDATA[", found.start()):
                pieces.append(html.escape(page[found.start() + 9 : at].removesuffix("]]>")))
            continue
        name = name.lower()
        if found[1]:
            if name in BLOCKS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main", "nav", "footer", "aside", "header", "form", "table") and name not in BLOCKS:
                    break
            continue
        if name in CONTROLS:
            elements[stack[-1][1]].controls += 1
        if name in RAW or name in SKIPPED and name != "head":
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            if found[3].rstrip().endswith("/") and name in ("svg", "math"):
                continue
            at = close.end() if close else end
            continue
        if name == "br" or name == "wbr":
            pieces.append(" " if name == "br" else "")
            continue
        if name in BLOCKS:
            flush()
        if name in VOID or name in ("head", "html"):
            continue
        if name in CLOSES_P:  # a new block ends an open paragraph, an item the item before
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p" or stack[k][0] == name and name in ("li", "dd", "dt", "tr", "td", "th", "option"):
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in BLOCKS:
                    break
        element = Element(stack[-1][1], name)
        if name in BLOCKS and name != "body" and found[3]:
            element.read_names(found[3])
        elements.append(element)
        if name == "a":
            links += 1
        stack.append((name, len(elements) - 1))
    flush()
    _resolve(out, elements)
    return out


def content_score(block: Block) -> float:
    """Above 0 for content: the difference of the two terminal capacities."""
    words = block.text.count(" ") + 1
    score = BIAS + min(MOST_WORDS, PER_WORD * (words - 8)) + LINKS * block.linked
    score += IN_HOME * block.home + IN_AWAY * block.away + HINT_HOME * block.hint_home + HINT_AWAY * block.hint_away
    return score + HEADING * block.heading


def minimum_cut(scores: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost: True for the content side of the minimum cut.

    Shortest augmenting paths by levels (Dinic), with every path search kept on a stack of its
    own, so that a long page needs no recursion.
    """
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    left: list[float] = []

    def link(a: int, b: int, forward: float, backward: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        left.append(forward)
        heads[b].append(len(to))
        to.append(a)
        left.append(backward)

    for i, score in enumerate(scores):
        if score > 0:
            link(source, i, score, 0.0)
        elif score < 0:
            link(i, sink, -score, 0.0)
    for a, b, cost in edges:
        link(a, b, cost, cost)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if left[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(left[e] for e in path)
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if left[e] <= tiny)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while following[a] < len(heads[a]):
                e = heads[a][following[a]]
                if left[e] > tiny and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                following[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                following[a] += 1


def labelled_blocks(page: str) -> tuple[list[Block], list[bool]]:
    found = blocks(page)
    scores = [content_score(b) for b in found]
    if all(s > 0 for s in scores) or all(s <= 0 for s in scores):  # nothing to cut
        return found, [s > 0 for s in scores]
    edges = [(i, i + 1, ADJACENT) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if block.parent in last:
            edges.append((last[block.parent], i, SAME_PARENT))
        last[block.parent] = i
    return found, minimum_cut(scores, edges)


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by an empty line; a null or empty page has the empty text."""
    if not page:
        return ""
    found, content = labelled_blocks(page)
    return "\n\n".join(b.text for b, c in zip(found, content, strict=True) if c)


def extract_text(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), page: str = "html") -> DataFrame:
    """(row, text): the main text of every whole page; one output row per input row.

    ``row`` is a struct of the ``keep`` columns. Pages are parsed one by one in batches of rows, and
    no page depends on another, so repeated rows give repeated results.
    """
    source = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(page).cast("string").alias("page"))
    schema = T.StructType([source.schema.fields[0], T.StructField("text", T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return source.mapInArrow(extract, schema)
