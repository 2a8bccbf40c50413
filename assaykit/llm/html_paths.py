"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their root-to-leaf tag path. A path's text ratio is its text
length per node, its punctuation ratio the sentence marks per node. Both are fused with a prior for
the elements on the path: nothing for page furniture, more inside an article. A container counts
as much as its best path, so its heading, list items and table cells stand or fall with its
paragraphs, however many they are. Containers at or above a share of the page's best are content.
All their nodes outside furniture are returned, in page order. A word such as "sidebar" in a class,
id, role or aria-label lowers the score of what lies beneath, which then is judged apart from the
container around it. It says nothing on html, body, the outermost article or main, or an element
that holds most of the page's text.

Defined results: a null or empty html has an empty text; broken or cut off markup is read as far
as it goes (an open tag at the end is dropped); a page without content paths has an empty text;
repeated rows are read one by one; an empty table gives an empty table. Only the named columns are
read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""",
    re.S,
)
NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
PART = re.compile(r"[a-z]+|[0-9]+", re.I)

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: The inside of these is no markup.
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: An opening tag of the key ends an open element of the value (without leaving its container).
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
FENCES = frozenset("article aside body div footer form header main nav section table ul ol dl".split())
#: Elements that never hold main text.
FURNITURE = frozenset(
    "head script style noscript template iframe object svg canvas nav header footer aside form "
    "button select option textarea input menu dialog label".split()
)
#: Name parts that speak against main text.
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disqus footer header masthead menu modal nav navbar "
    "navigation newsletter notice notices pagination pager popup promo promoted promotion related "
    "respond replies reply search share sharing sidebar sidebars signup social sponsor sponsored "
    "subscribe subscription toolbar widget widgets login alert disclaimer gdpr discussion "
    "contentinfo complementary".split()
)
#: Parts that name a subject as often as a piece of the page.
SUBJECT_NAMES = frozenset("alert discussion notice notices related search social".split())
#: Factor, and share of the page's text from which it does not apply: for names whose parts all
#: speak against main text ("cookie-banner"), and for names with such a part ("has-sidebar").
WHOLE_NAME, PART_NAME = (0.02, 0.9), (0.25, 0.5)
#: The outermost holder, or else the nearest container, pools the paths beneath it.
HOLDERS = frozenset("article main".split())
CONTAINERS = frozenset("section div td body".split())
HOLDER_PRIOR = 20.0
MARKS = re.compile(r"[.,;:!?…。，、؟]")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    path: tuple[str, ...]
    container: tuple[str, ...]
    prior: float
    block: int
    text: str
    named: tuple[tuple[tuple[str, ...], tuple[float, float]], ...] = ()  # path, factor and share


@dataclass
class PathStats:
    nodes: int = 0
    chars: int = 0
    marks: int = 0
    container: tuple[str, ...] = ()
    prior: float = 1.0
    score: float = field(default=0.0)  # of the container


def text_nodes(page: str) -> list[Node]:
    """Text runs in page order, each with its tag path and the number of its block."""
    nodes: list[Node] = []
    stack: list[tuple[str, str, float, tuple]] = []  # element, path step, prior and names so far
    block, at, n = 0, 0, len(page)

    def put(raw: str) -> None:
        if raw.strip():
            path = tuple(x[1] for x in stack)
            held = [i for i, x in enumerate(stack) if x[0] in HOLDERS]
            near = [i for i, x in enumerate(stack) if x[0] in CONTAINERS]
            cut = held[0] if held else near[-1] if near else -1
            prior = stack[-1][2] if stack else 1.0
            named = stack[-1][3] if stack else ()
            nodes.append(Node(path, path[: cut + 1], prior, block, entities.unescape(raw), named))
        elif raw and nodes and nodes[-1].block == block:
            nodes[-1].text += " "

    while at < n:
        found = TAG.search(page, at)
        if found is None:
            put(page[at:])
            break
        if found.start() > at:
            put(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name == "br":
            if nodes and nodes[-1].block == block:
                nodes[-1].text += " "
            continue
        if name in BLOCKS:
            block += 1
        if found[1]:
            _close(stack, name)
            continue
        if name in BLOCKS and name != "p":
            _end_of(stack, {"p"})
        if name == "p":
            _end_of(stack, {"p"})
        if name in ENDS:
            _end_of(stack, ENDS[name])
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else n
            block += 1
            continue
        if not found[3].rstrip().endswith("/"):
            stack.append(_step(name, found[3], stack))
    return nodes


def _step(name: str, attributes: str, stack: list) -> tuple[str, str, float, tuple]:
    prior, named = stack[-1][2:] if stack else (1.0, ())
    labels = " ".join(x.strip("\"'") for x in NAMED.findall(attributes)) if attributes else ""
    step = f"{name}.{labels.replace(' ', '.')}" if labels else name
    held = any(x[0] in HOLDERS for x in stack)
    own_head = {"header"} if held else set()  # an article's own heading is no page header
    if name in FURNITURE and name not in own_head:
        prior = 0.0
    elif name in HOLDERS and not held:
        prior *= HOLDER_PRIOR
    elif labels and name not in ("html", "body"):
        against = _against(labels, FURNITURE_NAMES - own_head)
        if against:
            named = (*named, ((*(x[1] for x in stack), step), against))
    return name, step, prior, named


def _against(labels: str, names: frozenset[str]) -> tuple[float, float] | None:
    """What the strongest of the names says against main text, if any does."""
    found = None
    for label in labels.split():
        parts = {p.lower() for p in PART.findall(label) if not p.isdigit()}
        if parts and parts <= names - SUBJECT_NAMES:
            return WHOLE_NAME
        if parts & names:
            found = PART_NAME
    return found


def _apply_names(nodes: list[Node]) -> None:
    """Lower priors beneath named elements, which become containers of their own."""
    if not any(node.named for node in nodes):
        return
    held: dict[tuple[str, ...], int] = {}
    total = 0
    for node in nodes:
        if node.prior:
            size = len(node.text.strip())
            total += size
            for path, _ in node.named:
                held[path] = held.get(path, 0) + size
    for node in nodes:
        for path, (factor, share) in node.named:
            if node.prior and held[path] <= share * total:
                node.prior *= factor
                node.container = max(node.container, path, key=len)


def _close(stack: list, name: str) -> None:
    """End the nearest open element of the name; an end tag without one is ignored."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            return
        if stack[i][0] in FENCES and name not in FENCES and name not in ("html", "body"):
            return


def _end_of(stack: list, names: set[str]) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in names:
            del stack[i:]
            return
        if stack[i][0] in FENCES:
            return


def score_paths(nodes: list[Node]) -> dict[tuple[str, ...], PathStats]:
    """Per path the score of its container: the best fused text and punctuation ratio in it."""
    stats: dict[tuple[str, ...], PathStats] = {}
    for node in nodes:
        s = stats.setdefault(node.path, PathStats())
        s.nodes += 1
        s.chars += len(node.text)
        s.marks += len(MARKS.findall(node.text))
        s.container, s.prior = node.container, node.prior
    best: dict[tuple, float] = {}
    for s in stats.values():
        own = s.prior * (s.chars / s.nodes) * (1.0 + s.marks / s.nodes)
        best[s.container] = max(own, best.get(s.container, 0.0))
    for s in stats.values():
        s.score = best[s.container] if s.prior else 0.0
    return stats


def main_text(page: str | None, share: float = 0.1) -> str:
    """The text of the content containers: blocks joined by line feeds."""
    nodes = text_nodes(page or "")
    _apply_names(nodes)
    stats = score_paths(nodes)
    least = share * max((s.score for s in stats.values()), default=0.0)
    blocks: dict[int, list[str]] = {}
    for node in nodes:
        score = stats[node.path].score
        if score > 0.0 and score >= least:
            blocks.setdefault(node.block, []).append(node.text)
    texts = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n".join(text for text in texts if text)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url and the main text of every row."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    kind = dict(rows.dtypes)["page_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    return rows.mapInPandas(run, f"page_id {kind}, url string, text string")
