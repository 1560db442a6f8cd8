"""Main text of raw pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, fresh

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
# Elements that are no part of the article wherever they stand.
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe object svg canvas button select "
    "textarea dialog menu head title video audio map".split()
)
# Words of class, id or role that make an element suspect; its weight decides (``without_marked``).
MARK_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline-ad comment "
    "comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice overlay pager pagination popup promo promoted promotion related reply replies "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget "
    "complementary contentinfo search alert alertdialog".split()
)
# Layout names tell what a page has or lacks; the header of an article is part of it.
LAYOUT_WORDS = frozenset("has have with without no not hide hidden".split())
HEADER_WORDS = frozenset(("header", "masthead"))
ARTICLE_WORDS = frozenset("article post entry story content main".split())
# Elements that an own kind, or the end of their parent, closes without a tag.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "thead": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
LISTS = frozenset(("ul", "ol", "dl", "table", "select"))
ROOTS = frozenset(("html", "body", "article", "main"))
RAW = r"script|style|noscript|template|textarea|iframe|title|svg"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*+>"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+[^>]*+)>""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


@dataclass
class Block:
    """Text of one block: its tag path, the elements it stands in, and which of these are marked."""

    path: str
    text: str
    inside: tuple[int, ...]
    marked: tuple[int, ...] = ()


def is_dropped(tag: str, open_tags: list[str]) -> bool:
    return tag in DROPPED or tag == "header" and "article" not in open_tags


def is_marked(tag: str, rest: str, open_tags: list[str]) -> bool:
    """Whether a class, id or role has a word of MARK_WORDS, compounds like has-sidebar apart."""
    if tag in ROOTS or tag in INLINE or "=" not in rest:
        return False
    inside = "article" in open_tags or "main" in open_tags
    for name, *values in ATTRIBUTE.findall(rest):
        if name.lower() in ("class", "id", "role"):
            for one in "".join(values).lower().split():
                words = re.split(r"[^a-z0-9]+", one)
                title = inside or not ARTICLE_WORDS.isdisjoint(words)
                for before, word in zip(["", *words], words):
                    if word in MARK_WORDS and before not in LAYOUT_WORDS and not (title and word in HEADER_WORDS):
                        return True
    return False


def blocks(page: str) -> tuple[list[Block], list[str]]:
    """Text blocks of a page in order, without dropped elements, with marked ones; and all elements' tags."""
    found: list[Block] = []
    tags: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # tag, number of the element, dropped
    marked: set[int] = set()
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                outer = [(t, n) for t, n, _ in stack if t not in INLINE]
                path = "/".join(t for t, _ in outer)
                inside = tuple(n for _, n in outer)
                found.append(Block(path, text, inside, tuple(n for n in inside if n in marked)))

    def close(at: int) -> None:
        if any(t not in INLINE for t, _, _ in stack[at:]):
            flush()
        del stack[at:]

    def start(tag: str, rest: str) -> None:
        if tag == "br":
            pieces.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            return
        if tag not in INLINE:
            flush()
            # Block starts end an open paragraph or heading; its formatting ends with it.
            ends = CLOSES.get(tag, set()) | {"p"}
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in ends:
                    close(at)
                    if tag not in CLOSES:
                        break
                elif stack[at][0] not in INLINE and (tag not in CLOSES or stack[at][0] in LISTS):
                    break
        tags.append(tag)
        open_tags = [t for t, _, _ in stack]
        gone = bool(stack and stack[-1][2]) or is_dropped(tag, open_tags)
        if not gone and is_marked(tag, rest, open_tags):
            marked.add(len(tags) - 1)
        stack.append((tag, len(tags) - 1, gone))

    def end(tag: str) -> None:
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == tag:
                close(at)
                return
            if tag in INLINE and stack[at][0] not in INLINE:
                return

    place = 0
    for token in TOKEN.finditer(page):
        if token.start() > place and not (stack and stack[-1][2]):
            pieces.append(page[place:token.start()])
        place = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["end"]:
            end(tag)
        else:
            start(tag, token["rest"])
    if place < len(page) and not (stack and stack[-1][2]):
        pieces.append(page[place:])
    flush()
    return found, tags


def smooth(values: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing over a block and its neighbours, edges repeated."""
    kernel = np.exp(-np.arange(-2, 3) ** 2 / (2 * sigma**2))
    return np.convolve(np.pad(values, 2, mode="edge"), kernel / kernel.sum(), "valid")


def without_marked(found: list[Block], tags: list[str]) -> list[Block]:
    """The blocks without those of marked elements that are beside the page's text.

    A block weighs its characters times its punctuation ratio.  A marked element stays
    if an ``article`` or ``main`` is in it, or if it outweighs all blocks that no mark
    concerns and none of these is in an ``article`` or ``main``; inner marked elements are judged when the outer ones that stay have lost
    their marks.  So a mark decides about the lesser part of a page, and empties none.
    """
    weight = [len(b.text) * (1 + len(PUNCTUATION.findall(b.text))) for b in found]
    cleared: set[int] = set()
    for depth in range(max((len(b.marked) for b in found), default=0)):
        others = [(b, w) for b, w in zip(found, weight) if cleared.issuperset(b.marked)]
        free = sum(w for _, w in others)
        if any(tags[m] in ("article", "main") for b, _ in others for m in b.inside):
            free = float("inf")
        inside: dict[int, int] = {}
        for b, w in zip(found, weight):
            if len(b.marked) > depth and cleared.issuperset(b.marked[:depth]):
                n = b.marked[depth]
                inside[n] = inside.get(n, 0) + w
                if any(tags[m] in ("article", "main") for m in b.inside if m > n):
                    cleared.add(n)
        cleared.update(n for n, w in inside.items() if w > free)
    return [b for b in found if cleared.issuperset(b.marked)]


def content_paths(found: list[Block]) -> list[str]:
    """The paths of the content nodes.

    A path's text ratio is its characters per block, its punctuation ratio its marks
    per block.  Both are laid along the page, smoothed, and fused by multiplication;
    paths whose blocks reach the standard deviation of all on average are content,
    the one of them with the most text and punctuation first.
    """
    total: dict[str, list[int]] = {}
    for b in found:
        row = total.setdefault(b.path, [0, 0, 0])
        row[0] += len(b.text)
        row[1] += len(PUNCTUATION.findall(b.text))
        row[2] += 1
    chars = smooth(np.array([total[b.path][0] / total[b.path][2] for b in found]))
    marks = smooth(np.array([total[b.path][1] / total[b.path][2] for b in found]))
    fused = chars * (1 + marks)
    values: dict[str, list[float]] = {}
    for b, value in zip(found, fused):
        values.setdefault(b.path, []).append(value)
    least = fused.std()
    chosen = [p for p, v in values.items() if np.mean(v) >= least] or list(values)
    return sorted(chosen, key=lambda p: (total[p][0] * (1 + total[p][1] / total[p][2]), p), reverse=True)


def main_text(page: str | None) -> str:
    """The article of a page, one line per block.

    If all blocks of the first content path are in an ``article`` or ``main``, the
    elements of that kind that hold content blocks are the article.  Else it is what the
    first path's blocks have in common, the blocks of all other content paths with what
    each has in common below the body, and all that stands between them.  Of these, short
    blocks stay too; dropped elements, and marked ones beside the text, were left out
    before.
    """
    found, tags = blocks(page or "")
    found = without_marked(found, tags)
    if not found:
        return ""
    paths = content_paths(found)
    of_path: dict[str, list[int]] = {p: [] for p in paths}
    for k, b in enumerate(found):
        if b.path in of_path:
            of_path[b.path].append(k)
    content = sorted(k for places in of_path.values() for k in places)
    root = {k: next((n for n in found[k].inside if tags[n] in ("article", "main")), None) for k in content}
    if None not in (root[k] for k in of_path[paths[0]]):
        holders = {n for n in root.values() if n is not None}
        return "\n".join(b.text for b in found if not holders.isdisjoint(b.inside))
    holders = set()
    for path, places in of_path.items():
        lead = [found[k].inside for k in places]
        # Numbers of elements are unique, so what two blocks share is a common beginning.
        shared = [n for n in lead[0] if all(n in inside for inside in lead)]
        if len(lead) == 1 and shared and tags[shared[-1]] not in ROOTS:
            shared.pop()
        if path == paths[0] and not shared:
            return "\n".join(b.text for b in found)
        if shared and (path == paths[0] or tags[shared[-1]] not in ("html", "body")):
            holders.add(shared[-1])
    kept = [
        b.text for k, b in enumerate(found) if content[0] <= k <= content[-1] or not holders.isdisjoint(b.inside)
    ]
    return "\n".join(kept)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each as a last column.

    The ratios are those of one page's own paths, so pages are independent: no
    shuffle, whole pages only.  Nulls: a null or blank page, or one without article
    text, gives the empty text.  Malformed markup is read as browsers do in the
    common cases (unclosed paragraphs, items and formatting; an unclosed script or
    comment runs to the end).  Other columns pass unchanged; if ``text_col`` is
    taken, the added name gets underscores in front.
    """
    (name,) = fresh(pages, text_col)
    at = pages.columns.index(html_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                texts = [main_text(page) for page in batch.column(at).to_pylist()]
                cells = [*batch.columns, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cells, [*batch.schema.names, name])

    return pages.mapInArrow(apply, pages.select("*", F.lit("").alias(name)).schema)
