"""Main text of HTML pages from flat text blocks.

A page becomes a flat list of text blocks: runs of text between block-level tags, without markup,
scripts, styles and form controls. A decision tree tells main text from the rest by a block's word count and
link density, those of the blocks before and after it, its tag, and two marks of where it stands: within an
article or main element, and within an element that its tag, role, class or id names as page furniture. The
tree is grown at first use from the labelled blocks of the small pages in html_labels.py. A name that only
contains a word of page furniture (share-price, related-work) is a weak mark, and then size, density and
neighbours decide, as they do on pages that mark no article.

Character references are decoded, white space inside a block becomes one space, blocks are joined in
page order by one line feed; nothing else is dropped or capped. Null and empty pages: empty text. Very long
pages are read whole, in time that grows with their length. Repeated rows keep a row each. An empty table
gives no rows; other columns are ignored. Broken markup (unclosed tags, comments, quotes) is read to the
page's end without failing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table
from tessera.llm.html_labels import PAGES

#: Elements whose content is never text of the page.
HIDDEN = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "select", "textarea", "button", "head")
#: Those of them whose content has no tags: unclosed, they reach to the page's end.
RAW = ("script", "style", "textarea")
#: Elements that do not end an unclosed head.
_IN_HEAD = frozenset("title base link meta script style noscript template object".split())
#: Elements that end a block.
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul video audio canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are page furniture by their tag.
FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
#: Words of names (class, id, role, aria-label) that mark page furniture.
FURNITURE_WORDS = frozenset(
    """ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disclaimer
    disqus footer gdpr masthead menu modal nav navbar navigation navigationbar newsletter notice notification pagination pager popup promo promoted
    promotion replies reply respond sidebar signup sponsor sponsored subscribe subscription toolbar topbar widget widgets complementary alert login""".split()
)
#: Words that mark it weakly when they stand alone.
WEAK_WORDS = frozenset("header related search share sharing social skip discussion responses feedback".split())
#: Words that name what furniture is laid out in; a name of these and of furniture words is a full mark.
LAYOUT_WORDS = frozenset(
    """box wrapper wrap container list section block area slot bar item items button buttons link links post posts article articles inner outer content form
    panel top bottom left right page site global primary secondary mobile desktop sticky fixed reader readers user users icons tools unit placeholder group
    row col column main story stories entry div block web privacy policy""".split()
)
MAIN_WORDS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre figcaption".split())
#: Open tags that end where another of their kind begins.
_ENDED_BY = {"p": BLOCK, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    rf"|<({'|'.join(RAW)})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARKS = re.compile(r"""(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN_ATTRIBUTE = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*(?:"[^"]*display\s*:\s*none|'[^']*display\s*:\s*none))""", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block(NamedTuple):
    text: str
    words: int
    link_words: int
    #: The block's tag: 2 for a heading, 1 for a paragraph, 0 for others.
    kind: int
    main: int
    #: 2: in page furniture; 1: a name around it has a word of furniture; 0: neither.
    furniture: int


class _Open(NamedTuple):
    tag: str
    main: int
    furniture: int
    link: int
    hidden: int
    kind: int = 0


def _weight(words: list[str]) -> int:
    """How far a name's words mark page furniture: 2 fully, 1 weakly, 0 not."""
    strong = sum(w in FURNITURE_WORDS for w in words)
    weak = sum(w in WEAK_WORDS for w in words)
    if not strong and not weak:
        return 0
    layout = sum(w in LAYOUT_WORDS for w in words)
    return 2 if strong + weak + layout == len(words) and (strong or len(words) > 1) else 1


def _marked(tag: str, attributes: str, main: int) -> tuple[int, int]:
    """(opens main text, how far it opens page furniture) for a start tag."""
    furniture, named_main = 0, False
    if attributes and ("=" in attributes or "hidden" in attributes):
        if _HIDDEN_ATTRIBUTE.search(attributes):
            return 0, 2
        for attribute, *values in _MARKS.findall(attributes):
            for name in values:
                # A label is one phrase; the others are lists of names.
                for part in [name] if attribute.lower() == "aria-label" else name.split():
                    words = [p.lower() for p in _NAME_PARTS.findall(part)]
                    furniture = max(furniture, _weight(words))
                    named_main = named_main or not MAIN_WORDS.isdisjoint(words)
    if tag in ("body", "html"):
        return int(named_main), 0
    if tag in FURNITURE_TAGS and not (tag == "header" and main):
        return 0, 2
    return int((tag in ("article", "main") or named_main) and furniture < 2), furniture


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    found: list[Block] = []
    stack: list[_Open] = []
    top = _Open("", 0, 0, 0, 0)
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        if parts:
            words = html.unescape("".join(parts)).split() if any("&" in p for p in parts) else "".join(parts).split()
            if words:
                found.append(Block(" ".join(words), len(words), min(linked, len(words)), top.kind, top.main, top.furniture))
            parts.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if top.hidden:
            return
        parts.append(raw)
        if top.link:
            linked += len(raw.split())

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            take(page[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag, ends, attributes = tag.lower(), m[2] or m[5], m[4] or m[7] or ""
        if ends:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), -1)
            if tag in BLOCK and not (top.hidden and (depth < 0 or stack[depth].hidden)):
                close()
            # An inline end tag does not close blocks around it.
            if depth >= 0 and (tag in BLOCK or tag in HIDDEN or all(o.tag not in BLOCK for o in stack[depth + 1 :])):
                del stack[depth:]
            elif tag == "a":
                stack = [o._replace(link=0) for o in stack]
            top = stack[-1] if stack else _Open("", 0, 0, 0, 0)
            continue
        if tag not in _IN_HEAD and top.hidden and (stack[-1].tag == "head" or tag == "body"):
            # The end tag of a head can be left out.
            stack = stack[: next((k for k, o in enumerate(stack) if o.tag == "head"), len(stack))]
            top = stack[-1] if stack else _Open("", 0, 0, 0, 0)
        if tag == "head":
            close()
        if tag in BLOCK and not top.hidden:
            close()
            if stack and tag in _ENDED_BY.get(stack[-1].tag, ()):
                stack.pop()
                top = stack[-1] if stack else _Open("", 0, 0, 0, 0)
        if tag in VOID or attributes.endswith("/"):
            continue
        main, furniture = _marked(tag, attributes, top.main)
        kind = 2 if tag in HEADINGS else 1 if tag in PARAGRAPHS else top.kind if tag not in BLOCK else 0
        stack.append(_Open(tag, int(top.main or main), max(top.furniture, furniture), int(top.link or tag == "a"), int(top.hidden or tag in HIDDEN), kind))
        top = stack[-1]
    if at < len(page):
        take(page[at:])
    close()
    return found


#: Features of a block, in this order. place: 1 within marked main text, -1 outside it on a page that marks
#: some, 0 on a page that marks none. kind and furniture as in Block.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "kind", "place", "furniture")


def features(found: list[Block]) -> list[tuple]:
    """The features of a page's blocks."""
    marks_main = any(b.main and b.furniture < 2 for b in found)
    none = (0, 0.0)
    size = [none, *((b.words, b.link_words / b.words) for b in found), none]
    return [(*size[k + 1], *size[k], *size[k + 2], b.kind, 1 if b.main else -1 if marks_main else 0, b.furniture) for k, b in enumerate(found)]


def labelled() -> tuple:
    """Features of the labelled pages' blocks, then 1 for main text; a block's first character, + or -, is its label."""
    rows = []
    for page in PAGES:
        found = blocks(page)
        # The label is written onto the first word, so it changes no count.
        rows += [(*f, int(b.text[0] == "+")) for f, b in zip(features(found), found, strict=True)]
    return tuple(rows)


def grow(rows: tuple, depth: int = 8):
    """A decision tree: 0 or 1, or (feature, threshold, tree if value <= threshold, tree if above)."""
    ones = sum(r[-1] for r in rows)
    if depth == 0 or ones in (0, len(rows)):
        return int(2 * ones > len(rows))

    def impurity(part: list) -> float:
        p = sum(r[-1] for r in part)
        return p * (len(part) - p) / len(part)

    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left, right = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            cost = impurity(left) + impurity(right)
            if best is None or cost < best[0] - 1e-9:
                best = (cost, f, cut, tuple(left), tuple(right))
    if best is None:
        return int(2 * ones > len(rows))
    _, f, cut, left, right = best
    return f, cut, grow(left, depth - 1), grow(right, depth - 1)


@lru_cache(maxsize=1)
def tree():
    return grow(labelled())


def is_main(features: tuple, node=None) -> bool:
    node = tree() if node is None else node
    while isinstance(node, tuple):
        f, cut, low, high = node
        node = low if features[f] <= cut else high
    return bool(node)


def main_blocks(found: list[Block]) -> list[Block]:
    """The blocks that the tree takes for main text."""
    return [b for b, f in zip(found, features(found), strict=True) if is_main(f)]


def main_text(page: str | None) -> str:
    return "\n".join(b.text for b in main_blocks(blocks(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (columns page_id, url, html)."""
    kinds = "page_id long, url string, text string, n_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), n], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(read, kinds)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
