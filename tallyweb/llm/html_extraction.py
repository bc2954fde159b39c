"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each with its root-to-leaf path of block-level tags. For
every path the text length, the part of it in links, and the punctuation of all its blocks
are added up; the ratios per block are smoothed over the path's nearest ancestors and all
that lies under them, and fused into one score: text, punctuation, freedom from links, the
page's own mark of its article, and words of class and id that name what is no article. A
threshold on the score selects the paths whose blocks are the content, a lower one for paths
beside the best one or in the same article. Blocks under elements that are no article by
their kind (menus, headers, footers, asides, forms) and unseen ones (scripts, styles,
hidden) take no part.

A block's white space becomes single spaces, blocks are joined by one line feed in page
order; nothing is cut. One pass over the table, page by page, no shuffle; time is linear in
the page: paths are nodes of a tree, no more than DEEPEST levels are told apart, as in
browsers.

Defined cases: null or empty html, or html without content, gives an empty text; unclosed
tags, stray < and quotes are read as browsers do; bytes that are not UTF-8 become U+FFFD;
repeated rows are extracted one by one; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is text to no parser: one that is not closed lasts to the page's end.
RAW = "script style textarea title noscript template iframe".split()
#: Other elements whose content is never text of the page; one that is not closed is passed over.
UNSEEN = "svg math select object canvas audio video button".split()
#: Elements and roles of what is no article.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset head".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id for what is no article: as a whole name they weigh the most, as a part of one less.
_PLAIN = (
    "ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed|s)?|promos?|sidebar|nav|navbar|navigation|breadcrumbs?|footer|masthead|cookies?|consent|gdpr|newsletter|subscribe|subscription|signup|login|"
    "share|sharing|social|related|recommended|recommendations|comments?|disqus|replies|reply|respond|popup|modal|overlay|widgets?|toolbar|pagination|pager"
)
_VAGUE = "banner|promotion|menu|header|notices?|alerts?|search"
_WHOLE = re.compile(rf"(?:{_PLAIN}|{_VAGUE})", re.I)
_PART = re.compile(rf"(?:^|[_-])(?:{_PLAIN})(?:$|[_-])", re.I)
_VAGUE_PART = re.compile(rf"(?:^|[_-])(?:{_VAGUE})(?:$|[_-])", re.I)
WHOLE_WEIGHT, PART_WEIGHT, VAGUE_WEIGHT = 0.05, 0.1, 0.4
#: Weight of what lies outside the article that a page marks.
OUTSIDE_WEIGHT = 0.05
#: Least score for the best one: of any path, and of one beside the best or in its article.
THRESHOLD, NEAR_THRESHOLD = 0.25, 0.05
#: Ancestors over which ratios are smoothed.
LEVELS = 3
DEEPEST = 512
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small span strike strong sub sup time tt u var wbr source input br link meta base".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open p; opening a key ends the nearest of its values.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}
_HOLDS = frozenset("ul ol dl table article section main body html div".split())
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW + UNSEEN}
PUNCTUATION = re.compile(r"[.,;:!?…。、！？；：«»„“”]")


@dataclass
class Path:
    """A node of the tree of paths."""

    parent: int
    tag: str
    weight: float
    article: int
    heading: bool
    seen: dict[tuple, int] = field(default_factory=dict)


@dataclass
class Block:
    path: int
    text: str
    linked: int


def _weight(tag: str, attributes: str, in_article: bool) -> float:
    """0 for what is no article by its kind or not seen, less than 1 for what a class or id names so."""
    if tag in ASIDE_TAGS or (tag == "header" and not in_article):
        return 0.0
    if not attributes.strip() or tag in ("html", "body"):
        return 1.0
    out = 1.0
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id") and tag != "main":
            for word in value.split():
                if in_article and "header" in word.lower():  # an article's own header holds its title
                    continue
                out = min(out, WHOLE_WEIGHT if _WHOLE.fullmatch(word) else PART_WEIGHT if _PART.search(word) else VAGUE_WEIGHT if _VAGUE_PART.search(word) else 1.0)
        if name == "role" and value.strip().lower() in ASIDE_ROLES:
            return 0.0
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return 0.0
    return out


def blocks_of(page: str) -> tuple[list[Path], list[Block]]:
    """The paths of a page, and its blocks in order, without those that are no article by their kind."""
    paths = [Path(-1, "", 1.0, 0, False)]
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open block-level elements and their paths
    opened: Counter[str] = Counter()
    missing: set[str] = set()  # elements that are not closed any more
    headers = articles = link = linked = 0
    parts: list[str] = []

    def here() -> int:
        return stack[-1][1] if stack else 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            own = paths[here()]
            if text and own.weight and not (headers and not own.heading):
                out.append(Block(here(), text, 0 if own.heading else min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal headers
        tag, path = stack.pop()
        opened[tag] -= 1
        headers -= tag == "header" and paths[path].weight > 0

    def push(tag: str, weight: float) -> None:
        nonlocal headers, articles
        up = here()
        above = paths[up]
        article = above.article
        weight = above.weight * weight
        if tag in ("article", "main") and weight == 1 and not article:
            articles += 1
            article = articles
        key = (tag, weight, article)
        path = above.seen.get(key)
        if path is None:
            path = above.seen[key] = len(paths)
            paths.append(Path(up, tag, weight, article, above.heading or tag in HEADINGS))
        stack.append((tag, path))
        opened[tag] += 1
        headers += tag == "header" and weight > 0

    def closed_at(tag: str, at: int, pattern: re.Pattern) -> int | None:
        """Where the element that is open at a place ends."""
        if tag in missing:
            return None
        found = pattern.search(page, at)
        if found is None:
            missing.add(tag)
        return found.end() if found else None

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                parts.append(m[0])
                linked += len(m[0]) if link else 0
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], (m[3] or m[6] or "")
        if tag in _END:
            if not closing and not attributes.endswith("/"):
                end = closed_at(tag, at, _END[tag])
                at = end if end is not None else n if tag in RAW else at
            parts.append(" " if tag not in INLINE else "")
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else 1
            elif tag == "br":
                parts.append(" ")
            if not closing and tag not in VOID and _weight(tag, attributes, paths[here()].article > 0) < VAGUE_WEIGHT:
                end = closed_at(tag, at, re.compile(rf"</{re.escape(tag)}\s*>", re.I))  # an inline aside ends where it is closed
                at = end if end is not None else at
                link = 0 if tag == "a" else link
            continue
        flush()
        link = 0
        if closing:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        if tag == "body":
            while stack and stack[-1][0] != "html":
                pop()
        ends = _CLOSES.get(tag, set())
        while stack and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS and tag in HEADINGS):
            pop()
        if any(opened[t] for t in ends):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in _HOLDS:
                    break
        if attributes.endswith("/") and tag not in ("p", "div"):
            continue
        if len(stack) >= DEEPEST:
            pop()
        push(tag, _weight(tag, attributes, paths[here()].article > 0))
    flush()
    return paths, out


def content_paths(paths: list[Path], blocks: list[Block]) -> set[int]:
    """The paths whose blocks are content."""
    own: dict[int, list[int]] = {}
    for b in blocks:
        sums = own.setdefault(b.path, [0, 0, 0, 0])
        for i, x in enumerate((len(b.text), b.linked, len(PUNCTUATION.findall(b.text)), 1)):
            sums[i] += x
    if not own:
        return set()
    under: dict[int, list[int]] = {}
    for k, sums in own.items():
        node = k
        for _ in range(LEVELS + 1):
            total = under.setdefault(node, [0, 0, 0, 0])
            for i in range(4):
                total[i] += sums[i]
            node = paths[node].parent
            if node < 0:
                break

    def ratios(sums: list[int]) -> tuple[float, float]:
        length, linked, marks, count = sums
        return (length - linked) / count, marks / count

    marked = any(paths[k].article for k in own)
    score, free = {}, {}
    for k, sums in own.items():
        text = mark = total = 0.0
        node, part = paths[k].parent, 1.0
        while node >= 0 and node in under and part > 2.0**-LEVELS:
            t, m = ratios(under[node])
            text, mark, total, part = text + part * t, mark + part * m, total + part, part / 2
            node = paths[node].parent
        t, m = ratios(sums)
        smooth = (text / total if total else t) * math.log2(2 + (mark / total if total else m))
        free[k] = 1 - sums[1] / sums[0]
        score[k] = math.sqrt(smooth * t * math.log2(2 + m)) * free[k] * paths[k].weight * (OUTSIDE_WEIGHT if marked and not paths[k].article else 1)
    best = max(own, key=lambda k: (score[k] * math.sqrt(own[k][0]), -k))
    top = paths[best]
    # Beside the best: in its article, or under its parent, unless that is the body.
    beside = {k for k in own if paths[k].article == top.article} if top.article else set()
    if not top.article and top.parent >= 0 and paths[top.parent].tag not in ("", "html", "body"):
        inside = {top.parent}
        for k in range(top.parent + 1, len(paths)):
            if paths[k].parent in inside:
                inside.add(k)
        beside = {k for k in own if k in inside}
    enough = lambda k: score[k] >= THRESHOLD * score[best] or (k in beside and paths[k].weight == top.weight and (paths[k].heading or score[k] >= NEAR_THRESHOLD * score[best]))
    return {k for k in own if free[k] > 0.4 and enough(k)}


def main_text(page: str | None) -> str:
    paths, blocks = blocks_of(page or "")
    keep = content_paths(paths, blocks)
    return "\n".join(b.text for b in blocks if b.path in keep)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of keep, text, and n_chars (its code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x.decode("utf-8", "replace") if x is not None else None) for x in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(keep))), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())], names=[*keep, "text", "n_chars"])

    own = pages.select(*keep, F.col(html).cast("string").cast("binary").alias("_html"))
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return own.mapInArrow(run, f"{schema}, text string, n_chars long")
