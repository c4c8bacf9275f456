"""Main text of web pages: flat text blocks, classified by a decision tree.

The markup is flattened to blocks, a block being the text between two block-level tags.  A block is described by its number
of words and link density, those of its neighbours, and whether it stands in an article or in a part that page
furniture is marked with (menu, header, footer, sidebar, notice, advert, form, comments: by tag, role, class or id).  The
tree is trained on ``LABELLED``, a small table of blocks labelled by hand.

A form or dialog is layout rather than furniture if no article stands outside such elements and it holds an article, or, being
a form outside articles, at least three quarters of the words that are neither links nor other furniture.

Defined results: null, empty and textless pages give the empty text; broken markup is read as far as it goes (a tag that
never ends is text; an element without text that never ends stops at the next block tag, code at the end); repeated rows are extracted each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stayledger.llm.common import in_arrow, in_chunks
from stayledger.llm.trees import Node, decide, grow

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article"]
# Labelled blocks: the features above, then 1 for main text.
LABELLED = [
    (6, 0.0, 5, 1.0, 40, 0.0, 0, 1, 1), (1, 0.0, 60, 0.0, 80, 0.0, 0, 1, 1), (85, 0.02, 9, 0.0, 120, 0.0, 0, 1, 1),
    (3, 0.0, 45, 0.0, 7, 0.1, 0, 1, 1), (40, 0.0, 30, 0.0, 12, 0.3, 0, 1, 1), (12, 0.25, 70, 0.0, 66, 0.0, 0, 1, 1),
    (150, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1), (8, 1.0, 50, 0.0, 50, 0.0, 0, 1, 1), (2, 0.5, 3, 1.0, 4, 0.0, 0, 1, 1),
    (20, 0.0, 4, 1.0, 2, 0.0, 0, 1, 1), (300, 0.1, 12, 0.0, 8, 0.5, 0, 1, 1), (5, 0.0, 5, 0.0, 5, 0.0, 0, 1, 1),
    (1, 0.0, 1, 0.0, 0, 0.0, 0, 1, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1), (2, 1.0, 2, 1.0, 2, 1.0, 0, 1, 1),
    (5, 1.0, 4, 1.0, 6, 1.0, 0, 1, 1), (3, 0.0, 2, 1.0, 2, 1.0, 0, 1, 1), (25, 0.8, 20, 0.7, 18, 0.9, 0, 1, 1),
    (4, 0.6, 30, 0.0, 2, 1.0, 0, 1, 1), (8, 0.0, 4, 1.0, 0, 0.0, 0, 1, 1), (6, 0.0, 1, 0.0, 3, 1.0, 0, 1, 1),
    (60, 0.0, 8, 0.0, 70, 0.0, 0, 0, 1), (45, 0.05, 50, 0.0, 60, 0.0, 0, 0, 1), (25, 0.0, 90, 0.0, 110, 0.0, 0, 0, 1),
    (18, 0.1, 40, 0.0, 35, 0.0, 0, 0, 1), (120, 0.0, 6, 1.0, 5, 1.0, 0, 0, 1), (9, 0.0, 12, 0.0, 95, 0.0, 0, 0, 1),
    (35, 0.0, 3, 1.0, 40, 0.1, 0, 0, 1), (70, 0.2, 55, 0.1, 4, 0.0, 0, 0, 1), (16, 0.0, 60, 0.0, 6, 0.0, 0, 0, 1),
    (3, 1.0, 0, 0.0, 4, 1.0, 1, 0, 0), (12, 1.0, 3, 1.0, 30, 0.0, 1, 0, 0), (7, 0.0, 5, 1.0, 9, 0.0, 1, 0, 0),
    (30, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0), (55, 0.1, 60, 0.0, 10, 0.0, 1, 0, 0), (4, 0.0, 12, 0.0, 3, 1.0, 1, 0, 0),
    (90, 0.0, 12, 0.0, 85, 0.0, 1, 1, 0), (6, 0.5, 70, 0.0, 66, 0.0, 1, 1, 0), (22, 0.0, 41, 0.0, 33, 0.0, 1, 1, 0),
    (140, 0.3, 10, 0.0, 5, 0.0, 1, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0), (5, 1.0, 4, 1.0, 6, 1.0, 0, 0, 0),
    (10, 0.9, 3, 1.0, 8, 0.8, 0, 0, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), (25, 0.8, 20, 0.7, 18, 0.9, 0, 0, 0),
    (6, 0.0, 1, 0.0, 3, 1.0, 0, 0, 1), (4, 0.6, 30, 0.0, 2, 1.0, 0, 0, 0), (8, 0.0, 4, 1.0, 4, 1.0, 0, 0, 0),
    # Outside articles: headings, short paragraphs, items and cells beside text, or alone on the page.
    (3, 0.0, 80, 0.0, 80, 0.0, 0, 0, 1), (3, 0.0, 1, 1.0, 80, 0.0, 0, 0, 1), (4, 0.0, 2, 1.0, 12, 0.0, 0, 0, 1),
    (6, 0.0, 5, 1.0, 3, 0.0, 0, 0, 1), (2, 0.0, 60, 0.0, 1, 1.0, 0, 0, 1), (5, 0.0, 7, 0.0, 4, 1.0, 0, 0, 1),
    (8, 0.0, 20, 0.0, 3, 1.0, 0, 0, 1), (5, 0.0, 5, 0.0, 5, 0.0, 0, 0, 1), (1, 0.0, 1, 0.0, 1, 0.0, 0, 0, 1),
    (2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 1), (7, 0.0, 30, 0.1, 6, 0.0, 0, 0, 1), (1, 0.0, 3, 0.0, 40, 0.1, 0, 0, 1),
    (4, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (8, 0.1, 9, 0.1, 70, 0.2, 0, 0, 1), (2, 0.0, 90, 0.2, 2, 1.0, 0, 0, 1),
    (1, 0.0, 1, 0.8, 2, 0.0, 0, 0, 1), (3, 0.0, 4, 0.7, 7, 0.0, 0, 0, 1), (6, 0.0, 2, 0.0, 5, 0.7, 0, 0, 1),
    # The same among links.
    (1, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0), (5, 0.0, 3, 1.0, 9, 0.8, 0, 0, 0), (8, 0.0, 12, 0.9, 6, 1.0, 0, 0, 0),
    (2, 0.0, 1, 0.7, 1, 0.7, 0, 0, 0), (6, 0.1, 20, 0.7, 4, 1.0, 0, 0, 0), (4, 0.0, 2, 1.0, 30, 0.8, 0, 0, 0),
    (7, 0.0, 5, 0.8, 2, 0.7, 0, 0, 0), (3, 0.0, 8, 1.0, 12, 0.9, 0, 0, 0),
    # Links beside text.
    (2, 1.0, 40, 0.0, 6, 0.0, 0, 0, 0), (5, 1.0, 3, 1.0, 30, 0.0, 0, 0, 0), (6, 0.9, 80, 0.0, 70, 0.0, 0, 0, 0),
    (12, 1.0, 2, 1.0, 3, 0.0, 0, 0, 0), (3, 0.7, 5, 0.0, 4, 0.0, 0, 0, 0), (1, 1.0, 3, 0.0, 2, 1.0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 60, 0.1, 0, 0, 0), (30, 0.8, 70, 0.1, 50, 0.0, 0, 0, 0), (4, 0.6, 2, 0.8, 90, 0.0, 0, 0, 0),
    (2, 1.0, 0, 0.0, 0, 0.0, 0, 0, 0), (9, 0.8, 4, 0.0, 20, 0.2, 0, 0, 0), (7, 1.0, 30, 0.2, 3, 0.8, 0, 0, 0),
    # Links of furniture inside an article.
    (3, 1.0, 40, 0.0, 60, 0.0, 1, 1, 0), (2, 1.0, 2, 1.0, 2, 1.0, 1, 1, 0), (30, 0.8, 10, 0.0, 12, 0.0, 1, 1, 0),
    (5, 0.6, 5, 0.6, 5, 0.6, 1, 1, 0), (1, 1.0, 60, 0.0, 1, 1.0, 1, 1, 0), (12, 1.0, 1, 1.0, 30, 0.0, 1, 1, 0),
    # Longer text among links.
    (14, 0.0, 3, 1.0, 2, 1.0, 0, 0, 1), (9, 0.0, 2, 1.0, 4, 1.0, 0, 0, 1), (40, 0.1, 6, 0.8, 8, 0.9, 0, 0, 1),
]
# Tags whose content is never text, tags that end a block, tags without an end, and furniture.
_RAW = frozenset("script style noscript template title iframe svg math object canvas audio video".split())
# Of these the ones that do not stand inside their own kind.
_ALONE = frozenset("noscript title iframe canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td"
    " textarea tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE_TAGS = frozenset("nav footer aside menu button select textarea label option".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search alert menu menubar".split())
# Tags and roles that may also stand around a whole page.
_WRAPPERS = frozenset("form dialog".split())
_FURNITURE_NAMES = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|adbox|sponsor\w*|promo\w*|nav\w*|menu\w*|header|masthead|footer|sidebar\w*|aside|notices?|"
    r"alerts?|banner\w*|cookies?|consent|comments?|replies|disqus|respond|form|newsletter|subscri\w*|login|signup|share|sharing|"
    r"social\w*|related|recommend\w*|breadcrumbs?|pagination|popup|modal|widget\w*|skip)(?:$|[_-])",
    re.I,
)
# Names that tell how something else looks or what it holds, and headers of an article.
_MODIFIER = re.compile(
    r"(?:has|with|without|no|is)[_-].*|.*[_-](?:open|opened|closed|active|enabled|disabled|visible|hidden|collapsed|expanded)"
    r"|(?:entry|post|article|story|content)[_-]+header",
    re.I,
)
# Inside an article these words tell furniture at the end of a name, or before words for its parts.
_EVERYDAY = re.compile(r"(?:social\w*|shar(?:e|ing)|forms?|menu\w*|nav\w*|notices?|alerts?|banner\w*)", re.I)
_PARTS = re.compile(
    r"(?:links?|buttons?|btns?|icons?|bars?|lists?|items?|box|blocks?|posts?|section|container|wrap|wrapper|inner|outer|widgets?|"
    r"media|area|tools?|panel|row|count|counts?|follow|top|bottom|left|right|main|body|group|field|fields|control|controls|\d*)",
    re.I,
)
_LAYOUT = re.compile(r"(?:^|[_-])layout(?:$|[_-])", re.I)
_SIDED = re.compile(r"(?:left|right)[_-].*|.*[_-](?:left|right)", re.I)
_HEADER = re.compile(r"(?:.*[_-])?(?:header|masthead)(?:[_-].*)?", re.I)
# Names of lists of other texts: an article inside them is one of these.
_OTHERS = re.compile(r"(?:^|[_-])(?:comments?|replies|disqus|respond|related|recommend\w*|promo\w*|sponsor\w*|ads?|advert\w*)(?:$|[_-])", re.I)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


# What makes furniture: nothing, a name that may stand for the layout around an article, or anything surer.
_NONE, _NAME, _SURE = 0, 1, 2


def _topic(token: str) -> bool:
    """Whether a name in an article tells what it is about (``social-science``) rather than furniture (``social-links``)."""
    parts = re.split(r"[_-]+", token)
    if any(_FURNITURE_NAMES.search(part) and not _EVERYDAY.fullmatch(part) for part in parts):
        return False
    at = max((i for i, part in enumerate(parts) if _EVERYDAY.fullmatch(part)), default=-1)
    return at >= 0 and not all(_PARTS.fullmatch(part) for part in parts[at + 1 :])


def _furniture_name(name: str, value: str, in_article: bool) -> int:
    kind = _NONE
    for token in value.split():
        if not _FURNITURE_NAMES.search(token) or _MODIFIER.fullmatch(token):
            continue
        if name == "class" and _SIDED.fullmatch(token) or in_article and (_HEADER.fullmatch(token) or _topic(token)):
            continue
        kind = max(kind, _SURE if _OTHERS.search(token) and not _LAYOUT.search(token) else _NAME)
    return kind


def _furniture(tag: str, attributes: str, in_article: bool) -> int:
    if tag in _FURNITURE_TAGS or (tag == "header" and not in_article):
        return _SURE
    if tag in ("article", "main", "body", "html"):
        return _NONE
    kind = _NONE
    for name, a, b, c in _NAMED.findall(attributes):
        name, value = name.lower(), (a or b or c).strip()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return _SURE
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return _SURE
        if name == "role" and value.lower() in _FURNITURE_ROLES:
            return _SURE
        if name in ("class", "id"):
            if tag == "form":  # that it is one says nothing yet
                value = re.sub(r"(?<![^\s_-])form(?![^\s_-])", "", value, flags=re.I)
            kind = max(kind, _furniture_name(name, value, in_article))
    return kind


def _after_raw(page: str, tag: str, attributes: str, at: int, stops: dict[str, tuple[int, int]]) -> int:
    """Where a raw element that begins before ``at`` ends: behind its end tag, or without one at the next block tag.

    Code without an end tag hides the rest, as its own tags are no markup.  ``stops`` keeps the next end tag of each kind."""
    if stops.get(tag, (-1, -1))[0] < at:
        found = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
        stops[tag] = found.span() if found else (len(page), -1)
    start, stop = stops[tag]
    if stop >= 0 and not (tag in _ALONE and re.compile(rf"<{tag}[\s/>]", re.I).search(page, at, start)):
        return stop
    if tag == "script" and not re.search(r"(?:^|\s)src\s*=", attributes, re.I):
        return len(page)
    following = _BLOCK_TAG.search(page, at)
    return following.start() if following else len(page)


def _wraps(tag: str, attributes: str) -> bool:
    """Whether an element is a form or a dialog by tag or role."""
    return tag in _WRAPPERS or any(
        name.lower() == "role" and (a or b or c).strip().lower() in _WRAPPERS for name, a, b, c in _NAMED.findall(attributes)
    )


_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCK, key=len, reverse=True))})(?=[\s/>])", re.I)


_MAIN, _ARTICLE = 1, 2


def _layouts(wrappers: list[list[int]], found: list[tuple[str, int, int, bool, int, int]]) -> list[bool]:
    """Of each form or dialog (around, whether a form outside articles, whether it holds an article): is it layout, as all around it?"""
    free = [0] * (len(wrappers) + 1)  # the last for blocks outside
    apart = 0
    for _, n, links, furniture, article, wrapper in found:
        if not furniture:
            free[wrapper] += n - links
            if wrapper < 0 and article == _ARTICLE:
                apart += n - links
    total = sum(free)
    for i in range(len(wrappers) - 1, -1, -1):
        around = wrappers[i][0]
        if around >= 0:
            free[around] += free[i]
            wrappers[around][2] |= wrappers[i][2]
    out: list[bool] = []
    for i, (around, form, holds) in enumerate(wrappers):
        own = not apart and bool(holds or form and free[i] and 4 * free[i] >= 3 * total)
        out.append(own and (around < 0 or out[around]))
    return out


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, words in links, furniture, article) of each block with text, in page order."""
    out: list[tuple[str, int, int, bool, int, int]] = []
    # Open elements: tag, kind of furniture, main or article, link, form or dialog; each inherits from the one around it.
    stack: list[tuple[str, int, int, bool, int]] = [("", _NONE, 0, False, -1)]
    stops: dict[str, tuple[int, int]] = {}
    wrappers: list[list[int]] = []
    opened: Counter = Counter()
    pieces: list[str] = []
    linked = 0
    state = stack[0]

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            n = len(text.split(" "))
            out.append((text, n, min(linked, n), state[1] > _NONE, state[2], state[4]))
        pieces.clear()
        linked = 0

    def pop_to(tag: str) -> None:
        while stack[-1][0] != tag:
            opened[stack.pop()[0]] -= 1
        opened[stack.pop()[0]] -= 1

    def text_of(raw: str) -> None:
        nonlocal linked
        if stack[-1][4] >= 0 and (opened["label"] or opened["button"]):
            return  # captions of a form stand inside its blocks
        text = entities.unescape(raw)
        pieces.append(text)
        if stack[-1][3]:
            linked += len(text.split())

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        if found is None:
            text_of(page[at:])
            break
        if found.start() > at:
            text_of(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = found.group(1), found.group(2), found.group(3)
        if tag is None:
            closing, tag, attributes = found.group(4), found.group(5), found.group(6)
        if tag is None:  # comment or declaration
            continue
        tag = tag.lower()
        if tag in _RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                at = _after_raw(page, tag, attributes, at, stops)
            continue
        if tag in _BLOCK:
            close()
        if tag == "br":
            pieces.append(" ")
        if tag in _VOID:
            continue
        if closing:
            if opened[tag]:
                pop_to(tag)
        else:
            for one in ("p",) if tag in _BLOCK and tag != "p" else (tag,) if tag in ("p", "li", "td", "th", "tr", "dd", "dt", "option") else ():
                # A paragraph ends where the next block begins; items end each other inside their list.
                if opened[one] and (one == "p" or stack[-1][0] == one):
                    pop_to(one)
            above = stack[-1]
            article = max(above[2], _ARTICLE if tag == "article" else _MAIN if tag == "main" else 0)
            # The first article or main sheds the names of the layout around it.
            around = _NONE if article and not above[2] and above[1] == _NAME else above[1]
            kind, wrapper = max(around, _furniture(tag, attributes, above[2] > 0)), above[4]
            if wrapper >= 0 and article and not above[2] and kind == _NONE:
                wrappers[wrapper][2] = 1
            if _wraps(tag, attributes) and not (tag == "form" and opened[tag]):  # a form in a form is none
                wrappers.append([wrapper, int(tag == "form" and above[2] < _ARTICLE), 0])
                wrapper = len(wrappers) - 1
            stack.append((tag, kind, article, above[3] or tag == "a", wrapper))
            opened[tag] += 1
        state = stack[-1]
    close()
    layout = _layouts(wrappers, out)
    return [
        (text, n, links, furniture or wrapper >= 0 and not layout[wrapper], article > 0)
        for text, n, links, furniture, article, wrapper in out
    ]


def described(found: list[tuple[str, int, int, bool, bool]]) -> list[list[float]]:
    """Features of each block; at an end of the page the one neighbour counts twice, and a lone block has none."""
    own = [(float(n), links / n) for _, n, links, _, _ in found]
    padded = [own[1], *own, own[-2]] if len(own) > 1 else [(0.0, 0.0), *own, (0.0, 0.0)]
    return [
        [*padded[i + 1], *padded[i], *padded[i + 2], float(found[i][3]), float(found[i][4])] for i in range(len(found))
    ]


def train(rows: list[tuple] = LABELLED) -> Node:
    table = np.array(rows, dtype=float)
    return grow(table[:, :-1], table[:, -1], depth=6, least=1)


def main_text(page: str | None, tree: Node) -> str:
    found = blocks(page or "")
    return "\n".join(b[0] for b, x in zip(found, described(found)) if decide(tree, x) >= 0.5)


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """page_id, url and text of each page."""
    tree = tree or train()  # a few dozen nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "html"):
            texts = [main_text(page, tree) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, text string"
    return in_arrow(pages.select("page_id", "url", "html"), run, schema)
