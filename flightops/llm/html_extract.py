"""HTML extraction: flat text blocks classified by a decision tree over shallow features.

A page is cut into blocks at block-level tags. Each block has its number of
words, its link density (share of characters inside links), and the same two of
the blocks before and after it. Comments and notices can read like an article,
so four more features stand beside these: whether it is a heading, whether the
containers around it call themselves main text or something else (by tag name,
class and id), and whether it stands outside of an article that the page has.
A small decision tree, grown here from the labelled blocks in `LABELLED`, tells
main text from the rest; without telling containers it decides by a block and
its neighbours alone. What html and body are called, and wrappers of an article
that call themselves after a layout, does not count.

Scripts, styles, markup and comments never make text. Character references are
decoded; white space inside a block becomes one space; blocks are joined by two
newlines in page order, whole.

* null or empty html: empty text. No main block: empty text.
* unclosed tags: a block tag ends the block before it; a container ends with its
  own end tag or with that of a container around it.
* an empty table gives no rows. Very long pages are read in time in proportion to their length, a page at a time.
* repeated rows are extracted one by one; other columns pass through, and
  `text` replaces a column of that name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import by_bytes, map_arrow

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"(/?)([a-zA-Z][\w:-]*)")
_STOP = re.compile(r"[<>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
#: Elements whose content is no text, with what ends them.
_DROPPED = {t: re.compile(rf"</{t}\s*>" + (r"|(?=<body\b)" if t == "head" else ""), re.IGNORECASE) for t in
            "script style noscript template svg math iframe object head textarea select".split()}

BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
            "thead tr ul button label".split())
#: Tags whose content a new one of them ends.
SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
#: What a tag name, or a word of a class or id, says of a container.
SIDE_TAGS = set("nav aside footer form button menu dialog fieldset label".split())
SIDE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline cookie cookies comment comments consent "
                 "copyright disclaimer disqus footer form gdpr hidden login masthead menu modal nav navbar navigation newsletter notice "
                 "overlay pager pagination paywall popup promo promoted promotion recommended related reply replies respond search share "
                 "sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split())
MAIN_TAGS = {"article", "main"}
#: Parts of a class name that say something about the layout of a container, not what it holds.
LAYOUT_WORDS = set("no not has with without is layout wrapper page theme template enabled disabled".split())
MAIN_WORDS = set("article articlebody content entry main maincontent post story".split())


@dataclass
class Block:
    text: str
    linked: int   # characters inside links
    heading: int  # 1 in h1 to h6
    main: int     # 1 inside a container that calls itself the main text
    side: int     # 1 inside a container that calls itself something else

    @property
    def words(self) -> int:
        return len(self.text.split())

    @property
    def density(self) -> float:
        return self.linked / max(1, len(self.text))


_HEADINGS = {f"h{k}" for k in range(1, 7)}
#: Tags that say what kind of text a block is: the innermost one decides whether it is a heading.
_KINDS = set("p li blockquote pre td th dd dt figcaption summary".split()) | _HEADINGS


def tags(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before it, tag in lower case or "", whether it ends, attributes); the last has no tag.

    Each character is looked at a bounded number of times: a quote or an element that is never closed is searched for once.
    """
    at, begin, size, quotes = 0, 0, len(page), {'"': True, "'": True}
    while (open_ := page.find("<", at)) >= 0:
        if page.startswith("<!--", open_):
            end = page.find("-->", open_ + 4)
            yield page[begin:open_], "", False, ""
            at = begin = size if end < 0 else end + 3
            continue
        name = _NAME.match(page, open_ + 1)
        if name is None:
            if page[open_ + 1:open_ + 2] in ("!", "?", "/"):
                end = page.find(">", open_)
                yield page[begin:open_], "", False, ""
                at = begin = size if end < 0 else end + 1
            else:
                at = open_ + 1  # a plain sign
            continue
        end = name.end()
        while stop := _STOP.search(page, end):
            end = stop.end()
            if stop[0] in "<>":
                break
            if quotes[stop[0]]:
                closing = page.find(stop[0], end)
                quotes[stop[0]] = closing >= 0
                end = end if closing < 0 else closing + 1
        tag = name[2].lower()
        if stop is None:  # never closed: no tag
            at = name.end()
            continue
        after = end - 1 if stop[0] == "<" else end
        yield page[begin:open_], tag, bool(name[1]), page[name.end():end - 1]
        if tag in _DROPPED and not name[1]:
            close = _DROPPED[tag].search(page, after)
            after = size if close is None else close.end()
        at = begin = after
    yield page[begin:], "", False, ""


def _says(attributes: str) -> tuple[bool, bool, bool]:
    """Whether a container calls itself main text, something else, or is hidden."""
    main = side = off = False
    for a in _ATTRIBUTE.finditer(attributes):
        value, name = (a[2] or a[3] or a[4] or "").lower(), a[1].lower()
        off |= name == "hidden" or name == "style" and "display:none" in value.replace(" ", "")
        if name in ("hidden", "style"):
            continue
        for token in value.split():
            words = set(_WORD.findall(token))
            if words & LAYOUT_WORDS:
                continue
            aside = bool(words & SIDE_WORDS)  # in one name, as comment-content, the other word only says where
            side |= aside
            main |= not aside and bool(words & MAIN_WORDS)
    return main, side, off


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = []  # tag, main so far, side so far (2: by its tag, for good), in a heading
    depth: dict[str, int] = {}                    # open tags by name
    parts: list[str] = []
    links = linked = 0
    seen = False                                  # whether main text has begun

    def flush() -> None:
        nonlocal linked, seen
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            _, main, side, heading = stack[-1] if stack else ("", 0, 0, False)
            seen |= bool(main and not side)
            out.append(Block(text, min(linked, len(text)), int(heading), main, int(side > 0)))
        linked = 0

    def pop() -> str:
        tag = stack.pop()[0]
        depth[tag] -= 1
        return tag

    for raw, tag, ends, attributes in tags(page):
        if raw:
            plain = html.unescape(raw)
            parts.append(plain)
            if links:
                linked += len(_SPACE.sub(" ", plain))
        if tag == "a":
            links = 0 if ends else 1
        elif tag == "br":
            parts.append(" ")
        elif tag == "hr" or tag in ("head", "textarea", "select", "iframe", "object"):
            flush()
        elif tag in BLOCK:
            flush()
            if ends:
                links = 0
                if depth.get(tag):
                    while pop() != tag:
                        pass
                continue
            if stack and (stack[-1][0] == "p" or stack[-1][0] in SIBLINGS.get(tag, ())):
                pop()
            main, side, heading = stack[-1][1:] if stack else (0, 0, False)
            if tag in MAIN_TAGS:
                main, side = 1, side if side == 2 or seen else 0  # a wrapper's name says nothing of the article in it
            elif tag not in ("html", "body"):
                calls_main, calls_side, off = _says(attributes)
                if tag in SIDE_TAGS or off or tag == "header" and not main:
                    side = 2
                elif calls_main:
                    main, side = 1, 0 if side == 1 and not seen and not calls_side else side
                elif calls_side:
                    side = max(side, 1)
            if not attributes.rstrip().endswith("/"):
                stack.append((tag, main, side, tag in _HEADINGS if tag in _KINDS else heading))
                depth[tag] = depth.get(tag, 0) + 1
    flush()
    return out


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "heading", "main", "side", "outside")


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES a block; where there is no neighbour, a block without words or links."""
    words, density = [0, *(b.words for b in found), 0], [0.0, *(b.density for b in found), 0.0]
    marked = any(b.main and not b.side for b in found)
    return np.array([[words[i], density[i], words[i - 1], density[i - 1], words[i + 1], density[i + 1],
                      b.heading, b.main, b.side, int(marked and not b.main)] for i, b in enumerate(found, 1)], dtype=np.float64).reshape(-1, len(FEATURES))


#: Labelled blocks: the FEATURES, then 1 for main text. Written by hand after common page layouts.
LABELLED = [
    # an article in its container: headings, long and short paragraphs, lists, quotations, lists of links
    (8, 0, 6, 0, 40, 0, 1, 1, 0, 0, 1), (45, 0, 8, 0, 60, 0, 0, 1, 0, 0, 1), (120, 0, 45, 0, 3, 0, 0, 1, 0, 0, 1), (1, 0, 120, 0, 80, 0, 0, 1, 0, 0, 1),
    (2, 0, 1, 0, 2, 0, 0, 1, 0, 0, 1), (60, .1, 20, 0, 12, .9, 0, 1, 0, 0, 1), (30, .35, 60, .1, 50, 0, 0, 1, 0, 0, 1), (4, 0, 30, 0, 5, 1, 0, 1, 0, 0, 1),
    (200, 0, 0, 0, 0, 0, 0, 1, 0, 0, 1), (25, 0, 90, 0, 6, .8, 0, 1, 0, 0, 1), (3, 0, 2, 0, 40, 0, 0, 1, 0, 0, 1), (9, .7, 80, 0, 50, 0, 0, 1, 0, 0, 1),
    (6, 1, 50, 0, 40, 0, 0, 1, 0, 0, 1), (5, 0, 3, 1, 40, 0, 1, 1, 0, 0, 1), (1, 0, 6, 1, 200, 0, 0, 1, 0, 0, 1), (2, 1, 70, 0, 30, 0, 0, 1, 0, 0, 1),
    # menus, headers, footers, sidebars, notices, adverts, forms and comments that say so, inside the article or out of it
    (1, 1, 0, 0, 1, 1, 0, 0, 1, 0, 0), (2, 1, 1, 1, 1, 1, 0, 0, 1, 0, 0), (1, 1, 2, 1, 9, 0, 0, 0, 1, 0, 0), (7, 0, 1, 1, 8, 0, 0, 0, 1, 0, 0),
    (30, 0, 2, 1, 8, 0, 0, 0, 1, 0, 0), (12, .2, 60, 0, 0, 0, 0, 0, 1, 0, 0), (40, 0, 100, 0, 30, 0, 0, 0, 1, 0, 0), (90, 0, 30, 0, 40, 0, 0, 0, 1, 0, 0),
    (60, 0, 80, 0, 70, 0, 0, 1, 1, 0, 0), (5, .9, 80, 0, 20, 0, 0, 1, 1, 0, 0), (15, 0, 40, 0, 60, 0, 0, 1, 1, 0, 0), (3, 0, 12, 0, 4, 0, 1, 1, 1, 0, 0),
    (4, 0, 60, 0, 20, 0, 1, 0, 1, 0, 0), (150, .05, 4, 0, 60, 0, 0, 0, 1, 0, 0), (2, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0), (1, 0, 1, 1, 40, 0, 0, 1, 1, 0, 0),
    # pages without any container that says what it is: prose by its length and its neighbours, the rest not
    (50, 0, 8, 0, 70, 0, 0, 0, 0, 0, 1), (90, .05, 50, 0, 40, 0, 0, 0, 0, 0, 1), (14, 0, 90, 0, 60, 0, 0, 0, 0, 0, 1), (3, 0, 60, 0, 80, 0, 0, 0, 0, 0, 1),
    (7, 0, 1, 1, 50, 0, 1, 0, 0, 0, 1), (20, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1), (12, 0, 40, 0, 3, 1, 0, 0, 0, 0, 1), (80, 0, 0, 0, 70, 0, 0, 0, 0, 0, 1),
    (40, 0, 80, 0, 30, .1, 0, 0, 0, 0, 1), (5, 0, 20, 0, 50, 0, 1, 0, 0, 0, 1), (2, 0, 14, 0, 16, 0, 0, 0, 0, 0, 1), (9, 0, 2, 0, 4, 0, 0, 0, 0, 0, 1),
    (2, 1, 1, 1, 3, 1, 0, 0, 0, 0, 0), (1, 1, 0, 0, 2, 1, 0, 0, 0, 0, 0), (6, .8, 50, 0, 5, .9, 0, 0, 0, 0, 0), (3, 1, 40, 0, 0, 0, 0, 0, 0, 0, 0),
    (8, .9, 3, 1, 60, 0, 0, 0, 0, 0, 0), (20, .75, 60, 0, 12, .8, 0, 0, 0, 0, 0), (4, 0, 3, 1, 2, 1, 0, 0, 0, 0, 0), (3, 0, 60, 0, 0, 0, 0, 0, 0, 0, 0),
    (5, 0, 0, 0, 3, 1, 0, 0, 0, 0, 0), (6, .2, 50, 0, 0, 0, 0, 0, 0, 0, 0), (2, 0, 2, 1, 30, 0, 0, 0, 0, 0, 0), (35, .6, 2, 1, 4, 1, 0, 0, 0, 0, 0),
    # prose beside a container that calls itself the main text
    (40, 0, 60, 0, 30, 0, 0, 0, 0, 1, 0), (6, 0, 80, 0, 20, .1, 1, 0, 0, 1, 0), (15, .2, 120, 0, 2, 1, 0, 0, 0, 1, 0),
    (90, 0, 6, 0, 8, .5, 0, 0, 0, 1, 0), (3, 0, 2, 1, 60, 0, 0, 0, 0, 1, 0), (20, 0, 0, 0, 70, 0, 0, 0, 0, 1, 0),
    # pages of plain containers: short blocks between long ones are text, the same between links or other short ones are not
    (3, 0, 60, 0, 90, 0, 0, 0, 0, 0, 1), (3, 0, 1, 1, 2, 1, 0, 0, 0, 0, 0), (4, 0, 45, 0, 70, 0, 0, 0, 0, 0, 1), (4, 0, 2, .9, 3, 1, 0, 0, 0, 0, 0),
    (8, 0, 100, 0, 55, 0, 0, 0, 0, 0, 1), (8, 0, 3, 1, 5, .8, 0, 0, 0, 0, 0), (10, 0, 80, 0, 120, 0, 0, 0, 0, 0, 1), (10, 0, 4, 1, 6, 1, 0, 0, 0, 0, 0),
    (6, 0, 70, 0, 9, 0, 0, 0, 0, 0, 1), (6, 0, 5, .9, 4, 0, 0, 0, 0, 0, 0), (12, 0, 60, 0, 25, 0, 0, 0, 0, 0, 1), (12, 0, 2, 1, 3, .7, 0, 0, 0, 0, 0),
    (9, 0, 30, 0, 40, 0, 0, 0, 0, 0, 1), (9, 0, 1, 1, 1, 1, 0, 0, 0, 0, 0), (5, .1, 55, 0, 65, .1, 0, 0, 0, 0, 1), (5, .1, 3, .9, 2, .9, 0, 0, 0, 0, 0),
    (7, 0, 1, 1, 80, 0, 1, 0, 0, 0, 1), (7, 0, 2, 1, 3, 1, 1, 0, 0, 0, 0), (14, 0, 4, 1, 6, .5, 0, 0, 0, 0, 0), (16, 0, 90, .05, 60, 0, 0, 0, 0, 0, 1),
    (25, 0, 60, 0, 50, 0, 0, 0, 0, 0, 1), (22, 0, 2, 1, 3, 1, 0, 0, 0, 0, 0), (3, 0, 90, 0, 2, 1, 0, 0, 0, 0, 0), (11, .05, 70, 0, 3, 1, 0, 0, 0, 0, 0),
]


def grow(rows: np.ndarray, depth: int = 8) -> tuple:
    """A tree of least Gini impurity: (feature, bound, tree at most the bound, tree above it), or (share of main text,)."""
    y = rows[:, -1]
    if depth == 0 or y.min() == y.max():
        return (float(y.mean()),)
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for bound in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= bound
            cost = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[low], y[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(bound))
    if best is None:
        return (float(y.mean()),)
    low = rows[:, best[1]] <= best[2]
    return (best[1], best[2], grow(rows[low], depth - 1), grow(rows[~low], depth - 1))


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    """True for rows of main text."""
    if len(tree) == 1:
        return np.full(len(x), tree[0] >= 0.5)
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x), dtype=bool)
    out[low], out[~low] = classify(tree[2], x[low]), classify(tree[3], x[~low])
    return out


def main_text(page: str | None, tree: tuple) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, classify(tree, features(found))) if keep)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", labelled=LABELLED) -> DataFrame:
    """`pages` without the html, with its main text in `text_col`."""
    tree = grow(np.array(labelled, dtype=np.float64))
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html_col, text_col)]
    given = pages.select(*kept, F.col(f"`{html_col}`").alias("_hx_in"))
    out = given.drop("_hx_in").schema.add(text_col, "string")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in by_bytes(part, part.num_columns - 1):
                texts = [main_text(x.as_py(), tree) for x in some.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(texts, type=pa.string())],
                                                 names=[*part.schema.names[:-1], text_col])

    return map_arrow(given, run, out)


def digest(pages: DataFrame) -> DataFrame:
    """Contract columns of op8 over pages."""
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
