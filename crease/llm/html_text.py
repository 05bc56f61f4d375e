"""Main text of web pages by the line-block distribution.

Markup is stripped and each block of the page becomes a line. Parts that are no article by
their tag, class or id (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
comments) are left out. The lengths of the lines are summed over sliding windows; where a page
has an ``article`` or ``main``, a line outside has a tenth of its length. A stretch of text lies
between dives of the sums to 0, and is kept if the sums surge in it: if they come to a quarter of
the highest of the page, or it to a quarter of the longest. A part that is left out is a dive only
if the container changes with it, as an advert between the paragraphs of an article does not; the
edge of an article is one always.
"""

from __future__ import annotations

import html
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a window.
WINDOW = 3
#: A stretch surges at this share of the highest window sum, or of the length of the longest stretch. Others go, unless
#: they lie in the container that holds all of the longest.
LEAST_SHARE = 0.25
#: What the length of a line outside counts for where there is an article.
OUTSIDE = 0.1
#: Lines and stretches with more link text than this share are menus, outside an article.
MOST_LINKS = 0.6

#: Elements whose content is never text of the article.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video nav header footer aside "
    "form button select textarea input label fieldset dialog menu".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stay inside a line.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)
#: Elements that lie in a container but are none.
BLOCKS = frozenset(
    "address blockquote body caption center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup html li ol option "
    "p pre summary table tbody td tfoot th thead tr ul".split()
)
#: The elements whose start ends an open one that has no end tag.
ENDS = {
    "p": frozenset(
        "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hgroup main menu nav ol p pre section table ul".split()
    ),
    "li": {"li"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
}
#: Words in class, id or role that mark parts that are no article; "has-", "with-" and "no-" before
#: them tell of the layout around an article.
NAMES = re.compile(
    r"(?<![a-z])(?<!has-)(?<!with-)(?<!no-)(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|rail|widget|footer|header|masthead|topbar|toolbar|share|sharing|social|"
    r"related|recommend\w*|newsletter|subscribe|signup|login|search|comments?|disqus|replies|reader-comments|pagination|pager|"
    r"complementary|contentinfo|skip-link)(?![a-z])"
)
#: The containers of a line, from the outermost to the innermost, by their places in the page.
Path = tuple[int, ...]
#: A line without text.
EMPTY: tuple[str, int, bool, Path] = ("", 0, False, ())
_RAW = re.compile(r"<(script|style|noscript|template|textarea|title|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>", re.S)
_TAG = re.compile(r"""<(/?)([a-zA-Z][\w:-]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|</?[a-zA-Z][^>]*>""")
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_CLASSED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Classes of an article that tell of its subject or layout, not of what it is.
_TOPIC = re.compile(r"(?:category|tag|topic|section|format|type|status|post)-|.*-(?:left|right|top|bottom|none|open|closed|enabled|disabled|on|off)$")
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?![\w-])", re.I)
_UNSEEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


def _is_side(name: str, attributes: str, named: bool) -> bool:
    """Whether an element is no article, by tag, class or id; those of articles themselves count if ``named``."""
    if name in DROPPED:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    if name == "article":
        words = " ".join(a or b or c for a, b, c in _CLASSED.findall(attributes)).lower().split() if named else []
        found = [(w, m) for w in words if not _TOPIC.match(w) for m in NAMES.finditer(w)]
        return any(m.start() == 0 or m.end() == len(w) for w, m in found)
    if _UNSEEN.search(attributes) or _HIDDEN.search(_QUOTED.sub("=''", attributes)):
        return True
    return any(NAMES.search((a or b or c).lower()) for a, b, c in _NAMED.findall(attributes))


def _together(one: Path, other: Path) -> bool:
    """Whether the containers are the same, or one is inside the other; all are inside the body, which does not count."""
    least = min(len(one), len(other))
    return one == other or least > 0 and one[:least] == other[:least]


def lines_of(page: str, named: bool = True) -> list[tuple[str, int, bool, Path]]:
    """Lines of a page: text, characters of links in it, whether it is inside an article, its containers."""
    page = _COMMENT.sub("", _RAW.sub("\n", page))
    lines: list[tuple[str, int, bool, Path]] = []
    parts: list[str] = []
    links = 0
    open_: list[tuple[str, bool, bool, Path]] = []  # name, side part, in an article, containers
    side = inside = linked = cut = False
    path: Path = ()

    def close() -> None:
        nonlocal links, cut
        if text := " ".join(html.unescape("".join(parts)).split()):
            if lines and (inside != lines[-1][2] or cut and not _together(lines[-1][3], path)):
                lines.extend([EMPTY] * WINDOW)
            cut = False
            lines.append((text, links, inside, path))
        parts.clear()
        links = 0

    at = 0
    for m in _TAG.finditer(page):
        if not side and m.start() > at:
            parts.append(piece := page[at : m.start()])
            links += len(piece) if linked else 0
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name not in INLINE and not side:
            close()
        if m[1]:
            if name == "a":
                linked = False
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    side, inside, path = open_[-1][1:] if open_ else (False, False, ())
                    break
        elif name not in VOID and not m[3].endswith("/"):
            if name == "a":
                linked = True
                continue
            top = len(open_) - 1
            while top >= 0 and (open_[top][0] in INLINE or name in ENDS.get(open_[top][0], ())):
                if open_[top][0] not in INLINE:  # its end tag is left out
                    del open_[top:]
                    side, inside, path = open_[-1][1:] if open_ else (False, False, ())
                top -= 1
            if not side and _is_side(name, m[3], named):
                close()
                side = cut = True
            elif not side and name in ("article", "main"):
                inside, path = True, (*path, m.start())
            elif not side and not inside and name not in INLINE and name not in BLOCKS:
                path = (*path, m.start())
            if name not in INLINE or side:
                open_.append((name, side, inside, path))
    if not side:
        parts.append(page[at:] if "<" not in page[at:] else page[at : at + page[at:].rindex("<")])
        close()
    return lines


def main_text(page: str | None) -> str:
    """Text of the article; empty if the page is null, empty or without text."""
    if not page:
        return ""
    # Where all text is in articles with such names, the names tell nothing.
    lines = lines_of(page) or lines_of(page, named=False)
    lines = [EMPTY if not line[2] and line[1] > MOST_LINKS * len(line[0]) else line for line in lines]
    outside = OUTSIDE if any(line[2] for line in lines) else 1
    lengths = [len(line[0]) * (1 if line[2] else outside) for line in lines]
    ends = [sum(lengths[i : i + WINDOW]) for i in range(len(lines))]
    stretches: list[list[int]] = []
    begin = None
    for i, total in enumerate([*ends, 0]):
        if total and begin is None:  # a surge
            begin = i
        elif not total and begin is not None:  # a dive
            stretches.append([j for j in range(begin, min(i + WINDOW - 1, len(lines))) if lengths[j]])
            begin = None
    if not stretches:
        return ""
    size = [sum(lengths[j] for j in s) for s in stretches]
    peak = [max(sum(lengths[j : j + WINDOW]) for j in s) for s in stretches]
    holds = os.path.commonprefix([lines[j][3] for j in stretches[size.index(max(size))]])
    kept = []
    for stretch, n, high in zip(stretches, size, peak):
        surge = high >= LEAST_SHARE * max(peak) or n >= LEAST_SHARE * max(size)
        near = holds and all(lines[j][3][: len(holds)] == holds for j in stretch)
        menu = not lines[stretch[0]][2] and sum(lines[j][1] for j in stretch) > MOST_LINKS * sum(len(lines[j][0]) for j in stretch)
        if (surge or near) and not menu:
            kept += [lines[j][0] for j in stretch]
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars. Rows are independent: no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [main_text(page) for page in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"].array, "url": batch["url"].array, "text": text, "n_chars": list(map(len, text))}
            )

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).mapInPandas(
        run, f"page_id {kinds['page_id']}, url string, text string, n_chars long"
    )
