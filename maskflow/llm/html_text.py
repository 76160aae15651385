"""Main text of web pages by the line-block distribution.

Markup is stripped into lines, one per block of the page. The lengths of the lines
are summed over a sliding window; where the sum surges above the threshold of the
page a block of main text begins, where it dives to nothing it ends, and the lines
between are kept. Before that, parts that the markup itself names as something else
are taken out (navigation, headers and footers of the page, asides, forms, scripts,
notices, adverts, comments of readers). Lines of an article or main element weigh more
and are windows of their own, so the story beside a teaser is found by its weight.

Defined cases: null and empty pages have empty text. Markup that is cut off, nested
wrongly or left open is read as browsers do: a part that is never closed ends with the
element around it. Pages without any block keep their plain text as one line. Text is
whole: no line between a surge and a dive is dropped for being short, and lines that lead
to a surge belong to it. Outside an article slight lines (short, no end of a sentence) are
a dive where two or more of them end a block, and only one leads to it. Short lines of rights
behind the last surge go. Time grows with the page's length, also where nothing is closed. Repeated rows
each give a row; other columns are kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.llm.tables import lean_batches

#: Lines that one sum of the distribution covers.
WINDOW = 3
#: A block of main text starts where the sum is at least this share of the largest.
SURGE = 0.15
#: The share is of no less and no more than so many characters, so that neither pages
#: of short lines nor the lines beside a very long one are lost.
SURGE_CHARS, SURGE_MOST = 120, 300
#: A line in an article weighs as much as so many of its length outside.
ARTICLE = 4
#: A line of rights is no longer than this.
LEGAL_CHARS = 160

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only behind an equals sign.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

# Elements of the public HTML standard, by their part in a page.
#: Content of these is not text of the page.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "title", "textarea", "noframes", "audio", "video", "xmp"}
#: These and what is in them are never main text.
APART = {"nav", "aside", "form", "dialog", "menu", "head", "button", "select", "fieldset", "search"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: An open paragraph ends where one of these starts.
_ENDS_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
#: Words in a class, id or role that name a part as something else than the article.
_OTHER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promos?|promoted|promotions?|nav|nav-?bar|navigation|menus?|menu-?bar|breadcrumbs?|side-?bars?|footer|"
    r"site-?header|page-?header|masthead|cookies?|consent|notice|notification|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|"
    r"share|sharing|social|related|recommend\w*|comments?|comment-?\w*|disqus\w*|respond|replies|reply|discussion|complementary|contentinfo|search|skip-?link|copyright|gdpr|paywall|toolbar|widget\w*|pagination|pager)(?:$|[\s_-])",
    re.I,
)
#: An article that is a comment or a teaser of another one.
_LESSER = re.compile(r"(?:^|[\s_-])(?:comments?|reply|replies|related|teaser|recommend\w*)(?:$|[\s_-])", re.I)
_PAGE_HEADER = re.compile(r"(?:^|\s)(?:header|top-?bar)(?:$|\s)", re.I)
#: Layout names that tell what a part has beside it, not what it is.
_BESIDE = re.compile(r"(?<![^\s])(?:with|has|no|without|is|js)[-_]\S+", re.I)
#: A line of rights, as pages have at their foot.
_LEGAL = re.compile(
    r"(?:copyright\s*)?(?:©|\(c\)\s*(?:copyright\s*)?\d{4})|copyright\s+\d{4}|copyright\b(?![^.!?]*[.!?]$)|all rights reserved", re.I
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(raw: str) -> dict[str, str]:
    return {
        name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(raw)
    }


#: Names of readers' comments and adverts; a part so named is the story only where there is nothing else.
_COMMENTS = re.compile(r"comment|repl(?:y|ies)|disqus|respond|discussion|ads?\b|advert|adsense|sponsor", re.I)
#: A part that its name puts aside is read after all where the rest of the page has less than
#: this share of its text; of comments where the rest has fewer characters than this.
REST, REST_CHARS = 0.1, 60
#: Shorter lines without an end of a sentence are slight: outside an article two of them
#: behind a story end it, and no more than one leads to it.
SLIGHT_CHARS = 40


def _is_apart(name: str, attributes: dict[str, str], inside_article: bool) -> bool | str:
    """Whether a part is something else than the story; its names where only these say so."""
    if name in APART or (name in {"header", "footer"} and not (name == "header" and inside_article)):
        return True
    if name in {"html", "body", "main"}:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    named = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    # Camel case and joined words are read as words.
    named = _BESIDE.sub(" ", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", named))
    other = _LESSER if name == "article" else _OTHER
    found = other.search(named) or name != "article" and not inside_article and _PAGE_HEADER.search(named)
    return found[0] if found else False


def lines(page: str) -> list[tuple[str, int, int, bool]]:
    """The page's lines in order: text, the number of its article (0: none), the length of link text, and whether it is an h1.

    A part that only its names put aside stays where it has nearly all of the page's text.
    """
    stays: set[int] = set()
    while True:
        aside: dict[int, list] = {}
        found = list(_lines(page, stays, aside))
        rest = sum(len(text) for text, *_ in found)
        whole = rest + sum(size for size, _, _ in aside.values())
        # Beside an article nothing else is the story; inside it a part may be.
        story = any(article for _, article, _, _ in found)
        more = {
            place for place, (size, named, inside) in aside.items()
            if size > REST_CHARS and (inside or not story) and (whole - size < REST_CHARS or not _COMMENTS.search(named) and whole - size < REST * size)
        }
        if not more:
            return found
        stays |= more


def _lines(page: str, stays: set[int], aside: dict[int, list]) -> Iterator[tuple[str, int, int, bool]]:
    """Lines outside of the parts put aside; ``aside`` gets the size of those put aside by name, by place."""
    stack: list[tuple[str, bool, bool]] = []  # name, apart, article
    open_: Counter = Counter()
    parts: list[str] = []
    blank = True
    named_at = -1  # the part put aside by name that is being read, if nothing else puts it aside
    link, article, line_article, title = 0, 0, 0, False
    apart = count = 0
    at, end = 0, len(page)

    def close(to: int) -> None:
        nonlocal apart, article, named_at
        while len(stack) > to:
            name, was_apart, was_article = stack.pop()
            open_[name] -= 1
            apart -= was_apart
            article -= was_article
        if not apart:
            named_at = -1

    def line():
        nonlocal link, blank
        text = " ".join("".join(parts).split())
        out = (text, line_article, link, title)
        parts.clear()
        link, blank = 0, True
        return out if text else None

    while at < end:
        tag = _MARKUP.search(page, at)
        if tag is None:
            stop = end
        else:
            stop = tag.start()
        if stop > at and apart == 1 and named_at >= 0:
            aside[named_at][0] += len(page[at:stop].strip())
        if stop > at and not apart:
            text = html.unescape(page[at:stop])
            if blank:
                line_article = count if article else 0
                title = open_["h1"] > 0
                blank = not text.strip()
            parts.append(text)
            if open_["a"]:
                link += len(text.strip())
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if page.startswith("<![CDATA[", stop) and not apart:
                parts.append(page[stop + 9 : at - 3 if page.endswith("]]>", stop, at) else at])
            continue
        if name not in INLINE and name not in RAW:
            if name == "br":
                parts.append(" ")
            elif (found := line()) is not None:
                yield found
        if tag[1]:
            if not open_[name]:
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                # An inline element is not closed over the border of a block.
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if name in RAW:
            shut = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if name in {"svg", "math"} and tag[3].rstrip().endswith("/"):
                continue
            at = shut.end() if shut else end
            continue
        if name in VOID or tag[3].rstrip().endswith("/") and name not in {"p", "div"}:
            continue
        _open_scopes(name, stack, open_, close)
        inside = article > 0
        is_article = name in {"article", "main"}
        named = _is_apart(name, _attributes(tag[3]), inside)
        is_apart = bool(named) and stop not in stays
        if is_apart and isinstance(named, str) and not apart:
            named_at = stop
            aside[stop] = [0, named, inside]
        open_[name] += 1
        stack.append((name, is_apart, is_article))
        apart += is_apart
        count += is_article and not inside
        article += is_article
    if (found := line()) is not None:
        yield found


def _open_scopes(name: str, stack: list[tuple[str, bool, bool]], open_: Counter, close) -> None:
    """Closes what the start of an element ends: paragraphs, list items, cells."""
    if name in _ENDS_P and open_["p"]:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == "p":
                close(k)
                return
            if stack[k][0] not in INLINE:
                break
    ended = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
    own = ended.get(name)
    if own and any(open_[k] for k in own):
        scope = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot"} - ({"tr"} if name == "tr" else set())
        lowest = None
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in own:
                lowest = k
            elif stack[k][0] in scope or (name in {"td", "th"} and stack[k][0] == "tr"):
                break
        if lowest is not None:
            close(lowest)


def between_surges(
    sizes: list[int], threshold: float, titles: list[bool] | None = None, slight: list[bool] | None = None
) -> list[bool]:
    """Which lines lie between a surge and the dive after it.

    A surge begins with the lines before it that have some weight, and at the title of
    the page if that is among them. With ``slight`` lines no more than one of these
    leads to a surge, and where only such lines are left, two or more, the text has dived.
    """
    n = len(sizes)
    sums = [sum(sizes[k : k + WINDOW]) for k in range(n + 1)]
    keep, inside = [False] * n, False
    for k in range(n):
        if not inside and sizes[k] and sums[k] >= threshold:
            inside = True
            before, led = k - 1, 0
            while before >= 0 and sizes[before] and not keep[before] and not (titles and titles[before + 1]):
                led += bool(slight and slight[before] and not (titles and titles[before]))
                if led > 1:
                    break
                keep[before] = True
                before -= 1
        elif inside and not sizes[k] and not sums[k]:
            inside = False
        keep[k] = inside
    if slight:
        for block in (list(b) for kept, b in groupby(range(n), key=lambda k: keep[k]) if kept):
            last = len(block)
            while last and (slight[block[last - 1]] or not sizes[block[last - 1]]):
                last -= 1
            if last and sum(slight[k] for k in block[last:]) > 1:
                for k in block[last:]:
                    keep[k] = False
    return keep


def _threshold(sizes: list[int]) -> float:
    """The sum at which a block begins; one long line does not lift it."""
    most = max((sum(sizes[k : k + WINDOW]) for k in range(len(sizes))), default=0)
    usual = median([s for s in sizes if s] or [0]) * WINDOW / 2
    return min(max(SURGE_CHARS, min(SURGE * most, usual, SURGE_MOST)), most)


def _legal_tail(texts: list[str], sizes: list[int], threshold: float) -> set[int]:
    """The short lines of rights behind the last window that has the weight of a surge."""
    tail: set[int] = set()
    weights = list(sizes)
    for k in range(len(texts) - 1, -1, -1):
        if sum(weights[k + 1 : k + 1 + WINDOW]) >= threshold:
            break
        if len(texts[k]) <= LEGAL_CHARS and _LEGAL.match(texts[k]):
            weights[k] = 0
            tail.add(k)
    return tail


def main_text(page: str | None) -> str:
    """The main text of one page: its lines joined by single spaces."""
    found = list(lines(page or ""))
    # Lines that are links for the most part weigh nothing, like menus without a name,
    # but in an article they are text.
    weights = [
        len(text) * (1 if link * 2 > len(text) else ARTICLE) if article else 0 if link * 2 > len(text) else len(text)
        for text, article, link, _ in found
    ]
    # No window reaches over the border of an article; what is around one is read on.
    parts: dict[int, list[int]] = {}
    for k, (_, article, _, _) in enumerate(found):
        parts.setdefault(article, []).append(k)
    blocks: list[tuple[bool, int, list[int]]] = []  # in an article, weight, lines
    for article, own in parts.items():
        sizes, titles = [weights[k] for k in own], [found[k][3] for k in own]
        threshold, tail = _threshold(sizes), set()
        if not article:
            tail = _legal_tail([found[k][0] for k in own], sizes, threshold)
            sizes = [0 if k in tail else s for k, s in enumerate(sizes)]
        slight = None if article else [
            len(found[k][0]) < SLIGHT_CHARS and found[k][0][-1] not in ".!?…\"'”’»)" and not found[k][3] for k in own
        ]
        surged = between_surges(sizes, threshold, titles, slight)
        kept = [k not in tail and inside for k, inside in enumerate(surged)]
        for inside, block in groupby(range(len(own)), key=lambda k: kept[k]):
            if inside:
                block = list(block)
                blocks.append((bool(article), sum(sizes[k] for k in block), [own[k] for k in block]))
    if not blocks:
        return ""
    # The heaviest block says whether the story is in an article; of the other kind only
    # blocks stay that weigh half as much.
    main, most, _ = max(blocks, key=lambda b: b[1])
    stay = [k for article, weight, own in blocks if article == main or 2 * weight >= most for k in own]
    return " ".join(found[k][0] for k in sorted(stay))


def _extract(batches):
    for batch in batches:
        texts = [main_text(page) for page in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], batch.schema.names)


def extract(
    spark: SparkSession, pages: DataFrame, html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """``pages`` with the markup replaced by ``text_col``, the main text."""
    lean_batches(spark)
    rest = [c for c in pages.columns if c != html_col]
    plain = pages.select(
        *(F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(rest)),
        F.col(f"`{html_col}`").cast("string").alias("_html"),
    )
    done = plain.mapInArrow(_extract, T.StructType([*plain.schema.fields[:-1], T.StructField("_html", T.StringType())]))
    return done.select(*(F.col(f"_{k}").alias(c) for k, c in enumerate(rest)), F.col("_html").alias(text_col))
