"""Main text of web pages by structure and nearest-URL page differencing.

A page is cut into lines (the text of its blocks). Lines in menus, headers, footers,
asides, forms and the like are out. Within each host, pages stand in the order of
their paths, and each is aligned with its two nearest by a longest common
subsequence of lines: what it shares with them is the site's template and is
deleted. Lines inside an explicit article element stay even if shared, because two
pages of a host may carry the same article; so does a page whose lines are all
shared, because it is a copy and not a template.

Neighbours are found by a range partitioning over host and path, so that a host of
any size is spread over many tasks; only the first and last page of each partition
meet in a second step.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.session import write_and_read

NAME = "op2_main_text"
SQL = None

#: elements whose content is not markup; all but none of it is text of the page
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "xmp", "noframes"}
#: elements that never belong to the main text
OUT = {
    "head", "nav", "footer", "aside", "form", "noscript", "template", "svg", "math", "button", "select", "datalist",
    "dialog", "menu", "object", "canvas", "audio", "video", "map",
}
#: elements that stand between the words of a line; every other element begins and ends a line
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "input", "ins", "kbd", "label", "mark", "meter", "output", "progress", "q", "rp", "rt", "ruby", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "picture", "source", "track", "embed",
    "area", "param",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar", "tooltip", "status",
}

#: words that begin or end the class or id of a part left out
NAMES = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer sidebar ad ads advert adverts"
    " advertisement advertisements advertising banner promo promotion promotions sponsor sponsored cookie cookies consent"
    " gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login"
    " share sharing social related recommended comment comments commentlist replies disqus respond widget widgets search"
    " pagination pager toolbar copyright form forms".split()
)
#: a header of these is the page's and not the article's
_PAGE = {"site", "page", "main", "top", "global"}
#: names with these words tell what a wrapper has beside its content
_BESIDE = {"with", "has", "no", "without"}


def _named_out(name: str) -> bool:
    words = [w for w in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", name) if w]
    words = [w.lower() for w in words if not w.isdigit()]
    if not words or _BESIDE & set(words):
        return False
    if "header" in words:
        return words[0] == "header" or words[0] in _PAGE and words[1:] == ["header"]
    return words[0] in NAMES or words[-1] in NAMES


_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>"""
    r"""|<([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ITEMS = {"li", "dt", "dd", "tr", "td", "th", "option"}
_ARTICLE_ROLE = re.compile(r"""role\s*=\s*["']?article""", re.I)
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _is_out(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in OUT or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    if tag in ("html", "body", "main"):
        return False
    return any(map(_named_out, f"{found.get('class', '')} {found.get('id', '')}".split()))


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """Lines of a page in order, each with its kind: 0 out, 1 open to question, 2 in an article, 3 in the main element.

    References are decoded, white space is one space, empty lines are left out.
    """
    lines: list[tuple[str, int]] = []
    words: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements that are not inline, and the kind outside each
    kind, at, muted = 1, 0, 0  # muted: inline elements open from the outermost that is out
    page = page or ""
    lowered = None

    def end_line() -> None:
        if words:
            line = " ".join(html.unescape("".join(words)).split())
            if line:
                lines.append((line, kind))
            words.clear()

    while True:
        m = _TOKEN.search(page, at)
        if not muted:
            words.append(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = m[1] or m[4]
        if name:
            tag, attributes = name.lower(), (m[2] if m[1] else m[5]) or ""
            closed = attributes.endswith("/") or tag in VOID
            if tag in RAW:
                if lowered is None:
                    lowered = page.translate(_ASCII_LOWER)
                end = lowered.find(f"</{tag}", at)
                at = len(page) if end < 0 else end
            elif tag in INLINE:
                if tag == "br" and not muted:
                    words.append(" ")
                elif not closed and (muted or "=" in attributes or "hidden" in attributes):
                    muted += bool(muted) or _is_out(tag, attributes, True)
            else:
                end_line()
                muted = 0
                while stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in _ITEMS):
                    kind = stack.pop()[1]
                if closed:
                    continue
                stack.append((tag, kind))
                if kind:
                    if _is_out(tag, attributes, kind == 2):
                        kind = 0
                    elif tag == "article" or attributes and _ARTICLE_ROLE.search(attributes):
                        kind = 2
                    elif tag == "main" and kind == 1:
                        kind = 3
        elif m[3]:
            tag = m[3].lower()
            if tag in INLINE:
                muted -= muted > 0
                continue
            if tag in RAW:
                continue
            end_line()
            muted = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    kind = stack[k][1]
                    del stack[k:]
                    break
    end_line()
    return lines


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host and path of a url; both empty without one."""
    if not url or "://" not in url:
        return "", ""
    rest = re.split("[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def common_lines(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Which of my lines are in a longest common subsequence with their lines.

    Equal ends are taken off and lines that only one side has left out; the rest is done
    with one row of bits per line of mine.
    """
    shared = np.zeros(len(mine), bool)
    low, high = 0, min(len(mine), len(theirs))
    while low < high and mine[low] == theirs[low]:
        low += 1
    tail = 0
    while tail < high - low and mine[-1 - tail] == theirs[-1 - tail]:
        tail += 1
    shared[:low] = True
    shared[len(mine) - tail :] = True
    a, b = mine[low : len(mine) - tail], theirs[low : len(theirs) - tail]
    places = np.flatnonzero(np.isin(a, b))
    b = b[np.isin(b, a)]
    if not len(places):
        return shared
    where: dict[int, int] = {}
    for k, line in enumerate(b.tolist()):
        where[line] = where.get(line, 0) | 1 << k
    full = (1 << len(b)) - 1
    row, rows = full, []
    for line in a[places].tolist():
        fits = row & where[line]
        row = ((row + fits) | (row - fits)) & full
        rows.append(row)
    # a zero bit k in row i: the best over b[:k + 1] is one longer than over b[:k]
    k = len(b) - 1
    for i in range(len(rows) - 1, -1, -1):
        while k >= 0 and rows[i] >> k & 1:
            k -= 1
        if k < 0:
            break
        before = rows[i - 1] if i else full
        if before >> k & 1:  # the step at k came with line i
            shared[low + places[i]] = True
            k -= 1
    return shared


_LONGS = ArrayType(LongType())
_CUT = StructType(
    [
        StructField("host", StringType()),
        StructField("path", StringType()),
        StructField("line", ArrayType(StringType())),
        StructField("kind", ArrayType(IntegerType())),
    ]
)


#: hundredths of a page's characters in shared lines, from which on it is a near copy of the other page
NEAR = 80


def template_lines(mine: np.ndarray, theirs: np.ndarray, chars: np.ndarray) -> np.ndarray | None:
    """My lines (hashes) that are template by comparison with one other page; None if mine is a near copy of it,
    which tells nothing of a template. `chars`: the characters of my lines."""
    if not len(mine) or not len(theirs):
        return mine[:0]
    shared = common_lines(mine, theirs)
    return None if 100 * chars[shared].sum() >= NEAR * chars.sum() else mine[shared]


@F.pandas_udf(_CUT)
def _cut(urls: pd.Series, pages: pd.Series) -> pd.DataFrame:
    rows = []
    for url, page in zip(urls, pages, strict=True):
        lines = page_lines(page)
        rows.append(
            (
                *host_and_path(url),
                [t for t, _ in lines],
                [k for _, k in lines],
            )
        )
    return pd.DataFrame(rows, columns=["host", "path", "line", "kind"])


def _neighbours(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Template lines of the pages of a sorted stream, each by the page before and the one after it.

    A near copy of the page before is set against the last page that was not one. The first and the last page of
    the stream (edge 1, 2; 3: the only one) keep their lines.
    """
    none = np.zeros(0, np.int64)
    held, other, number = None, None, 0

    def row(page, found, edge):
        own = (page.hash, page.chars) if edge else (None, None)
        return (page.page, page.host, page.path, edge, *own, found)

    def batch(rows):
        return pd.DataFrame(rows, columns=["page", "host", "path", "edge", "hash", "chars", "found"])

    def by(page, neighbour):
        return None if neighbour is None else template_lines(page.hash, neighbour.hash, page.chars)

    for frame in pages:
        rows = []
        for page in frame.itertuples(index=False):
            found = none
            if held is not None:
                before, so_far = held
                if before.host == page.host:
                    found = by(page, before)
                    if found is None:
                        found = by(page, other)
                    else:
                        other = before
                    after = by(before, page)
                    so_far = so_far if after is None else np.r_[so_far, after]
                else:
                    other = None
                rows.append(row(before, so_far, int(number == 1)))
            held = (page, none if found is None else found)
            number += 1
        if rows:
            yield batch(rows)
    if held is not None:
        yield batch([row(*held, 3 if number == 1 else 2)])


_SPREAD = "page long, host string, path string, edge int, hash array<long>, chars array<int>, found array<long>"


@F.pandas_udf(_LONGS)
def _met(mine: pd.Series, chars: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    rows = []
    for x, n, *sides in zip(mine, chars, before, after, strict=True):
        found = [template_lines(x, y, n) for y in sides if y is not None]
        rows.append(np.concatenate([np.zeros(0, np.int64), *[f for f in found if f is not None]]))
    return pd.Series(rows, dtype=object)


def shared_lines(cut: DataFrame) -> DataFrame:
    """Per page: the hashes of its template lines. `cut` has page, host, path, hash and chars."""
    spread = write_and_read(
        cut.repartitionByRange("host", "path", "page")
        .sortWithinPartitions("host", "path", "page")
        .mapInPandas(_neighbours, _SPREAD),
        "neighbours",
    )
    # at most two pages of each partition
    edges = spread.where("edge > 0")
    at = Window.partitionBy("host").orderBy("path", "page")
    met = edges.withColumns(
        {
            "before": F.when(F.col("edge") != 2, F.lag("hash").over(at)),
            "after": F.when(F.col("edge") != 1, F.lead("hash").over(at)),
        }
    ).select("page", _met("hash", "chars", "before", "after").alias("found"))
    every = spread.select("page", "found").union(met)
    return every.groupBy("page").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("template"))


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of `pages`: id, url, text and n_chars.

    A page with an article element (that is not in a part left out) gives that element's
    lines, else one with a main element what is in it, else all lines; of the last two
    without the lines that are template: those that stand, in order, in a neighbour that is no near copy (NEAR).
    Null and empty pages have an empty text. A page
    without a host, or the only one of its host, has no neighbours. Rows that repeat an
    id share what is deleted; rows without an id lose no template line. Other columns do
    not matter. Lines are written to the shared folder.
    """
    cut = write_and_read(
        pages.select(F.col(id).alias("page"), F.col(url).alias("url"), _cut(F.col(url), F.col(page)).alias("c")).select(
            "page", "url", "c.*"
        ),
        "lines",
    )
    best = F.when(F.array_contains("kind", 2), 2).when(F.array_contains("kind", 3), 3).otherwise(1)
    cut = cut.withColumns({"best": best, "hash": F.transform("line", lambda line: F.xxhash64(line)), "chars": F.transform("line", lambda line: F.length(line))})
    compared = cut.where((F.col("host") != "") & F.col("page").isNotNull() & (F.size("hash") > 0))
    shared = shared_lines(compared.dropDuplicates(["page"]).select("page", "host", "path", "hash", "chars"))
    # written, so that the planner knows its size; pages with an article keep all of its lines
    asked = compared.where("best <> 2").select("page").distinct()
    shared = write_and_read(shared.where(F.size("template") > 0).join(asked, "page", "left_semi"), "template")
    none = F.array().cast("array<long>")
    rows = F.arrays_zip("line", "kind", "hash")
    kept = F.filter(
        rows,
        lambda r: (r["kind"] == F.col("best"))
        & ((r["kind"] == 2) | ~F.array_contains(F.coalesce(F.col("template"), none), r["hash"])),
    )
    return (
        cut.join(shared, "page", "left")
        .select(
            F.col("page").alias(id), F.col("url").alias(url), F.array_join(F.transform(kept, lambda r: r["line"]), "\n").alias("text")
        )
        .withColumn("n_chars", F.length("text").cast("long"))
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return extract(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))
