"""URL filters by a bit-parallel wildcard automaton.

All rules are packed into one row of 64-bit words, a bit per rule position. One
Shift-And step per URL byte moves every position of every rule at once, for all
URLs of a batch together: ``D = ((D << 1 | first) & eats[byte]) | (D & stays[byte])``.

A rule is a glob over ``.host/path`` (host with a leading dot): ``*`` is any run
without a slash, ``**`` any run, ``?`` one character but a slash, other characters
stand for themselves. A host rule ``example.org/en/1`` becomes
``*.example.org/en/1**``: its host and all subdomains, paths that start so.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.words import utf8

NAME = "op10_url_filter"

#: fixed values: the contract's rules
HOST_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: the method's own globs, for URLs that no host rule fits
BLOCKED_GLOBS = ("*.ads.**", "*/login**", "**/wp-admin/**", "**/cgi-bin/**", "**.zip", "**.exe", "*/tag/**", "*/??/9*0")

_ANY, _SEGMENT, _ONE = object(), object(), object()


def parts(glob: str) -> list:
    """The pieces of a glob: bytes that stand for themselves, and wildcards."""
    out, i = [], 0
    while i < len(glob):
        if glob.startswith("**", i):
            out.append(_ANY)
            i += 2
        else:
            out += {"*": [_SEGMENT], "?": [_ONE]}.get(glob[i]) or list(glob[i].encode())
            i += 1
    return out


class Automaton:
    """Many globs as one multiword Shift-And automaton.

    A wildcard run adds no position: it lets the position before it stay active.
    Each rule has a position 0 that is active at the start only, so that a leading
    wildcard is the staying of that position.
    """

    def __init__(self, globs: Sequence[str]) -> None:
        eats, stays, last = [], [], []
        slash, lead, follow = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
        slash[47] = True
        follow[0x80:0xC0] = True
        lead = ~follow & ~slash
        for glob in globs:
            eats.append(np.zeros(256, bool))
            stays.append(np.zeros(256, bool))
            for part in parts(glob):
                if part is _ANY:
                    stays[-1] = np.ones(256, bool)
                elif part is _SEGMENT:
                    stays[-1] = stays[-1] | ~slash
                elif part is _ONE:
                    eats.append(lead)
                    stays.append(follow.copy())
                else:
                    eats.append(np.arange(256) == part)
                    stays.append(np.zeros(256, bool))
            last.append(len(eats) - 1)
        first = [0, *[x + 1 for x in last[:-1]]] if last else []
        self.words = max(1, -(-len(eats) // 64))
        self.last = last
        self.eats = self._pack(eats)
        self.stays = self._pack(stays)
        self.start = np.zeros(self.words, np.uint64)
        for bit in first:
            self.start[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def _pack(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((256, self.words), np.uint64)
        for bit, row in enumerate(rows):
            out[row, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return out

    def fits(self, texts: pa.Array) -> np.ndarray:
        """For each text (a row) and rule (a column): does the rule fit the whole text?"""
        data, offsets = utf8(texts)
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        begin, sizes = offsets[:-1][order], length[order]
        state = np.tile(self.start, (len(order), 1))
        longest = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(longest), "left")
        for at in range(longest):
            n = alive[at]
            byte, now = data[begin[:n] + at], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.eats[byte]) | (now & self.stays[byte])
        out = np.zeros((len(order), len(self.last)), bool)
        for rule, bit in enumerate(self.last):
            out[order, rule] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
        return out


def judge(
    pages: DataFrame,
    url: str = "url",
    host_rules: Sequence[tuple[str, str]] = HOST_RULES,
    blocked: Sequence[str] = BLOCKED_GLOBS,
) -> DataFrame:
    """`pages` with host, path, rule and verdict, each url judged on its own: no shuffle.

    The longest fitting host rule decides (of two equally long ones the first);
    without one, a url that a blocked glob fits is blocked and any other allowed.
    A null url, or one without ``://``, has an empty host and path, no rule, and is
    allowed. Long urls, repeated rows and other columns need nothing special; a
    column named as one of the four new ones is replaced.
    """
    ranked = sorted(host_rules, key=lambda r: -len(r[1]))
    globs = [f"*.{rule}**" for _, rule in ranked] + list(blocked)
    verdicts = np.array([verdict for verdict, _ in ranked] + ["block"] * len(blocked) + ["allow"], dtype=object)
    names = np.array([rule for _, rule in ranked] + [None] * (len(blocked) + 1), dtype=object)

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def decide(canonical: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(globs)
        for texts in canonical:
            fits = automaton.fits(pa.array(texts, pa.large_string()))
            which = np.where(fits.any(axis=1), fits.argmax(axis=1), len(globs)) if globs else np.zeros(len(texts), int)
            yield pd.DataFrame({"rule": names[which], "verdict": verdicts[which]})

    rest = F.when(F.instr(F.col(url), "://") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "?", 1))
    rest = F.coalesce(F.substring_index(rest, "#", 1), F.lit(""))
    slash = F.instr(rest, "/")
    host = F.translate(
        F.when(slash > 0, F.substring(rest, F.lit(1), slash - 1)).otherwise(rest),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(F.lit(""))
    out = pages.withColumns({"host": host, "path": path})
    judged = decide(F.concat(F.lit("."), "host", "path"))
    kept = [c for c in out.columns if c not in ("rule", "verdict")]
    return out.select(*kept, judged.alias("rule")).select(*kept, "rule.rule", "rule.verdict")


def query(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%'
    THEN regexp_extract(regexp_replace(url, '^.*?://', '', 's'), '^[^?#]*', 0, 's') ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*', 0, 's'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '/.*$', 0, 's'), '') AS path FROM cut),
ruled AS (
  SELECT *, CASE
    WHEN regexp_matches(host, '(^|\.)example\.org$') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN regexp_matches(host, '(^|\.)example\.org$') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN regexp_matches(host, '(^|\.)com$') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN regexp_matches(host, '(^|\.)com$') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN regexp_matches(host, '(^|\.)org$') AND starts_with(path, '/') THEN 'org/' END AS rule FROM split)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches('.' || host || path,
      '^([^/]*\.ads\..*|[^/]*/login.*|.*/wp-admin/.*|.*/cgi-bin/.*|.*\.zip|.*\.exe|[^/]*/tag/.*|[^/]*/[^/]{2}/9[^/]*0)$', 's')
      THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
