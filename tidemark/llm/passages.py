"""Passages of words that stand in an earlier document, too, wherever its lines break.

Every passage of a fixed number of words belongs to a group, the least hash of the
grams of GRAM words in it, so equal passages are in the same group. Few grams are the
least of a passage (about one for 16 words), and only groups that two documents have
are looked at passage by passage. What goes is found exactly, by hashes of 128 bits.

Words that come together where a passage went may make one that an earlier document
has; these passages are compared again with all documents until nothing is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.suffix_dedup import _sliding_least
from tidemark.llm.words import SPACED, Hasher, Words, chunks, find_words, lists, long_windows, released, utf8, window_starts
from tidemark.session import settled, write_and_read, write_by_key

#: words of a passage
PASSAGE = 51
GRAM = 20
#: so few documents of a round are picked by their ids, which spares reading all texts for them
PICKED = 100

_LONGS = ArrayType(LongType())
_HELD = StructType([StructField("group", _LONGS), StructField("run", _LONGS)])
_LEFT = StructType([StructField("text", StringType()), StructField("n", LongType()), StructField("fresh", _LONGS)])


def _words(texts: pa.Array, hasher: Hasher) -> Iterator[tuple]:
    """Chunks of the texts: bytes, the offset of each text, words and their hashes."""
    data, offsets = utf8(texts)
    for a, b in chunks(offsets):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = find_words(part, bounds, SPACED)
        yield part, bounds, words, hasher.ranges(part, words.starts, words.ends)


def _groups(words: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """The groups of all passages of a chunk, in order."""
    at = window_starts(words, size)
    if not len(at):
        return np.zeros(0, np.uint64)
    gram = min(GRAM, size)
    grams, first = long_windows(words, hashes, gram)
    every = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    every[first] = grams
    return _sliding_least(every, size - gram + 1)[at]


def _passages(texts: pa.Array, hasher: Hasher, size: int) -> Iterator[tuple]:
    """Of each text the bytes, the words' starts and ends, and of its passages the hash, the group and the first word."""
    for part, bounds, words, hashes in _words(texts, hasher):
        runs, at = long_windows(words, hashes, size)
        groups = _groups(words, hashes, size)
        cuts = np.searchsorted(at, words.bounds)
        for k in range(len(bounds) - 1):
            first, last = words.bounds[k], words.bounds[k + 1]
            own = slice(cuts[k], cuts[k + 1])
            yield (
                part[bounds[k] : bounds[k + 1]].tobytes(),
                words.starts[first:last] - bounds[k],
                words.ends[first:last] - bounds[k],
                runs[own].view(np.int64),
                groups[own].view(np.int64),
                at[own] - first,
            )


def grouper(size: int):
    """A column function: the groups of each text's passages."""

    @F.arrow_udf(_LONGS)
    def groups(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for texts in released(batches):
            found = []
            for _, bounds, words, hashes in _words(texts, hasher):
                every = _groups(words, hashes, size).view(np.int64)
                cuts = np.searchsorted(window_starts(words, size), words.bounds)
                found += [np.unique(every[cuts[k] : cuts[k + 1]]) for k in range(len(bounds) - 1)]
            yield lists(found)

    return groups


def holder(size: int):
    """A column function: group and hash of each text's passages that are in the given groups."""

    @F.arrow_udf(_HELD)
    def held(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for texts, asked in released(batches):
            groups, runs = [], []
            for (*_, every, own, _), wanted in zip(_passages(texts, hasher, size), asked, strict=True):
                inside = np.isin(own, wanted.values.to_numpy())
                groups.append(own[inside])
                runs.append(every[inside])
            yield pa.StructArray.from_arrays([lists(groups), lists(runs)], names=_HELD.names)

    return held


def without(raw: bytes, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    """The text without the words that are `gone`; of the two gaps beside them the one with more line breaks stays."""
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
    out, at = [], 0
    for i, j in edges.tolist():
        before = int(ends[i - 1]) if i else 0
        after = int(starts[j]) if j < len(starts) else len(raw)
        left, right = raw[before : starts[i]], raw[ends[j - 1] : after]
        if not i or j == len(starts):
            gap = b"" if not i and j == len(starts) else right if i else left
        else:
            gap = right if right.count(b"\n") > left.count(b"\n") else left
        out += [raw[at:before], gap]
        at = after
    return b"".join([*out, raw[at:]])


def cutter(size: int):
    """A column function: a text without its passages of those hashes, how many pieces went, and the groups of its
    fresh passages: those that it did not have, or that were cut and came together again."""

    @F.arrow_udf(_LEFT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for texts, asked in released(batches):
            out, counts, old = [], [], []
            for (raw, starts, ends, own, _, at), runs in zip(_passages(texts, hasher, size), asked, strict=True):
                hit = np.isin(own, runs.values.to_numpy())
                step = np.zeros(len(starts) + 1, np.int64)
                step[at[hit]] += 1
                step[at[hit] + size] -= 1
                gone = np.cumsum(step[:-1]) > 0
                out.append(without(raw, starts, ends, gone).decode())
                counts.append(int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()))
                old.append(own[~hit])
            now = pa.array(out, pa.large_string())
            fresh = [
                np.unique(groups[~np.isin(own, before)])
                for (*_, own, groups, _), before in zip(_passages(now, hasher, size), old, strict=True)
            ]
            yield pa.StructArray.from_arrays(
                [now.cast(pa.string()), pa.array(counts, pa.int64()), lists(fresh)], names=_LEFT.names
            )

    return cut


def _found(asked: DataFrame, size: int) -> DataFrame:
    """Per document the hashes of the passages that a document with a smaller id has; `asked`: the groups to look at."""
    held = asked.select("doc", holder(size)("text", "asked").alias("h"))
    every = write_and_read(held.select("doc", F.inline(F.arrays_zip("h.group", "h.run"))), "passages")
    later = every.withColumn("a", F.min("doc").over(Window.partitionBy("group", "run"))).where("doc > a")
    return later.groupBy("doc").agg(F.collect_set("run").alias("runs"))


def _cut(rows: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """The rows (doc, part, text, n) of the documents in `found` without its passages, with the groups that are fresh."""
    cut = rows.join(found.hint("shuffle_hash"), "doc").select("doc", "part", "n", cutter(size)("text", "runs").alias("c"))
    return cut.select("doc", "part", F.col("c.text").alias("text"), (F.col("n") + F.col("c.n")).alias("n"), "c.fresh")


def _asked(groups: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Per document its groups that another document has too; `among`: only these groups."""
    if among is not None:
        groups = groups.join(among, "group", "left_semi")
    own = Window.partitionBy("group")
    met = groups.withColumns({"a": F.min("doc").over(own), "z": F.max("doc").over(own)}).where("a < z")
    return met.groupBy("doc").agg(F.collect_set("group").alias("asked"))


def repeated(texts: DataFrame, size: int = PASSAGE) -> DataFrame | None:
    """The rows of `texts` (doc, part, text; by `write_by_key`) of documents that change, cut, with n, the pieces that
    went; None if none.

    A passage goes if a document with a smaller id has it. Rows that repeat an id are one document; part tells them
    apart. In a round only fresh passages of the round before can be found: of two documents that have one, the later
    has lost all others. So a round reads the documents that share a group of those, and no others.
    """
    groups = write_and_read(texts.select("doc", F.explode(grouper(size)("text")).alias("group")), "groups")
    rows = texts.withColumn("n", F.lit(0).cast("long"))
    found = settled(lambda: _found(rows.join(_asked(groups).hint("shuffle_hash"), "doc"), size), "found")
    if found.isEmpty():
        return None
    # texts as the first round left them, and those that later rounds changed
    first = last = write_by_key(_cut(rows, found, size), "doc", "cut", dealt=True)
    later = first.limit(0)
    while True:
        fresh = write_and_read(last.select("doc", F.explode("fresh").alias("group")), "fresh")
        groups = groups.union(fresh)
        asked = _asked(groups, fresh.select("group").distinct())
        for name, table in (("in_first", first), ("in_later", later)):
            docs = table.select("doc").distinct().withColumn(name, F.lit(True))
            asked = asked.join(docs, "doc", "left")
        asked = write_and_read(asked, "asked")
        ids = [r["doc"] for r in asked.select("doc").limit(PICKED + 1).collect()]
        picked = F.col("doc").isin(ids) if len(ids) <= PICKED else F.lit(True)
        in_first, in_later = (F.coalesce(c, F.lit(False)) for c in ("in_first", "in_later"))

        def now(wanted: DataFrame) -> DataFrame:
            """The texts of these documents as they are by now."""
            own = [(rows, ~in_first & ~in_later), (first, in_first & ~in_later), (later, in_later)]
            parts = [t.select("doc", "part", "text", "n").where(picked).join(wanted.where(c).hint("shuffle_hash"), "doc") for t, c in own]
            return parts[0].union(parts[1]).union(parts[2])

        found = settled(lambda: _found(now(asked), size), "found")
        if found.isEmpty():
            same = later.select("doc").distinct()
            return first.join(same, "doc", "left_anti").union(later).select("doc", "part", "text", "n")
        wanted = asked.drop("asked").join(found, "doc", "left_semi")
        last = write_and_read(_cut(now(wanted), found, size), "cut")
        later = write_and_read(later.join(last.select("doc").distinct(), "doc", "left_anti").union(last), "later")
