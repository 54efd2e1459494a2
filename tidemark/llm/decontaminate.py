"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents of one partition. Its text is the sequence of
word numbers: words of the phrases being searched have numbers from 2 on, every
other word is the separator 1, and stretches of known words that are shorter than
the shortest phrase become part of the separator, as no phrase fits into them. The
Burrows-Wheeler transform of that text stands in a wavelet tree; all phrases are
searched backwards together by ranks in the tree, their places found by walking to
sampled suffix positions, and the places of a document merged into removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from tidemark.llm.words import ALNUM, LOWER, utf8

NAME = "op1_decontaminate"
SQL = None

#: words of a phrase
WINDOW = 13
#: words of a shard's index; one document is never split
SHARD_WORDS = 1 << 21
#: every so many positions of a shard's text keep their suffix position
SAMPLE = 16
#: UTF-8 bytes of benchmark items that one pass searches for
ITEM_BYTES = 16 << 20

#: A-Z to a-z, separators to spaces, as a table for bytes.translate
_PLAIN = bytes(int(LOWER[b]) if ALNUM[LOWER[b]] else 32 for b in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words of a lower-cased text; a null text has none."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_PLAIN).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of `text` in order, by prefix doubling; text ends with its only 0."""
    rank = text.astype(np.int64)
    width = 1
    while True:
        second = np.zeros_like(rank)
        second[:-width] = rank[width:] + 1
        key = rank * (int(second.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        fresh = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        rank = np.empty_like(fresh)
        rank[order] = fresh
        if fresh[-1] == len(text) - 1:
            return order
        width *= 2


class Bits:
    """A bit row with constant-time ranks."""

    def __init__(self, bits: np.ndarray) -> None:
        self.ones = np.r_[0, np.cumsum(bits, dtype=np.int32)].astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        return self.ones[at]


class WaveletTree:
    """Ranks of symbols in a sequence: a bit row per binary digit, zeros of each level before its ones."""

    def __init__(self, text: np.ndarray) -> None:
        self.levels = max(1, int(text.max()).bit_length())
        self.rows, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = (text >> level) & 1
            self.rows.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            text = np.concatenate([text[bits == 0], text[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        first, last = np.zeros_like(at), at
        for level, row, zeros in zip(reversed(range(self.levels)), self.rows, self.zeros, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = row.rank(first), row.rank(last)
            first, last = np.where(one, zeros + a, first - a), np.where(one, zeros + b, last - b)
        return last - first

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """The symbols at places."""
        out = np.zeros_like(at)
        for row, zeros in zip(self.rows, self.zeros, strict=True):
            before = row.rank(at)
            one = row.rank(at + 1) > before
            out = out * 2 + one
            at = np.where(one, zeros + before, at - before)
        return out


class FMIndex:
    """Search and location of word sequences in one text of small numbers (above 0)."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE) -> None:
        text = np.r_[text, 0]
        order = suffix_array(text)
        bwt = text[order - 1]
        self.size = len(text)
        self.before = np.r_[0, np.cumsum(np.bincount(text))]
        self.tree = WaveletTree(bwt)
        marked = order % sample == 0
        self.marked = Bits(marked)
        self.samples = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase (a row, filled up on the left)."""
        first, last = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for k in range(phrases.shape[1]):
            go = np.flatnonzero((k < lengths) & (first < last))
            symbol = phrases[go, phrases.shape[1] - 1 - k]
            known = symbol < len(self.before) - 1
            symbol = np.where(known, symbol, 0)
            start = self.before[symbol]
            first[go] = np.where(known, start + self.tree.rank(symbol, first[go]), 0)
            last[go] = np.where(known, start + self.tree.rank(symbol, last[go]), 0)
        return first, last

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, walking backwards in the text to a sampled one."""
        out, at, steps = np.full(len(rows), -1, np.int64), rows.copy(), 0
        left = np.arange(len(rows))
        while len(left):
            place = at[left]
            rank = self.marked.rank(place)
            hit = self.marked.rank(place + 1) > rank
            out[left[hit]] = self.samples[rank[hit]] + steps
            left = left[~hit]
            place = place[~hit]
            symbol = self.tree.symbol(place)
            at[left] = self.before[symbol] + self.tree.rank(symbol, place)
            steps += 1
        return out


class Phrases:
    """The windows of benchmark items as rows of word numbers, each once, with the items it stands in."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.items = [item for item, _ in items]
        for place, (_, text) in enumerate(items):
            row = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words_of(text)]
            for at in range(max(1, len(row) - window + 1) if row else 0):
                found.setdefault(tuple(row[at : at + window]), set()).add(place)
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.shortest = int(self.lengths.min()) if found else 0
        self.rows = np.zeros((len(found), window), np.int64)
        for row, phrase in enumerate(found):
            self.rows[row, window - len(phrase) :] = phrase
        self.owners = [sorted(x) for x in found.values()]


def shard_spans(numbers: np.ndarray, bounds: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, list, list]]:
    """Document (from 0), merged spans and item places, for the documents of a shard with a hit.

    numbers: the word numbers of all its documents, bounds: where each begins.
    """
    if not len(phrases.rows):
        return
    # stretches of known words within one document
    known = np.r_[False, numbers > 1, False]
    step = np.diff(known.astype(np.int8))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = bounds[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(numbers))])
    cuts = cuts[known[cuts] & known[cuts + 1]] if len(cuts) else cuts
    starts, ends = np.sort(np.r_[starts, cuts]), np.sort(np.r_[ends, cuts])
    long = ends - starts >= phrases.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return
    sizes = ends - starts
    offsets = np.r_[0, np.cumsum(sizes + 1)[:-1]]  # each stretch is followed by one separator
    text = np.ones(int((sizes + 1).sum()), np.int64)
    inside = np.arange(len(text)) - np.repeat(offsets, sizes + 1)
    real = inside < np.repeat(sizes, sizes + 1)
    origin = np.repeat(starts, sizes + 1) + inside
    text[real] = numbers[origin[real]]

    index = FMIndex(text)
    first, last = index.search(phrases.rows, phrases.lengths)
    count = last - first
    which = np.repeat(np.arange(len(count)), count)
    if not len(which):
        return
    rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    at = origin[index.locate(rows)]
    document = np.searchsorted(bounds, at, "right") - 1
    order = np.lexsort((at, document))
    at, which, document = at[order], which[order], document[order]
    edges = np.flatnonzero(np.r_[True, np.diff(document) != 0, True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        base, spans, items = bounds[document[a]], [], set()
        for start, phrase in zip((at[a:b] - base).tolist(), which[a:b].tolist(), strict=True):
            items.update(phrases.owners[phrase])
            end = start + int(phrases.lengths[phrase])
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(end, spans[-1][1])
            else:
                spans.append([start, end])
        yield int(document[a]), spans, sorted(items)


_FOUND = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def _finder(phrases: Phrases, shard_words: int):
    """A column function: per text its number of words, spans of hit words [first, last) and items hit."""

    @F.arrow_udf(_FOUND)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers = phrases.numbers
        for texts in batches:
            data, offsets = utf8(texts)
            plain = data.tobytes().translate(_PLAIN)
            counts, spans, items = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
            first, size, parts = 0, 0, []
            for place in range(len(texts)):
                found = plain[offsets[place] : offsets[place + 1]].split()
                counts[place] = len(found)
                parts.append(np.fromiter((numbers.get(w, 1) for w in found), np.int64, len(found)))
                size += len(found)
                if size >= shard_words or place + 1 == len(texts):
                    bounds = np.r_[0, np.cumsum([len(p) for p in parts])]
                    for document, hit, owners in shard_spans(np.concatenate(parts), bounds, phrases):
                        spans[first + document] = [{"first": a, "last": b} for a, b in hit]
                        items[first + document] = sorted(
                            {str(phrases.items[x]) for x in owners if phrases.items[x] is not None}
                        )
                    first, size, parts = place + 1, 0, []
            yield pa.StructArray.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["n_words", "spans", "items"],
            )

    return find


def _passes(items: DataFrame, item: str, text: str, limit: int) -> Iterator[Phrases]:
    """The phrases of blocks of items, each block of about `limit` bytes."""
    total = items.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = max(1, -(-total // limit))
    part = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    for block in range(blocks):
        mine = part.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else part
        yield Phrases([(r["item"], r["text"]) for r in mine.collect()])


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    shard_words: int = SHARD_WORDS,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """`docs` with `hits`: n_words, spans (merged ranges of hit words, the end excluded) and items.

    Items are searched in blocks of `item_bytes`, one pass over the texts for each, and
    the passes merged row by row; no row leaves its partition. Null texts and items
    have no words; an item without words has no phrase; rows that repeat are judged
    alike; an empty benchmark hits nothing. A column named `hits` is replaced.
    """
    out = docs.drop("hits")
    for number, phrases in enumerate(_passes(benchmark, item, item_text, item_bytes)):
        out = out.withColumn(f"_hits{number}", _finder(phrases, shard_words)(F.coalesce(F.col(text), F.lit(""))))
    found = [F.col(f"_hits{k}") for k in range(number + 1)]
    if len(found) == 1:
        return out.withColumnRenamed("_hits0", "hits")
    every = F.array_sort(F.flatten(F.array(*[f["spans"] for f in found])))
    start = F.array().cast("array<struct<first:long,last:long>>")

    def add(done, span):
        tail = F.element_at(done, -1)
        joined = F.struct(tail["first"].alias("first"), F.greatest(tail["last"], span["last"]).alias("last"))
        meets = (F.size(done) > 0) & (span["first"] <= F.get(done, F.size(done) - 1)["last"])
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(meets, F.concat(shorter, F.array(joined))).otherwise(F.concat(done, F.array(span)))

    hits = F.struct(
        found[0]["n_words"].alias("n_words"),
        F.aggregate(every, start, add).alias("spans"),
        F.array_distinct(F.flatten(F.array(*[f["items"] for f in found]))).alias("items"),
    )
    return out.withColumn("hits", hits).drop(*[f"_hits{k}" for k in range(number + 1)])


def n_hit(hits="hits"):
    """Words inside any span."""
    return F.aggregate(f"{hits}.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def contaminated(hits="hits"):
    """At least a twentieth of the words is hit."""
    return (n_hit(hits) > 0) & (20 * n_hit(hits) >= F.col(f"{hits}.n_words"))


@F.arrow_udf(StringType())
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    data, offsets = utf8(texts)
    out = texts.to_pylist()
    for place, cut in enumerate(spans.to_pylist()):
        if cut:
            raw = data[offsets[place] : offsets[place + 1]]
            inside = np.r_[False, np.frombuffer(raw.tobytes().translate(_PLAIN), np.uint8) != 32, False]
            step = np.diff(inside.astype(np.int8))
            starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            keep = np.ones(len(raw), bool)
            for span in cut:
                keep[starts[span["first"]] : ends[span["last"] - 1]] = False
            out[place] = raw[keep].tobytes().decode()
    return pa.array(out, pa.string())


def remove_spans(found: DataFrame, text: str = "text", where: Column | None = None) -> DataFrame:
    """The texts without their spans, from the first byte of a span's first word to the last of its last.

    where: the rows that lose them (all by default).
    """
    spans = F.col("hits.spans") if where is None else F.when(where, F.col("hits.spans"))
    return found.withColumn(text, _without(F.col(text), spans))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = find_spans(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    items = F.array_sort("hits.items")
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
