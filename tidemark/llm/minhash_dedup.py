"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit numbers make the whole signature: one scatters the
shingle hashes, the other, shifted circularly by k, gives coordinate k as the least
of its values over the shingles.

Exact copies of a shingle set are one node from the start. A band's bucket is never
expanded into pairs: every member meets the bucket's pivot, chosen anew in each
band. What is left between different components of one bucket is settled in further
rounds (`_rest`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemark.llm.graph import components
from tidemark.llm.words import LOWER, SPACED, Hasher, chunks, find_words, lists, mix, released, utf8, windows
from tidemark.session import settled, write_and_read

NAME = "op7_minhash_dedup"
SQL = None


@dataclass(frozen=True)
class Shape:
    """What is compared, and how.

    A pair with just the wanted similarity meets in no band with probability
    (1 - t ** rows) ** bands.
    """

    threshold: int  # similarity in hundredths
    bands: int
    rows: int
    shingle: int = 5
    lower: bool = False  # A-Z count as a-z


#: a linked pair is missed by all bands with probability 7e-9
DOCUMENTS = Shape(threshold=85, bands=32, rows=5, lower=True)
#: size of the parity sketch that bounds the difference of two sets from below
ODD_BITS = 512

_M = np.uint32


def shingle_sets(texts: pa.Array, hasher: Hasher, size: int, lower: bool = False) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; fewer words make one shingle, none an empty set."""
    data, offsets = utf8(texts)
    for a, b in chunks(offsets):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if lower:
            part = LOWER[part]
        words = find_words(part, bounds, SPACED)
        hashes = hasher.ranges(part, words.starts, words.ends)
        runs, at = windows(words, hashes, size)
        cuts = np.searchsorted(at, words.bounds)
        for text in range(b - a):
            first, last = words.bounds[text], words.bounds[text + 1]
            if 0 < last - first < size:
                whole = np.zeros(1, np.uint64)
                with np.errstate(over="ignore"):
                    for h in hashes[first:last]:
                        whole = mix(whole + h + np.uint64(1))
                yield whole
            else:
                yield np.unique(runs[cuts[text] : cuts[text + 1]])


def _scatter(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _M(16))
    x = x * _M(0x7FEB352D)
    x = x ^ (x >> _M(15))
    x = x * _M(0x846CA68B)
    return x ^ (x >> _M(16))


class Circulant:
    """Signatures of `size` coordinates for many shingle sets at once, one coordinate after another."""

    def __init__(self, size: int) -> None:
        self.size = size

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of coordinates for each set; none of the sets is empty."""
        out = np.empty((len(sets), self.size), np.uint32)
        starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
        shingles = np.concatenate(sets)
        scattered = _scatter((shingles ^ (shingles >> np.uint64(32))).astype(np.uint32))
        x, y = np.empty_like(scattered), np.empty_like(scattered)
        for k in range(self.size):
            np.add(scattered, _M(k), out=x)
            for factor, by in ((0x9E3779B1, 15), (0x85EBCA77, 13)):
                np.multiply(x, _M(factor), out=x)
                np.right_shift(x, _M(by), out=y)
                np.bitwise_xor(x, y, out=x)
            np.multiply(x, _M(0xC2B2AE3D), out=x)
            out[:, k] = np.minimum.reduceat(x, starts)
        return out

    def bands(self, signature: np.ndarray, rows: int) -> np.ndarray:
        """For each signature one 64-bit key for each band of `rows` coordinates."""
        values = signature.reshape(len(signature), -1, rows).astype(np.uint64)
        key = np.tile(np.arange(values.shape[1], dtype=np.uint64), (len(values), 1))
        with np.errstate(over="ignore"):
            for k in range(rows):
                key = mix(key + values[:, :, k] + np.uint64(0x9E3779B97F4A7C15))
        return key.view(np.int64)


_LONGS = ArrayType(LongType())
_SIGNED = StructType(
    [
        StructField("n", LongType()),
        StructField("key_a", LongType()),
        StructField("key_b", LongType()),
        StructField("bands", _LONGS),
        StructField("odd", _LONGS),
    ]
)


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """ODD_BITS parities of the shingles that hash to each bit.

    Two sketches differ in at most as many bits as the sets differ in shingles.
    """
    bits = np.bincount((mix(found) % np.uint64(ODD_BITS)).astype(np.int64), minlength=ODD_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


#: shingles that are signed together
HELD = 1 << 18


def _signed(circulant: Circulant, sets: list[np.ndarray], shape: Shape) -> list[tuple]:
    none, some = np.zeros(0, np.int64), [s for s in sets if len(s)]
    bands = iter(circulant.bands(circulant.signatures(some), shape.rows) if some else ())
    rows = []
    for found in sets:
        if len(found):
            with np.errstate(over="ignore"):
                a = int(mix(found).sum().view(np.int64))
                b = int(np.bitwise_xor.reduce(mix(found + np.uint64(0x5851F42D4C957F2D))).view(np.int64))
            rows.append((len(found), a, b, next(bands), odd_sketch(found)))
        else:
            rows.append((0, 0, 0, none, odd_sketch(found)))
    return rows


def signer(shape: Shape):
    """A column function: size, key, bands and sketch of each text's shingle set."""

    @F.arrow_udf(_SIGNED)
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher, circulant = Hasher(), Circulant(shape.bands * shape.rows)
        for texts in released(batches):
            rows, held, size = [], [], 0
            for found in shingle_sets(texts, hasher, shape.shingle, shape.lower):
                held.append(found)
                size += len(found)
                if size >= HELD:
                    rows += _signed(circulant, held, shape)
                    held, size = [], 0
            rows += _signed(circulant, held, shape)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:3]] + [lists(list(c)) for c in columns[3:]], names=_SIGNED.names
            )

    return signed


def shingler(shape: Shape):
    """A column function: the shingle set of each text."""

    @F.arrow_udf(_LONGS)
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for texts in released(batches):
            yield lists(list(shingle_sets(texts, hasher, shape.shingle, shape.lower)))

    return shingles


def _alike(common: Column, n: Column, m: Column, threshold: int) -> Column:
    return 100 * common >= threshold * (n + m - common)


def _verified(pairs: DataFrame, texts: DataFrame, shape: Shape) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    pairs = write_and_read(pairs, "pairs")
    ids = write_and_read(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = texts.join(ids, "id", "left_semi").dropDuplicates(["id"]).select("id", shingler(shape)("text").alias("set"))
    sets = write_and_read(sets, "sets")
    met = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    return met.where(_alike(common, F.size("x"), F.size("y"), shape.threshold)).select("a", "b")


def _sized(n: Column, m: Column, threshold: int) -> Column:
    """No smaller set can reach the threshold with a larger one beyond this."""
    return 100 * F.least(n, m) >= threshold * F.greatest(n, m)


def _shared(buckets: DataFrame, key: str, order: Column) -> DataFrame:
    """The rows of buckets with more than one, each with its bucket's pivot (the first by `order`), the size of
    that, and c, the rows of the bucket."""
    own = Window.partitionBy(key)
    pivots = {"_p": F.min(F.struct(order.alias("o"), "id", "n")).over(own), "_c": F.count("*").over(own)}
    met = buckets.withColumns(pivots).where("_c > 1")
    return met.select(*buckets.columns, F.col("_p.id").alias("pivot"), F.col("_p.n").alias("m"), F.col("_c").alias("c"))


def _stars(shared: DataFrame, threshold: int) -> DataFrame:
    """Pairs of every member with its bucket's pivot: a bucket of m rows gives m - 1 pairs."""
    return (
        shared.where((F.col("id") != F.col("pivot")) & _sized(F.col("n"), F.col("m"), threshold))
        .select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
        .distinct()
    )


def _members(shared: DataFrame) -> DataFrame:
    """The rows of buckets without the pivots, where there are two or more."""
    return shared.where((F.col("id") != F.col("pivot")) & (F.col("c") > 2))


def _labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    named = components(edges).withColumnRenamed("node", "id")
    return rows.join(named, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


def _mixed(rows: DataFrame, key: str) -> DataFrame:
    """The rows of buckets in which more than one label is left."""
    open_ = rows.groupBy(key).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select(key)
    return rows.join(open_, key, "left_semi")


def _rare_shingles(texts: DataFrame, ids: DataFrame, shape: Shape) -> DataFrame:
    """The prefix filter: of each text the shingles that are rarest among these texts.

    Two sets of the wanted similarity share one of their first n - ceil(t n) + 1
    shingles in any common order. In the order of frequency that prefix is filled by
    what sets a text apart, so texts that only share what many have do not meet.
    Columns: id, n, shingle, place (from 1), common (the text's mean frequency, negated).
    """
    sets = texts.join(ids, "id", "left_semi").dropDuplicates(["id"]).select("id", shingler(shape)("text").alias("set"))
    flat = write_and_read(sets.select("id", F.size("set").alias("n"), F.explode("set").alias("shingle")), "shingles")
    met = flat.withColumn("f", F.count("*").over(Window.partitionBy("shingle"))).where("f > 1")
    # one order for all three, so that rows are sorted once
    own = Window.partitionBy("id").orderBy("f", "shingle")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = met.withColumns(
        {
            "place": F.col("n") - F.count("*").over(whole) + F.row_number().over(own),
            "common": -F.sum("f").over(whole) / F.col("n"),
        }
    )
    first = F.col("n") - F.ceil(F.lit(shape.threshold) * F.col("n") / 100) + 1
    return ranked.where(F.col("place") <= first).select("id", "n", "shingle", "place", "common")


_WORDS = [f"w{k}" for k in range(ODD_BITS // 64)]


def _differ(x: str, y: str) -> Column:
    """Bits in which the sketches of two rows differ."""
    total = F.lit(0)
    for w in _WORDS:
        total = total + F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}")))
    return total


def _rest(rows: DataFrame, marks: DataFrame, texts: DataFrame, edges: DataFrame, shape: Shape) -> DataFrame:
    """Links that stars over the bands can have missed: between components that share a bucket.

    A bucket's pivot has met all its other rows, so only these can still be open against each other.
    """
    ids = write_and_read(_mixed(_labelled(rows, edges), "band").select("id").distinct(), "open")
    rare = settled(lambda: _shared(_rare_shingles(texts, ids, shape), "shingle", F.col("common")), "rare")
    edges = settled(lambda: edges.union(_verified(_stars(rare, shape.threshold), texts, shape)).distinct(), "links")
    left = _mixed(_labelled(_members(rare).drop("common", "pivot", "m", "c"), edges), "shingle")
    sketch = marks.select("id", *[F.col("odd")[k].alias(w) for k, w in enumerate(_WORDS)]).dropDuplicates(["id"])
    left = write_and_read(left.join(sketch, "id"), "left")
    return edges.union(_verified(_close(_meeting(left, shape), shape), texts, shape)).distinct()


#: sizes of a block lie within this ratio
SIZE_STEP = 1.02


def _meeting(left: DataFrame, shape: Shape) -> DataFrame:
    """Rows (x, y) of prefix shingles that meet: x is the smaller text (of equal ones that with the smaller id).

    Sizes fall into blocks. Texts of n and m shingles need ceil(t (n + m) / (1 + t)) in common,
    so for each block that its partner may be in a text shows only the shingles before what that
    leaves: fewer, the more the sizes differ. Texts that share less than is needed, however long
    that is, have no place in which both show it, but for the width of a block. Where one label
    has most of the rows that meet in a place, those are not set against each other.
    """
    t, step = shape.threshold, math.log(SIZE_STEP)
    n, place = F.col("n"), F.col("place")
    block = lambda size: F.floor(F.log(size) / step)
    least = lambda b: F.ceil(F.pow(F.lit(SIZE_STEP), b) * (1 - 1e-9)).cast("long")
    shown = lambda other: place <= n - F.ceil(t * (n + other) / (100 + t)) + 1
    smallest = F.ceil(t * n / 100)
    partners = {
        "small": (F.sequence(block(n), block(F.floor(100 * n / t))), F.greatest(n, least(F.col("b")))),
        "large": (F.sequence(block(smallest), block(n)), F.greatest(smallest, least(F.col("b")))),
    }
    roles = []
    for role, (blocks, other) in partners.items():
        rows = left.select("*", F.explode(blocks).alias("b")).where(shown(other))
        pair = (block(n), F.col("b")) if role == "small" else (F.col("b"), block(n))
        roles.append(rows.select(*left.columns, *[c.alias(k) for c, k in zip(pair, ("lo", "hi"), strict=True)], F.lit(role).alias("role")))
    both = roles[0].unionByName(roles[1])
    key = ["shingle", "lo", "hi"]
    votes = both.groupBy(*key, "label").agg(F.count("*").alias("c"))
    most = votes.groupBy(*key).agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.count("*").alias("labels"))
    both = both.join(most.where("labels > 1"), key)
    often = F.col("label") == F.col("most")
    # of the label with most rows the small ones meet the others only, and the large ones likewise
    x = both.where("role = 'small'").select("*", F.explode(F.when(often, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("g"))
    y = both.where("role = 'large'").select("*", F.when(often, 1).otherwise(0).alias("g"))
    x, y = x.alias("x"), y.alias("y")
    same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in [*key, "g"]]
    ordered = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))
    return x.join(y, reduce(lambda c, d: c & d, same) & ordered)


def _close(met: DataFrame, shape: Shape) -> DataFrame:
    """The pairs (a, b) of different labels that place, size and sketch leave open."""
    n, m = F.col("x.n"), F.col("y.n")
    # of the shingles at and after the two places no more can be shared
    most = F.least(F.col("x.place"), F.col("y.place")) + F.least(n - F.col("x.place"), m - F.col("y.place"))
    most = F.least(most, F.floor((n + m - _differ("x", "y")) / 2))
    return (
        met.where((F.col("x.label") != F.col("y.label")) & _sized(n, m, shape.threshold) & _alike(most, n, m, shape.threshold))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )


def links(marks: DataFrame, texts: DataFrame, shape: Shape) -> DataFrame:
    """Links (a, b) between texts with different shingle sets that connect all that are similar.

    `marks` has id and a signer's columns, a row for each set; `texts` id and text. Not every
    similar pair is a link: one that links already connect may be left out.
    """
    rows = marks.select("id", "n", F.explode("bands").alias("band"))
    shared = write_and_read(_shared(rows, "band", F.xxhash64("id", "band")), "bands")
    edges = settled(lambda: _verified(_stars(shared, shape.threshold), texts, shape), "links")
    return settled(lambda: _rest(_members(shared).select("id", "n", "band"), marks, texts, edges, shape), "links")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", shape: Shape = DOCUMENTS) -> DataFrame:
    """Per row of `docs`: the id, n_shingles and component_id, the smallest id it is linked with.

    Texts without words have no shingles and are linked with nothing. Rows without an
    id are counted but linked with nothing (component_id null). Rows that repeat an id
    count as one document if their texts agree; give ids that name one text each.
    Null texts count as empty. Columns of `docs` other than id and text do not matter.
    """
    texts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = write_and_read(texts.select("id", signer(shape)("text").alias("s")).select("id", "s.*"), "signatures")
    known = marks.where(F.col("id").isNotNull() & (F.col("n") > 0))
    same = write_and_read(known.groupBy("key_a", "key_b").agg(F.min("id").alias("rep")), "sets")
    nodes = known.join(same.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"])
    edges = links(nodes, texts, shape)
    named = same.join(components(edges).withColumnRenamed("node", "rep"), "rep", "left").select(
        "key_a", "key_b", F.coalesce("component", "rep").alias("component")
    )
    return marks.join(named, ["key_a", "key_b"], "left").select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component")))
        .otherwise(F.col("id"))
        .alias("component_id"),
    )


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the documents that are not the first of their class; rows without an id stay."""
    gone = settled(lambda: classes(docs, id, text).where(F.col(id) != F.col("component_id")).select(id).distinct(), "gone")
    return docs.join(gone, id, "left_anti")


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = classes(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
