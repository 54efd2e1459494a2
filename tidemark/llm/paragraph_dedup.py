"""Substring dedup by paragraph MinHash banding.

Paragraphs are the lines of a text with at least MIN_WORDS words. Bands are tuned for
recall, paragraphs that meet in a band are compared exactly (Jaccard similarity of
their shingle sets, or edit distance of words), and of each connected component the
first paragraph, by document and place, stays.

What is left is searched for passages of PASSAGE words that a document with a smaller
id has, too, within longer lines, over short ones or broken elsewhere (`passages`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm import passages
from tidemark.llm.graph import components
from tidemark.llm.minhash_dedup import Shape, links, signer
from tidemark.llm.passages import PASSAGE
from tidemark.llm.words import SPACED, Hasher, Words, chunks, find_words, lists, mix, released, utf8, windows
from tidemark.session import settled, write_and_read, write_by_key

NAME = "op8_paragraph_dedup"
SQL = None

#: shorter lines are headings, refrains and list items, and stay
MIN_WORDS = 15
THRESHOLD = 80
#: the most that tuned bands may miss of pairs with just the wanted similarity
MISS = 1e-6
COORDINATES = 160
#: single coordinates that a paragraph must share with others to be signed; one alone is mostly shared by chance
MET = 2


def tuned(threshold: int = THRESHOLD, miss: float = MISS, coordinates: int = COORDINATES) -> Shape:
    """The longest bands, and the fewest of them, that miss no more than half of `miss` with so many coordinates."""
    t = threshold / 100
    for rows in range(coordinates, 0, -1):
        for bands in range(1, coordinates // rows + 1):
            if (1 - t**rows) ** bands <= miss / 2:
                return Shape(threshold, bands, rows)
    raise ValueError("too few coordinates for that recall")


def screening(threshold: int = THRESHOLD, miss: float = MISS) -> int:
    """Single coordinates of which a pair of that similarity shares MET, but for half of `miss`."""
    t = threshold / 100
    fewer = lambda k: sum(math.comb(k, x) * t**x * (1 - t) ** (k - x) for x in range(MET))
    return next(k for k in range(MET, 1000) if fewer(k) <= miss / 2)


_SCREENED = ArrayType(
    StructType(
        [
            StructField("place", IntegerType()),
            StructField("n", LongType()),
            StructField("key_a", LongType()),
            StructField("key_b", LongType()),
            StructField("single", ArrayType(LongType())),
        ]
    )
)


def _circulant64(x: np.ndarray, k: int) -> np.ndarray:
    """Coordinate k of scattered 64-bit shingles: its least value tells the shingle itself."""
    x = (x + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xCA5A826395121157)


def _screened(data: np.ndarray, bounds: np.ndarray, hasher: Hasher, shingle: int, screen: int, min_words: int) -> tuple:
    """Of the lines with at least `min_words` words: which they are, size, two halves of the key, and coordinates.

    One sort brings each line's shingles in order, 44 bits of each, which keep the sets of one line apart.
    """
    words = find_words(data, bounds, SPACED)
    long = (words.counts >= min_words)[words.text]
    words = Words(words.starts[long], words.ends[long], words.text[long], words.bounds)
    runs, at = windows(words, hasher.ranges(data, words.starts, words.ends), shingle)
    if not len(runs):
        return *[np.zeros(0, np.int64)] * 4, np.zeros((0, screen), np.int64)
    every = np.sort(words.text[at].astype(np.uint64) << np.uint64(44) | runs >> np.uint64(20))
    every = every[np.r_[True, every[1:] != every[:-1]]]
    line = (every >> np.uint64(44)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    with np.errstate(over="ignore"):
        shingles = mix(every & np.uint64((1 << 44) - 1))
        key_a = np.add.reduceat(shingles, starts)
        key_b = np.bitwise_xor.reduceat(mix(shingles + np.uint64(1)), starts)
        single = [
            mix(np.minimum.reduceat(_circulant64(shingles, k), starts) + np.uint64(k)) for k in range(screen)
        ]
    sizes = np.diff(np.r_[starts, len(every)])
    return line[starts], sizes, key_a.view(np.int64), key_b.view(np.int64), np.stack(single, axis=1).view(np.int64)


def screener(shingle: int, screen: int, min_words: int):
    """A column function: of each text's lines with at least `min_words` words the number (from 0), and size, key
    and `screen` single coordinates of the shingle set. Lines of about CHUNK bytes are worked on together."""

    @F.arrow_udf(_SCREENED)
    def screened(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for texts in released(batches):
            data, offsets = utf8(texts)
            breaks = np.flatnonzero(data == ord("\n"))
            # where lines start, of all texts; an empty one at the end of a text starts as the next text does
            edges = np.unique(np.r_[offsets, breaks + 1])
            found = []
            for a, b in chunks(edges):
                part, bounds = data[edges[a] : edges[b]], edges[a : b + 1] - edges[a]
                line, *rest = _screened(part, bounds, hasher, shingle, screen, min_words)
                found.append((edges[a + line], *rest))
            if not found:
                found = [(*[np.zeros(0, np.int64)] * 4, np.zeros((0, screen), np.int64))]
            starts, n, key_a, key_b, single = (np.concatenate(c) for c in zip(*found, strict=True))
            of = np.searchsorted(offsets, starts, "right") - 1
            place = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[of])
            rows = pa.StructArray.from_arrays(
                [pa.array(place, pa.int32()), *[pa.array(c, pa.int64()) for c in (n, key_a, key_b)], lists(list(single))],
                names=_SCREENED.elementType.names,
            )
            yield pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(offsets))), pa.int32()), rows)

    return screened


def _texts(docs: DataFrame, id: str, text: str, placed: DataFrame) -> DataFrame:
    """Id and text of the paragraphs in `placed` (id, doc, part, place)."""
    wanted = placed.groupBy("doc").agg(F.collect_list(F.struct("part", "place", "id")).alias("wanted"))
    whole = docs.select(F.col(id).alias("doc"), F.xxhash64(text).alias("part"), F.col(text).alias("whole"))
    own = F.filter("wanted", lambda w: w["part"] == F.col("part"))
    lines = whole.join(wanted.hint("shuffle_hash"), "doc").select(F.split("whole", "\n").alias("lines"), F.explode(own).alias("w"))
    return lines.select("w.id", F.get("lines", F.col("w.place")).alias("text"))


def repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, shape: Shape | None = None
) -> DataFrame:
    """Paragraphs that go: doc, and the numbers of the lines that are not the first of their component.

    All paragraphs are numbered and screened; only those that share MET single coordinates
    with ones of other texts are signed, banded and compared.
    """
    shape = shape or tuned()
    if min_words < shape.shingle:
        raise ValueError("a paragraph needs the words of a shingle")
    known = docs.where(F.col(id).isNotNull())
    screened = screener(shape.shingle, screening(shape.threshold), min_words)(text)
    # rows that repeat an id may have other texts: part tells them apart
    marks = write_and_read(
        known.select(F.col(id).alias("doc"), F.xxhash64(text).alias("part"), screened.alias("s"))
        .select("doc", "part", F.inline("s"))
        .withColumn("id", F.monotonically_increasing_id()),
        "paragraphs",
    )
    # equal sets have equal coordinates
    same = write_and_read(
        marks.groupBy("key_a", "key_b").agg(
            F.min("id").alias("rep"),
            F.min(F.struct("doc", "place")).alias("first"),
            F.count("*").alias("copies"),
            F.any_value("single").alias("single"),
        ),
        "sets",
    )
    single = same.select(F.col("rep").alias("id"), F.explode("single").alias("single"))
    often = single.withColumn("c", F.count("*").over(Window.partitionBy("single"))).where("c > 1")
    met = write_and_read(often.groupBy("id").count().where(F.col("count") >= MET).select("id"), "met")
    placed = marks.select("id", "doc", "part", "place").join(met, "id", "left_semi")
    # a row that repeats a document and its text gives its paragraphs the same ids once more
    texts = write_and_read(_texts(docs, id, text, placed), "texts")

    def classes() -> DataFrame:
        signed = write_and_read(texts.select("id", signer(shape)("text").alias("s")).select("id", "s.*"), "signatures")
        named = components(links(signed, texts, shape)).withColumnRenamed("node", "rep")
        # a paragraph without copies and links stays
        open_ = same.drop("single").join(named, "rep", "left").where("component is not null or copies > 1")
        return open_.withColumn("component", F.coalesce("component", "rep"))

    classes = settled(classes, "classes")
    firsts = classes.groupBy("component").agg(F.min("first").alias("stays"))
    sets = classes.join(firsts, "component").select("key_a", "key_b", "stays")
    return (
        marks.join(sets, ["key_a", "key_b"])
        .where((F.col("doc") != F.col("stays.doc")) | (F.col("place") != F.col("stays.place")))
        .groupBy("doc")
        .agg(F.collect_set("place").alias("gone"))
    )


def dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    shape: Shape | None = None,
    passage: int = PASSAGE,
) -> DataFrame:
    """`docs` with the repeated paragraphs and passages taken out of their texts, and with n_paragraphs
    (lines of any length) and n_removed (whole lines, and stretches of passages in what they left).

    First whole lines go and what stays is joined as it was; then passages of `passage`
    words that a document with a smaller id still has. A null or empty text stays; rows
    without an id are neither compared nor changed; rows that repeat an id are one
    document and changed alike. Columns named as the two new ones are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_paragraphs", "n_removed")]
    # columns without a type cannot be written
    void = [c for c, kind in docs.select(*columns).dtypes if kind == "void"]
    # dealt by id once: the joins with what is found move no text
    docs = write_by_key(docs.select(*[c for c in columns if c not in void]), id, "documents")
    gone = settled(lambda: repeats(docs, id, text, min_words, shape), "gone")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda line, k: ~F.array_contains("_gone", k))
    left = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    gone = gone.select(F.col("doc").alias("_doc"), F.col("gone").alias("_gone")).hint("shuffle_hash")
    joined = docs.join(gone, F.col(id) == F.col("_doc"), "left")
    texts = docs.select(id, text).join(gone, F.col(id) == F.col("_doc"), "left").select(F.col(id).alias("doc"), left.alias("text"))
    # so many words have at least so many characters in and between them
    long = texts.where(F.col("doc").isNotNull() & (F.length("text") >= 2 * passage - 1))
    long = long.select("doc", F.xxhash64("text").alias("part"), "text")
    changed = settled(lambda: passages.repeated(write_by_key(long, "doc", "left", dealt=True), passage), "changed")
    if changed is None:
        joined = joined.withColumn("_cut", F.lit(None).cast("struct<text: string, n: bigint>"))
    else:
        # rows that repeat an id may have other texts
        parts = changed.groupBy(F.col("doc").alias("_changed")).agg(F.collect_set(F.struct("part", "text", "n")).alias("_parts"))
        own = F.filter("_parts", lambda p: p["part"] == F.xxhash64(left))
        joined = joined.join(parts.hint("shuffle_hash"), F.col(id) == F.col("_changed"), "left").withColumn("_cut", F.get(own, 0))
    return joined.select(
        *[F.coalesce("_cut.text", left).alias(text) if c == text else F.lit(None).alias(c) if c in void else F.col(c) for c in columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_paragraphs"),
        (F.coalesce(F.size("_gone"), F.lit(0)) + F.coalesce("_cut.n", F.lit(0))).cast("long").alias("n_removed"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return dedup(docs).select("doc_id", "n_paragraphs", "n_removed", F.sha2("text", 256).alias("kept_sha256"), "text")
