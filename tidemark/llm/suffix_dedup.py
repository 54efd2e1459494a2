"""Suffix-array dedup by column-wise construction over collections of strings.

A byte goes if a string of LENGTH bytes over it also starts earlier. To bring equal
strings together, every string of LENGTH bytes is put down to its anchor, the k-gram
in it with the least hash: equal strings have equal anchors at the same place in
them. The strings of a text with the same anchor lie next to each other and make a
region. Regions whose anchor is met again form, by anchor, collections of aligned
strings; for each the sorted order of all suffixes and their common prefixes are
built column by column from the right: every round inserts one symbol of every
string, as the stable sort of the order before by that symbol (the last-to-first
step of the Burrows-Wheeler transform), and takes the common prefix of neighbours as
one more than the least between their former places. Suffixes with LENGTH bytes in
common are equal strings, all but the first of which go.

Copies of a region are one string of a collection. What stands between the stages is
written in sequence to the shared folder; a collection holds about COLLECTION strings,
whole anchors each, and anchors with more regions than that are settled string by
string (`_crowded`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tidemark.llm.words import _BASE, _BASE_INVERSE, _CODES, chunks, mix, utf8
from tidemark.session import write_and_read

NAME = "op5_suffix_dedup"
SQL = None

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1  # anchors to choose from
COLLECTION = 50_000

_U = np.uint64
_REGION = pa.struct(
    [("anchor", pa.int64()), ("region", pa.int64()), ("start", pa.int64()), ("size", pa.int32()), ("off", pa.int32())]
)
_REGIONS = ArrayType(
    StructType.fromJson(
        {
            "type": "struct",
            "fields": [
                {"name": n, "type": t, "nullable": True, "metadata": {}}
                for n, t in (
                    ("anchor", "long"),
                    ("region", "long"),
                    ("start", "long"),
                    ("size", "integer"),
                    ("off", "integer"),
                )
            ],
        }
    )
)


class Sums:
    """Running sums of code x base^position, from which the hash of any range is a difference."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, _U)

    def of(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        with np.errstate(over="ignore"):
            if n > len(self.powers):
                self.powers = np.multiply.accumulate(np.r_[_U(1), np.full(n - 1, _BASE, _U)])
                self.inverses = np.multiply.accumulate(np.r_[_U(1), np.full(n - 1, _BASE_INVERSE, _U)])
            sums = np.zeros(n, _U)
            np.cumsum(_CODES[data] * self.powers[: n - 1], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(_U))


def _sliding_least(keys: np.ndarray, span: int) -> np.ndarray:
    """The least of every `span` consecutive keys, from running minima of blocks in both directions."""
    n = len(keys) - span + 1
    blocks = -(-len(keys) // span)
    padded = np.full(blocks * span, np.iinfo(_U).max, _U)
    padded[: len(keys)] = keys
    rows = padded.reshape(blocks, span)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[span - 1 : span - 1 + n])


def find_regions(data: np.ndarray, offsets: np.ndarray, sums: Sums) -> tuple[np.ndarray, ...]:
    """Regions of some texts: text, hash of the anchor, hash of the region, start, strings, place of the anchor."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    running = sums.of(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = sums.ranges(running, at, at + GRAM)
    least = _sliding_least((grams >> _U(32) << _U(32)) | at.astype(_U), SPAN)
    anchor = (least & _U(0xFFFFFFFF)).astype(np.int64)
    edges = np.zeros(n + 1, np.int32)
    low = offsets[:-1]
    high = np.maximum(low, offsets[1:] - LENGTH + 1)
    np.add.at(edges, low[high > low], 1)
    np.add.at(edges, high[high > low], -1)
    valid = np.cumsum(edges[:-1]) > 0
    same = (anchor[1:] == anchor[:-1]) & valid[1:] & valid[:-1]
    first = np.flatnonzero(valid & np.r_[True, ~same])
    last = np.flatnonzero(valid & np.r_[~same, True])
    text = np.searchsorted(offsets, first, "right") - 1
    # the end of one text and the start of the next are never one region
    region = sums.ranges(running, first, last + LENGTH)
    return (
        text,
        grams[anchor[first]].view(np.int64),
        region.view(np.int64),
        first - offsets[text],
        last - first + 1,
        anchor[first] - first,
    )


@F.arrow_udf(_REGIONS)
def _regions(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    sums = Sums()
    for texts in batches:
        data, offsets = utf8(texts)
        parts = []
        for a, b in chunks(offsets):
            found = find_regions(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], sums)
            parts.append((found[0] + a, *found[1:]))
        text, *columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 6
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        rows = pa.StructArray.from_arrays(
            [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, _REGION, strict=True)],
            fields=list(_REGION),
        )
        yield pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows)


@F.arrow_udf(ArrayType(BinaryType()))
def _cut(texts: pa.Array, starts: pa.Array, sizes: pa.Array) -> pa.Array:
    """The bytes of regions."""
    data, offsets = utf8(texts)
    raw = data.tobytes()
    return pa.array(
        [
            [raw[o + s : o + s + n + LENGTH - 1] for s, n in zip(ss, ns, strict=True)]
            for o, ss, ns in zip(offsets[:-1].tolist(), starts.to_pylist(), sizes.to_pylist(), strict=True)
        ],
        pa.list_(pa.binary()),
    )


def repeated_columns(strings: list[bytes], off: np.ndarray, size: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which strings of LENGTH bytes of aligned regions stand in a region before.

    strings: regions with their anchors at one column; off: bytes before the anchor;
    size: strings in each; order: the regions by first occurrence. A row per region, a
    column per place from SPAN - 1 bytes before the anchor up to the anchor.
    """
    m, width = len(strings), SPAN - 1 + LENGTH
    padded = b"".join(
        [bytes(x) + s + bytes(width - x - len(s)) for x, s in zip((SPAN - 1 - off).tolist(), strings, strict=True)]
    )
    cells = np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(m, width).T)
    del padded
    out = np.zeros((m, SPAN), bool)
    rank = np.arange(m)  # the sorted order of the suffixes from the present column on
    common = np.full(m + 1, width, np.int32)  # bytes each shares with the one before it
    common[0] = -1
    for column in range(width - 1, -1, -1):
        symbol = cells[column, rank]
        moved = np.argsort(symbol, kind="stable")
        rank = rank[moved]
        symbol = symbol[moved]
        joined = symbol[1:] == symbol[:-1]
        before, after = moved[:-1][joined] + 1, moved[1:][joined] + 1
        fresh = np.full(m + 1, -1, np.int32)
        if len(before):
            fresh[1:m][joined] = np.minimum.reduceat(common, np.stack([before, after], 1).ravel())[::2] + 1
        fresh[1:m][~joined] = 0
        common = fresh
        if column < SPAN:
            valid = (SPAN - 1 - off <= column) & (column < SPAN - 1 - off + size)
            begins = np.flatnonzero(common[:m] < LENGTH)
            place = np.where(valid[rank], order[rank], m)
            least = np.repeat(np.minimum.reduceat(place, begins), np.diff(np.r_[begins, m]))
            out[rank, column] = valid[rank] & (place > least)
    return out


_RUN = StructType([StructField("first", LongType()), StructField("last", LongType())])
_FOUND = StructType(
    [
        StructField("anchor", LongType()),
        StructField("region", LongType()),
        StructField("off", LongType()),
        StructField("size", LongType()),
        StructField("runs", ArrayType(_RUN)),
    ]
)


def _settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Repeated runs of strings (counted from the region's start) of the regions of whole anchors."""
    table = pa.Table.from_batches(rows)
    get = {c: table[c].to_numpy() for c in ("anchor", "region", "off", "size", "doc", "start")}
    order = np.empty(len(table), np.int64)
    order[np.lexsort((get["start"] + get["off"], get["doc"]))] = np.arange(len(table))
    off, size = get["off"].astype(np.int64), get["size"].astype(np.int64)
    out = repeated_columns(table["bytes"].to_pylist(), off, size, order)
    step = np.diff(np.pad(out.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(step == 1)
    last = np.nonzero(step == -1)[1] - 1
    base = (SPAN - 1 - off)[row]
    hit, counts = np.unique(row, return_counts=True)
    runs = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], names=["first", "last"])
    return pa.RecordBatch.from_arrays(
        [
            *[pa.array(get[c][hit].astype(np.int64)) for c in ("anchor", "region", "off", "size")],
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), runs),
        ],
        names=["anchor", "region", "off", "size", "runs"],
    )


def _collections(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by anchor: whole anchors are gathered up to about `limit` regions."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            cuts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
            at = 0
            if held and size >= limit and len(anchors) and held[-1].column("anchor")[-1].as_py() != anchors[0]:
                yield _settle(held)
                held, size = [], 0
            while size + len(anchors) - at >= limit:
                later = cuts[(cuts > at) & (size + cuts - at >= limit)]
                if not len(later):
                    break
                held.append(batch.slice(at, int(later[0]) - at))
                yield _settle(held)
                held, size, at = [], 0, int(later[0])
            if at < len(anchors):
                held.append(batch.slice(at))
                size += len(anchors) - at
        if held:
            yield _settle(held)

    return run


_KEY = ("anchor", "region", "off", "size")
_WINDOWS = StructType([StructField("at", LongType()), StructField("hash_a", LongType()), StructField("hash_b", LongType())])


@F.arrow_udf(ArrayType(_WINDOWS))
def _strings(regions: pa.Array) -> pa.Array:
    """The hashes (128 bits) of the strings of LENGTH bytes of each region."""
    out = []
    for raw in regions.to_pylist():
        rows = []
        for at in range(len(raw) - LENGTH + 1):
            digest = hashlib.blake2b(raw[at : at + LENGTH], digest_size=16).digest()
            rows.append(
                {
                    "at": at,
                    "hash_a": int.from_bytes(digest[:8], "little", signed=True),
                    "hash_b": int.from_bytes(digest[8:], "little", signed=True),
                }
            )
        out.append(rows)
    return pa.array(out, pa.list_(pa.struct([("at", pa.int64()), ("hash_a", pa.int64()), ("hash_b", pa.int64())])))


def _crowded(regions: DataFrame) -> DataFrame:
    """The same rows for anchors with more regions than a collection holds: a group for each string."""
    flat = regions.select(*_KEY, "doc", "start", F.explode(_strings("bytes")).alias("s")).select(
        *_KEY, F.struct("doc", (F.col("start") + F.col("s.at")).alias("pos")).alias("place"), "s.*"
    )
    first = flat.groupBy("hash_a", "hash_b").agg(F.min("place").alias("least"), F.count("*").alias("c")).where("c > 1")
    gone = flat.join(first.drop("c"), ["hash_a", "hash_b"]).where("place > least")
    run = F.struct(F.col("at").alias("first"), F.col("at").alias("last"))
    return gone.groupBy(*_KEY).agg(F.array_sort(F.collect_list(run)).alias("runs"))


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", collection: int = COLLECTION) -> DataFrame:
    """Ranges of bytes that go: doc, first, last (excluded); they may overlap."""
    known = docs.where(F.col(id).isNotNull() & (F.octet_length(text) >= LENGTH)).select(
        F.col(id).cast("long").alias("doc"), F.col(text).alias("text")
    )
    # read twice: all regions would be most of the space that the job takes
    every = known.select("doc", F.explode(_regions("text")).alias("r")).select("doc", "r.*")
    often = every.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    met = write_and_read(every.join(often, "anchor"), "met")
    one = write_and_read(met.groupBy(*_KEY).agg(F.min(F.struct("doc", "start")).alias("at")), "firsts")
    wanted = one.groupBy("at.doc").agg(F.sort_array(F.collect_list(F.struct("at.start", *_KEY))).alias("w"))
    texts = known.join(wanted, "doc").dropDuplicates(["doc"])
    cut = texts.select("doc", F.explode(F.arrays_zip("w", _cut("text", "w.start", "w.size").alias("bytes"))).alias("x"))
    cut = write_and_read(cut.select("doc", "x.w.*", "x.bytes"), "strings")
    crowds = cut.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > collection).select("anchor")
    crowds = write_and_read(crowds, "crowds")
    usual = cut.join(crowds, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    order = [*_KEY, "doc", "start", "bytes"]
    found = usual.select(*order).mapInArrow(_collections(collection), _FOUND)
    rest = _crowded(cut.join(crowds, "anchor", "left_semi")).select(
        *[F.col(c).cast("long").alias(c) for c in _KEY], F.col("runs").cast(ArrayType(_RUN)).alias("runs")
    )
    found = write_and_read(found.union(rest), "runs")
    # the first occurrence of a region loses its repeated strings, every other all of them
    placed = met.join(one, list(_KEY))
    again = placed.where((F.col("doc") != F.col("at.doc")) | (F.col("start") != F.col("at.start"))).select(
        "doc", F.col("start").alias("first"), (F.col("start") + F.col("size") + LENGTH - 1).alias("last")
    )
    firsts = (
        one.join(found, list(_KEY))
        .select("at.doc", "at.start", F.explode("runs").alias("r"))
        .select("doc", (F.col("start") + F.col("r.first")).alias("first"), (F.col("start") + F.col("r.last") + LENGTH).alias("last"))
    )
    return again.union(firsts)


_KEPT = StructType(
    [
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("n_spans", LongType()),
        StructField("kept_sha256", StringType()),
    ]
)


def _merged(ranges: list[dict] | None) -> list[list[int]]:
    out: list[list[int]] = []
    for r in ranges or ():  # sorted
        if out and r["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["last"])
        else:
            out.append([r["first"], r["last"]])
    return out


def _keep(raw: bytes, spans: list[list[int]]) -> bytes:
    at, parts = 0, []
    for first, last in spans:
        parts.append(raw[at:first])
        at = last
    return b"".join([*parts, raw[at:]])


@F.arrow_udf(_KEPT)
def _digest(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    data, offsets = utf8(texts)
    rows = []
    for a, b, found in zip(offsets[:-1].tolist(), offsets[1:].tolist(), ranges.to_pylist(), strict=True):
        raw, spans = data[a:b].tobytes(), _merged(found)
        rows.append(
            {
                "n_bytes": len(raw),
                "n_removed": sum(y - x for x, y in spans),
                "n_spans": len(spans),
                "kept_sha256": hashlib.sha256(_keep(raw, spans)).hexdigest(),
            }
        )
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.array(rows, pa.struct(list(zip(_KEPT.names, types, strict=True))))


@F.arrow_udf(BinaryType())
def _left(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    data, offsets = utf8(texts)
    return pa.array(
        [
            _keep(data[a:b].tobytes(), _merged(found))
            for a, b, found in zip(offsets[:-1].tolist(), offsets[1:].tolist(), ranges.to_pylist(), strict=True)
        ],
        pa.binary(),
    )


def mark(docs: DataFrame, id: str = "doc_id", text: str = "text", collection: int = COLLECTION) -> DataFrame:
    """`docs` with `gone`: the byte ranges of each text that stand earlier too (null: none), sorted, maybe overlapping.

    Ids are integers. Null and short texts lose nothing; rows without an id are neither
    compared nor changed; rows that repeat an id are one document and should agree in
    their text. Other columns are kept; one named `gone` is replaced.
    """
    docs = docs.drop("gone")
    ranges = repeats(docs, id, text, collection)
    spans = ranges.groupBy(F.col("doc").alias("_doc")).agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("gone")
    )
    return docs.join(spans, F.col(id).cast("long") == F.col("_doc"), "left").drop("_doc")


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `kept`, the bytes that are left of each text (a cut may fall inside a character)."""
    return mark(docs, id, text).withColumn("kept", _left(F.col(text), F.col("gone"))).drop("gone")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return mark(docs).select("doc_id", _digest("text", "gone").alias("d")).select("doc_id", "d.*")
