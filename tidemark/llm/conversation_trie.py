"""The prefix trie of conversations, by a splitter skeleton.

Every conversation is a path of turn digests. Sorted by path and cut at splitters into
shards, a node of the trie (a path's beginning) stands in one shard, unless it begins
the path of a splitter: the rows before and after a cut share only such nodes. So

1. splitters are picked from a sample of paths with their conversation ids (equal paths
   are cut as well, by id). Their sorted paths are broadcast: the trie of these, the skeleton.
   Of it a shard meets only the paths of the cuts at its two ends;
2. every sorted shard goes through its paths once, with the open path on a stack. A node
   that is left behind is finished, with the sums of its subtree, unless it belongs to the
   skeleton: then the shard gives out what it knows of it, a partial aggregate;
3. the partial aggregates are reduced by node, and the sums of skeleton nodes go up to all
   skeleton nodes above them. The skeleton is small: its nodes are those of the splitters.

A task holds the open path, and of open nodes outside the skeleton the finished children.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.merkle_manifest import crc32_sql
from tidemark.llm.places import numbered
from tidemark.session import write_and_read

NAME = "op13_conversation_trie"

#: rows of a shard, about, and the most shards: they bound the splitters that are broadcast
SHARD = 1 << 10
MOST_SHARDS = 4096
#: sampled rows for each splitter
SAMPLE = 50
#: bytes of a turn's digest
WIDTH = 16
#: conversation ids are handed on as text in pieces of about so many bytes
PIECE = 1 << 20

#: conversations that share a beginning come in families of ids, and take up to MOST - 1 turns from the first of them
FAMILY, MOST = 100, 6

_TURNS = "array<struct<digest: binary, chars: long>>"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and the turns (digest of role and text, code points of the text) in order, of each conversation.

    By turn, null first; turns with the same number by their digests. A null role or text is empty. Rows without a
    conv_id belong to no conversation and are left out. The digest is the first 16 bytes of a SHA-256.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("_turn"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    return ordered.select("conv_id", F.transform("_turns", lambda t: F.struct(t["digest"], t["chars"])).cast(_TURNS).alias("turns"))


def rebuilt(found: DataFrame) -> DataFrame:
    """`found` with the first h turns of each from the first conversation of its family, its own after these."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST).cast("int")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    found = write_and_read(found.withColumns({"_h": h, "_family": first}), "trie-turns")
    # at most a hundredth of the conversations, each met by its family alone
    heads = found.where(F.col("conv_id") == F.col("_family")).select(
        F.col("conv_id").alias("_head"), F.slice("turns", 1, MOST - 1).alias("_begins")
    )
    met = found.join(heads, F.col("_family") == F.col("_head"), "left")
    none = F.array().cast(_TURNS)
    begins = F.when(F.col("_h") > 0, F.slice(F.coalesce("_begins", none), F.lit(1), F.greatest("_h", F.lit(1)))).otherwise(none)
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return met.select("conv_id", F.concat(begins, own).alias("turns"))


def splitters(rows: DataFrame, shard: int, most: int) -> list[tuple[bytes, int]]:
    """Cuts between about equally many `rows` (path, conv_id), taken from a sorted sample. Any cuts give the same
    trie; they only balance the work. At most `most` - 1 rows come to the driver."""
    total = rows.count()
    shards = min(most, -(-total // shard))
    if shards < 2:
        return []
    share = min(1.0, SAMPLE * shards / total)
    seen = rows.select(F.lit(0).alias("_all"), "path", "conv_id")
    ordered = numbered(seen.sample(share, seed=1) if share < 1 else seen, "_all", ["path", "conv_id"], "trie-sample")
    place = F.ceil(F.col("_pos") * shards / F.col("_n"))  # the first row at or after each cut
    first = ordered.where((place > 0) & (F.ceil((F.col("_pos") - 1) * shards / F.col("_n")) < place) & (place < shards))
    return sorted({(bytes(r["path"]), r["conv_id"]) for r in first.select("path", "conv_id").collect()})


def _shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their beginnings."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // WIDTH
    x, y = np.frombuffer(a, np.uint8, most), np.frombuffer(b, np.uint8, most)
    return int((x != y).argmax()) // WIDTH


_ROOT = bytes(WIDTH)


class _Node:
    """An open node: its key (a digest of the path to it), sums over what is finished below, its own members."""

    __slots__ = ("key", "line", "chars", "skeleton", "n_convs", "least", "n_children", "leaves", "saved", "children", "ends")

    def __init__(self, key: bytes, line: bytes, chars: int, skeleton: bool):
        self.key, self.chars, self.skeleton = key, chars, skeleton
        self.line = line + key if skeleton else b""  # the keys from the root on
        self.n_convs, self.least = 0, None
        self.n_children = self.leaves = self.saved = 0
        self.children: list[tuple] = []
        self.ends = _Ends(keep=skeleton)


class _Ends:
    """Ids of the conversations that end at a node, in order: hashed, or kept as pieces of text to be hashed later."""

    def __init__(self, keep: bool):
        self.sha, self.any = hashlib.sha256(), False
        self.keep, self.text, self.size = keep, [], 0

    def add(self, conv_id: int) -> str | None:
        if not self.keep:
            self.sha.update(f",{conv_id}".encode() if self.any else f"{conv_id}".encode())
            self.any = True
            return None
        self.text.append(str(conv_id))
        self.size += len(self.text[-1]) + 1
        return self.piece() if self.size >= PIECE else None

    def piece(self) -> str | None:
        out = ",".join(self.text) if self.text else None
        self.text, self.size = [], 0
        return out


#: rows of the trie pass. Kinds: node (finished; key is that of its parent, if that belongs to the skeleton), part (what
#: a shard knows of a skeleton node, with the keys of the line to it), ends (a piece of the ids that end at one)
_FIELDS = [
    ("kind", pa.string()),
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
    ("key", pa.binary()),
    ("line", pa.binary()),
    ("chars", pa.int64()),
    ("shard", pa.int32()),
    ("piece", pa.int64()),
    ("ids", pa.string()),
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key binary, line binary, chars long, shard int, piece long, ids string"
)
_BATCH = 10_000


class _Pass:
    """Goes through the sorted paths of one shard after another; `rows` holds what is to be given out."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.cuts, self.stack, self.rows = cuts, [], []
        self.shard, self.pieces, self.path = None, 0, b""
        self.beside: list[bytes] = []

    def _finish(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        depth = len(self.stack)
        if node.skeleton:
            self._piece(node, node.ends.piece())
            part = ("part", node.least, depth, None, node.n_convs, node.n_children, node.leaves, node.saved, None)
            self.rows.append((*part, node.key, node.line, node.chars, self.shard, None, None))
            return  # all above belong to the skeleton, too, and count it when the skeleton is reduced
        leaves = node.leaves if node.n_children else 1
        saved = node.saved + (node.n_convs - 1) * node.chars
        for child in node.children:
            self.rows.append((*child[:3], node.least, *child[4:]))
        done = ("node", node.least, depth, None, node.n_convs, node.n_children, leaves, saved, node.ends.sha.hexdigest())
        rest = (None, None, self.shard, None, None)
        if above is None:  # a root outside the skeleton: the only shard
            self.rows.append((*done, None, *rest))
            return
        above.n_children += 1
        above.leaves += leaves
        above.saved += saved
        if above.skeleton:
            self.rows.append((*done, above.key, *rest))
        else:
            above.children.append((*done, None, *rest))

    def _piece(self, node: _Node, text: str | None) -> None:
        if text is not None:
            self.rows.append(("ends", *[None] * 8, node.key, None, None, self.shard, self.pieces, text))
            self.pieces += 1

    def end(self) -> None:
        while self.stack:
            self._finish()

    def _begin(self, shard: int) -> None:
        """Of the splitters' trie a shard meets the paths of the cuts at its two ends."""
        self.end()
        self.shard, self.pieces, self.path = shard, 0, b""
        self.beside = [path for path, _ in self.cuts[max(shard - 1, 0) : shard + 1]]
        self.stack.append(_Node(_ROOT, b"", 0, bool(self.cuts)))

    def add(self, shard: int, path: bytes, chars: list[int], conv_id: int) -> None:
        if shard != self.shard:
            self._begin(shard)
        common = _shared_turns(self.path, path)
        while len(self.stack) - 1 > common:
            self._finish()
        if len(chars) > common:
            skeleton = max((_shared_turns(cut, path) for cut in self.beside), default=0)
            for d in range(common, len(chars)):
                above = self.stack[-1]
                key = hashlib.sha256(above.key + path[d * WIDTH : (d + 1) * WIDTH]).digest()[:WIDTH]
                self.stack.append(_Node(key, above.line, chars[d], d < skeleton))
        self.path = path
        for node in self.stack:
            node.n_convs += 1
            node.least = conv_id if node.least is None else min(node.least, conv_id)
        self._piece(self.stack[-1], self.stack[-1].ends.add(conv_id))

    def taken(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], schema=_SCHEMA)
            self.rows = []


def _walk(cuts):
    """The trie pass over sorted rows (shard, path, chars, conv_id)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Pass(cuts.value)
        for batch in batches:
            for at in range(batch.num_rows):
                found.add(*(batch.column(k)[at].as_py() for k in range(4)))
                yield from found.taken(_BATCH)
        found.end()
        yield from found.taken()

    return walk


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The SHA-256 of the ids of each skeleton node, from pieces that come in order."""
    now, sha = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch["key"], batch["ids"], strict=True):
            if key != now:
                if sha:
                    done.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["key", "ends_sha256"])
    if sha:
        yield pd.DataFrame([(now, sha.hexdigest())], columns=["key", "ends_sha256"])


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_NO_IDS = hashlib.sha256(b"").hexdigest()


def _skeleton_nodes(given: DataFrame) -> DataFrame:
    """The finished skeleton nodes, with their keys, from all shards' partial aggregates."""
    parts = given.where("kind = 'part'").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("depth", "chars", "line")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )

    def ancestor(d: Column) -> Column:
        return F.substring(F.col("line"), (d * WIDTH + 1).cast("int"), F.lit(WIDTH))

    parts = write_and_read(parts.withColumn("_above", F.when(F.col("depth") > 0, ancestor(F.col("depth") - 1))), "trie-parts")
    children = parts.where("depth > 0").groupBy(F.col("_above").alias("key")).agg(F.count("*").alias("_more"))
    counted = parts.join(children, "key", "left")
    counted = counted.withColumn("n_children", F.col("n_children") + F.coalesce(F.col("_more"), F.lit(0)))
    own = counted.withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"),
        }
    )
    own = write_and_read(own.drop("_more"), "trie-own")
    # what a skeleton node has goes to itself and to all above it
    line = F.transform(F.sequence(F.lit(0).cast("long"), F.col("depth")), ancestor)
    sums = own.select(F.explode(line).alias("key"), "n_leaves", "saved_tokens").groupBy("key").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    ends = given.where("kind = 'ends'").select("key", "shard", "piece", "ids")
    ends = ends.repartition("key").sortWithinPartitions("key", "shard", "piece").mapInPandas(_hashed, "key binary, ends_sha256 string")
    parents = own.select(F.col("key").alias("_above"), F.col("conv_id").alias("parent_conv_id"))
    whole = own.drop("n_leaves", "saved_tokens").join(sums, "key").join(ends, "key", "left").join(parents, "_above", "left")
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS))).select("key", *NODE)


def trie(paths: DataFrame, shard: int = SHARD, most: int = MOST_SHARDS) -> DataFrame:
    """The nodes of the trie of `paths` (conv_id, turns), turns being an array of digest and chars. See `nodes`."""
    digests = F.aggregate("turns", F.lit(b""), lambda a, t: F.concat(a, t["digest"]))
    rows = paths.select(digests.alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"), "conv_id")
    rows = write_and_read(rows, "trie-paths")
    cuts = splitters(rows, shard, most)
    # at most `most` - 1 paths
    known = rows.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(known.value, (bytes(p), int(c))) for p, c in zip(path, conv_id, strict=True)], dtype="int32")

    dealt = rows.select(shard_of("path", "conv_id").alias("shard"), "path", "chars", "conv_id")
    dealt = dealt.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    given = write_and_read(dealt.mapInArrow(_walk(known), _DDL), "trie-nodes")
    whole = write_and_read(_skeleton_nodes(given), "trie-skeleton")
    local = given.where("kind = 'node'")
    ids = whole.select("key", F.col("conv_id").alias("_parent"))
    under = local.where("key IS NOT NULL").join(ids, "key").withColumn("parent_conv_id", F.col("_parent"))
    return local.where("key IS NULL").select(*NODE).unionByName(under.select(*NODE)).unionByName(whole.select(*NODE))


def nodes(turns: DataFrame, shard: int = SHARD, most: int = MOST_SHARDS) -> DataFrame:
    """A row for each distinct beginning of the rebuilt conversations: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    `turns` has conv_id, turn, role and text; other columns are left out, rows without a conv_id too. A conversation
    without turns (after rebuilding) belongs to the root. Without any conversation there is no node. A conversation is
    one row in a task, whatever its length. The ids that end at one node are hashed in order, so those of a skeleton node
    come to one task, as texts of about PIECE bytes one after another.
    """
    return trie(rebuilt(conversations(turns)), shard, most)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return nodes(spark.read.parquet(f"{folder}/conversations.parquet"))


SQL = f"""
WITH turned AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS digest,
    length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list({{'d': digest, 'c': chars}} ORDER BY turn NULLS FIRST, digest) AS turns,
    {crc32_sql("CAST(conv_id AS VARCHAR)")} % {MOST} AS h FROM turned GROUP BY conv_id),
paths AS (
  SELECT c.conv_id, list_concat(coalesce(f.turns, [])[1:c.h], c.turns[c.h + 1:]) AS p
  FROM convs c LEFT JOIN convs f ON f.conv_id = c.conv_id - c.conv_id % {FAMILY}),
steps AS (
  SELECT conv_id, d AS depth, list_transform(p[1:d], lambda t: t.d) AS node, list_transform(p[1:d - 1], lambda t: t.d) AS above,
    coalesce(p[d].c, 0) AS chars, d = len(p) AS ends FROM paths, LATERAL (SELECT unnest(range(len(p) + 1)) AS d)),
trie AS (
  SELECT depth, node, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY depth, node),
children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n FROM trie WHERE depth > 0 GROUP BY 1, 2),
sums AS (
  SELECT a AS depth, t.node[1:a] AS node, sum(t.saved) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM trie t LEFT JOIN children c USING (depth, node), LATERAL (SELECT unnest(range(t.depth + 1)) AS a) GROUP BY 1, 2)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM trie t JOIN sums s USING (depth, node) LEFT JOIN children c USING (depth, node)
LEFT JOIN trie p ON t.depth > 0 AND p.depth = t.depth - 1 AND p.node = t.above
"""
