"""A Merkle manifest of a table, and the proofs of its rows as octopus multiproofs.

Every row is a leaf: the digest of its fields, each with its length. The leaves of a
group (a language) stand in order; every two consecutive nodes become the digest of
their hex digests, the last of an odd run the digest of its own, until the group has
one node, its subroot. The subroots, in order of their groups, likewise give the root.

Leaves are dealt into leaf partitions, aligned runs of LEAVES positions of one tree.

* `build` reduces each run to its top node, then runs of these, so that a tree of any
  size takes a few shuffles, and keeps the nodes above the runs (two per run).
* `prove` works the other way. A leaf partition derives all nodes inside its run by
  itself. The nodes that it lacks, for all its proofs together, are the siblings along
  the two edges of its run, level by level up to the root: this minimal union of
  coordinates is fetched in one join, the shared interiors are derived once, and every
  proof is put together from them inside the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.places import numbered
from tidemark.session import write_and_read

NAME = "op12_merkle_manifest"

#: leaves of a leaf partition: 2 ** LEVELS
LEVELS = 12
#: the tree of the subroots
TOP = -1
#: nodes at least so many levels above the leaf partitions, and those of the top tree, are kept in COPIES
#: copies for the fetch: each is asked for by a thousand leaf partitions and more
CROWDED, COPIES = 10, 64

_IS_ROOT = "shiftleft(1L, _level) >= _n AND _pos = 0"
_NODES = "_tree long, _level int, _pos long, _digest string, _n long"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """The leaf of a row: each field as UTF-8 byte count, colon and value, or - where it is null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _levels(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(0, int(n) - 1).bit_length()


def interiors(digests: list[str], first: int, n: int, levels: int) -> list[list[str]]:
    """The nodes over a run of leaves at `first` (aligned) and after, from the leaves up, of a tree of n leaves."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[k : k + 2])) for k in range(0, len(below), 2)])
    return out


def _reduce(level: int, keep_all: bool):
    """Of each run of nodes of a level, the nodes above them: all, or only the top one."""

    def reduced(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("_pos")
        tree, first, n = int(run["_tree"].iloc[0]), int(run["_pos"].iloc[0]), int(run["_n"].iloc[0])
        found = interiors(list(run["_digest"]), first, n, min(LEVELS, _levels(n) - level))
        rows = []
        for up in range(1, len(found)):
            if keep_all or up == len(found) - 1:
                rows += [(tree, level + up, (first >> up) + k, d, n) for k, d in enumerate(found[up])]
        return pd.DataFrame(rows, columns=["_tree", "_level", "_pos", "_digest", "_n"])

    return reduced


def _trees(leaves: DataFrame, keep_all: bool) -> DataFrame:
    """The nodes of all trees from the level of the leaf partitions on (`keep_all`: from the leaves on)."""
    most = leaves.agg(F.max("_n")).first()[0] or 0
    now = leaves.select("_tree", F.lit(0).alias("_level"), "_pos", "_digest", "_n")
    # a tree of one leaf is its own root
    kept = [now if keep_all else now.where("_n = 1")]
    level = 0
    while level < _levels(most):
        runs = now.where(F.col("_n") > F.lit(1 << level)).groupBy("_tree", F.shiftright("_pos", LEVELS))
        above = write_and_read(runs.applyInPandas(_reduce(level, keep_all or level > 0), _NODES), "merkle-nodes")
        kept.append(above)
        level += LEVELS
        now = above.where(F.col("_level") == level)
    out = kept[0]
    for nodes in kept[1:]:
        out = out.unionByName(nodes)
    return out


@dataclass
class Manifest:
    """leaves: _tree, _pos, _n, _digest and the carried columns; nodes: _tree, _level, _pos, _digest, _n;
    groups: _tree and the group's value; trees: number of groups."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    trees: int

    @property
    def subroots(self) -> DataFrame:
        """The subroot of every group."""
        tops = self.nodes.where(F.col("_tree") != TOP).where(_IS_ROOT)
        return self.groups.join(tops.select("_tree", F.col("_digest").alias("subroot")), "_tree")

    @property
    def root(self) -> str | None:
        """The digest of the whole table; None if it has no rows."""
        if not self.trees:
            return None
        return self.nodes.where(F.col("_tree") == TOP).where(_IS_ROOT).first()["_digest"]


def build(rows: DataFrame, group: str, order: Sequence[str], digest_column: str) -> Manifest:
    """The manifest of `rows`, which have a digest each. Groups and rows stand in order, nulls first, texts
    by their UTF-8 bytes; rows that agree in `order` by their digests. All other columns are carried along."""
    others = [c for c in rows.columns if c not in (group, digest_column)]
    named = rows.select(F.col(group).alias("_group"), F.col(digest_column).alias("_digest"), *others)
    placed = numbered(named, "_group", [*order, "_digest"], "merkle-leaves")
    names = write_and_read(placed.select("_group").distinct().withColumn("_all", F.lit(0)), "merkle-names")
    groups = numbered(names, "_all", ["_group"], "merkle-groups").select(
        F.col("_group").alias("_name"), F.col("_pos").alias("_tree"), F.col("_n").alias("_groups")
    )
    groups = write_and_read(groups, "merkle-trees")
    trees = groups.count()
    leaves = placed.join(groups, F.col("_group").eqNullSafe(F.col("_name"))).drop("_name", "_groups")
    leaves = write_and_read(leaves, "merkle-placed")
    nodes = write_and_read(_trees(leaves, keep_all=False), "merkle-upper")
    if trees:
        subroots = nodes.where(_IS_ROOT)
        top = subroots.select(F.lit(TOP).cast("long").alias("_tree"), F.col("_tree").alias("_pos"), "_digest")
        top = write_and_read(_trees(top.withColumn("_n", F.lit(trees).cast("long")), keep_all=True), "merkle-top")
        nodes = nodes.unionByName(top)
    return Manifest(leaves, nodes, groups.drop("_groups").withColumnRenamed("_name", group), trees)


def _edges(tree: Column, first: Column, last: Column, n: Column) -> Column:
    """The coordinates that the run of leaves from first to last of a tree of n lacks for its proofs: at each
    level the sibling left of the run's first node and the one right of its last, where the run lacks them."""
    levels = F.ceil(F.log2(n)).cast("int")  # one too many where log2 is inexact does no harm: no node is there

    def at(level: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.floor(first / width), F.floor(last / width)
        count = F.ceil(n / width)
        left = F.when((low % 2 == 1), low - 1)
        right = F.when((high % 2 == 0) & (high + 1 < count), high + 1)
        return F.transform(
            F.filter(F.array(left, right), lambda x: x.isNotNull()),
            lambda x: F.struct(tree.cast("long").alias("_tree"), level.cast("int").alias("_level"), x.alias("_pos")),
        )

    return F.when(n > 1, F.flatten(F.transform(F.sequence(F.lit(0), levels), at))).otherwise(F.array())


def _fetched(manifest: Manifest) -> DataFrame:
    """A row for each leaf partition, with the digests of the coordinates it lacks."""
    runs = manifest.leaves.groupBy("_tree", F.shiftright("_pos", LEVELS).alias("_run")).agg(
        F.min("_pos").alias("_first"), F.max("_pos").alias("_last"), F.first("_n").alias("_n")
    )
    lacking = F.concat(
        _edges(F.col("_tree"), F.col("_first"), F.col("_last"), F.col("_n")),
        _edges(F.lit(TOP), F.col("_tree"), F.col("_tree"), F.lit(manifest.trees)),
        # the roots of both trees, to be compared with
        F.array(
            F.struct(F.col("_tree").alias("_tree"), F.lit(-1).alias("_level"), F.lit(0).cast("long").alias("_pos")),
            F.struct(F.lit(TOP).cast("long").alias("_tree"), F.lit(-1).alias("_level"), F.lit(0).cast("long").alias("_pos")),
        ),
    )
    asked = runs.select(F.struct("_tree", "_run").alias("_by"), F.explode(lacking).alias("_c")).select("_by", "_c.*")

    def crowded(level: Column, tree: Column) -> Column:
        return (tree == TOP) | (level < 0) | (level >= LEVELS + CROWDED)

    salt = F.when(crowded(F.col("_level"), F.col("_tree")), F.pmod(F.xxhash64("_by"), F.lit(COPIES))).otherwise(F.lit(0))
    asked = asked.withColumn("_salt", salt.cast("int"))
    nodes = manifest.nodes.select("_tree", "_level", "_pos", "_digest", "_n")
    roots = nodes.where(_IS_ROOT).withColumn("_level", F.lit(-1))
    kept = nodes.unionByName(roots)
    salts = F.when(crowded(F.col("_level"), F.col("_tree")), F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))
    kept = kept.select("_tree", "_level", "_pos", "_digest", F.explode(salts).alias("_salt"))
    found = asked.join(kept, ["_tree", "_level", "_pos", "_salt"])
    rows = found.groupBy("_by").agg(
        F.collect_list(F.struct(F.col("_tree"), F.col("_level"), F.col("_pos"), F.col("_digest"))).alias("_lacking")
    )
    return rows.select(F.col("_by._tree").alias("_tree"), F.col("_by._run").alias("_run"), "_lacking")


def _path(place: int, n: int, at) -> list[tuple[int, str | None]]:
    """For each level from a leaf up: on which side (0 left, 1 right) its sibling stands, and the sibling."""
    path = []
    while n > 1:
        other = place ^ 1
        path.append((other & 1, at(len(path), other) if other < n else None))
        place, n = place >> 1, (n + 1) >> 1
    return path


def fold(leaf_digest: str, path: list[tuple[int, str | None]]) -> str:
    """The root that a leaf and its siblings lead to."""
    now = leaf_digest
    for right, other in path:
        now = digest(now if other is None else now + other if right else other + now)
    return now


def _expand(trees: int, shown: str, kept: Sequence[str]):
    """The proofs of one leaf partition from its leaves and the digests it lacked."""

    def expanded(key, leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("_pos")
        tree, n, first = int(leaves["_tree"].iloc[0]), int(leaves["_n"].iloc[0]), int(leaves["_pos"].iloc[0])
        lacking = {(r["_tree"], r["_level"], r["_pos"]): r["_digest"] for r in fetched["_lacking"].iloc[0]}
        own = interiors(list(leaves["_digest"]), first, n, min(LEVELS, _levels(n)))

        def at(level: int, place: int) -> str:
            inside = place - (first >> level)
            if level < len(own) and 0 <= inside < len(own[level]):
                return own[level][inside]
            return lacking[tree, level, place]

        top = _path(tree, trees, lambda level, place: lacking[TOP, level, place])
        # what all leaves of the run share: the path from its top node on
        shared = _path(first >> LEVELS, -(-n >> LEVELS), lambda level, place: at(level + LEVELS, place)) + top
        subroot, root = lacking[tree, -1, 0], lacking[TOP, -1, 0]
        proofs, folded = [], []
        for place, showing in zip(leaves["_pos"], leaves[shown], strict=True):
            path, place, width = [], int(place), n
            for level in range(min(LEVELS, _levels(n))):
                other = place ^ 1
                path.append((other & 1, at(level, other) if other < width else None))
                place, width = place >> 1, (width + 1) >> 1
            path += shared
            proofs.append(digest("".join(other for _, other in path if other is not None)))
            folded.append(fold(showing, path))
        out = leaves[list(kept)].copy()
        out["leaf"], out["subroot"], out["root"] = leaves["_digest"], subroot, root
        out["proof_sha256"], out["folded_root"] = proofs, folded
        out["verified"] = out["folded_root"] == root
        return out

    return expanded


def prove(manifest: Manifest, shown: str, kept: Sequence[str]) -> DataFrame:
    """For every leaf the `kept` columns, leaf, subroot, root, proof_sha256 (digest of its siblings), folded_root
    (what the digest in column `shown` and these siblings lead to) and verified (folded_root is the root).

    A task holds one leaf partition (at most 2 ** LEVELS leaves) and two digests per level.
    """
    types = {f.name: f.dataType.simpleString() for f in manifest.leaves.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    schema += ", leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    columns = list(dict.fromkeys([*kept, shown, "_tree", "_pos", "_n", "_digest"]))
    leaves = manifest.leaves.select(*columns, F.shiftright("_pos", LEVELS).alias("_run"))
    return (
        leaves.groupBy("_tree", "_run")
        .cogroup(_fetched(manifest).groupBy("_tree", "_run"))
        .applyInPandas(_expand(manifest.trees, shown, kept), schema)
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verify(docs: DataFrame) -> DataFrame:
    """Every row of `docs` (doc_id, source, lang, n_chars, text) with its proof, where every seventh document,
    by the CRC-32 of its id, is shown with one character more than the manifest has.

    Null fields count as `-`. A null doc_id stands first in its language and is never tampered with, as is
    a row without n_chars. Rows with the same id and language stand in order of their leaves; rows that repeat
    have a leaf each. Other columns are left out; no rows give no rows.
    """
    fields = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = {**fields, "n_chars": F.col("n_chars") + 1}
    original = leaf(list(fields.values()))
    shown = F.when(tampered, leaf(list(more.values()))).otherwise(original)
    leaves = write_and_read(docs.select("lang", "doc_id", original.alias("leaf"), shown.alias("_shown")), "merkle-rows")
    return prove(build(leaves, "lang", ["doc_id"], "leaf"), "_shown", ["doc_id"])


def query(spark: SparkSession, folder: str) -> DataFrame:
    return verify(spark.read.parquet(f"{folder}/documents.parquet"))


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({s}) + 1), lambda k: ascii({s}[k])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, in DuckDB's SQL."""
    return _CRC.format(s=f"({text})")


def _leaf_sql(n_chars: str) -> str:
    parts = {c: n_chars if c == "n_chars" else c for c in FIELDS}
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode(CAST({e} AS VARCHAR))) || ':' || CAST({e} AS VARCHAR), '-')" for e in parts.values()
    ) + ")"


SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("(n_chars + 1)")} AS more,
    {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 AS hit FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER () AS id FROM hashed),
tree_nodes AS (
  SELECT tree, 0 AS lev, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, lev + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (min(n) + 1) // 2
  FROM tree_nodes WHERE n > 1 GROUP BY tree, lev, pos // 2),
subroots AS (SELECT tree, d FROM tree_nodes WHERE n = 1),
top_nodes AS (
  SELECT -1 AS tree, 0 AS lev, tree AS pos, d, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT -1, lev + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (min(n) + 1) // 2
  FROM top_nodes WHERE n > 1 GROUP BY lev, pos // 2),
root AS (SELECT d FROM top_nodes WHERE n = 1),
folds AS (
  SELECT id, tree, pos, 0 AS lev, false AS top, CASE WHEN hit THEN more ELSE leaf END AS d, '' AS proof FROM placed
  UNION ALL
  SELECT f.id, f.tree, CASE WHEN f.top OR m.n > 1 THEN f.pos // 2 ELSE f.tree END,
    CASE WHEN f.top OR m.n > 1 THEN f.lev + 1 ELSE 0 END, f.top OR m.n = 1,
    CASE WHEN m.n = 1 THEN f.d WHEN f.pos % 2 = 1 THEN sha256(s.d || f.d) WHEN s.d IS NULL THEN sha256(f.d) ELSE sha256(f.d || s.d) END,
    f.proof || coalesce(s.d, '')
  FROM folds f
  JOIN (SELECT * FROM tree_nodes UNION ALL SELECT * FROM top_nodes) m
    ON m.tree = CASE WHEN f.top THEN -1 ELSE f.tree END AND m.lev = f.lev AND m.pos = f.pos
  LEFT JOIN (SELECT * FROM tree_nodes UNION ALL SELECT * FROM top_nodes) s
    ON s.tree = m.tree AND s.lev = f.lev AND s.pos = CASE WHEN f.pos % 2 = 1 THEN f.pos - 1 ELSE f.pos + 1 END
  WHERE m.n > 1 OR NOT f.top),
ended AS (SELECT f.* FROM folds f JOIN top_nodes t ON f.top AND t.lev = f.lev AND t.pos = f.pos AND t.n = 1)
SELECT p.doc_id, p.leaf, s.d AS subroot, r.d AS root, sha256(e.proof) AS proof_sha256, e.d AS folded_root, e.d = r.d AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN ended e ON e.id = p.id CROSS JOIN root r
"""
