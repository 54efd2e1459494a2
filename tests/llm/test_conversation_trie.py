"""The trie against a plain one, with shards of a few conversations."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tests.oracle import connect, differences
from tidemark.llm import conversation_trie as m


def plain_paths(rows):
    """conv_id to its rebuilt (role, text) turns, from (conv_id, turn, role, text) rows without equal turns."""
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    return out


def plain_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, below = defaultdict(set), defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].add(node)
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    rows = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if paths[c] == node)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below[node] if n)
        leaves = sum(n not in children for n in below[node])
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(own), len(node), parent, len(own), len(children[node]) if node in children else 0, leaves, saved, digest))
    return sorted(rows, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, depth int"
    )


def check(spark, rows, **options):
    got = sorted((tuple(r) for r in m.nodes(frame(spark, rows), **options).collect()), key=repr)
    assert got == plain_trie(plain_paths(rows))
    return got


def forks(n):
    """Conversations of few different turns, so that beginnings are shared at every depth."""
    return [(c, t, "user" if t % 2 == 0 else "bot", f"ü{(c >> (t % 3)) % 3}{t}" * (1 + t)) for c in range(n) for t in range(c * 7 % 9)]


@pytest.mark.parametrize("shard", [1, 7, 1000])
def test_shards_do_not_matter(spark, monkeypatch, shard):
    monkeypatch.setattr(m, "PIECE", 8)
    check(spark, forks(230), shard=shard)


def test_hot_conversation(spark, monkeypatch):
    """A third of all conversations are the same, so that one path fills many shards; one is long."""
    monkeypatch.setattr(m, "PIECE", 32)
    rows = forks(120)
    rows += [(c, t, "user", f"same {t}") for c in [*range(1000, 1060)] for t in range(7)]
    rows += [(5000, t, None, f"long {t}") for t in range(300)]
    found = check(spark, rows, shard=5)
    assert max(r[1] for r in found) > 290


def test_edges(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, None),
        (1, 5, "", ""),
        (7, 1, "bot", "x" * 100_000),
        (100, 0, "user", "head"),
        (None, 1, "user", "nobody"),
        (None, None, None, None),
    ]
    rows += [(c, 0, "user", "only turn") for c in range(200, 230)]
    assert any(not p for p in plain_paths(rows).values())
    check(spark, rows)
    check(spark, rows, shard=2)
    assert check(spark, []) == []
    assert check(spark, [(None, 1, "user", "nobody")]) == []
    check(spark, [(3, 0, "user", "one")])
    # repeated rows are repeated turns
    left_out = zlib.crc32(b"6") % 6
    assert m.nodes(frame(spark, [(6, 0, "user", "t")] * 9)).count() == 1 + 9 - left_out


def test_own_family(spark):
    """Members of a family begin as its first conversation does, as far as their ids say."""
    rows = [(c, t, "user", f"{c}.{t}") for c in range(300, 340) for t in range(8)]
    found = check(spark, rows, shard=4)
    assert max(r[3] for r in found if r[1] == 1) > 20


def test_query_agrees_with_sql(spark, data_dir):
    assert differences(m.query(spark, data_dir), connect(data_dir), m.SQL) is None
