"""The manifest against a plain Merkle tree, folded leaf by leaf."""

import hashlib
import zlib

import pytest

from tests.oracle import connect, differences
from tidemark.llm import merkle_manifest as m


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, more=0):
    doc, source, lang, n_chars, text = row
    n_chars = n_chars + more if n_chars is not None else None
    parts = [str(x) if x is not None else None for x in (doc, source, lang, n_chars, text)]
    return sha("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of every row (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [r for r in rows if r[2] == lang]
        trees[lang] = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    built = {lang: levels([plain_leaf(r) for r in own]) for lang, own in trees.items()}
    top = levels([built[lang][-1][0] for lang in langs])
    out = []
    for number, lang in enumerate(langs):
        for place, row in enumerate(trees[lang]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            siblings, now = "", plain_leaf(row, int(hit))
            for nodes, at in ((built[lang], place), (top, number)):
                for level in nodes[:-1]:
                    run = level[at // 2 * 2 : at // 2 * 2 + 2]
                    run[at % 2] = now
                    siblings += "".join(x for k, x in enumerate(run) if k != at % 2)
                    now, at = sha("".join(run)), at // 2
            root = top[-1][0]
            out.append((row[0], plain_leaf(row), built[lang][-1][0], root, sha(siblings), now, now == root))
    return out


def check(spark, rows):
    docs = spark.createDataFrame(
        [(*r, "x", 7) for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, leaf string, _pos int",
    )
    got = [tuple(r) for r in m.verify(docs).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)
    return got


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_all_proofs(spark, monkeypatch, bits):
    """Leaf partitions of 2, 8 and 4096 leaves; trees of 1 to 83 leaves, of every odd shape."""
    monkeypatch.setattr(m, "LEVELS", bits)
    monkeypatch.setattr(m, "CROWDED", 1)
    sizes = {None: 3, "": 1, "de": 2, "en": 83, "é": 16, "zz": 17}
    rows = [(1000 - 3 * k, "s" if k % 3 else None, lang, k, f"tëxt {k}") for lang, n in sizes.items() for k in range(n)]
    got = check(spark, rows)
    assert {r[6] for r in got} == {True, False}


def test_edges(spark):
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (None, "s", "en", 3, "a-b"),
        (5, None, "en", None, ""),
        (5, "", "en", 0, None),
        (5, "", "en", 0, None),
        (-7, "s", "", 2, "x" * 100_000),
        (2**62, "s", "\U0001f600", 2, "\x00"),
    ]
    check(spark, rows)
    assert check(spark, []) == []
    check(spark, [(1, "s", "en", 3, "one")])


def test_tampering_is_seen(spark):
    """Exactly the rows that are shown with another text than the manifest has fail."""
    docs = spark.range(50).selectExpr("id AS doc_id", "'g' AS lang", "sha2(string(id), 256) AS leaf")
    shown = docs.selectExpr("*", "IF(doc_id IN (3, 44), sha2('other', 256), leaf) AS seen")
    found = m.prove(m.build(shown, "lang", ["doc_id"], "leaf"), "seen", ["doc_id"])
    assert {r["doc_id"] for r in found.where("NOT verified").collect()} == {3, 44}


def test_manifest_parts(spark):
    docs = spark.range(10).selectExpr("id AS doc_id", "string(id % 2) AS lang", "sha2(string(id), 256) AS leaf")
    manifest = m.build(docs, "lang", ["doc_id"], "leaf")
    trees = {g: levels([sha(str(k)) for k in range(int(g), 10, 2)]) for g in "01"}
    assert {r["lang"]: r["subroot"] for r in manifest.subroots.collect()} == {g: t[-1][0] for g, t in trees.items()}
    assert manifest.root == levels([trees["0"][-1][0], trees["1"][-1][0]])[-1][0]


def test_query_agrees_with_sql(spark, data_dir):
    assert differences(m.query(spark, data_dir), connect(data_dir), m.SQL) is None
