import hashlib
import random

import duckdb
import numpy as np

from tests.llm.plain import ALNUM, EDGES, lower
from tidemark.llm import decontaminate


def _plain(docs, items, size=13):
    windows = {}
    for item, text in items:
        words = ALNUM.findall(lower(text or ""))
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words, hit, found = ALNUM.findall(lower(text or "")), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if owners := windows.get(tuple(words[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= owners
        ids = ",".join(sorted(map(str, found)))
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))
    return out


def test_query_agrees_with_plain_search(spark, data_dir, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{data_dir}/benchmark.parquet'").fetchall()
    expected = _plain([(i, t) for i, t, *_ in documents], items)
    assert any(row[1] for row in expected.values())
    assert {r[0]: tuple(r)[1:] for r in decontaminate.query(spark, data_dir).collect()} == expected


def test_edges_short_items_and_blocks(spark, edges):
    items = [(1, "A b, c"), (2, "x y x y x y x y x y x y x y x"), (3, None), (4, ""), (4, "one"), (5, "b c d"), (11, "a.b.c")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for item_bytes, shard_words in ((1 << 20, 1 << 20), (8, 4)):
        found = decontaminate.find_spans(edges, benchmark, item_bytes=item_bytes, shard_words=shard_words)
        rows = found.select(
            "doc_id", "text", "hits.n_words", decontaminate.n_hit(), "hits.items", decontaminate.contaminated()
        ).collect()
        assert len(rows) == len(EDGES)
        for doc, text, n, hit, owners, bad in rows:
            want = _plain([(doc, text)], items)[doc]
            assert (n, hit, len(owners), bad) == (want[0], want[1], want[2], want[4])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(found).collect()}
    assert cut[5] == " e f g" and cut[4] == "" and cut[1] is None and cut[7] == EDGES[6][1][-1:]


def test_empty_tables(spark, edges):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert all(not r["hits"]["items"] for r in decontaminate.find_spans(edges, nothing).collect())
    assert decontaminate.find_spans(edges.where("false"), nothing).count() == 0


def test_index_counts_and_places():
    rng = random.Random(5)
    text = np.array([rng.randrange(1, 5) for _ in range(400)])
    index = decontaminate.FMIndex(text, sample=7)
    phrases = [tuple(rng.randrange(1, 6) for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    rows = np.zeros((60, 4), np.int64)
    for k, p in enumerate(phrases):
        rows[k, 4 - len(p) :] = p
    first, last = index.search(rows, np.array([len(p) for p in phrases]))
    for k, p in enumerate(phrases):
        places = [i for i in range(len(text) - len(p) + 1) if tuple(text[i : i + len(p)]) == p]
        assert sorted(index.locate(np.arange(first[k], last[k]))) == places
