"""The mix against plain quotas, and what every mix must keep."""

import math
from fractions import Fraction

import pytest

from tests.llm.plain import SPACED
from tests.oracle import connect, differences
from tidemark.llm import source_mix as m


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """By rounds: what is above a source's cap is shared again by weight."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sizes)}
    full, level = set(), Fraction(0)
    while len(full) < len(sizes):
        left = Fraction(share) * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        level = left / sum(w for s, w in weight.items() if s not in full)
        above = {s for s in sizes if s not in full and weight[s] * level > cap * sizes[s]}
        if not above:
            break
        full |= above
    return {s: float(cap * sizes[s] if s in full else weight[s] * level) for s in sizes}


def plain_seats(votes, seats):
    """Seat by seat to the highest quotient."""
    got = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda p: (votes[p] / (2 * got[p] + 1), -p))
        got[best] += 1
    return got


@pytest.mark.parametrize(
    "groups",
    [
        {1: ([53, 24, 23], 7), 2: ([1], 5), 3: ([10, 10, 10, 10], 6)},
        {1: ([1000, 1, 1, 1, 1, 1, 1], 9), 2: ([0, 0, 7], 4), 3: ([5, 5], 0)},
        {1: ([98, 1.5, 0.25, 0.25], 100), 2: (list(range(1, 40)), 333), 3: ([1] * 30, 11)},
    ],
)
def test_highest_quotients(spark, groups):
    rows = [(g, k, float(v), n) for g, (votes, n) in groups.items() for k, v in enumerate(votes)]
    parties = spark.createDataFrame(rows, "g int, party int, votes double, seats long")
    found = m.apportion(parties, "g", "votes", "seats", ["party"]).collect()
    want = {(g, k): q for g, (votes, n) in groups.items() for k, q in enumerate(plain_seats(votes, n))}
    assert {(r["g"], r["party"]): r["_quota"] for r in found} == want


@pytest.mark.parametrize("sizes", [[100, 1, 50, 5], [7, 0, 3], [1], [10, 10, 10, 10, 10, 10, 1000], [0, 0]])
def test_targets(spark, sizes):
    rows = [(f"s{k}", n, k) for k, n in enumerate(sizes)]
    sources = spark.createDataFrame(rows, "_source string, _size long, _at long")
    found = {r["_source"]: r["_target"] for r in m.shared_out(sources, m.WEIGHTS, m.SHARE, m.CAP).collect()}
    want = plain_targets({s: n for s, n, _ in rows})
    assert found == pytest.approx(want)
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes))


def check(rows, found, block, shards=1):
    """What holds for every mix: (doc, source, text) rows, and their results by doc."""
    words = {d: len(SPACED.findall(t or "")) for d, _, t in rows}
    order = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(words[d] for d, own, _ in rows if own == s) for s in order}
    targets = plain_targets(sizes)
    for d, s, _ in rows:
        r = found[d]
        assert (r["size"], r["source_size"]) == (words[d], sizes[s])
        assert r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 2 * words[d]
    for s in order:
        taken = sum(found[d]["taken"] for d, own, _ in rows if own == s)
        assert abs(taken - targets[s]) <= (2 + 2 * shards) * block


def mixed(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, _at int")
    return {r["doc_id"]: r for r in m.mix(docs, **options).documents.collect()}


def test_edges(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, "a", "one"), (4, None, "w " * 5000), (5, "", "x\x1fy z\n" * 40)]
    rows += [(6, "ab", " \t\n"), (7, "é", "p q " * 300), (8, "\U0001f600", "k " * 77), (9, "b", "w " * 600)]
    check(rows, mixed(spark, rows), m.BLOCK)
    assert mixed(spark, []) == {}
    assert all(r["taken"] == 0 for r in mixed(spark, [(1, "a", None), (2, None, "")]).values())
    # repeated rows and rows without an id
    docs = spark.createDataFrame([(7, "s", "a b c d " * 20)] * 5 + [(None, "t", "x " * 90)] * 3, "doc_id long, source string, text string")
    rows = m.mix(docs).documents.collect()
    assert len(rows) == 8 and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)


def test_many_shards(spark):
    """A source with most words is many shards; quotas sum up, and a rerun agrees."""
    rows = [(k, "hot" if k % 5 else f"s{k % 3}", "w " * (1 + k * 37 % 200)) for k in range(400)]
    options = {"shard": 500, "block": 8}
    found = mixed(spark, rows, **options)
    places = {(r["_at"], r["_shard"]) for r in found.values()}
    assert len(places) > 30
    check(rows, found, 8, shards=len(places))
    assert mixed(spark, rows, **options) == found
    moved = mixed(spark, rows[::-1], seed="other", **options)
    assert {d: r["taken"] for d, r in moved.items()} != {d: r["taken"] for d, r in found.items()}
    seats = math.floor(1.5 * sum(r["size"] for r in found.values()) / 8 + 0.5)
    quotas = {(r["_at"], r["_shard"]): r["_quota"] for r in found.values()}
    assert abs(sum(quotas.values()) - seats) <= 1


def test_pieces_are_the_taken_words(spark):
    rows = [(k, f"s{k % 3}", " ".join(f"{k}.{j}" for j in range(10 + 13 * k))) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mix = m.mix(docs, carry=["text"])
    taken = {r["doc_id"]: r["taken"] for r in mix.documents.collect()}
    found = m.piece_texts(m.pieces(mix)).collect()
    for d, _, text in rows:
        own = [r for r in found if r["doc_id"] == d]
        assert sum(r["copies"] * r["n_words"] for r in own) == taken[d]
        for r in own:
            assert r["text"].split() == text.split()[r["first_word"] :][: r["n_words"]]


def test_query_agrees_with_sql(spark, data_dir):
    assert differences(m.query(spark, data_dir), connect(data_dir), m.SQL) is None
