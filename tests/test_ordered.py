"""Running values with and without split keys, against a plain loop."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered as o


def make_rows(n=600, tied=False, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None, "c"])
        ts = 7 if tied and rng.random() < 0.4 else rng.randrange(10_000)
        value = None if rng.random() < 0.2 else rng.randrange(-50, 50)
        rows.append((key, ts, i, value))
    rng.shuffle(rows)
    return rows


def by_hand(rows, keyed):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0] if keyed else 0, []).append(row)
    result = {}
    for group in groups.values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[: i + 1]]
            known = [v for v in seen if v is not None]
            before = [v for v in seen[:-1] if v is not None]
            later = [r[3] for r in group[i + 1 :] if r[3] is not None]
            result[row[2]] = {
                "total": sum(known) if known else None,
                "total_before": sum(before) if before else None,
                "n": i + 1,
                "n_before": i,
                "top": max(known, default=None),
                "top_before": max(before, default=None),
                "low": min(known, default=None),
                "last": known[-1] if known else None,
                "last_before": before[-1] if before else None,
                "prev": group[i - 1][3] if i else None,
                "foll": group[i + 1][3] if i + 1 < len(group) else None,
                "nxt": later[0] if later else None,
                "tail": seen[-5:],
                "tail1": seen[-1:],
            }
    return result


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("max_rows", [None, 200, 23, 3])
@pytest.mark.parametrize("tied", [True, False])
@pytest.mark.parametrize("sent", [o.BROADCAST_VALUES, 0])
def test_scan(spark, monkeypatch, keyed, max_rows, tied, sent):
    if not sent and max_rows not in (23, 3):
        pytest.skip("nothing is carried, or the same as with smaller stretches")
    monkeypatch.setattr(o, "BROADCAST_VALUES", sent)
    rows = make_rows(tied=tied)
    df = spark.createDataFrame(rows, "k string, ts bigint, id bigint, v int").repartition(5)
    groups = o.OrderedGroups(df, ["k"] if keyed else [], ["ts", "id"], max_rows)
    if max_rows and tied and max_rows < 100:
        assert len(groups.marks) == 2, "tied times are cut by the second column"
    if keyed and max_rows:
        assert groups.marks
    out = groups.done(
        groups.scan(
            groups.rows,
            total=o.running_sum("v"),
            total_before=o.running_sum("v", before=True),
            n=o.running_count(),
            n_before=o.running_count(before=True),
            top=o.running_max("v"),
            top_before=o.running_max("v", before=True),
            low=o.running_min("v"),
            last=o.latest("v"),
            last_before=o.latest("v", before=True),
            prev=o.previous("v"),
            foll=o.following("v"),
            nxt=o.next_known("v"),
            tail=o.tail("v", 5),
            tail1=o.tail("v", 1),
        )
    )
    expected = by_hand(rows, keyed)
    got = {r["id"]: r.asDict() for r in out.collect()}
    assert len(got) == len(rows) == out.count()
    for i, want in expected.items():
        assert {k: got[i][k] for k in want} == want


def test_no_group_is_left_large(spark):
    rows = [("hot", 7, i, 1) for i in range(900)] + [("k%d" % i, i, i, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts bigint, id bigint, v int")
    groups = o.OrderedGroups(df, ["k"], ["ts", "id"], 100)
    largest = groups.rows.groupBy("k", *groups.marks).count().agg(F.max("count")).first()[0]
    assert largest <= 200


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double"])
def test_order_types(spark, kind):
    seconds = F.col("id") * 90_001 if kind != "double" else F.col("id") / 7
    df = spark.range(200).withColumn("at", (F.timestamp_seconds(seconds) if kind != "double" else seconds).cast(kind))
    out = o.scan(df, [], ["at", "id"], 20, n=o.running_count())
    assert out.where("n != id + 1").count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], "k string, ts bigint")
    assert o.scan(df, ["k"], ["ts"], n=o.running_count()).count() == 0
    assert o.scan(df, [], ["ts"], n=o.running_count()).count() == 0


def test_profile_of_a_cheaper_table(spark):
    rows = make_rows(tied=True)
    df = spark.createDataFrame(rows, "k string, ts bigint, id bigint, v int")
    for like in (df.select("k", "ts"), df.select("k"), df):
        groups = o.OrderedGroups(df.withColumn("w", F.col("v") + 1), ["k"], ["ts", "id"], 20, like)
        assert groups.marks
        out = groups.done(groups.scan(groups.rows, n=o.running_count()))
        expected = by_hand(rows, True)
        assert {r["id"]: r["n"] for r in out.collect()} == {i: e["n"] for i, e in expected.items()}


@pytest.mark.parametrize("keys", [8, 32])
@pytest.mark.parametrize("text", [False, True])
def test_keys_one_after_another_are_cut(spark, keys, text):
    rows = [(f"k{i // 300}", f"{i:08d}" if text else i, i) for i in range(300 * keys)]
    df = spark.createDataFrame(rows, f"k string, at {'string' if text else 'bigint'}, id bigint")
    groups = o.OrderedGroups(df, ["k"], ["at", "id"], 100)
    largest = groups.rows.groupBy("k", *groups.marks).count().agg(F.max("count")).first()[0]
    limit = max(100, 300 * keys // (4 * 16))
    assert largest <= 2 * limit
    out = groups.done(groups.scan(groups.rows, n=o.running_count(), last=o.previous("id"))).collect()
    assert all((r["n"], r["last"]) == (r["id"] % 300 + 1, r["id"] - 1 if r["id"] % 300 else None) for r in out)


@pytest.mark.parametrize("text", [False, True])
def test_keys_are_cut_at_their_own_points_only(spark, text):
    """32 keys over one another: stretches grow with the rows, not with keys times cuts."""
    rows = [(f"k{i % 32}", f"{i // 64:08d}" if text else i // 64, i) for i in range(32 * 300)]
    df = spark.createDataFrame(rows, f"k string, at {'string' if text else 'bigint'}, id bigint")
    groups = o.OrderedGroups(df, ["k"], ["at", "id"], 50)
    limit = max(50, len(rows) // (4 * 16))
    pieces = 32 * math.ceil(300 / limit)
    stretches = groups.rows.select("k", *groups.marks).distinct().count()
    assert pieces <= stretches <= groups.stretches <= 2 * pieces
    largest = groups.rows.groupBy("k", *groups.marks).count().agg(F.max("count")).first()[0]
    assert largest <= 2 * limit
    out = groups.done(groups.scan(groups.rows, n=o.running_count())).collect()
    assert all(r["n"] == r["id"] // 32 + 1 for r in out)


def test_several_values_that_fill_stretches(spark):
    """Each is cut by the next column at its own points, and the sums of pieces stay in proportion."""
    rows = [("hot", i % 3, i) for i in range(1800)] + [("other", 5, i) for i in range(1800, 2400)]
    df = spark.createDataFrame(rows, "k string, at bigint, id bigint")
    groups = o.OrderedGroups(df, ["k"], ["at", "id"], 100)
    assert len(groups.marks) == 2
    sizes = [r["count"] for r in groups.rows.groupBy("k", *groups.marks).count().collect()]
    assert max(sizes) <= 200 and len(sizes) <= 2 * 24
    out = groups.done(groups.scan(groups.rows, n=o.running_count(), prev=o.previous("id"))).collect()
    place, before = {}, {}
    for key in ("hot", "other"):
        own = sorted((at, i) for k, at, i in rows if k == key)
        place |= {i: n for n, (_, i) in enumerate(own, 1)}
        before |= {i: (own[n - 1][1] if n else None) for n, (_, i) in enumerate(own)}
    assert {r["id"]: (r["n"], r["prev"]) for r in out} == {i: (place[i], before[i]) for i in place}


def test_one_text_for_many_rows_is_cut_by_the_next_column(spark):
    rows = [("hot", "same" if i % 3 else f"t{i:05d}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, at string, id bigint")
    groups = o.OrderedGroups(df, ["k"], ["at", "id"], 50)
    assert len(groups.marks) == 2
    out = groups.done(groups.scan(groups.rows, n=o.running_count())).collect()
    want = {i: n for n, (_, _, i) in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}
    assert {r["id"]: r["n"] for r in out} == want


def test_an_order_without_cut_points_is_refused(spark):
    df = spark.range(500).selectExpr("1 AS k", "array(id) AS at")
    with pytest.raises(TypeError, match="cut points"):
        o.OrderedGroups(df, ["k"], ["at"], 50)
