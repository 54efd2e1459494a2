"""The leader of a group where totals fall, against a plain loop."""

import random

import pytest

from tidemark.operators.leaders import leader_changes


def plain(rows):
    totals, led, out = {}, {}, []
    for seq, group, member, amount in sorted(rows):
        own = totals.setdefault(group, {})
        own[member] = own.get(member, 0) + (amount or 0)
        best = min(own, key=lambda m: (-own[m], m is not None, m or ""))
        now, was = (best, own[best]), led.get(group)
        if now != was:
            if was:
                out.append((group, seq, "-U", 0, *was))
            out.append((group, seq, "+U" if was else "+I", 1, *now))
        led[group] = now
    return sorted(out, key=repr)


@pytest.mark.parametrize("stretch, max_rows", [(1, None), (3, 50), (4096, None)])
def test_falling_totals(spark, stretch, max_rows):
    rng = random.Random(stretch)
    members = [None, *(f"m{k}" for k in range(12))]
    rows = [
        (k, rng.choice([None, "a", "hot", "hot"]), rng.choice(members), rng.choice([None, *range(-9, 10)])) for k in range(300)
    ]
    df = spark.createDataFrame(rows, "seq long, category string, user string, amount long")
    got = leader_changes(df, "category", "user", "seq", "amount", max_rows, stretch)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)
    assert leader_changes(df.where("false"), "category", "user", "seq", "amount").count() == 0
