"""The operators on small inputs with known results."""

import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.operators import changelog, eventtime, joins, keyed, metrics, partitioning, ranking, relational
from tidemark.operators.eventtime import late_disposition, window_firings
from tidemark.sources.tables import event_table, literal_rows

SECOND = timedelta(seconds=1)
SPLITS = pytest.mark.parametrize("max_rows", [None, 2])


def at(ms):
    return datetime(1970, 1, 1) + timedelta(milliseconds=ms)


def table(spark, rows, schema):
    df = literal_rows(spark, rows, schema)
    return df.withColumn("at", F.timestamp_millis("ts").cast("timestamp_ntz")) if "ts bigint" in schema else df


@pytest.fixture(scope="module")
def clicks(spark):
    return table(spark, fx.CLICKS, fx.CLICKS_SCHEMA)


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, fx.ORDERS, fx.ORDERS_SCHEMA)


@pytest.fixture(scope="module")
def late(spark):
    return table(spark, fx.LATE, fx.LATE_SCHEMA)


def test_purchase_tuples(clicks):
    got = [tuple(r) for r in relational.purchase_tuples(clicks).collect()]
    assert got == [("electronics", 299.99), ("books", 19.5), ("electronics", 799.0), ("electronics", 1299.0), ("books", 25.0)]


def test_purchase_needs_an_action(spark):
    df = spark.createDataFrame([(None, "a", 1.0)], "action string, category string, price double")
    assert relational.purchase_tuples(df).count() == 0
    assert relational.route_by_value(df).first()["route"] == "non_purchase"


def test_routes(clicks):
    routes = {}
    for r in relational.route_by_value(clicks).collect():
        routes.setdefault(r["route"], []).append(r["seq"])
    assert routes == {"high": [6, 8], "regular": [3, 4, 9], "non_purchase": [1, 2, 5, 7, 10, 11]}


def test_route_boundary(spark):
    df = spark.createDataFrame([("purchase", 500.0), ("purchase", 500.01)], "action string, price double")
    assert [r["route"] for r in relational.route_by_value(df).collect()] == ["regular", "high"]


def test_chains(spark):
    kept = relational.number_chain(spark.range(5_000_000), "id")
    assert kept.count() == 4_285_715
    letters = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    assert [r[0] for r in relational.letter_chain(letters, "s").collect()] == ["<A>", "<C>"]
    ids = relational.prefixed(spark.range(1, 6).coalesce(1), "id")
    assert [r[0] for r in ids.collect()] == [f"deployed-{i}" for i in range(1, 6)]


def test_running_tenfold(spark):
    df = literal_rows(spark, [("a", 1), ("b", 2), ("a", 3), ("c", 4), ("a", 5)], "k string, v int")
    got = changelog.running_total(df, ["k"], "seq", "v").orderBy("seq").collect()
    assert [(r["k"], r["total"] * 10) for r in got] == [("a", 10), ("b", 20), ("a", 40), ("c", 40), ("a", 90)]


def test_both_emission_policies(spark):
    df = literal_rows(spark, [(k, 1) for k in "ababac"], "k string, v int")
    running = changelog.running_total(df, ["k"], "seq", "v").orderBy("seq").collect()
    assert [(r["k"], r["total"]) for r in running] == [("a", 1), ("b", 1), ("a", 2), ("b", 2), ("a", 3), ("c", 1)]
    final = relational.totals(df, ["k"], "v").collect()
    assert {r["k"]: r["total"] for r in final} == {"a": 3, "b": 2, "c": 1}


@SPLITS
def test_changelog(orders, max_rows):
    changes = changelog.to_changelog(orders, ["category"], "seq", "amount", max_rows=max_rows)
    books = changes.where("category = 'books'").orderBy("seq", "step").collect()
    assert [(r["op"], r["total"]) for r in books] == [
        ("+I", 12), ("-U", 12), ("+U", 20), ("-U", 20), ("+U", 35), ("-U", 35), ("+U", 55), ("-U", 55), ("+U", 66)
    ]
    view = changelog.collapse(changes, ["category"], "seq").collect()
    assert {r["category"]: r["total"] for r in view} == fx.TOTALS


def test_collapse_deletes(spark):
    rows = [("a", 1, 1, "+I", 5), ("a", 2, 1, "-D", 5), ("b", 3, 1, "+I", 7)]
    df = spark.createDataFrame(rows, "k string, seq int, step int, op string, total int")
    assert [tuple(r) for r in changelog.collapse(df, ["k"], "seq").collect()] == [("b", 7)]


def test_append_only(spark, orders):
    changes = changelog.to_changelog(orders, ["category"], "seq", "amount")
    with pytest.raises(Exception, match="append-only"):
        changelog.require_append_only(changes).collect()
    inserts = changelog.require_append_only(changes.where("op = '+I'"))
    assert inserts.count() == 3 and "op" not in inserts.columns


@SPLITS
def test_leader_changelog(orders, max_rows):
    rows = changelog.leader_changelog(orders, "category", "userId", "seq", "amount", max_rows)
    led = rows.where("category = 'electronics' AND op <> '-U'").orderBy("seq").collect()
    assert [(r["op"], r["userId"], r["total"]) for r in led] == [
        ("+I", "u2", 80), ("+U", "u3", 100), ("+U", "u3", 160), ("+U", "u2", 170)
    ]
    back = rows.where("category = 'electronics' AND op = '-U'").orderBy("seq").collect()
    assert [(r["userId"], r["total"]) for r in back] == [("u2", 80), ("u3", 100), ("u3", 160)]


def test_top_spenders(orders):
    top = ranking.top_spenders(orders).collect()
    assert {r["category"]: (r["userId"], r["total"]) for r in top} == {
        "books": ("u1", 66), "electronics": ("u2", 170), "clothing": ("u2", 65)
    }
    assert ranking.top_spenders(orders, 2).count() == 5
    plan = ranking.top_spenders(orders)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_variants(orders):
    got = {v: {r["category"]: r["revenue"] for r in relational.query_variant(orders, v).collect()}
           for v in ("v0_baseline", "v1_projection", "v2_filter_after", "v3_filter_before")}
    assert all(result == fx.TOTALS for result in got.values())
    assert relational.query_variant(orders, "v2_filter_after", after=90).count() == 2
    assert relational.query_variant(orders, "v3_filter_before", before=25).where("category = 'books'").count() == 0
    assert relational.query_variant(orders, "v4_extra_key").count() == 5


def test_click_history(spark):
    df = table(spark, fx.HISTORY, fx.HISTORY_SCHEMA)
    got = keyed.click_history(df, "userId", "seq", "category").orderBy("userId", "seq").collect()
    assert [(r["userId"], r["count"], r["last_categories"]) for r in got] == fx.HISTORY_RESULT


@SPLITS
def test_spend_summary(spark, max_rows):
    df = table(spark, fx.HISTORY, fx.HISTORY_SCHEMA)
    rows = keyed.spend_summary(df, "userId", "seq", "category", "price", max_rows=max_rows).orderBy("seq").collect()
    last = {r["userId"]: (r["spend"], r["counts"]) for r in rows}
    assert last == {
        "u1": (164.0, {"books": 2, "toys": 1, "electronics": 1, "clothing": 1}),
        "u2": (219.0, {"toys": 1, "electronics": 1, "books": 1}),
    }
    assert rows[0]["counts"] == {"books": 1}


def test_session_counter(spark):
    times = [0, 500, 1500, 6500, 7500]
    df = table(spark, [("u1", t) for t in times[1:]], "userId string, ts bigint")
    got = keyed.session_counter(df, ["userId"], "at", "seq", 3 * SECOND).orderBy("seq").collect()
    assert [r["counter"] for r in got] == [1, 2, 1, 2]


def test_session_ends_at_the_ttl(spark):
    df = table(spark, [("u1", 0), ("u1", 2999), ("u1", 5999)], "userId string, ts bigint")
    got = keyed.session_counter(df, ["userId"], "at", "seq", 3 * SECOND).orderBy("seq").collect()
    assert [r["counter"] for r in got] == [1, 2, 1]


@SPLITS
def test_abandoned_carts(clicks, max_rows):
    alerts = keyed.abandoned_carts(clicks, "userId", "at", "seq", "action", 5 * SECOND, max_rows=max_rows)
    assert sorted(tuple(r) for r in alerts.collect()) == [
        ("u4", at(9000), "abandoned cart"), ("u8", at(13000), "abandoned cart")
    ]


def test_cart_deadline_is_inclusive(spark):
    rows = [("u1", 0, "add_to_cart"), ("u1", 5000, "purchase"), ("u2", 0, "add_to_cart"), ("u2", 5001, "purchase")]
    df = table(spark, rows, "userId string, ts bigint, action string")
    alerts = keyed.abandoned_carts(df, "userId", "at", "seq", "action", 5 * SECOND).collect()
    assert [r["userId"] for r in alerts] == ["u2"]


def test_batch_flush(spark):
    df = table(spark, fx.HISTORY, fx.HISTORY_SCHEMA)
    got = keyed.batch_flush(df, [], "seq", "category").orderBy("seq").collect()
    assert [r["message"] for r in got] == [
        "buffering: books (size=1)", "buffering: toys (size=2)", "FLUSH 3 events: books,toys,toys",
        "buffering: books (size=1)", "buffering: electronics (size=2)",
        "FLUSH 3 events: books,electronics,electronics",
        "buffering: clothing (size=1)", "buffering: books (size=2)",
    ]


def test_tumbling(orders):
    got = eventtime.tumbling_totals(orders, ["category"], "at", 5 * SECOND, "amount").collect()
    assert {(r["category"], r["window_end"]): r["total"] for r in got} == {
        ("books", at(5000)): 35, ("electronics", at(5000)): 180, ("clothing", at(5000)): 25,
        ("books", at(10000)): 20, ("electronics", at(10000)): 60, ("clothing", at(10000)): 40,
        ("books", at(15000)): 11, ("electronics", at(15000)): 90, ("clothing", at(15000)): 30,
    }
    assert {r["window_time"] for r in got} == {at(4999), at(9999), at(14999)}


def test_late_rows(late):
    tagged = late_disposition(late, ["seq"], "at", 5 * SECOND, 2 * SECOND, 2 * SECOND)
    tags = {r["seq"]: (r["disposition"], r["watermark"]) for r in tagged.collect()}
    assert tags[9] == ("late_update", at(5999))
    assert tags[11] == ("too_late", at(7499))
    assert {s for s, (tag, _) in tags.items() if tag == "on_time"} == set(range(1, 14)) - {9, 11}
    assert [r["price"] for r in eventtime.late_rows(tagged).collect()] == [99.0]


@SPLITS
def test_firings(late, max_rows):
    tagged = late_disposition(late, ["seq"], "at", 5 * SECOND, 2 * SECOND, 2 * SECOND, max_rows)
    fired = window_firings(tagged, ["category"], ["seq"], "price", max_rows).collect()
    assert sorted((r["category"], r["window_end"], r["total"], r["firing"]) for r in fired) == [
        ("books", at(5000), 55.0, "fire"), ("books", at(5000), 58.0, "update"),
        ("books", at(10000), 11.0, "fire"), ("books", at(15000), 20.0, "fire"),
        ("electronics", at(5000), 100.0, "fire"), ("electronics", at(10000), 1100.0, "fire"),
    ]


def _arrivals(spark, profiles_first):
    clicks = [(i + (100 if profiles_first else 0), *row) for i, row in enumerate(fx.CLICKS)]
    profiles = [(i + (0 if profiles_first else 100), *row) for i, row in enumerate(fx.PROFILES)]
    return (
        spark.createDataFrame(clicks, "seq int, " + fx.CLICKS_SCHEMA),
        spark.createDataFrame(profiles, "seq int, userId string, tier string"),
    )


@SPLITS
def test_tiers(spark, max_rows):
    got = joins.enrich_with_tier(*_arrivals(spark, True), "userId", "seq", max_rows=max_rows).collect()
    assert {r["userId"]: r["tier"] for r in got} == {
        "u1": "premium", "u2": "vip", "u3": "premium", "u5": "vip",
        "u4": "unknown", "u6": "unknown", "u7": "unknown", "u8": "unknown",
    }
    assert len(got) == 11
    got = joins.enrich_with_tier(*_arrivals(spark, False), "userId", "seq").collect()
    assert {r["tier"] for r in got} == {"unknown"}


def test_hold(spark):
    clicks = table(spark, [("u1", 0), ("u1", 3000), ("u2", 0), ("u3", 0)], "userId string, ts bigint")
    profiles = table(spark, [("u1", 2000, "a"), ("u2", 2001, "b")], "userId string, ts bigint, tier string")
    got = joins.enrich_with_hold(clicks, profiles, "userId", "at", "seq", 2 * SECOND)
    assert sorted((r["userId"], r["ts"], r["tier"]) for r in got.collect()) == [
        ("u1", 0, "a"), ("u1", 3000, "a"), ("u2", 0, "unknown"), ("u3", 0, "unknown")
    ]


@SPLITS
def test_as_of(spark, max_rows):
    rates = table(spark, [("EUR", 1000, 1.1), ("EUR", 2000, 1.2), ("EUR", 3000, 1.3), ("USD", 5000, 1.0)],
                  "currency string, ts bigint, rate double")
    trades = table(spark, [("EUR", 999, 1.0), ("EUR", 2000, 2.0), ("EUR", 2999, 3.0), ("USD", 4999, 4.0)],
                   "currency string, ts bigint, amount double")
    args = (["currency"], "at", "at", "seq", "seq", ["rate"])
    got = joins.as_of(trades, rates, *args, max_rows=max_rows)
    assert sorted((r["amount"], r["rate"]) for r in got.collect()) == [(2.0, 1.2), (3.0, 1.2)]
    assert joins.as_of(trades, rates, *args, inner=False).where("rate IS NULL").count() == 2


def test_multiplier(spark):
    clicks = spark.createDataFrame(
        [("u1", "books", 10.0), ("u2", "electronics", 100.0), ("u3", "clothing", 50.0), ("u4", "toys", 1.0)],
        "userId string, category string, price double",
    )
    table = spark.createDataFrame(
        [("books", 1.0, 1), ("electronics", 9.0, 1), ("electronics", 1.5, 2), ("clothing", 0.8, 1)],
        "category string, multiplier double, v int",
    )
    got = joins.apply_multiplier(clicks, table, order=["v"]).collect()
    assert {r["userId"]: r["adjusted"] for r in got} == {"u1": 10.0, "u2": 150.0, "u3": 40.0, "u4": None}
    status = {r["userId"]: r["status"] for r in got}
    assert status["u2"] == "adjusted" and status["u4"] == "unknown"


def test_compare_outputs(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), (None, 4)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 5)], "k string, v int")
    got = joins.compare_outputs(old, new, ["k"], ["v"]).collect()
    assert {r["k"]: r["difference"] for r in got} == {
        "a": "same", "b": "changed", "c": "same", "d": "only_new", None: "only_old"
    }


def slow_names(key):
    import time

    if key == "u2":
        time.sleep(3)
    return fx.NAMES.get(key)


def test_async_lookup(spark):
    keys = [f"u{i % 5}" for i in range(1000)]
    df = spark.createDataFrame(list(enumerate(keys)), "i int, userId string").coalesce(1)
    got = joins.async_lookup(df, "userId", slow_names, "name", timedelta(milliseconds=300)).collect()
    assert [r["i"] for r in got] == list(range(1000)), "input order"
    found = {r["userId"]: r["name"] for r in got}
    assert found == {"u0": "Alice", "u1": "Bob", "u2": "?TIMEOUT?", "u3": "Dave", "u4": "?"}


ALIVE = {"now": 0, "most": 0}


def watched(key):
    with WATCH:
        ALIVE["now"] += 1
        ALIVE["most"] = max(ALIVE["most"], ALIVE["now"])
    time.sleep(0.2)
    with WATCH:
        ALIVE["now"] -= 1
    return f"{key!r}"


WATCH = threading.Lock()


def test_calls_given_up_keep_their_place():
    calls = joins._Calls(watched, 4, 0.05)
    got = calls.run(list(range(40)), "?", "late")
    assert set(got) == set(range(40)) and set(got.values()) == {"late"}
    calls.close()
    assert ALIVE["most"] == 4


def as_text(key):
    return f"{key!r}"


def test_async_lookup_keeps_every_value(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, None, 1), (None, 2.5, 2), (5, 1.0, None)], "k bigint, d double, i int").withColumn(
        "m", F.col("k").cast("decimal(38,4)")
    ).withColumn("t", F.timestamp_micros(F.col("k"))).coalesce(1)
    rows = joins.async_lookup(df, "k", as_text, "name").collect()
    assert [r["name"] for r in rows] == [str(big), "?", "5"]
    assert [tuple(r)[:5] for r in rows] == [tuple(r) for r in df.collect()]


def broken(key):
    raise ValueError("service is down")


def test_async_lookup_fails_loudly(spark):
    with pytest.raises(Exception, match="service is down"):
        joins.async_lookup(spark.createDataFrame([("u1",)], "k string"), "k", broken).collect()


def test_categories_that_are_not_declared(spark):
    rows = [(i % 7, i, f"c{i % 300}" if i % 5 else None, i % 4) for i in range(1500)]
    df = spark.createDataFrame(rows, "userId int, seq int, category string, amount int")
    with pytest.raises(ValueError, match="more than 200 values"):
        keyed.spend_summary(df, "userId", "seq", "category", "amount")
    spent, times, want = {}, {}, {}
    for user, seq, category, amount in rows:
        spent[user] = spent.get(user, 0) + amount
        times[user, category] = times.get((user, category), 0) + 1
        want[seq] = (spent[user], times[user, category])
    for max_rows in (None, 40):
        got = keyed.category_counts(df, "userId", "seq", "category", "amount", max_rows).collect()
        assert {r["seq"]: (r["spend"], r["category_count"]) for r in got} == want


def test_partitioning(spark):
    prices = spark.createDataFrame(list(enumerate(fx.PRICES)), "i int, price double")
    got = prices.withColumn("b", partitioning.price_bucket("price")).orderBy("i").collect()
    assert [r["b"] for r in got] == fx.PRICE_BUCKETS
    placed = partitioning.tag_partition(partitioning.by_price_bucket(prices, 2)).collect()
    assert all(r["partition"] == r["bucket"] % 2 for r in placed)
    assert partitioning.rescale(spark.range(10, numPartitions=4), 2).rdd.getNumPartitions() == 2
    assert partitioning.rescale(spark.range(10, numPartitions=2), 4).rdd.getNumPartitions() == 4
    counts = [r["n"] for r in partitioning.partition_report(partitioning.rebalance(spark.range(100), 4)).collect()]
    assert sum(counts) == 100 and max(counts) < 40


def test_skew(spark):
    rows = [("vip_user", i) for i in range(90)] + [(f"u{i}", 90 + i) for i in range(10)]
    df = spark.createDataFrame(rows, "userId string, id int")
    report = {r["userId"]: r for r in partitioning.skew_report(df, ["userId"]).collect()}
    assert [k for k, r in report.items() if r["skewed"]] == ["vip_user"]
    assert report["vip_user"]["share"] == 0.9 and report["vip_user"]["ratio"] == 9.9
    placed = partitioning.key_placement(partitioning.by_key(df, 16, "userId"), ["userId"]).collect()
    assert {r["userId"]: (r["partitions"], r["n"]) for r in placed} == {k: (1, r["n"]) for k, r in report.items()}
    assert partitioning.key_placement(partitioning.rebalance(df, 16), ["userId"]).agg(F.max("partitions")).first()[0] > 1
    parts = partitioning.salted_partials(df, ["userId"], "id", ["id"])
    assert parts.where("userId = 'vip_user'").agg(F.max("n")).first()[0] < 30
    salted = partitioning.salted_totals(df, ["userId"], "id", ["id"]).collect()
    assert {r["userId"]: r["total"] for r in salted}["vip_user"] == sum(range(90))
    assert sum(r["n"] for r in salted) == 100


def test_user_aggregate(spark):
    df = spark.range(100, numPartitions=7).selectExpr("id % 3 AS k", "CAST(id AS DOUBLE) AS v")
    got = relational.fold_per_key(df, ["k"], "v", lambda values: values.sum(), "double").collect()
    assert {r["k"]: r["result"] for r in got} == {k: sum(range(k, 100, 3)) for k in range(3)}


def test_observed_filter(spark):
    df = literal_rows(spark, [(float(v),) for v in (30, 10, 40, 24, 25)], "amount double")
    kept, seen = metrics.observed_filter(df, "amount", "seq")
    assert kept.count() == 3
    assert seen.get == {"dropped": 2, "kept": 3, "latest": 25.0}


def test_ticks(spark):
    rows = [(0,), (10,), (450,), (1000,)]
    df = table(spark, rows, "ts bigint")
    got = metrics.throughput_ticks(df, "at", timedelta(milliseconds=200)).orderBy("tick").collect()
    assert [r["n"] for r in got] == [2, 0, 1, 0, 0, 1]
    far = table(spark, [(0,), (200 * 25_000,)], "ts bigint")
    ticks = metrics.throughput_ticks(far, "at", timedelta(milliseconds=200))
    assert (ticks.count(), ticks.distinct().count()) == (25_001, 25_001)


def test_reservoir(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id AS DOUBLE) AS v", "id % 2 AS k")
    one = metrics.reservoir_histogram(df, "v", "id").first()
    assert (one["n"], one["low"], one["high"]) == (1024, 3976.0, 4999.0)
    per_key = metrics.reservoir_histogram(df, "v", "id", ["k"]).orderBy("k").collect()
    assert [(r["n"], r["low"]) for r in per_key] == [(1024, 4998.0 - 2 * 1023), (1024, 4999.0 - 2 * 1023)]


@SPLITS
def test_sustained_average(spark, max_rows):
    minute = 60_000
    values = [10, 900, 900, 900, 900, 10, 10, 10]
    df = table(spark, [("s", i * 10 * minute, v) for i, v in enumerate(values)], "k string, ts bigint, v int")
    got = metrics.sustained_average(
        df, ["k"], "at", "v", timedelta(minutes=15), 600, timedelta(minutes=15), max_rows
    ).orderBy("at").collect()
    assert [r["average"] for r in got] == [10, 455, 900, 900, 900, 455, 10, 10]
    assert [r["firing"] for r in got] == [False] * 4 + [True] + [False] * 3


@SPLITS
def test_increase(spark, max_rows):
    minute = 60_000
    values = [5, 6, 8, 1, 2, 2]
    df = table(spark, [("s", i * 4 * minute, v) for i, v in enumerate(values)], "k string, ts bigint, v int")
    got = metrics.increase_alert(
        df, ["k"], "at", "seq", "v", timedelta(minutes=10), 2, max_rows=max_rows
    ).orderBy("at").collect()
    assert [r["increase"] for r in got] == [0, 1, 3, 3, 2, 1]
    assert [r["firing"] for r in got] == [False, False, True, True, False, False]


def test_gaps(spark):
    df = table(spark, [("s", 0), ("s", 300_000), ("s", 600_001)], "k string, ts bigint")
    got = metrics.gap_alert(df, ["k"], "at", "seq", timedelta(minutes=5)).orderBy("alert_time").collect()
    assert [(r["alert_time"], r["resumed"]) for r in got] == [(at(600_000), at(600_001)), (at(900_001), None)]


def test_gap_at_the_open_end(spark):
    df = table(spark, [("s", 0), ("s", 900_000), ("r", 0)], "k string, ts bigint")
    got = metrics.gap_alert(df, ["k"], "at", "seq", timedelta(minutes=5), now=F.lit(at(1_000_000))).collect()
    assert {(r["k"], r["resumed"]) for r in got} == {("s", at(900_000)), ("r", None)}


@SPLITS
def test_retention_of_odd_ids(spark, max_rows):
    big = 2**53
    df = spark.createDataFrame([("j", None, "z", big)] + [("j", at(0), f"s{k}", big + k) for k in range(8)], "job string, at timestamp, id string, n bigint")
    for tie in ("id", "n"):
        got = metrics.retention(df, "job", "at", tie, F.lit(at(0)), max_rows=max_rows).where("verdict = 'keep'").collect()
        assert {r["id"] for r in got} == {f"s{k}" for k in range(3, 8)}


def test_leader_refuses_refunds(spark):
    df = literal_rows(spark, [("a", "m", 3), ("a", "n", -1)], "g string, who string, v int")
    with pytest.raises(Exception, match="must not be negative"):
        changelog.leader_changelog(df, "g", "who", "seq", "v").collect()


@SPLITS
def test_retention(spark, max_rows):
    day = 86_400_000
    df = table(spark, [("job", d * day) for d in range(200)], "job string, ts bigint")
    now = F.lit(at(200 * day))
    got = metrics.retention(df, "job", "at", "seq", now, max_rows=max_rows).where("verdict = 'keep'").collect()
    kept = {r["seq"] - 1 for r in got}
    sundays = {d for d in range(110, 200) if at(d * day).weekday() == 6}
    assert kept == set(range(195, 200)) | sundays


def test_idle_total(spark):
    df = table(spark, [("a", 0, 1), ("a", 5000, 2), ("b", 1000, 4)], "k string, ts bigint, v int")
    got = relational.idle_total(df, ["k"], "at", "v", F.lit(at(9000)), 5 * SECOND).collect()
    assert [(r["k"], r["total"]) for r in got] == [("a", 3)]


def test_split_valid(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    good, bad = relational.split_valid(df, {"negative": F.col("v") >= 0})
    assert [r["v"] for r in good.collect()] == [1]
    assert {(r["v"], r["reason"]) for r in bad.collect()} == {(-1, "negative"), (None, "negative")}


def test_sql_on_event_table(spark):
    raw = spark.createDataFrame(fx.ORDERS, fx.ORDERS_SCHEMA)
    event_table(raw, "order_events")
    got = spark.sql(
        """SELECT window.end AS e, category, SUM(amount) AS total FROM order_events
        GROUP BY window(event_time, '5 seconds'), category"""
    ).collect()
    assert len(got) == 9 and {(r["category"], r["total"]) for r in got} >= {("books", 35.0), ("books", 11.0)}
