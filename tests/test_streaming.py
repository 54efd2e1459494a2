"""Streaming forms against known results and against the batch forms."""

import os
import random
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests import fixtures as fx
from tests.oracle import differences
from tidemark import plans
from tidemark.functions.scalars import from_epoch_millis
from tidemark.operators import changelog, joins, keyed
from tidemark.operators.joins import compare_outputs
from tidemark.session import prepare_streaming
from tidemark.sources import streams
from tidemark.sources.generators import datagen, order_fields, paced_datagen
from tidemark.sources.tables import literal_rows
from tidemark.streaming import operators as s
from tidemark.streaming import processors, sinks, staged, state

SECOND = timedelta(seconds=1)


def at(ms):
    return datetime(1970, 1, 1) + timedelta(milliseconds=ms)


class Feed:
    """A folder that a stream reads one file per micro-batch, in the order added."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema
        self.n = self.files = 0
        os.makedirs(self.folder, exist_ok=True)

    def add(self, *batches):
        for rows in batches:
            numbered = [(self.n + i, *row) for i, row in enumerate(rows, 1)]
            self.n += len(rows)
            df = self.spark.createDataFrame(numbered, f"seq int, {self.schema}")
            path = f"{self.folder}/{self.files:04d}.parquet"
            hidden = f"{self.folder}/.{self.files:04d}"
            pq.write_table(df.toArrow(), hidden)
            os.utime(hidden, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
            os.replace(hidden, path)
            self.files += 1
        return self

    def stream(self):
        df = self.spark.createDataFrame([], f"seq int, {self.schema}")
        made = streams.file_stream(self.spark, self.folder, df.schema, files_per_batch=1)
        return made.withColumn("at", from_epoch_millis("ts")) if "ts bigint" in self.schema else made


@pytest.fixture
def feed(spark, tmp_path):
    prepare_streaming(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield lambda schema, name="in": Feed(spark, tmp_path / name, schema)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def one_each(rows):
    return [[row] for row in rows]


def _kept(stream, tmp_path, mode, name):
    rows = []
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / name))
    return rows, writer.foreachBatch(lambda batch, _: rows.extend(batch.collect()))


def run(stream, tmp_path, mode="append", name="run"):
    """Everything that is there, a file per micro-batch."""
    rows, writer = _kept(stream, tmp_path, mode, name)
    sinks.run_to_end(writer)
    return rows


def run_once(stream, tmp_path, name="run"):
    """One micro-batch. State on the clock keeps a stream going, so it has no end to run to."""
    rows, writer = _kept(stream, tmp_path, "append", name)
    writer.trigger(once=True).start().awaitTermination(60)
    return rows


def paced(source, batches, stream, tmp_path, mode="append"):
    """The next file comes only after the watermark has taken in the one before."""
    rows, writer = _kept(stream, tmp_path, mode, "run")
    query = writer.start()
    try:
        for batch in batches:
            source.add(batch)
            query.processAllAvailable()
    finally:
        query.stop()
    return rows


def test_window_totals(feed, tmp_path):
    source = feed(fx.LATE_SCHEMA)
    totals = s.windowed_totals(source.stream(), ["category"], "at", 5 * SECOND, "price", 2 * SECOND)
    batches = [*one_each(fx.LATE), [("end", "none", 0.0, 60_000)]]
    got = {(r["category"], r["window_end"]): r["total"] for r in paced(source, batches, totals, tmp_path)}
    assert got == {
        ("books", at(5000)): 55, ("electronics", at(5000)): 100,
        ("electronics", at(10000)): 1100, ("books", at(10000)): 11, ("books", at(15000)): 20,
    }


def test_window_restatement(feed, tmp_path):
    source = feed(fx.LATE_SCHEMA)
    totals = s.windowed_totals(source.stream(), ["category"], "at", 5 * SECOND, "price", 2 * SECOND, 2 * SECOND)
    rows = paced(source, one_each(fx.LATE), totals, tmp_path, "update")
    first = [r["total"] for r in rows if (r["category"], r["window_end"]) == ("books", at(5000))]
    assert first == [12, 20, 35, 55, 58], "the late row restates the window, the too late one does not"


def test_late_disposition(feed, tmp_path):
    source = feed(fx.LATE_SCHEMA)
    tagged = s.late_disposition(
        s.with_watermark(source.stream(), "at", 2 * SECOND), "at", 5 * SECOND, 2 * SECOND, "seq"
    )
    tags = {r["seq"]: r["disposition"] for r in paced(source, one_each(fx.LATE), tagged, tmp_path)}
    assert tags == {i: {9: "late_update", 11: "too_late"}.get(i, "on_time") for i in range(1, 14)}


def late_windows(fed, **options):
    """Of a feed whose rows arrive a second after one another."""
    stream = fed.stream().withColumn("arrival", F.timestamp_seconds("seq"))
    return s.windows_with_lateness(
        stream, ["category"], "at", 5 * SECOND, "price", "seq", "arrival", SECOND, disorder=timedelta(0), bound=2 * SECOND, shards=3, **options
    )


def fired(rows):
    return sorted((r["category"], r["window_end"], r["seq"], r["total"], r["firing"]) for r in rows if r["category"] != "none")


LATE_FIRED = [
    ("books", at(5000), 8, 55, "fire"), ("books", at(5000), 9, 58, "update"), ("books", at(5000), 11, 99, "too_late"),
    ("books", at(10000), 10, 11, "fire"), ("books", at(15000), 13, 20, "fire"),
    ("electronics", at(5000), 5, 100, "fire"), ("electronics", at(10000), 12, 1100, "fire"),
]
#: one to pass all windows, one to pass its arrival
CLOSING = [("end", "none", 0.0, 60_000)] + [("end", "none", 0.0, 60_000)] * 3


@pytest.mark.parametrize("together", [True, False])
def test_late_windows(feed, tmp_path, together):
    """Fires on time, again for the late row, and gives the too late one out aside, however the rows are batched."""
    source = feed(fx.LATE_SCHEMA)
    batches = [[*fx.LATE, *CLOSING]] if together else one_each([*fx.LATE, *CLOSING])
    got = fired(run(late_windows(source.add(*batches), lateness=2 * SECOND), tmp_path))
    assert [r for r in got if r[4] != "fire"] == [r for r in LATE_FIRED if r[4] != "fire"]
    assert {(c, e): t for c, e, _, t, f in got if f == "fire"} == {(c, e): t for c, e, _, t, f in LATE_FIRED if f == "fire"}


def test_staged_sink_commits_once(spark, feed, tmp_path):
    """A batch that ends between stage and commit, or after its manifest but before the checkpoint, appears once."""
    source, table = feed("name string"), str(tmp_path / "table")
    source.add([("a",), ("b",)], [("c",)])
    schema = source.stream().schema
    stopped = tmp_path / "stopped"

    class Crashing(staged.StagedWriter):
        def commit(self, messages, batchId):
            if batchId == 1 and not stopped.exists():
                stopped.touch()
                raise RuntimeError("lost before the commit")
            super().commit(messages, batchId)
            if batchId == 1 and not (tmp_path / "late").exists():
                (tmp_path / "late").touch()
                raise RuntimeError("lost after the commit")

        def abort(self, messages, batchId):
            pass  # a lost driver takes nothing back

    class Source(staged.StagedSource):
        @classmethod
        def name(cls):
            return "crashing"

        def streamWriter(self, schema, overwrite):
            return Crashing(self.options["path"], "stream")

    spark.dataSource.register(Source)

    def attempt():
        writer = source.stream().writeStream.format("crashing").option("path", table)
        sinks.run_to_end(writer.option("checkpointLocation", str(tmp_path / "checkpoint")))

    def names():
        return sorted(r["name"] for r in staged.read_committed(spark, table, schema).collect())

    assert names() == []
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            attempt()
        assert names() == (["a", "b", "c"] if (tmp_path / "late").exists() else ["a", "b"])
    source.add([("d",)])
    attempt()
    assert names() == ["a", "b", "c", "d"]


def test_staged_commit_and_abort(tmp_path):
    rows = [pa.RecordBatch.from_pydict({"x": [1, 2]}), pa.RecordBatch.from_pydict({"x": [3]})]
    writer = staged.StagedWriter(str(tmp_path), "q")
    first, again, failed = (writer.write(iter(rows)) for _ in range(3))
    assert staged.committed_files(str(tmp_path)) == [] and writer.write(iter([])).files == []
    writer.commit([first, None, staged.Staged([])], 0)
    writer.commit([first], 0)  # the same once more
    writer.commit([again], 0)  # a repeated run
    writer.abort([failed, None], 1)
    assert staged.committed_files(str(tmp_path)) == [f"{tmp_path}/{first.files[0]}"]
    assert len(os.listdir(tmp_path / "_staged")) == 1
    assert pq.read_table(f"{tmp_path}/{first.files[0]}")["x"].to_pylist() == [1, 2, 3]


def test_ranked_members(spark, feed, tmp_path):
    """Places after every batch, with members that fall out of a list and others that come up; only changes go out."""
    source = feed("category string, user string, amount decimal(10,2)")
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", None]), rng.choice([None, *"klmnopqr"]), rng.choice([None, *range(-9, 12)])) for _ in range(60)]
    rows = [(c, u, None if n is None else Decimal(n)) for c, u, n in rows]
    totals, places = {}, {}
    for first in range(0, 60, 20):
        part = rows[first : first + 20]
        source.add(part)
        for c, u, n in part:
            totals[c, u] = totals.get((c, u), 0) + (n or 0)
        seen = run(s.ranked(source.stream(), "category", "user", "amount", 3, shards=2), tmp_path)
        for r in seen:
            assert places.get((r["category"], r["rn"])) != (r["user"], r["total"])
            assert r["op"] == ("+U" if (r["category"], r["rn"]) in places else "+I")
            places[r["category"], r["rn"]] = (r["user"], r["total"])
        want = {}
        for c in {c for c, _ in totals}:
            own = sorted((-n, u is not None, u) for (g, u), n in totals.items() if g == c)
            want |= {(c, k): (u, -n) for k, (n, _, u) in enumerate(own[:3], 1)}
        assert places == want


def test_late_windows_go_on_after_a_stop(feed, tmp_path):
    """The state of a stopped stream goes on: open and fired windows, event time and waiting rows."""
    source = feed(fx.LATE_SCHEMA)
    rows = [*fx.LATE, *CLOSING]
    got = []
    for part in (rows[:8], rows[8:10], rows[10:]):
        source.add(part)
        got += run(late_windows(source, lateness=2 * SECOND), tmp_path)
    assert fired(got) == fired(run(late_windows(source, lateness=2 * SECOND), tmp_path, name="whole"))
    assert [r[3] for r in fired(got) if r[:2] == ("books", at(5000))] == [55, 58, 99]


def test_idle_source(feed, tmp_path):
    """A source that says nothing holds event time, until it has been silent for too long; coming back it is late."""
    source = feed(fx.LATE_SCHEMA)
    # seconds of arrival: a and b begin, b falls silent after the second one
    rows = [("a", "x", 1.0, 1000), ("b", "x", 2.0, 1000), *[("a", "x", 10.0, 1000 * k) for k in range(8, 20)], ("b", "x", 4.0, 2000)]
    rows += [("a", "none", 0.0, 90_000)] * 12
    stream = late_windows(source.add(rows[:9], rows[9:]), lateness=timedelta(0), source="userId", idle=5 * SECOND)
    got = {(r[1], r[4]): (r[2], r[3]) for r in fired(run(stream, tmp_path))}
    assert got[at(5000), "fire"] == (2, 3)
    # b was heard last in second 2, so event time moves on in second 8, and b's row of second 15 is too late
    assert got[at(5000), "too_late"] == (15, 4)
    held = late_windows(source, lateness=timedelta(0), source="userId", idle=1000 * SECOND)
    assert [(r[2], r[3], r[4]) for r in fired(run(held, tmp_path, name="held")) if r[1] == at(5000)] == []


def test_rows_without_a_time_are_left_out(spark, feed, tmp_path):
    source = feed("user string, amount double, ts bigint")
    rows = [("u", 1.0, 1000), ("u", 2.0, None), ("u", 4.0, 2000), ("z", 0.0, 90_000)]
    timed = s.with_watermark(source.add(rows[:2], rows[2:]).stream(), "at", SECOND)
    got = run(s.running_total(timed, ["user"], "seq", "amount", at="at"), tmp_path)
    assert [(r["seq"], r["total"]) for r in got if r["user"] == "u"] == [(1, 1.0), (3, 5.0)]
    carts = timed.withColumn("action", F.lit("add_to_cart"))
    alerts = run(s.abandoned_carts(carts, "user", "at", "seq", "action", 5 * SECOND), tmp_path, name="carts")
    assert [(r["user"], r["alert_time"]) for r in alerts] == [("u", at(7000))]


def test_salted_windows(feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(*one_each(fx.ORDERS), [("end", "u0", "none", 0.0, 90_000)])
    totals = s.salted_window_totals(source.stream(), ["category"], "at", 5 * SECOND, "amount", "seq")
    got = {(r["category"], r["window_end"]): r["total"] for r in run(totals, tmp_path)}
    assert got == {
        ("books", at(5000)): 35, ("electronics", at(5000)): 180, ("clothing", at(5000)): 25,
        ("books", at(10000)): 20, ("electronics", at(10000)): 60, ("clothing", at(10000)): 40,
        ("books", at(15000)): 11, ("electronics", at(15000)): 90, ("clothing", at(15000)): 30,
    }


def test_sessions(spark, feed, tmp_path):
    rows = [("a", 0), ("a", 1000), ("b", 1500), ("a", 4000), ("a", 9000)]
    source = feed("k string, ts bigint").add(*one_each(rows), [("end", 99_000)])
    found = s.sessions(source.stream(), ["k"], "at", 3 * SECOND, "ts")
    got = {(r["k"], r["session_start"]): (r["session_end"], r["n"]) for r in run(found, tmp_path)}
    batch = literal_rows(spark, rows, "k string, ts bigint").withColumn("at", from_epoch_millis("ts"))
    want = keyed.sessions(batch, ["k"], "at", "seq", 3 * SECOND, "ts").collect()
    assert got == {(r["k"], r["session_start"]): (r["session_end"], r["n"]) for r in want}
    assert len(got) == 3


def test_running_forms(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS[:5], fx.ORDERS[5:6], fx.ORDERS[6:])
    batch = literal_rows(spark, fx.ORDERS, fx.ORDERS_SCHEMA)
    got = run(s.running_total(source.stream(), ["category"], "seq", "amount"), tmp_path, name="a")
    want = changelog.running_total(batch, ["category"], "seq", "amount").collect()
    assert {(r["seq"], float(r["total"])) for r in got} == {(r["seq"], r["total"]) for r in want}
    got = run(s.to_changelog(source.stream(), ["category"], "seq", "amount"), tmp_path, name="b")
    want = changelog.to_changelog(batch, ["category"], "seq", "amount").collect()
    assert sorted((r["seq"], r["step"], r["op"], float(r["total"])) for r in got) == sorted(
        (r["seq"], r["step"], r["op"], r["total"]) for r in want
    )


def test_history_forms(spark, feed, tmp_path):
    source = feed(fx.HISTORY_SCHEMA).add(fx.HISTORY[:3], fx.HISTORY[3:])
    got = run(s.click_history(source.stream(), ["userId"], "seq", "category"), tmp_path, name="a")
    got.sort(key=lambda r: (r["userId"], r["seq"]))
    assert [(r["userId"], r["count"], r["last_categories"]) for r in got] == fx.HISTORY_RESULT
    got = run(s.spend_summary(source.stream(), ["userId"], "seq", "category", "price"), tmp_path, name="b")
    batch = literal_rows(spark, fx.HISTORY, fx.HISTORY_SCHEMA)
    want = keyed.spend_summary(batch, "userId", "seq", "category", "price").collect()
    assert {r["seq"]: (float(r["spend"]), r["counts"]) for r in got} == {
        r["seq"]: (r["spend"], r["counts"]) for r in want
    }


def test_session_counters(feed, tmp_path):
    rows = [("u1", 500), ("u1", 1500), ("u1", 6500), ("u1", 7500)]
    source = feed("userId string, ts bigint").add(rows[:1], rows[1:3], rows[3:])
    got = run(s.session_counter(source.stream(), ["userId"], "at", "seq", 3 * SECOND), tmp_path, name="a")
    assert {r["seq"]: r["counter"] for r in got} == {1: 1, 2: 2, 3: 1, 4: 2}


def test_expired_state_is_gone(feed, tmp_path):
    source = feed("userId string, ts bigint").add([("u1", 0), ("u1", 1)])
    brief = s.expiring_counter(source.stream(), ["userId"], "seq", timedelta(milliseconds=500))
    lasting = s.expiring_counter(source.stream(), ["userId"], "seq", timedelta(hours=1))
    seen = [run_once(brief, tmp_path, "brief"), run_once(lasting, tmp_path, "lasting")]
    time.sleep(1)
    source.add([("u1", 2)])
    seen += [run_once(brief, tmp_path, "brief"), run_once(lasting, tmp_path, "lasting")]
    assert [[r["counter"] for r in rows] for rows in seen] == [[1, 2], [1, 2], [1], [3]]


def test_expiring_sum_and_flush(spark, feed, tmp_path):
    rows = [("u1", 500, 1.0, "a"), ("u1", 1500, 2.0, "b"), ("u1", 4500, 4.0, "c"), ("u1", 5000, 8.0, "d")]
    schema = "userId string, ts bigint, amount double, category string"
    source = feed(schema).add(rows[:2], rows[2:])
    got = run(s.expiring_sum(source.stream(), ["userId"], "at", "seq", "amount", 3 * SECOND), tmp_path, name="a")
    assert {r["seq"]: float(r["total"]) for r in got} == {1: 1, 2: 3, 3: 4, 4: 12}
    got = run(s.batch_flush(source.stream(), ["userId"], "seq", "category"), tmp_path, name="b")
    assert {r["seq"]: (r["size"], r["flushed"]) for r in got} == {
        1: (1, None), 2: (2, None), 3: (3, ["a", "b", "c"]), 4: (1, None)
    }


def test_running_totals_by_batch(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS[:5], fx.ORDERS[5:6], fx.ORDERS[6:])
    stream = source.stream().withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    table, rows = sinks.KeyedTable(str(tmp_path / "t"), ["category"]), []
    writer = sinks.running_totals_by_batch(
        stream, ["category"], "seq", "amount", table, str(tmp_path / "c"), lambda b, _: rows.extend(b.collect())
    )
    sinks.run_to_end(writer)
    batch = literal_rows(spark, fx.ORDERS, fx.ORDERS_SCHEMA)
    want = changelog.running_total(batch, ["category"], "seq", "amount").collect()
    assert {(r["seq"], float(r["total"])) for r in rows} == {(r["seq"], r["total"]) for r in want}
    assert {r["category"]: float(r["total"]) for r in table.read(spark).collect()} == fx.TOTALS


def test_enrichment_on_streams(spark, feed, tmp_path):
    source = feed("userId string").add([("u0",), ("u9",)], [("u1",)])
    dims = spark.createDataFrame(list(fx.NAMES.items()), "userId string, name string")
    want = {"u0": "Alice", "u9": "?", "u1": "Bob"}
    joined = joins.lookup_or_default(source.stream(), dims, "userId", "name")
    assert {r["userId"]: r["name"] for r in run(joined, tmp_path, name="a")} == want
    asked = joins.async_lookup(source.stream(), "userId", fx.NAMES.get, "name")
    assert {r["userId"]: r["name"] for r in run(asked, tmp_path, name="b")} == want
    rows, seen = [], []

    def read(session):
        seen.append(1)
        return dims if len(seen) == 1 else dims.withColumn("name", F.upper("name"))

    writer = sinks.enrich_each_batch(
        source.stream(), read, ["userId"], str(tmp_path / "c"), lambda b, _: rows.extend(b.collect())
    )
    sinks.run_to_end(writer)
    assert {r["userId"]: r["name"] for r in rows} == {"u0": "Alice", "u9": None, "u1": "BOB"}


@pytest.mark.parametrize("together", [True, False])
def test_abandoned_carts(feed, tmp_path, together):
    batches = [fx.CLICKS] if together else one_each(fx.CLICKS)
    source = feed(fx.CLICKS_SCHEMA).add(*batches, [("end", "", "", 0.0, 90_000, "purchase")])
    steps = s.with_watermark(source.stream(), "at")
    alerts = run(s.abandoned_carts(steps, "userId", "at", "seq", "action", 5 * SECOND), tmp_path)
    assert sorted((r["userId"], r["alert_time"]) for r in alerts) == [("u4", at(9000)), ("u8", at(13000))]


def test_late_purchase_in_the_same_batch(feed, tmp_path):
    rows = [("u1", "", "", 0.0, 0, "add_to_cart"), ("u1", "", "", 0.0, 5001, "purchase")]
    source = feed(fx.CLICKS_SCHEMA).add(rows)
    steps = s.with_watermark(source.stream(), "at")
    alerts = run(s.abandoned_carts(steps, "userId", "at", "seq", "action", 5 * SECOND), tmp_path)
    assert [r["alert_time"] for r in alerts] == [at(5000)]


@pytest.mark.parametrize("profiles_first", [True, False])
def test_tiers(spark, feed, tmp_path, profiles_first):
    rows = [(u, t, None) for u, t in fx.PROFILES]
    clicks = [(c[0], None, c[2]) for c in fx.CLICKS]
    order = (rows, clicks) if profiles_first else (clicks, rows)
    source = feed("userId string, tier string, category string").add(*order).stream()
    left = source.where("category IS NOT NULL").drop("tier")
    right = source.where("category IS NULL").drop("category")
    got = run(s.enrich_with_tier(left, right, "userId", "seq"), tmp_path)
    known = {"u1": "premium", "u2": "vip", "u3": "premium", "u5": "vip"} if profiles_first else {}
    assert {r["userId"]: r["tier"] for r in got} == {f"u{i}": known.get(f"u{i}", "unknown") for i in range(1, 9)}
    assert len(got) == 11


def test_as_of(spark, feed, tmp_path):
    rows = [
        ("EUR", 1000, 1.1, None), ("EUR", 2500, None, 1.0), ("EUR", 500, None, 2.0),
        ("EUR", 2000, 1.2, None), ("EUR", 3000, 1.3, None), ("EUR", 3000, None, 3.0),
        ("USD", 100, None, 4.0), ("EUR", 3500, None, 5.0),
    ]
    schema = "currency string, ts bigint, rate double, amount double"
    source = feed(schema).add(*one_each(rows), [("end", 99_000, 0.0, None)]).stream()
    source = s.with_watermark(source, "at", 2 * SECOND)
    trades = source.where("amount IS NOT NULL").select("currency", "at", "seq", "amount")
    rates = source.where("rate IS NOT NULL").select("currency", "at", "seq", "rate")
    got = run(s.as_of(trades, rates, "currency", "at", "seq", "rate"), tmp_path)
    batch = literal_rows(spark, rows, schema).withColumn("at", from_epoch_millis("ts"))
    want = joins.as_of(
        batch.where("amount IS NOT NULL").select("currency", "at", "seq", "amount"),
        batch.where("rate IS NOT NULL").select("currency", "at", "seq", "rate"),
        ["currency"], "at", "at", "seq", "seq", ["rate"],
    ).collect()
    assert sorted((r["amount"], r["rate"], r["at"]) for r in got) == sorted(
        (r["amount"], r["rate"], r["at"]) for r in want
    )
    assert [r["rate"] for r in sorted(got, key=lambda r: r["amount"])] == [1.2, 1.3, 1.3]


def test_held_join(feed, tmp_path):
    clicks = feed("userId string, ts bigint", "c").add([("u1", 1000), ("u2", 1000)], [("end", 99_000)], [("end", 99_001)])
    profiles = feed("userId string, ts bigint, tier string", "p").add(
        [("u1", 2500, "a"), ("u2", 3001, "b")], [("end", 99_000, "x")], [("end", 99_001, "x")]
    )
    right = profiles.stream().select("userId", F.col("at").alias("profile_at"), "tier")
    joined = s.held_join(clicks.stream(), right, "userId", "at", "profile_at", 2 * SECOND)
    got = {r["userId"]: r["tier"] for r in run(joined, tmp_path) if r["userId"] != "end"}
    assert got == {"u1": "a", "u2": None}


HELD = [
    ("u1", 1000, None), ("u1", 2500, "a"), ("u1", 3000, None), ("u2", 1000, None), ("u2", 3001, "b"),
    ("u3", 5000, None), ("u1", 2600, "c"), ("u4", None, None), (None, 4000, None), (None, 4500, "n"),
    ("u5", 1000, None), ("u5", 1500, None), ("u5", 3400, "d"),
]


def test_strict_join_gives_a_row_per_click(spark, feed, tmp_path):
    """One file per micro-batch, and a restart while clicks wait; the same as the bounded form."""
    schema = "userId string, ts bigint, tier string"
    source = feed(schema).add(*one_each(HELD[:5]))

    def joined():
        rows = s.with_watermark(source.stream(), "at", 3 * SECOND)
        clicks = rows.where("tier IS NULL").select("userId", "seq", "at")
        profiles = rows.where("tier IS NOT NULL").select("userId", "seq", "at", "tier")
        return s.enrich_with_hold(clicks, profiles, "userId", "at", "seq", 2 * SECOND)

    got = run(joined(), tmp_path)
    source.add(*one_each(HELD[5:]), [("end", 99_000, None), ("end", 99_000, "x")])
    got += [r for r in run(joined(), tmp_path) if r["userId"] != "end"]
    batch = literal_rows(spark, HELD, schema).where("ts IS NOT NULL").withColumn("at", from_epoch_millis("ts"))
    want = joins.enrich_with_hold(
        batch.where("tier IS NULL").select("userId", "seq", "at"),
        batch.where("tier IS NOT NULL").select("userId", "seq", "at", "tier"),
        "userId", "at", "seq", 2 * SECOND,
    ).collect()
    tiers = {(r["userId"], r["seq"]): r["tier"] for r in got}
    assert len(got) == len(want) == len(tiers)
    assert tiers == {(r["userId"], r["seq"]): r["tier"] for r in want}
    # a row without a user is a key like others; u5's first click is given up, its second one is not
    assert tiers[None, 9] == "n" and tiers["u5", 11] == "unknown" and tiers["u5", 12] == "d" and tiers["u3", 6] == "unknown"


def test_every_shard_sees_a_change_at_the_same_time(spark, feed, tmp_path):
    schema = "country string, ts bigint, name string, fact boolean"
    changes = [("de", 1000, "Germany", False), ("de", 3000, None, False), ("de", 5000, "Deutschland", False), (None, 1, "x", False)]
    facts = [("de", t, None, True) for t in range(500, 6500, 250)] + [("fr", 2000, None, True), (None, 2000, None, True)]
    rng = random.Random(5)
    rows = changes + facts
    rng.shuffle(rows)
    source = feed(schema).add(*[rows[i : i + 7] for i in range(0, len(rows), 7)])
    source.add([("end", 99_000, "e", False), ("end", 99_000, None, True)])
    timed = s.with_watermark(source.stream(), "at", 10 * SECOND)
    got = run(
        s.refreshed_dimension(
            timed.where("fact").select("country", "seq", "at"), timed.where("NOT fact").select("country", "seq", "at", "name"),
            "country", "at", "seq", "name", shards=5,
        ),
        tmp_path,
    )
    got = [r for r in got if r["country"] != "end"]
    assert len(got) == len(facts)
    for row in got:
        ms = round((row["at"] - at(0)).total_seconds() * 1000)
        name = None if ms < 1000 or 3000 <= ms < 5000 else "Germany" if ms < 3000 else "Deutschland"
        assert row["name"] == (name if row["country"] == "de" else None)


class FakeState(dict):
    """Map state, value state and timers in place of those of one key."""

    def getMapState(self, name, *_):
        return self.setdefault(name, FakeState())

    getValueState = getMapState
    getValue, removeKey, updateValue = dict.__getitem__, dict.__delitem__, dict.__setitem__

    def exists(self):
        return "value" in self

    def get(self):
        return self["value"]

    def update(self, value):
        self["value"] = value

    def registerTimer(self, at):
        self["timer"] = at

    def deleteTimer(self, at):
        assert self.pop("timer") == at

    def getCurrentWatermarkInMs(self):
        return self["now"]


def test_packed_rows_wait_and_go_by_the_piece(monkeypatch):
    """Most rows lie in one minute; neither what is written nor what is read or handed over is more than a piece."""
    for name, value in {"WRITTEN": 8000, "WHOLE": 4000, "CUT": 1000, "HANDED_PACKED": 20}.items():
        monkeypatch.setattr(processors, name, value)
    handed, read = [], []

    class Inner(processors._Packed):
        def init(self, handle):
            pass

        def take(self, rows):
            handed.append(rows["at"].to_pylist())
            yield rows

    class Holder(processors.PackedInTimeOrder):
        def _in_order(self, tables):
            read.append(sum(t.nbytes for t in tables))
            return super()._in_order(tables)

    rng = random.Random(3)
    minute = 60_000_000
    times = [1_700_000_000 * 10**6 + rng.randrange(minute if rng.random() < 0.8 else 3000 * minute) for _ in range(4000)]
    times += times[:40]  # twice
    rng.shuffle(times)
    holder, state, now = Holder(Inner(), "at"), FakeState(), FakeState()
    holder.row = lambda packed: processors.from_bytes(packed)
    holder.init(state)
    late, out = times[-1] - 1, []
    for k in range(0, len(times), 505):
        packs = [pa.table({"at": times[i : min(i + 50, k + 505)], "n": times[i : min(i + 50, k + 505)]}) for i in range(k, min(k + 505, len(times)), 50)]
        assert list(holder.handleInputRows(("x",), iter([{"_rows": processors.to_bytes(t)} for t in packs]), now)) == []
    stops = sorted(rng.sample(times, 12)) + [max(times) + minute]
    for stop in stops:
        now["now"] = stop // 1000
        for table in holder.handleExpiredTimer(("x",), now, None):
            out += table["at"].to_pylist()
        upto = [t for t in times if t <= now["now"] * 1000]
        assert out == sorted(upto)
        if len(upto) < len(times):
            assert now["now"] < state["timer"] <= -(-min(t for t in times if t > now["now"] * 1000) // 1000)
    assert out == sorted(times) and len(out) == 4040
    # a row that comes too late goes next
    list(holder.handleInputRows(("x",), iter([{"_rows": processors.to_bytes(pa.table({"at": [late], "n": [0]}))}]), now))
    assert [t["at"].to_pylist() for t in holder.handleExpiredTimer(("x",), now, None)] == [[late]]
    # a piece and the chunk that fills it
    assert max(map(len, handed)) <= 21 and max(read) <= 2 * 8000
    assert not state["packed_rows"] and not state["packed_buckets"].exists()


def test_clock_windows_close_by_themselves(feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS[:6])
    windows = s.clock_windows(source.stream(), ["category"], 2 * SECOND, "amount")
    rows, writer = _kept(windows, tmp_path, "append", "run")
    query = writer.trigger(processingTime="200 milliseconds").start()
    try:
        for n in (6, 12):  # the second file comes only after the first window was given out
            until = time.monotonic() + 60
            while sum(r["n"] for r in rows) < n and time.monotonic() < until:
                time.sleep(0.2)
            if n == 6:
                source.add(fx.ORDERS[6:])
    finally:
        query.stop()
    assert sum(r["n"] for r in rows) == 12 and len({r["window_end"] for r in rows}) >= 2
    assert all(r["window_end"] - r["window_start"] == 2 * SECOND for r in rows)
    totals = {}
    for r in rows:
        totals[r["category"]] = totals.get(r["category"], 0) + float(r["total"])
    assert totals == fx.TOTALS


def test_state_moves_to_a_version_with_a_field_more(spark, feed, tmp_path):
    first = feed(fx.ORDERS_SCHEMA, "first").add(fx.ORDERS[:4], fx.ORDERS[4:8])
    run(s.click_history(first.stream(), ["userId"], "seq", "category", n=3), tmp_path, name="old")
    left = state.carried(spark, str(tmp_path / "old"), ["userId"], {"count": "value", "last": "list"})
    held = {r["userId"]: (r["count"], r["last"]) for r in left.collect()}
    for user, (count, last) in held.items():
        mine = [o for o in fx.ORDERS[:8] if user in o]
        assert count == len(mine) and len(last) == min(3, count)
    second = feed(fx.ORDERS_SCHEMA, "second")
    second.n = 8
    second.add(fx.ORDERS[8:] + fx.ORDERS[:1])
    moved = run(s.moved_history(second.stream(), ["userId"], "seq", "category", left, n=3), tmp_path, name="new")
    whole = feed(fx.ORDERS_SCHEMA, "whole").add(fx.ORDERS + fx.ORDERS[:1])
    want = run(s.click_history(whole.stream(), ["userId"], "seq", "category", n=3), tmp_path, name="whole-run")
    want = {r["seq"]: (r["count"], r["last_categories"]) for r in want if r["seq"] > 8}
    assert {r["seq"]: (r["count"], r["last_categories"]) for r in moved} == want
    assert all(r["moved"] == held.get(r["userId"], (0,))[0] for r in moved)


def test_summary_goes_on_from_its_state(spark, feed, tmp_path):
    first = feed(fx.ORDERS_SCHEMA, "first").add(fx.ORDERS[:8])
    run(s.spend_summary(first.stream(), ["userId"], "seq", "category", "amount"), tmp_path, name="old")
    left = state.carried(spark, str(tmp_path / "old"), ["userId"], {"spend": "value", "counts": "map"})
    second = feed(fx.ORDERS_SCHEMA, "second")
    second.n = 8
    second.add(fx.ORDERS[8:])
    got = run(s.spend_summary(second.stream(), ["userId"], "seq", "category", "amount", initial=left), tmp_path, name="new")
    whole = feed(fx.ORDERS_SCHEMA, "whole").add(fx.ORDERS)
    want = run(s.spend_summary(whole.stream(), ["userId"], "seq", "category", "amount"), tmp_path, name="whole-run")
    assert sorted((r["seq"], r["spend"], sorted(r["counts"].items())) for r in got) == sorted(
        (r["seq"], r["spend"], sorted(r["counts"].items())) for r in want if r["seq"] > 8
    )


def test_readers_move_when_both_versions_agree(spark, tmp_path):
    old, new = (sinks.KeyedTable(str(tmp_path / side), ["k"]) for side in ("old", "new"))
    for batch, (a, b) in enumerate([(1, 1), (2, 3), (4, 4), (5, 5), (6, 9)]):
        old.write(spark.createDataFrame([("x", a)], "k string, v int"), batch)
        new.write(spark.createDataFrame([("x", b)], "k string, v int"), batch)
    cut = lambda: sinks.CutOver(str(tmp_path / "cut"), old, new, ["v"], needed=2)
    assert cut().check(spark, 0) and not cut().moved()
    assert not cut().check(spark, 1) and cut().check(spark, 2) and not cut().moved()
    assert cut().read(spark).first()["v"] == 6
    assert cut().check(spark, 3) and cut().moved()  # the second in a row
    assert not cut().check(spark, 4) and cut().read(spark).first()["v"] == 9


def test_the_sink_folds_its_changes(spark, tmp_path):
    table = sinks.KeyedTable(str(tmp_path / "t"), ["k"], fold_after=3)
    write = table.writer()
    for batch in range(7):
        write(spark.createDataFrame([("all", batch), (f"b{batch}", batch)], "k string, v int"), batch)
    assert table._versions(spark, "base") == [2, 5]
    want = {"all": 6, **{f"b{b}": b for b in range(7)}}
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == want
    # a batch that the base holds already may be written again
    write(spark.createDataFrame([("all", 5), ("b5", 5)], "k string, v int"), 5)
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == want
    assert {r["k"]: r["v"] for r in table.read(spark, before=5).collect()} == {"all": 4, **{f"b{b}": b for b in range(5)}}


def test_upsert_and_restart(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(*[fx.ORDERS[i : i + 2] for i in (0, 2, 4)])
    totals = source.stream().groupBy("category").agg(F.sum("amount").alias("total"))
    table = sinks.KeyedTable(str(tmp_path / "table"), ["category"])
    checkpoint = str(tmp_path / "checkpoint")
    sinks.run_to_end(sinks.upsert(totals, table, checkpoint))
    table.compact(spark)
    source.add(*[fx.ORDERS[i : i + 2] for i in (6, 8, 10)])
    sinks.run_to_end(sinks.upsert(totals, table, checkpoint))
    want = {**fx.TOTALS}
    assert {r["category"]: r["total"] for r in table.read(spark).collect()} == want
    # a batch that is written again changes nothing
    last = max(table._versions(spark, "changes"))
    again = spark.read.parquet(f"{table.path}/changes/v={last}").collect()
    table.write(spark.createDataFrame(again), last)
    assert {r["category"]: r["total"] for r in table.read(spark).collect()} == want
    table.compact(spark)
    assert {r["category"]: r["total"] for r in table.read(spark).collect()} == want
    names = state.read_state(spark, checkpoint).selectExpr("key.category AS c").collect()
    assert {r["c"] for r in names} == set(want)


def test_keyed_table_keeps_the_last_row(spark, tmp_path):
    table = sinks.KeyedTable(str(tmp_path / "t"), ["k"])
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], "k string, seq int, v int")
    table.write(rows, 0, ["seq"])
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == {"a": 20, "b": 5}


def test_csv_exactly_once(spark, tmp_path):
    streams.register_numbered(spark)

    def orders(n):
        numbers = spark.readStream.format("numbered").option("n", n).option("perTask", 3).load()
        return numbers.select(*order_fields("value"))

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n in (8, 20):  # the second run goes on where the first one stopped
        query = sinks.csv_files(orders(n), out, checkpoint).start()
        query.processAllAvailable()
        query.stop()
    lines = spark.read.schema("orderId string, userId string, amount double").csv(out).collect()
    assert sorted(tuple(r) for r in lines) == sorted(
        (f"o{i}", f"u{i % 4}", 10.0 + (i % 5) * 5.0) for i in range(20)
    )
    assert spark.read.format("numbered").option("n", 20).load().distinct().count() == 20


def test_seeded_state(spark, feed, tmp_path):
    history = literal_rows(spark, fx.ORDERS[:8], fx.ORDERS_SCHEMA)
    seed = state.totals_before(history, ["category"], "amount", "seq", 8)
    source = feed(fx.ORDERS_SCHEMA)
    source.n = 8
    source.add(fx.ORDERS[8:])
    rows = run(s.running_total(source.stream(), ["category"], "seq", "amount", seed), tmp_path)
    last = {r["category"]: float(r["total"]) for r in sorted(rows, key=lambda r: r["seq"])}
    assert last == fx.TOTALS
    kept = state.read_state(spark, str(tmp_path / "run"), "total").collect()
    assert {r["key"]["category"]: float(r["value"]["total"]) for r in kept} == fx.TOTALS
    load = state.state_load(spark, str(tmp_path / "run"), variable="total")
    assert load.agg(F.sum("n")).first()[0] == 3


def test_append_only_is_checked(feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS)
    updating = source.stream().groupBy("category").count()
    with pytest.raises(Exception, match="(?i)append"):
        sinks.append_only(updating, str(tmp_path / "o"), str(tmp_path / "c")).start()


def test_dual_run(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS[:6], fx.ORDERS[6:]).stream()
    old = source.groupBy("category").agg(F.sum("amount").alias("total"))
    new = source.where("amount > 25").groupBy("category").agg(F.sum("amount").alias("total"))
    sides = sinks.dual_run(old, new, str(tmp_path), ["category"])
    for writer, _ in sides:
        sinks.run_to_end(writer)
    tables = [table.read(spark) for _, table in sides]
    got = compare_outputs(*tables, ["category"], ["total"]).collect()
    assert {r["category"]: r["difference"] for r in got} == {
        "books": "only_old", "clothing": "changed", "electronics": "same"
    }


def test_routed_folders(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS[:6], fx.ORDERS[6:]).stream()
    routed = source.withColumn("route", F.when(F.col("amount") > 50, "high").otherwise("low"))
    for name, write in (("routes", sinks.routed_folders), ("batches", sinks.batch_folders)):
        out = str(tmp_path / name)
        writer = routed.writeStream.option("checkpointLocation", str(tmp_path / f"c{name}"))
        sinks.run_to_end(writer.foreachBatch(write(out)))
        rows = spark.read.parquet(out)
        assert rows.count() == 12 and rows.where("route = 'high'").count() == 4


def test_console_and_discard(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS).stream()
    sinks.run_to_end(sinks.print_rows(source, "orders").option("checkpointLocation", str(tmp_path / "a")))
    sinks.run_to_end(sinks.discard(source).option("checkpointLocation", str(tmp_path / "b")))
    sinks.discard(spark.range(5))


def test_topics(spark):
    options = streams.topic_options("host:9092", "orders", "g")
    assert options["subscribe"] == "orders" and options["startingOffsets"] == "earliest"
    raw = spark.createDataFrame(
        [(bytearray(b"\x00\x00\x00\x00\x01") + b'{"order_id": "o1", "amount": 2.5}', at(1000))],
        "value binary, timestamp timestamp",
    )
    decode = lambda body: F.from_json(body.cast("string"), "order_id string, amount double")
    row = streams.decode_topic(raw, decode).first()
    assert (row["order_id"], row["amount"], row["event_time"]) == ("o1", 2.5, at(1000))


def test_datagen(spark):
    fields = {
        "orderId": {"kind": "sequence"}, "category": {"length": 1},
        "text": {"length": 70}, "amount": {"min": 1, "max": 50},
    }
    made = datagen(spark, 500, fields)
    rows = made.collect()
    assert rows == made.collect() and [r["orderId"] for r in rows] == list(range(500))
    assert len({r["category"] for r in rows}) == 16 and all(len(r["text"]) == 70 for r in rows)
    assert all(1 <= r["amount"] <= 50 for r in rows)
    assert paced_datagen(spark, 10, fields).isStreaming


def test_same_code_on_either_input(spark, feed, tmp_path):
    source = feed(fx.ORDERS_SCHEMA).add(fx.ORDERS)
    schema = spark.createDataFrame([], f"seq int, {fx.ORDERS_SCHEMA}").schema
    results = []
    for bounded in (True, False):
        df = streams.table_input(spark, source.folder, schema, bounded)
        big = df.where("amount > 25").select("orderId")
        results.append(sorted(r[0] for r in (big.collect() if bounded else run(big, tmp_path))))
    assert results[0] == results[1] and len(results[0]) == 6


def test_database_merge_text():
    assert sinks.merge_statement("t1", "t1_staging", ["k"], ["k", "v"]) == (
        "MERGE INTO t1 t USING t1_staging s ON t.k = s.k WHEN MATCHED THEN UPDATE SET v = s.v"
        " WHEN NOT MATCHED THEN INSERT (k, v) VALUES (s.k, s.v)"
    )


STREAMS = sorted(name for name in registry.queries() if name.startswith("stream_"))


@pytest.fixture(scope="module")
def parts(spark, data_dir, tmp_path_factory):
    """The events in four parts that overlap in time, each in random order."""
    import duckdb

    folder = tmp_path_factory.mktemp("parts")
    (folder / "events.parquet").mkdir()
    con = duckdb.connect()
    for k in range(4):
        # hours of disorder between neighbouring parts
        con.execute(
            f"""COPY (SELECT e.* FROM '{data_dir}/events.parquet' e, (SELECT MIN(ts) AS a, MAX(ts) AS b FROM '{data_dir}/events.parquet') t
            WHERE LEAST(3, GREATEST(0, FLOOR(4 * EPOCH(e.ts + ((hash(event_id) % 8)::BIGINT - 4) * INTERVAL 1 HOUR - t.a) / (EPOCH(t.b - t.a) + 1)))) = {k}
            ORDER BY hash(event_id)) TO '{folder}/events.parquet/part-{k}.parquet' (FORMAT parquet)"""
        )
        os.utime(folder / "events.parquet" / f"part-{k}.parquet", (1_000_000 + k, 1_000_000 + k))
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", STREAMS)
def test_parts_in_several_batches(spark, parts, monkeypatch, name):
    monkeypatch.setattr(plans.streams, "FILES_PER_BATCH", 1)
    folder, con = parts
    assert differences(registry.queries()[name](spark, folder), con, registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["stream_late_windows", "stream_idle_sources", "stream_refreshed_dimension"])
def test_large_tables_are_passed_in_steps(spark, parts, monkeypatch, name):
    """No micro-batch gives out more than a step's rows, and what the steps bring along changes nothing."""
    monkeypatch.setattr(plans.streams, "PASSED", 150)
    folder, con = parts
    rows = registry.queries()[name](spark, folder)
    assert differences(rows, con, registry.oracle_sql()[name]) is None
    files = rows.groupBy(F.input_file_name().alias("file")).count()
    assert files.agg(F.max("count")).first()[0] <= 150 and files.count() > 7


@pytest.fixture(scope="module")
def dealt(data_dir, tmp_path_factory):
    """The events dealt by hash to twelve parts (three batches) that all span the days; the first four are written at one time."""
    import duckdb

    folder = tmp_path_factory.mktemp("dealt")
    (folder / "events.parquet").mkdir()
    con = duckdb.connect()
    for k in range(12):
        part = folder / "events.parquet" / f"part-{k}.parquet"
        con.execute(f"COPY (SELECT * FROM '{data_dir}/events.parquet' WHERE hash(event_id) % 12 = {k}) TO '{part}' (FORMAT parquet)")
        os.utime(part, (1_000_000 + max(k, 3), 1_000_000 + max(k, 3)))
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", STREAMS)
def test_parts_dealt_by_hash(spark, dealt, name):
    folder, con = dealt
    assert differences(registry.queries()[name](spark, folder), con, registry.oracle_sql()[name]) is None
