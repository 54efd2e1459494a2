"""Streaming forms over the events table, run until its rows are used up.

A bounded stream ends with a far-future row (`_finished`), as the end of the input
would end it: windows close, timers fire, and rows that wait for their order are given
out. Its own results stay open for ever.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import money
from tidemark.operators.joins import compare_outputs
from tidemark.operators.ordered import running_max, scan
from tidemark.plans.inputs import EVENTS_SQL, as_doubles
from tidemark.plans.registry import query
from tidemark.plans.running import TYPES, _session_sql
from tidemark.session import prepare_streaming, scratch_path
from tidemark.sources.streams import file_stream, table_input, with_file_time
from tidemark.sources.tables import event_table, load_table, with_zone, without_zone
from tidemark.streaming import operators as s
from tidemark.streaming import staged, state
from tidemark.streaming.sinks import (
    CutOver, KeyedTable, append_only, csv_files, dual_run, publish_places, run_on_clock, run_to_end, streaming_top, upsert,
)

HOUR, DAY = timedelta(hours=1), timedelta(days=1)

#: a trigger takes so many files of the table, and more where it would take more than MOST_BATCHES triggers
FILES_PER_BATCH = 4
MOST_BATCHES = 100
#: the least time that a row may come late; `_bound` finds what the table needs. event_id and ts tell its order
BOUND = DAY
#: rows of the table that a watermark may pass at a time where a few shards give them out
PASSED = 4_000_000
END = datetime(2999, 1, 1, tzinfo=timezone.utc)
AFTER_END = datetime(3009, 1, 1, tzinfo=timezone.utc)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
NOBODY = -1


def _select(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", "ts", "user_id", "event_type", money("value").alias("amount"))


def _events(spark, folder) -> DataFrame:
    """The table as a stream, be it one file or a folder of parts."""
    table = load_table(spark, folder, "events")
    schema, per_batch = table.schema, max(FILES_PER_BATCH, -(-len(table.inputFiles()) // MOST_BATCHES))
    # as a pattern, the path may be a file, too
    return _select(file_stream(spark, f"{folder}/{{events.parquet}}", schema, files_per_batch=per_batch))


def _bound(spark, folder) -> timedelta:
    """How far a file's first row is behind the last of the files that may be read before it: those not
    written later. A table whose files all span its time needs all of that."""
    rows = with_zone(
        spark.read.parquet(f"{folder}/events.parquet").select(
            "ts", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("written")
        )
    ).select("file", "written", F.unix_micros("ts").alias("us"))
    files = rows.groupBy("file", "written").agg(F.min("us").alias("first"), F.max("us").alias("last"))
    # a row for each file; of files written at the same time either may be read first
    times = files.groupBy("written").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("n"))
    seen = scan(times, [], ["written"], like=times, before=running_max("last", before=True))
    ahead = F.greatest(F.col("before"), F.when(F.col("n") > 1, F.col("last")))
    late = seen.select((ahead - F.col("first")).alias("late")).agg(F.max("late")).first()[0]
    # rows at the watermark are late, too, and it is kept in milliseconds
    return BOUND if late is None else max(BOUND, timedelta(microseconds=late) + timedelta(seconds=1))


def _steps(spark, folder, passes: Column, bound: timedelta) -> tuple[timedelta, list[timedelta]]:
    """The bound, and the times since the epoch (of `passes`, in microseconds) at which a watermark stops on its way
    past a table of more than PASSED rows. Files would move the watermark as far as they reach, so such a table is
    held whole by its bound, and passed from its first time on once all of it is there."""
    rows = with_zone(_select(load_table(spark, folder, "events")))
    us = F.unix_micros("ts")
    n, first, last = rows.agg(F.count(us), F.min(us), F.max(us)).first()
    parts = -(-n // PASSED)
    if parts < 2:
        return bound, []
    cuts = rows.agg(F.percentile_approx(passes, [k / parts for k in range(1, parts)])).first()[0]
    held = timedelta(microseconds=last - first) + timedelta(seconds=1)
    return max(bound, held), [timedelta(microseconds=us) for us in sorted(set(cuts or []))]


def _finished(
    spark, folder, build: Callable[[DataFrame, timedelta], DataFrame], label: str, ends: tuple[datetime, ...] = (END,),
    kinds: tuple[str, ...] = ("purchase", "signup"), passes: Column | None = None, ahead: timedelta = timedelta(0),
) -> DataFrame:
    """Run into files to the end of the table, then past it, and read the files back.

    `passes`: the time of a row that the watermark must pass, in microseconds. Large tables are then passed in steps,
    by rows that come one after another behind the table's last time. `ahead`: how far such a row's time is before the
    watermark that it sets, besides the bound."""
    prepare_streaming(spark)
    path = scratch_path(spark, label)
    events = _events(spark, folder)
    bound, cuts = _bound(spark, folder), []
    if passes is not None:
        bound, cuts = _steps(spark, folder, passes, bound)

    def nobody(times) -> DataFrame:
        rows = [(NOBODY, at, NOBODY, kind) for at in times for kind in kinds]
        made = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string")
        return made.withColumn("amount", money(F.lit(0))).coalesce(1)

    last = nobody(ends)
    last.limit(0).write.parquet(f"{path}/end")
    ended_by = spark.readStream.schema(last.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/end")
    stream = build(events.unionByName(ended_by), bound)
    run_to_end(append_only(stream, f"{path}/out", f"{path}/checkpoint"))
    for step in (*(nobody([EPOCH + cut + bound + ahead]) for cut in cuts), last):
        step.write.mode("append").parquet(f"{path}/end")
    run_to_end(append_only(stream, f"{path}/out", f"{path}/checkpoint"))
    rows = without_zone(spark.read.schema(stream.schema).parquet(f"{path}/out"))
    return rows.where(F.col("user_id") != NOBODY) if "user_id" in rows.columns else rows


def _timed(df: DataFrame, bound: timedelta) -> DataFrame:
    return s.with_watermark(df, "ts", bound)


@query(
    "stream_upsert_totals",
    f"SELECT event_type, user_id, CAST(SUM(amount) AS DOUBLE) AS total FROM {EVENTS_SQL} GROUP BY 1, 2",
)
def stream_upsert_totals(spark, folder):
    """Every micro-batch of the table upserts its changed keys."""
    prepare_streaming(spark)
    path = scratch_path(spark, "upsert")
    totals = _events(spark, folder).groupBy("event_type", "user_id").agg(F.sum("amount").alias("total"))
    table = KeyedTable(f"{path}/table", ["event_type", "user_id"])
    run_to_end(upsert(totals, table, f"{path}/checkpoint"))
    return as_doubles(table.read(spark), "total")


@query(
    "stream_top_spender",
    f"""SELECT event_type, user_id, CAST(total AS DOUBLE) AS total, rn FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY total DESC, user_id) AS rn
        FROM (SELECT event_type, user_id, SUM(amount) AS total FROM {EVENTS_SQL} GROUP BY 1, 2)) WHERE rn <= 3""",
)
def stream_top_spender(spark, folder):
    prepare_streaming(spark)
    path = scratch_path(spark, "top")
    totals = _events(spark, folder).groupBy(
        F.col("event_type").alias("category"), F.col("user_id").alias("userId")
    ).agg(F.sum("amount").alias("total"))
    published = KeyedTable(f"{path}/top", ["category", "rn"])
    run_to_end(
        streaming_top(totals, KeyedTable(f"{path}/table", ["category", "userId"]), 3, f"{path}/checkpoint", published.write)
    )
    top = published.read(spark).select(
        F.col("category").alias("event_type"), F.col("userId").alias("user_id"), "total", F.col("rn").cast("long").alias("rn")
    )
    return as_doubles(top, "total")


@query(
    "stream_window_totals",
    f"""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, CAST(SUM(amount) AS DOUBLE) AS total
    FROM {EVENTS_SQL} GROUP BY 1, 2, 3""",
)
def stream_window_totals(spark, folder):
    def build(events, bound):
        return s.windowed_totals(events, ["event_type"], "ts", HOUR, "amount", bound)

    return as_doubles(_finished(spark, folder, build, "windows"), "total")


@query(
    "stream_running_revenue",
    f"""SELECT user_id, event_id, CAST(SUM(amount) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total FROM {EVENTS_SQL}""",
)
def stream_running_revenue(spark, folder):
    def build(events, bound):
        return s.running_total(_timed(events, bound), ["user_id"], "event_id", "amount", at="ts")

    return as_doubles(_finished(spark, folder, build, "running"), "total")


@query(
    "stream_abandoned_cart",
    """SELECT user_id, ts + INTERVAL 6 HOURS AS alert_time, 'abandoned cart' AS reason FROM (
        SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
        FROM events WHERE event_type IN ('click', 'purchase'))
    WHERE event_type = 'click' AND (nxt > ts + INTERVAL 6 HOURS OR nxt IS NULL)""",
)
def stream_abandoned_cart(spark, folder):
    def build(events, bound):
        steps = events.where(F.col("event_type").isin("click", "purchase"))
        return s.abandoned_carts(
            _timed(steps, bound), "user_id", "ts", "event_id", "event_type", timedelta(hours=6), cart="click"
        )

    return _finished(spark, folder, build, "carts")


BY_USER = "OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"


@query(
    "stream_changelog",
    f"""WITH r AS (SELECT event_id, user_id, amount, SUM(amount) {BY_USER} AS total, COUNT(*) {BY_USER} AS n FROM {EVENTS_SQL})
    SELECT event_id, user_id, CASE WHEN n = 1 THEN '+I' ELSE '+U' END AS op, 1 AS step, CAST(total AS DOUBLE) AS total FROM r
    UNION ALL SELECT event_id, user_id, '-U', 0, CAST(total - amount AS DOUBLE) FROM r WHERE n > 1""",
)
def stream_changelog(spark, folder):
    def build(events, bound):
        return s.to_changelog(_timed(events, bound), ["user_id"], "event_id", "amount", at="ts")

    return as_doubles(_finished(spark, folder, build, "changes"), "total")


@query(
    "stream_click_history",
    f"""SELECT event_id, user_id, COUNT(*) {BY_USER} AS "count",
        array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING), ',') AS last_categories
    FROM events""",
)
def stream_click_history(spark, folder):
    def build(events, bound):
        return s.click_history(_timed(events, bound), ["user_id"], "event_id", "event_type", at="ts")

    seen = _finished(spark, folder, build, "history")
    return seen.withColumn("last_categories", F.array_join("last_categories", ","))


@query(
    "stream_ttl_counter",
    """SELECT event_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) AS counter
    FROM (SELECT *, SUM(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
        FROM (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 12 HOURS
            THEN 0 ELSE 1 END AS new FROM events))""",
)
def stream_ttl_counter(spark, folder):
    def build(events, bound):
        return s.session_counter(_timed(events, bound), ["user_id"], "ts", "event_id", 12 * HOUR, hold=True)

    return _finished(spark, folder, build, "sessions")


@query(
    "stream_enrich_tier",
    """SELECT c.event_id, c.user_id, COALESCE('tier' || CAST(p.event_id % 3 AS VARCHAR), 'unknown') AS tier
    FROM (SELECT * FROM events WHERE event_type <> 'signup') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') p
    ON c.user_id = p.user_id AND c.event_id >= p.event_id""",
)
def stream_enrich_tier(spark, folder):
    def build(events, bound):
        clicks = events.where(F.col("event_type") != "signup").select("event_id", "user_id", "ts")
        tier = F.concat(F.lit("tier"), (F.col("event_id") % 3).cast("string")).alias("tier")
        profiles = events.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts", tier)
        return s.enrich_with_tier(_timed(clicks, bound), _timed(profiles, bound), "user_id", "event_id", at="ts")

    return _finished(spark, folder, build, "tiers")


@query(
    "stream_temporal_join",
    f"""SELECT t.event_id, t.user_id, CAST(t.amount AS DOUBLE) AS amount, CAST(r.amount AS DOUBLE) AS rate
    FROM (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'purchase') t
    ASOF JOIN (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'signup') r
    ON t.user_id = r.user_id AND t.ts >= r.ts""",
)
def stream_temporal_join(spark, folder):
    """The slower of the two inputs sets the watermark."""

    def build(events, bound):
        trades = _timed(events.where(F.col("event_type") == "purchase"), bound)
        rates = _timed(events.where(F.col("event_type") == "signup"), bound)
        return s.as_of(
            trades.select("event_id", "user_id", "ts", "amount"),
            rates.select("event_id", "user_id", "ts", F.col("amount").alias("rate")),
            "user_id", "ts", "event_id", "rate",
        )

    return as_doubles(_finished(spark, folder, build, "temporal").drop("ts"), "amount", "rate")


@query(
    "stream_spend_summary",
    f"""SELECT event_id, user_id, CAST(SUM(amount) {BY_USER} AS DOUBLE) AS spend, """
    + ", ".join(f"NULLIF(COUNT(*) FILTER (WHERE event_type = '{t}') {BY_USER}, 0) AS n_{t}" for t in TYPES)
    + f" FROM {EVENTS_SQL}",
)
def stream_spend_summary(spark, folder):
    def build(events, bound):
        return s.spend_summary(_timed(events, bound), ["user_id"], "event_id", "event_type", "amount", at="ts")

    seen = _finished(spark, folder, build, "spend")
    counts = [F.try_element_at("counts", F.lit(t)).alias(f"n_{t}") for t in TYPES]
    return as_doubles(seen.select("event_id", "user_id", "spend", *counts), "spend")


@query(
    "stream_ttl_sum",
    f"""SELECT event_id, user_id,
        CAST(SUM(amount) OVER (PARTITION BY user_id, session ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
    FROM {_session_sql(12)}""",
)
def stream_ttl_sum(spark, folder):
    def build(events, bound):
        return s.expiring_sum(_timed(events, bound), ["user_id"], "ts", "event_id", "amount", 12 * HOUR, hold=True)

    return as_doubles(_finished(spark, folder, build, "sums"), "total")


@query(
    "stream_batch_flush",
    """SELECT event_id, user_id, size, CASE WHEN size = 3 THEN items END AS flushed FROM (
        SELECT *, CAST((rn - 1) % 3 + 1 AS INTEGER) AS size,
            array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS 2 PRECEDING), ',') AS items
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events))""",
)
def stream_batch_flush(spark, folder):
    def build(events, bound):
        return s.batch_flush(_timed(events, bound), ["user_id"], "event_id", "event_type", 3, at="ts")

    seen = _finished(spark, folder, build, "flush")
    return seen.withColumn("flushed", F.array_join("flushed", ","))


@query(
    "stream_session_windows",
    f"""SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 8 HOURS AS session_end, COUNT(*) AS n,
        CAST(SUM(amount) AS DOUBLE) AS total FROM {_session_sql(8, '<=')} GROUP BY user_id, session""",
)
def stream_session_windows(spark, folder):
    def build(events, bound):
        return s.sessions(events, ["user_id"], "ts", timedelta(hours=8), "amount", bound)

    return as_doubles(_finished(spark, folder, build, "stream-sessions"), "total")


@query(
    "stream_salted_windows",
    f"""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
        CAST(SUM(amount) AS DOUBLE) AS total FROM {EVENTS_SQL} GROUP BY 1, 2, 3""",
)
def stream_salted_windows(spark, folder):
    def build(events, bound):
        return s.salted_window_totals(events, ["event_type"], "ts", DAY, "amount", "event_id", bound)

    return as_doubles(_finished(spark, folder, build, "salted"), "total")


def _late_windows(spark, folder, label: str, **options) -> DataFrame:
    """Events that arrive up to eight hours after their time; event time moves by the minute of arrival."""
    minutes = F.floor(F.unix_micros("ts") / 60_000_000) + F.pmod(F.col("event_id") * 7919, F.lit(480))

    def build(events, bound):
        arriving = events.withColumn("arrival", F.timestamp_micros(minutes * 60_000_000))
        arriving = arriving.withColumn("source", F.pmod("user_id", F.lit(4)))
        return s.windows_with_lateness(
            arriving, ["event_type"], "ts", HOUR, "amount", "event_id", "arrival", timedelta(minutes=1),
            disorder=bound + 8 * HOUR, bound=HOUR, lateness=2 * HOUR, **options,
        )

    ahead = 8 * HOUR - timedelta(minutes=NOBODY * 7919 % 480)
    fired = _finished(spark, folder, build, label, ends=(END, AFTER_END), passes=minutes * 60_000_000, ahead=ahead)
    fired = fired.where(F.col("event_id") != NOBODY)
    return as_doubles(fired, "total")


ARRIVING_SQL = f"""(SELECT *, epoch_us(ts) // 60000000 + (event_id * 7919) % 480 AS arrival, user_id % 4 AS source,
    time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end FROM {EVENTS_SQL})"""


def _late_windows_sql(low: str) -> str:
    """`low`: by tick of arrival, the event time that its sources stand at (columns arrival, low)."""
    return f"""WITH e AS {ARRIVING_SQL}, low AS ({low}),
    marks AS (SELECT arrival, MAX(low) OVER (ORDER BY arrival) - INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS watermark FROM low),
    tagged AS (SELECT e.*, CASE WHEN watermark >= window_end - INTERVAL 1 MILLISECOND + INTERVAL 2 HOURS THEN 'too_late'
        WHEN watermark >= window_end - INTERVAL 1 MILLISECOND THEN 'update' ELSE 'fire' END AS firing
        FROM e ASOF LEFT JOIN marks m ON e.arrival > m.arrival),
    k AS (SELECT *, SUM(amount) OVER w AS total, LEAD(firing) OVER w AS nxt FROM tagged WHERE firing <> 'too_late'
        WINDOW w AS (PARTITION BY event_type, window_end ORDER BY arrival, event_id))
    SELECT event_type, event_id, window_end, CAST(total AS DOUBLE) AS total, firing FROM k
    WHERE firing = 'update' OR nxt IS NULL OR nxt = 'update'
    UNION ALL SELECT event_type, event_id, window_end, CAST(amount AS DOUBLE), firing FROM tagged WHERE firing = 'too_late'"""


@query("stream_late_windows", _late_windows_sql("SELECT arrival, MAX(ts) AS low FROM e GROUP BY arrival"))
def stream_late_windows(spark, folder):
    return _late_windows(spark, folder, "late-windows")


@query(
    "stream_idle_sources",
    _late_windows_sql(
        """SELECT t.arrival, MIN(seen) FILTER (WHERE t.arrival - m.arrival <= 240) AS low
        FROM (SELECT DISTINCT e.arrival, s.source FROM e, (SELECT DISTINCT source FROM e) s) t
        ASOF JOIN (SELECT source, arrival, MAX(MAX(ts)) OVER (PARTITION BY source ORDER BY arrival) AS seen FROM e GROUP BY source, arrival) m
        ON t.source = m.source AND t.arrival >= m.arrival GROUP BY t.arrival"""
    ),
)
def stream_idle_sources(spark, folder):
    """Four sources; one that was silent for four hours does not hold the others up."""
    return _late_windows(spark, folder, "idle-sources", source="source", idle=4 * HOUR)


@query(
    "stream_ranked_spenders",
    """SELECT event_type, rn, user_id, CAST(total AS DOUBLE) AS total FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY total DESC, user_id) AS rn FROM (
            SELECT event_type, user_id, SUM(CAST(CASE WHEN event_id % 3 = 0 THEN -value ELSE value END AS DECIMAL(18,2))) AS total
            FROM events GROUP BY 1, 2)) WHERE rn <= 3""",
)
def stream_ranked_spenders(spark, folder):
    """Top three per type from lists in state, with refunds: every third event takes its amount back."""
    prepare_streaming(spark)
    path = scratch_path(spark, "ranked")
    refund = F.when(F.col("event_id") % 3 == 0, -F.col("amount")).otherwise(F.col("amount")).cast("decimal(18,2)")
    places = s.ranked(_events(spark, folder).withColumn("amount", refund), "event_type", "user_id", "amount", 3)
    table = KeyedTable(f"{path}/places", ["event_type", "rn"])
    run_to_end(publish_places(places, table, f"{path}/checkpoint"))
    return as_doubles(table.read(spark), "total")


@query("stream_staged_rows", f"SELECT event_id, user_id, event_type, CAST(amount AS DOUBLE) AS amount FROM {EVENTS_SQL}")
def stream_staged_rows(spark, folder):
    """Every row once through the sink with stage and commit."""
    path = scratch_path(spark, "staged")
    rows = _events(spark, folder).drop("ts")
    run_to_end(staged.staged_files(rows, f"{path}/table", f"{path}/checkpoint"))
    return as_doubles(staged.read_committed(spark, f"{path}/table", rows.schema), "amount")


@query(
    "stream_held_enrichment",
    f"""SELECT c.event_id, c.user_id,
        COALESCE(CAST(p.amount AS VARCHAR), CASE WHEN n.ts <= c.ts + INTERVAL 12 HOURS THEN CAST(n.amount AS VARCHAR) END, 'unknown') AS tier
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'signup') p ON c.user_id = p.user_id AND c.ts >= p.ts
    ASOF LEFT JOIN (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'signup') n ON c.user_id = n.user_id AND c.ts < n.ts""",
)
def stream_held_enrichment(spark, folder):
    """A row per click: clicks before a user's first signup wait up to twelve hours for it."""

    def build(events, bound):
        clicks = events.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
        tier = F.col("amount").cast("string").alias("tier")
        profiles = events.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts", tier)
        return s.enrich_with_hold(_timed(clicks, bound), _timed(profiles, bound), "user_id", "ts", "event_id", 12 * HOUR)

    return _finished(spark, folder, build, "held", kinds=("click", "signup")).drop("ts")


@query(
    "stream_refreshed_dimension",
    f"""SELECT f.event_id, f.user_id, f.team, CAST(d.rate AS DOUBLE) AS rate
    FROM (SELECT *, user_id % 10 AS team FROM {EVENTS_SQL} WHERE event_type <> 'signup') f
    ASOF LEFT JOIN (SELECT user_id % 10 AS team, ts, CASE WHEN event_id % 5 > 0 THEN amount END AS rate FROM {EVENTS_SQL}
        WHERE event_type = 'signup' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id % 10, ts ORDER BY event_id DESC) = 1) d
    ON f.team = d.team AND f.ts >= d.ts""",
)
def stream_refreshed_dimension(spark, folder):
    """Every signup sets the rate of its team, and each fifth one takes it away; all shards see it at the same time."""

    def build(events, bound):
        events = events.withColumn("team", F.col("user_id") % 10)
        facts = events.where(F.col("event_type") != "signup").select("event_id", "user_id", "team", "ts")
        rate = F.when(F.col("event_id") % 5 > 0, F.col("amount")).alias("rate")
        changes = events.where(F.col("event_type") == "signup").select("team", "ts", "event_id", rate)
        return s.refreshed_dimension(_timed(facts, bound), _timed(changes, bound), "team", "ts", "event_id", "rate")

    return as_doubles(_finished(spark, folder, build, "dimension", passes=F.unix_micros("ts")).drop("ts"), "rate")


@query(
    "stream_clock_windows",
    f"SELECT event_type, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS total FROM {EVENTS_SQL} GROUP BY 1",
)
def stream_clock_windows(spark, folder):
    """Windows of a second on the clock. Their bounds differ from run to run, so the rows are summed over them."""
    prepare_streaming(spark)
    path = scratch_path(spark, "clock")
    rows = load_table(spark, folder, "events").count()
    windows = s.clock_windows(_events(spark, folder), ["event_type"], timedelta(seconds=1), "amount")
    spark.createDataFrame([], windows.schema).write.parquet(f"{path}/out")

    def given_out():
        return spark.read.schema(windows.schema).parquet(f"{path}/out")

    def done():
        return given_out().agg(F.sum("n")).first()[0] == (rows or None)

    run_on_clock(append_only(windows, f"{path}/out", f"{path}/checkpoint"), done)
    summed = given_out().groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return as_doubles(summed, "total")


def _middle(spark, folder) -> int:
    return (load_table(spark, folder, "events").agg(F.max("event_id")).first()[0] or 0) // 2


def _in_two(spark, folder, path: str) -> tuple[DataFrame, Callable[[], None]]:
    """A stream over the events up to the middle event_id, and a call that lets the others follow."""
    rows = with_zone(_select(load_table(spark, folder, "events")))
    middle = _middle(spark, folder)
    rows.where(F.col("event_id") <= middle).write.parquet(f"{path}/in")

    def follow():
        rows.where(F.col("event_id") > middle).write.mode("append").parquet(f"{path}/in")

    return file_stream(spark, f"{path}/in", rows.schema), follow


@query(
    "stream_resumed_totals",
    f"""SELECT user_id, event_id, CAST(SUM(amount) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total FROM {EVENTS_SQL}""",
)
def stream_resumed_totals(spark, folder):
    """Stopped after the first half of the events; the second run goes on from the checkpoint."""
    prepare_streaming(spark)
    path = scratch_path(spark, "resumed")
    events, follow = _in_two(spark, folder, path)
    totals = s.running_total(events, ["user_id"], "event_id", "amount")
    run_to_end(append_only(totals, f"{path}/out", f"{path}/checkpoint"))
    follow()
    run_to_end(append_only(totals, f"{path}/out", f"{path}/checkpoint"))
    return as_doubles(spark.read.schema(totals.schema).parquet(f"{path}/out"), "total")


@query(
    "stream_state_table",
    f"SELECT user_id, CAST(SUM(amount) AS DOUBLE) AS total FROM {EVENTS_SQL} GROUP BY 1",
)
def stream_state_table(spark, folder):
    """The state of a stopped stream, read as a table."""
    prepare_streaming(spark)
    path = scratch_path(spark, "state")
    totals = s.running_total(_events(spark, folder), ["user_id"], "event_id", "amount")
    run_to_end(append_only(totals, f"{path}/out", f"{path}/checkpoint"))
    return as_doubles(state.carried(spark, f"{path}/checkpoint", ["user_id"], {"total": "value"}), "total")


@query(
    "stream_state_changes",
    f"""SELECT * FROM (SELECT user_id, CAST(SUM(amount) FILTER (WHERE first) AS DOUBLE) AS old, CAST(SUM(amount) AS DOUBLE) AS new,
        CASE WHEN bool_or(first) THEN '+U' ELSE '+I' END AS op
    FROM (SELECT *, event_id <= (SELECT MAX(event_id) // 2 FROM events) AS first FROM {EVENTS_SQL}) GROUP BY user_id)
    WHERE old IS DISTINCT FROM new""",
)
def stream_state_changes(spark, folder):
    """What the second half of the events, taken as one batch, changed in the totals."""
    prepare_streaming(spark)
    path = scratch_path(spark, "changed")
    events, follow = _in_two(spark, folder, path)
    totals = s.running_total(events, ["user_id"], "event_id", "amount")
    run_to_end(append_only(totals, f"{path}/out", f"{path}/checkpoint"))
    follow()
    run_to_end(append_only(totals, f"{path}/out", f"{path}/checkpoint"))
    return as_doubles(state.state_changes(spark, f"{path}/checkpoint", ["user_id"], "total", 0, 1), "old", "new")


@query(
    "stream_moved_history",
    f"""SELECT event_id, user_id, "count", last_categories, moved FROM (
        SELECT *, COUNT(*) {BY_USER} AS "count", COUNT(*) FILTER (WHERE NOT late) OVER (PARTITION BY user_id) AS moved,
            array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING), ',') AS last_categories
        FROM (SELECT *, event_id > (SELECT MAX(event_id) // 2 FROM events) AS late FROM events)) WHERE late""",
)
def stream_moved_history(spark, folder):
    """The first half of the events under one version of the state; the second version, which has a field more, goes on
    from what the first one left."""
    prepare_streaming(spark)
    path = scratch_path(spark, "moved")
    events, follow = _in_two(spark, folder, path)
    first = s.click_history(events, ["user_id"], "event_id", "event_type")
    run_to_end(append_only(first, f"{path}/old", f"{path}/old-checkpoint"))
    left = state.carried(spark, f"{path}/old-checkpoint", ["user_id"], {"count": "value", "last": "list"})
    left.write.parquet(f"{path}/left")
    follow()
    later = events.where(F.col("event_id") > _middle(spark, folder))  # the old stream has seen the others
    second = s.moved_history(later, ["user_id"], "event_id", "event_type", spark.read.parquet(f"{path}/left"))
    run_to_end(append_only(second, f"{path}/new", f"{path}/new-checkpoint"))
    seen = spark.read.schema(second.schema).parquet(f"{path}/new")
    return seen.withColumn("last_categories", F.array_join("last_categories", ","))


@query(
    "stream_cut_over",
    f"SELECT event_type, user_id, CAST(SUM(amount) AS DOUBLE) AS total FROM {EVENTS_SQL} GROUP BY 1, 2",
)
def stream_cut_over(spark, folder):
    """Two versions of the totals side by side; readers follow the pointer, which moves when the two agree."""
    prepare_streaming(spark)
    path = scratch_path(spark, "cut")
    events = _events(spark, folder)
    old = events.groupBy("event_type", "user_id").agg(F.sum("amount").alias("total"))
    cents = F.sum((F.col("amount") * 100).cast("long"))
    new = events.groupBy("event_type", "user_id").agg((cents / F.lit(100)).cast("decimal(28,2)").alias("total"))
    (old_run, old_table), (new_run, new_table) = dual_run(old, new, path, ["event_type", "user_id"])
    batches = [run_to_end(run).lastProgress for run in (old_run, new_run)]
    readers = CutOver(f"{path}/cut", old_table, new_table, ["total"], needed=1)
    readers.check(spark, min(p["batchId"] for p in batches))
    return as_doubles(readers.read(spark), "total")


@query("stream_csv_rows", f"SELECT event_id, user_id, event_type, CAST(amount AS DOUBLE) AS amount FROM {EVENTS_SQL}")
def stream_csv_rows(spark, folder):
    """Every row once in CSV files that roll after so many rows."""
    path = scratch_path(spark, "csv")
    rows = _events(spark, folder).drop("ts")
    run_to_end(csv_files(rows, f"{path}/out", f"{path}/checkpoint", rows_per_file=1_000_000))
    return as_doubles(spark.read.schema(rows.schema).csv(f"{path}/out"), "amount")


@query(
    "event_time_bridge",
    "SELECT event_id, user_id, event_type, date_trunc('millisecond', ts) AS event_time FROM events",
)
def event_time_bridge(spark, folder):
    """Records with epoch milliseconds as a named table with an event time, read by SQL."""
    rows = with_zone(load_table(spark, folder, "events")).withColumn("millis", F.unix_millis("ts"))
    event_table(rows.drop("ts"), "event_time_bridge", "millis")
    return without_zone(spark.sql("SELECT event_id, user_id, event_type, event_time FROM event_time_bridge"))


@query(
    "table_as_stream",
    """SELECT event_type, COUNT(*) AS table_rows, COUNT(*) AS stream_rows, 'same' AS difference
    FROM events GROUP BY 1""",
)
def table_as_stream(spark, folder):
    """One input function gives the files as a table and as a stream; both count the same rows."""
    prepare_streaming(spark)
    path = scratch_path(spark, "switch")
    schema = load_table(spark, folder, "events").schema

    def counted(bounded: bool) -> DataFrame:
        # as a pattern, the path may be a file, too
        rows = table_input(spark, f"{folder}/{{events.parquet}}", schema, bounded)
        return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))

    kept = KeyedTable(f"{path}/table", ["event_type"])
    run_to_end(upsert(counted(bounded=False), kept, f"{path}/checkpoint"))
    both = compare_outputs(counted(bounded=True), kept.read(spark), ["event_type"], ["rows"])
    return both.withColumnsRenamed({"old_rows": "table_rows", "new_rows": "stream_rows"})


@query(
    "stream_file_time",
    "SELECT event_type, COUNT(*) AS n, COUNT(*) AS timed FROM events GROUP BY 1",
)
def stream_file_time(spark, folder):
    """Rows take the time at which their file was written as event time; it is known for all and never ahead."""
    prepare_streaming(spark)
    path = scratch_path(spark, "file-time")
    schema = load_table(spark, folder, "events").schema
    timed = with_file_time(file_stream(spark, f"{folder}/{{events.parquet}}", schema), "written")
    run_to_end(append_only(timed.select("event_type", "written"), f"{path}/out", f"{path}/checkpoint"))
    rows = spark.read.parquet(f"{path}/out")
    known = F.col("written") <= F.current_timestamp()
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(known).alias("timed"))
