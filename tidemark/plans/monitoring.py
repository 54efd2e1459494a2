"""Metrics, histograms, ticks, alerts, retention."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import metrics, ranking
from tidemark.plans.inputs import EVENTS_SQL, as_doubles, events, hot_key
from tidemark.plans.registry import query
from tidemark.plans.running import both
from tidemark.sources.tables import load_table


@query(
    "metrics_dropped",
    "SELECT COUNT(*) FILTER (WHERE value < 25) AS dropped, COUNT(*) FILTER (WHERE value >= 25) AS kept, arg_max(value, event_id) AS latest FROM events",
)
def metrics_dropped(spark, folder):
    return metrics.counters(load_table(spark, folder, "events"), "value", "event_id")


def _rounded(df):
    return df.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})


HISTOGRAM = """COUNT(value) AS n, MIN(value) AS low, MAX(value) AS high,
    ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.95), 6) AS p95,
    ROUND(quantile_cont(value, 0.99), 6) AS p99"""


@query(
    "latency_histogram",
    f"SELECT {HISTOGRAM} FROM (SELECT value FROM events ORDER BY event_id DESC LIMIT 1024)",
)
def latency_histogram(spark, folder):
    return _rounded(metrics.reservoir_histogram(load_table(spark, folder, "events"), "value", "event_id"))


@query(
    "latency_histogram_by_type",
    f"""SELECT event_type, {HISTOGRAM} FROM (SELECT event_type, value,
        ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn <= 1024 GROUP BY event_type""",
)
def latency_histogram_by_type(spark, folder):
    return _rounded(
        metrics.reservoir_histogram(load_table(spark, folder, "events"), "value", "event_id", ["event_type"])
    )


@query(
    "throughput_ticks",
    """WITH c AS (SELECT time_bucket(INTERVAL 10 MINUTES, ts) AS tick, COUNT(*) AS n FROM events GROUP BY 1)
    SELECT g.tick, COALESCE(c.n, 0) AS n FROM
        (SELECT UNNEST(generate_series((SELECT MIN(tick) FROM c), (SELECT MAX(tick) FROM c), INTERVAL 10 MINUTES)) AS tick) g
    LEFT JOIN c ON c.tick = g.tick""",
)
def throughput_ticks(spark, folder):
    return metrics.throughput_ticks(load_table(spark, folder, "events"), "ts", timedelta(minutes=10))


HELD = """l AS (SELECT *, COALESCE(LAG(above) OVER w, FALSE) AS was FROM a
        WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
    s AS (SELECT *, LAST_VALUE(CASE WHEN above AND NOT was THEN ts END IGNORE NULLS)
        OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS since FROM l)"""


@both(
    "sustained_alert",
    f"""WITH v AS (SELECT event_type, ts, CAST(SUM(amount) OVER w AS DOUBLE) / COUNT(amount) OVER w AS average
            FROM {EVENTS_SQL} WINDOW w AS (PARTITION BY event_type ORDER BY ts
                RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)),
        a AS (SELECT *, average > 50 AS above FROM v), {HELD}
    SELECT event_type, ts, average, COALESCE(above AND ts - since >= INTERVAL 2 HOURS, FALSE) AS firing FROM s""",
)
def sustained_alert(spark, folder, max_rows):
    return metrics.sustained_average(
        events(spark, folder, bool(max_rows)), ["event_type"], "ts", "amount",
        timedelta(hours=6), 50, timedelta(hours=2), max_rows,
    )


@both(
    "increase_alert",
    f"""WITH d AS (SELECT event_type, ts, event_id, CASE WHEN amount >= LAG(amount) OVER w
                THEN amount - LAG(amount) OVER w WHEN LAG(amount) OVER w IS NOT NULL THEN amount END AS d
            FROM {EVENTS_SQL} WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
        i AS (SELECT *, COALESCE(SUM(d) OVER w, 0) - COALESCE(FIRST_VALUE(d) OVER w, 0) AS increase
            FROM d WINDOW w AS (PARTITION BY event_type ORDER BY ts
                RANGE BETWEEN INTERVAL 3 HOURS PRECEDING AND CURRENT ROW)),
        a AS (SELECT *, increase > 150 AS above FROM i), {HELD}
    SELECT event_type, ts, event_id, CAST(increase AS DOUBLE) AS increase,
        COALESCE(above AND ts - since >= INTERVAL 1 HOUR, FALSE) AS firing FROM s""",
)
def increase_alert(spark, folder, max_rows):
    found = metrics.increase_alert(
        events(spark, folder, bool(max_rows)), ["event_type"], "ts", "event_id", "amount",
        timedelta(hours=3), 150, timedelta(hours=1), max_rows,
    )
    return as_doubles(found, "increase")


@both(
    "gap_alert",
    """SELECT user_id, ts + INTERVAL 24 HOURS AS alert_time, nxt AS resumed FROM (
        SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
    WHERE COALESCE(nxt, TIMESTAMP '2024-01-31 00:00:00') > ts + INTERVAL 24 HOURS""",
)
def gap_alert(spark, folder, max_rows):
    return metrics.gap_alert(
        events(spark, folder, bool(max_rows)), ["user_id"], "ts", "event_id", timedelta(hours=24), max_rows,
        now=F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"),
    )


@both(
    "retention_select",
    """SELECT o_orderkey, o_custkey, CASE WHEN rn <= 5 OR (wk = 1 AND o_orderdate >= TIMESTAMP '2001-06-30' - INTERVAL 90 DAYS)
            THEN 'keep' ELSE 'delete' END AS verdict FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn,
            ROW_NUMBER() OVER (PARTITION BY o_custkey, date_trunc('week', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS wk
        FROM orders)""",
    table="orders",
    key="o_custkey",
)
def retention_select(spark, folder, max_rows):
    customer = hot_key("o_custkey") if max_rows else F.col("o_custkey")
    kept = metrics.retention(
        load_table(spark, folder, "orders").select("o_orderkey", customer.alias("o_custkey"), "o_orderdate"),
        "o_custkey", "o_orderdate", "o_orderkey", F.lit("2001-06-30").cast("timestamp_ntz"), max_rows=max_rows,
    )
    return kept.drop("o_orderdate")


@query(
    "last_transition",
    """SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus, MAX(o_orderdate) AS o_orderdate
    FROM orders GROUP BY o_custkey""",
)
def last_transition(spark, folder):
    return ranking.latest_per_key(
        load_table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderdate"]
    )
