"""Event-time windows and late rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F, types as T

from tidemark.functions.scalars import order_number
from tidemark.operators import eventtime
from tidemark.plans.inputs import EVENTS_SQL, as_doubles, events
from tidemark.plans.registry import query
from tidemark.session import write_and_read

HOUR = timedelta(hours=1)


@query(
    "tumbling_revenue",
    f"""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
        time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
        time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS window_time,
        CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n
    FROM {EVENTS_SQL} GROUP BY event_type, time_bucket(INTERVAL 1 DAY, ts)""",
)
def tumbling_revenue(spark, folder):
    return as_doubles(
        eventtime.tumbling_totals(events(spark, folder), ["event_type"], "ts", timedelta(days=1), "amount"), "total"
    )


@query(
    "tumbling_sql",
    f"""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
        CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n
    FROM {EVENTS_SQL} GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)""",
)
def tumbling_sql(spark, folder):
    return as_doubles(
        eventtime.tumbling_totals_sql(events(spark, folder), "event_type", "ts", 3600, "amount"), "total"
    )


@query(
    "sliding_revenue",
    f"""SELECT event_type, start AS window_start, start + INTERVAL 6 HOURS AS window_end,
        start + INTERVAL 6 HOURS - INTERVAL 1 MILLISECOND AS window_time,
        CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n
    FROM (SELECT event_type, amount, time_bucket(INTERVAL 2 HOURS, ts) - INTERVAL 2 HOURS * k AS start
          FROM {EVENTS_SQL}, range(3) AS r(k))
    GROUP BY event_type, start""",
)
def sliding_revenue(spark, folder):
    return as_doubles(
        eventtime.sliding_totals(
            events(spark, folder), ["event_type"], "ts", timedelta(hours=6), timedelta(hours=2), "amount"
        ),
        "total",
    )


def _arrivals(spark, folder):
    """Events delayed by up to eight hours: `arrival` in minutes, ties by event_id."""
    minutes = F.floor(order_number("ts", T.TimestampNTZType()) / 60_000_000)
    return events(spark, folder).withColumn("arrival", minutes + F.pmod(F.col("event_id") * 7919, F.lit(480)))


ARRIVAL_SQL = f"(SELECT *, epoch_us(ts) // 60000000 + (event_id * 7919) % 480 AS arrival FROM {EVENTS_SQL})"
WATERMARK_SQL = f"""(SELECT *, MAX(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        - INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS watermark,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end FROM {ARRIVAL_SQL})"""
TAGGED_SQL = f"""(SELECT *, CASE
        WHEN watermark >= window_end - INTERVAL 1 MILLISECOND + INTERVAL 2 HOURS THEN 'too_late'
        WHEN watermark >= window_end - INTERVAL 1 MILLISECOND THEN 'late_update' ELSE 'on_time' END AS disposition
    FROM {WATERMARK_SQL})"""


def _tagged(spark, folder):
    return eventtime.late_disposition(
        _arrivals(spark, folder), ["arrival", "event_id"], "ts", HOUR, HOUR, 2 * HOUR
    )


@query("late_disposition", f"SELECT event_id, ts, watermark, window_end, disposition FROM {TAGGED_SQL}")
def late_disposition(spark, folder):
    return _tagged(spark, folder).select("event_id", "ts", "watermark", "window_end", "disposition")


@query(
    "punctuated_watermark",
    f"""SELECT event_id, MAX(CASE WHEN event_type = 'purchase' THEN ts END)
        OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        - INTERVAL 1 MILLISECOND AS watermark FROM {ARRIVAL_SQL}""",
)
def punctuated_watermark(spark, folder):
    return eventtime.with_watermark_before(
        _arrivals(spark, folder), ["arrival", "event_id"], "ts", timedelta(0), F.col("event_type") == "purchase"
    ).select("event_id", "watermark")


def _firings(spark, folder, max_rows):
    tagged = write_and_read(_tagged(spark, folder), "tagged")
    fired = eventtime.window_firings(
        tagged, ["event_type"], ["arrival", "event_id"], "amount", max_rows
    )
    return as_doubles(fired.select("event_type", "event_id", "window_end", "total", "firing"), "total")


FIRINGS_SQL = f"""WITH k AS (SELECT *, SUM(amount) OVER w AS total, LEAD(disposition) OVER w AS nxt FROM {TAGGED_SQL}
        WHERE disposition <> 'too_late'
        WINDOW w AS (PARTITION BY event_type, window_end ORDER BY arrival, event_id))
    SELECT event_type, event_id, window_end, CAST(total AS DOUBLE) AS total,
        CASE WHEN disposition = 'late_update' THEN 'update' ELSE 'fire' END AS firing
    FROM k WHERE disposition = 'late_update' OR nxt IS NULL OR nxt = 'late_update'"""


@query("late_updates", FIRINGS_SQL)
def late_updates(spark, folder):
    return _firings(spark, folder, None)


@query("late_updates_split", FIRINGS_SQL)
def late_updates_split(spark, folder):
    return _firings(spark, folder, 1)


@query(
    "late_side",
    f"SELECT event_id, event_type, CAST(amount AS DOUBLE) AS amount, ts FROM {TAGGED_SQL} WHERE disposition = 'too_late'",
)
def late_side(spark, folder):
    rows = eventtime.late_rows(_tagged(spark, folder))
    return as_doubles(rows.select("event_id", "event_type", "amount", "ts"), "amount")


@query(
    "on_time_totals",
    f"""SELECT event_type, window_end, CAST(SUM(amount) AS DOUBLE) AS total FROM {TAGGED_SQL}
    WHERE disposition = 'on_time' GROUP BY event_type, window_end""",
)
def on_time_totals(spark, folder):
    kept = _tagged(spark, folder).where(F.col("disposition") == "on_time")
    return as_doubles(kept.groupBy("event_type", "window_end").agg(F.sum("amount").alias("total")), "total")
