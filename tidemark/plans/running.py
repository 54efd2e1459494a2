"""Running values, change rows and per-key event logic.

Every `_split` query is the same computation on keys of which one holds a third
of the rows, with each key above a small share cut into stretches, as large
inputs are by default.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import changelog, keyed, leaders
from tidemark.plans.inputs import EVENTS_SQL, as_doubles, events, with_hot_key
from tidemark.plans.registry import query

HALF_DAY = timedelta(hours=12)


def both(name, sql, table="events", key="user_id"):
    """Register a query as it is, and with a hot key and forced splitting."""

    def register(fn):
        query(name, sql)(lambda spark, folder: fn(spark, folder, None))
        query(f"{name}_split", with_hot_key(sql, table, key))(lambda spark, folder: fn(spark, folder, 1))
        return fn

    return register


RUNNING = "OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)"


@both(
    "running_revenue",
    f"SELECT event_id, event_type, CAST(SUM(amount) {RUNNING} AS DOUBLE) AS total FROM {EVENTS_SQL}",
)
def running_revenue(spark, folder, max_rows):
    seen = changelog.running_total(
        events(spark, folder, bool(max_rows)).select("event_id", "event_type", "amount"),
        ["event_type"], "event_id", "amount", max_rows=max_rows,
    )
    return as_doubles(seen.drop("amount"), "total")


@query(
    "running_tenfold",
    f"SELECT event_id, user_id, CAST(SUM(amount) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) * 10 AS DOUBLE) AS total FROM {EVENTS_SQL}",
)
def running_tenfold(spark, folder):
    seen = changelog.running_total(
        events(spark, folder).select("event_id", "user_id", "amount"), ["user_id"], "event_id", "amount"
    )
    return seen.select("event_id", "user_id", (F.col("total") * 10).cast("double").alias("total"))


@both(
    "changelog_totals",
    f"""WITH r AS (SELECT event_id, event_type, amount, SUM(amount) {RUNNING} AS total,
            ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM {EVENTS_SQL})
    SELECT event_id, event_type, CASE WHEN rn = 1 THEN '+I' ELSE '+U' END AS op, 1 AS step,
        CAST(total AS DOUBLE) AS total FROM r
    UNION ALL
    SELECT event_id, event_type, '-U', 0, CAST(total - amount AS DOUBLE) FROM r WHERE rn > 1""",
)
def changelog_totals(spark, folder, max_rows):
    changes = changelog.to_changelog(events(spark, folder, bool(max_rows)), ["event_type"], "event_id", "amount", max_rows=max_rows)
    return as_doubles(changes, "total")


@query(
    "changelog_collapse",
    f"SELECT event_type, CAST(SUM(amount) AS DOUBLE) AS total FROM {EVENTS_SQL} GROUP BY event_type",
)
def changelog_collapse(spark, folder):
    changes = changelog.to_changelog(events(spark, folder), ["event_type"], "event_id", "amount")
    return as_doubles(changelog.collapse(changes, ["event_type"], "event_id"), "total")


@both(
    "top_spender_changelog",
    f"""WITH s AS (SELECT event_id, event_type, user_id,
            SUM(amount) OVER (PARTITION BY event_type, user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS total
            FROM {EVENTS_SQL}),
        m AS (SELECT *, MAX(total) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best FROM s),
        l AS (SELECT a.event_id, a.event_type, a.best AS total, MIN(b.user_id) AS user_id FROM m a
              JOIN s b ON a.event_type = b.event_type AND b.total = a.best AND b.event_id <= a.event_id
              GROUP BY 1, 2, 3),
        p AS (SELECT *, LAG(total) OVER w AS was_total, LAG(user_id) OVER w AS was_user FROM l
              WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
    SELECT event_id, event_type, CASE WHEN was_total IS NULL THEN '+I' ELSE '+U' END AS op, 1 AS step,
        user_id, CAST(total AS DOUBLE) AS total FROM p
    WHERE was_total IS NULL OR total <> was_total OR user_id <> was_user
    UNION ALL
    SELECT event_id, event_type, '-U', 0, was_user, CAST(was_total AS DOUBLE) FROM p
    WHERE was_total IS NOT NULL AND (total <> was_total OR user_id <> was_user)""",
)
def top_spender_changelog(spark, folder, max_rows):
    changes = changelog.leader_changelog(
        events(spark, folder, bool(max_rows)), "event_type", "user_id", "event_id", "amount", max_rows
    )
    return as_doubles(changes, "total")


REFUNDED_SQL = """(SELECT event_id, event_type, user_id,
    CAST(CASE WHEN event_id % 3 = 0 THEN -value ELSE value END AS DECIMAL(18,2)) AS amount FROM events)"""


@both(
    "leader_with_refunds",
    f"""WITH s AS (SELECT *, SUM(amount) OVER w AS total, LEAD(event_id) OVER w AS until FROM {REFUNDED_SQL}
            WINDOW w AS (PARTITION BY event_type, user_id ORDER BY event_id)),
        l AS (SELECT a.event_id, a.event_type, b.user_id, b.total FROM s a
              JOIN s b ON a.event_type = b.event_type AND b.event_id <= a.event_id AND (b.until IS NULL OR a.event_id < b.until)
              QUALIFY ROW_NUMBER() OVER (PARTITION BY a.event_type, a.event_id ORDER BY b.total DESC, b.user_id) = 1),
        p AS (SELECT *, LAG(total) OVER w AS was_total, LAG(user_id) OVER w AS was_user FROM l
              WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
    SELECT event_id, event_type, CASE WHEN was_total IS NULL THEN '+I' ELSE '+U' END AS op, 1 AS step,
        user_id, CAST(total AS DOUBLE) AS total FROM p
    WHERE was_total IS NULL OR total <> was_total OR user_id <> was_user
    UNION ALL
    SELECT event_id, event_type, '-U', 0, was_user, CAST(was_total AS DOUBLE) FROM p
    WHERE was_total IS NOT NULL AND (total <> was_total OR user_id <> was_user)""",
)
def leader_with_refunds(spark, folder, max_rows):
    """Every third event takes its amount back from its user."""
    refund = F.when(F.col("event_id") % 3 == 0, -F.col("amount")).otherwise(F.col("amount"))
    rows = events(spark, folder, bool(max_rows)).withColumn("amount", refund.cast("decimal(18,2)"))
    changes = leaders.leader_changes(
        rows, "event_type", "user_id", "event_id", "amount", max_rows, **({"stretch": 37} if max_rows else {})
    )
    return as_doubles(changes, "total")


@both(
    "click_history",
    """SELECT event_id, user_id, COUNT(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS "count",
        array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING), ',') AS last_categories
    FROM events""",
)
def click_history(spark, folder, max_rows):
    seen = keyed.click_history(
        events(spark, folder, bool(max_rows)).select("event_id", "user_id", "event_type"),
        "user_id", "event_id", "event_type", max_rows=max_rows,
    )
    return seen.select("event_id", "user_id", "count", F.array_join("last_categories", ",").alias("last_categories"))


TYPES = ("click", "error", "purchase", "signup", "view")
BY_USER = "OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"


@both(
    "spend_summary",
    f"""SELECT event_id, user_id, CAST(SUM(amount) {BY_USER} AS DOUBLE) AS spend, """
    + ", ".join(f"NULLIF(COUNT(*) FILTER (WHERE event_type = '{t}') {BY_USER}, 0) AS n_{t}" for t in TYPES)
    + f" FROM {EVENTS_SQL}",
)
def spend_summary(spark, folder, max_rows):
    seen = keyed.spend_summary(
        events(spark, folder, bool(max_rows)), "user_id", "event_id", "event_type", "amount", TYPES, max_rows
    )
    counts = [F.try_element_at("counts", F.lit(t)).alias(f"n_{t}") for t in TYPES]
    return as_doubles(seen.select("event_id", "user_id", "spend", *counts), "spend")


@both(
    "category_counts",
    f"""SELECT event_id, user_id, event_type, CAST(SUM(amount) {BY_USER} AS DOUBLE) AS spend,
        ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS category_count FROM {EVENTS_SQL}""",
)
def category_counts(spark, folder, max_rows):
    seen = keyed.category_counts(
        events(spark, folder, bool(max_rows)), "user_id", "event_id", "event_type", "amount", max_rows
    )
    return as_doubles(seen.select("event_id", "user_id", "event_type", "spend", "category_count"), "spend")


def _session_sql(hours, same="<"):
    return f"""(SELECT *, SUM(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
        FROM (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) {same} INTERVAL {hours} HOURS
                  THEN 0 ELSE 1 END AS new FROM {EVENTS_SQL}))"""


@both(
    "ttl_session_counter",
    f"""SELECT event_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) AS counter
    FROM {_session_sql(12)}""",
)
def ttl_session_counter(spark, folder, max_rows):
    return keyed.session_counter(
        events(spark, folder, bool(max_rows)).select("event_id", "user_id", "ts"), ["user_id"], "ts", "event_id", HALF_DAY, max_rows
    ).select("event_id", "user_id", "counter")


@both(
    "ttl_sum",
    f"""SELECT event_id, user_id,
        CAST(SUM(amount) OVER (PARTITION BY user_id, session ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
    FROM {_session_sql(12)}""",
)
def ttl_sum(spark, folder, max_rows):
    seen = keyed.expiring_sum(
        events(spark, folder, bool(max_rows)), ["user_id"], "ts", "event_id", "amount", HALF_DAY, max_rows
    )
    return as_doubles(seen.select("event_id", "user_id", "total"), "total")


@both(
    "session_windows",
    f"""SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 8 HOURS AS session_end, COUNT(*) AS n,
        CAST(SUM(amount) AS DOUBLE) AS total FROM {_session_sql(8, '<=')} GROUP BY user_id, session""",
)
def session_windows(spark, folder, max_rows):
    found = keyed.sessions(
        events(spark, folder, bool(max_rows)), ["user_id"], "ts", "event_id", timedelta(hours=8), "amount", max_rows
    )
    return as_doubles(found, "total")


@both(
    "abandoned_cart",
    """SELECT user_id, ts + INTERVAL 6 HOURS AS alert_time, 'abandoned cart' AS reason FROM (
        SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
        FROM events WHERE event_type IN ('click', 'purchase'))
    WHERE event_type = 'click' AND (nxt IS NULL OR nxt > ts + INTERVAL 6 HOURS)""",
)
def abandoned_cart(spark, folder, max_rows):
    return keyed.abandoned_carts(
        events(spark, folder, bool(max_rows)), "user_id", "ts", "event_id", "event_type", timedelta(hours=6),
        cart="click", max_rows=max_rows,
    )


@both(
    "batch_flush",
    """SELECT event_id, user_id, size, CASE WHEN size = 3 THEN 'FLUSH 3 events: ' || items
            ELSE 'buffering: ' || event_type || ' (size=' || size || ')' END AS message FROM (
        SELECT *, CAST((rn - 1) % 3 + 1 AS INTEGER) AS size,
            array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS 2 PRECEDING), ',') AS items
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events))""",
)
def batch_flush(spark, folder, max_rows):
    seen = keyed.batch_flush(
        events(spark, folder, bool(max_rows)), ["user_id"], "event_id", "event_type", 3, max_rows
    )
    return seen.select("event_id", "user_id", "size", "message")
