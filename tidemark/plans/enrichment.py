"""Enrichment: as-of, broadcast and lookup joins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.functions.scalars import lookup
from tidemark.operators import joins
from tidemark.plans.inputs import EVENTS_SQL, as_doubles, events
from tidemark.plans.registry import query
from tidemark.plans.running import both
from tidemark.sources.tables import load_table

# fixed values: a small dimension that leaves one event type out
MULTIPLIERS = {"view": 1.0, "click": 1.5, "purchase": 0.8, "signup": 2.0}
TITLES = {"view": "Looked", "click": "Clicked", "purchase": "Bought", "signup": "Joined"}

TITLES_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in TITLES.items()) + ") AS t(event_type, title)"


def _signups(spark, folder, hot):
    return events(spark, folder, hot).where(F.col("event_type") == "signup").select(
        "user_id", "event_id", "ts", F.col("amount").alias("rate")
    )


@both(
    "enrich_tier",
    f"""SELECT c.event_id, c.user_id, COALESCE('tier' || CAST(p.event_id % 3 AS VARCHAR), 'unknown') AS tier
    FROM (SELECT * FROM events WHERE event_type <> 'signup') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') p
    ON c.user_id = p.user_id AND c.event_id >= p.event_id""",
)
def enrich_tier(spark, folder, max_rows):
    every = events(spark, folder, bool(max_rows))
    clicks = every.where(F.col("event_type") != "signup").select("event_id", "user_id")
    profiles = every.where(F.col("event_type") == "signup").select(
        "event_id", "user_id", F.concat(F.lit("tier"), (F.col("event_id") % 3).cast("string")).alias("tier")
    )
    return joins.enrich_with_tier(clicks, profiles, "user_id", "event_id", max_rows=max_rows)


@both(
    "temporal_join",
    f"""SELECT t.event_id, t.user_id, CAST(t.amount AS DOUBLE) AS amount, CAST(r.amount AS DOUBLE) AS rate,
        CAST(t.amount * r.amount AS DOUBLE) AS converted
    FROM (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'purchase') t
    ASOF JOIN (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'signup') r
    ON t.user_id = r.user_id AND t.ts >= r.ts""",
)
def temporal_join(spark, folder, max_rows):
    trades = events(spark, folder, bool(max_rows)).where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", "amount"
    )
    joined = joins.as_of(
        trades, _signups(spark, folder, bool(max_rows)), ["user_id"], "ts", "ts", "event_id", "event_id", ["rate"],
        max_rows=max_rows,
    )
    joined = joined.withColumn("converted", F.col("amount") * F.col("rate")).drop("ts")
    return as_doubles(joined, "amount", "rate", "converted")


@both(
    "held_enrichment",
    f"""SELECT c.event_id, c.user_id,
        COALESCE(CAST(p.amount AS VARCHAR), CASE WHEN n.ts <= c.ts + INTERVAL 12 HOURS THEN CAST(n.amount AS VARCHAR) END, 'unknown') AS tier
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'signup') p ON c.user_id = p.user_id AND c.ts >= p.ts
    ASOF LEFT JOIN (SELECT * FROM {EVENTS_SQL} WHERE event_type = 'signup') n ON c.user_id = n.user_id AND c.ts < n.ts""",
)
def held_enrichment(spark, folder, max_rows):
    clicks = events(spark, folder, bool(max_rows)).where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    profiles = _signups(spark, folder, bool(max_rows)).withColumn("tier", F.col("rate").cast("string"))
    return joins.enrich_with_hold(
        clicks, profiles, "user_id", "ts", "event_id", timedelta(hours=12), max_rows=max_rows
    ).drop("ts")


@query(
    "broadcast_multiplier",
    """SELECT event_id, event_type, value, CAST(multiplier AS DOUBLE) AS multiplier,
        CAST(CAST(value AS DECIMAL(18,2)) * multiplier AS DOUBLE) AS adjusted,
        CASE WHEN multiplier IS NULL THEN 'unknown' ELSE 'adjusted' END AS status
    FROM events LEFT JOIN (VALUES """
    + ", ".join(f"('{k}', {v}::DECIMAL(4,1))" for k, v in MULTIPLIERS.items())
    + ") AS m(event_type, multiplier) USING (event_type)",
)
def broadcast_multiplier(spark, folder):
    # two versions per type; the second one counts
    rows = [(k, i, v + 1 - i) for k, v in MULTIPLIERS.items() for i in (0, 1)]
    table = spark.createDataFrame(rows, "event_type string, version int, multiplier double")
    table = table.withColumn("multiplier", F.col("multiplier").cast("decimal(4,1)"))
    priced = events(spark, folder).select("event_id", "event_type", F.col("amount").alias("value"))
    adjusted = joins.apply_multiplier(priced, table, "event_type", "value", order=["version"])
    return as_doubles(adjusted, "value", "multiplier", "adjusted")


@query(
    "broadcast_dimension",
    """SELECT s_suppkey, s_name, n_name FROM supplier
    LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey""",
)
def broadcast_dimension(spark, folder):
    nations = load_table(spark, folder, "nation").where("n_regionkey < 3")
    nations = nations.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = load_table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return joins.lookup_dimension(suppliers, nations, ["s_nationkey"]).drop("s_nationkey")


@query(
    "large_dimension",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def large_dimension(spark, folder):
    lines = load_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    kinds = load_table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return joins.lookup_dimension(lines, kinds, ["l_orderkey"])


TITLE_SQL = f"SELECT event_id, event_type, COALESCE(title, '?') AS title FROM events LEFT JOIN {TITLES_SQL} USING (event_type)"


def _typed(spark, folder):
    return load_table(spark, folder, "events").select("event_id", "event_type")


@query("lookup_default", TITLE_SQL)
def lookup_default(spark, folder):
    table = spark.createDataFrame(list(TITLES.items()), "event_type string, title string")
    return joins.lookup_or_default(_typed(spark, folder), table, "event_type", "title")


@query("lookup_mapping", TITLE_SQL)
def lookup_mapping(spark, folder):
    return _typed(spark, folder).withColumn("title", lookup("event_type", TITLES, "?"))


def ask_title(kind):
    return TITLES.get(kind)


@query("async_lookup", TITLE_SQL)
def async_lookup(spark, folder):
    return joins.async_lookup(_typed(spark, folder), "event_type", ask_title, "title")


@query("lateral_lookup", TITLE_SQL)
def lateral_lookup(spark, folder):
    table = spark.createDataFrame(list(TITLES.items()), "event_type string, title string")
    return joins.lateral_lookup(_typed(spark, folder), table, "event_type", "title")
