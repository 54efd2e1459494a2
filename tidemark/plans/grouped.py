"""Projection, routing, totals, variants, ranking."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.functions.scalars import csv_line, money, two_decimals
from tidemark.operators import partitioning, ranking, relational
from tidemark.operators.joins import compare_outputs
from tidemark.plans.inputs import EVENTS_SQL, ORDERS_SQL, as_doubles, events, orders
from tidemark.plans.registry import query
from tidemark.sources.generators import order_fields
from tidemark.sources.tables import load_table


@query("purchase_tuples", "SELECT event_type AS category, value AS price FROM events WHERE event_type = 'purchase'")
def purchase_tuples(spark, folder):
    return relational.purchase_tuples(
        load_table(spark, folder, "events").select(
            F.col("event_type").alias("action"), F.col("event_type").alias("category"), F.col("value").alias("price")
        )
    )


@query(
    "micro_chain",
    "SELECT CAST(l_orderkey + 1 AS VARCHAR) AS x FROM lineitem WHERE (l_orderkey + 1) % 7 <> 0",
)
def micro_chain(spark, folder):
    return relational.number_chain(load_table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "letter_chain",
    "SELECT '<' || upper(event_type) || '>' AS s FROM events WHERE upper(event_type) <> 'VIEW'",
)
def letter_chain(spark, folder):
    return relational.letter_chain(load_table(spark, folder, "events"), "event_type", "VIEW")


@query("prefixed_ids", "SELECT 'deployed-' || CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders")
def prefixed_ids(spark, folder):
    return relational.prefixed(load_table(spark, folder, "orders"), "o_orderkey")


ROUTE_SQL = """SELECT event_id, value, CASE
        WHEN event_type = 'purchase' AND value > 25 THEN 'high'
        WHEN event_type = 'purchase' THEN 'regular' ELSE 'non_purchase' END AS route
    FROM events"""


def _routed(spark, folder):
    return relational.route_by_value(load_table(spark, folder, "events"), 25, "event_type", "value")


@query("route_by_value", ROUTE_SQL)
def route_by_value(spark, folder):
    return _routed(spark, folder).select("event_id", "value", "route")


@query(
    "route_totals",
    f"SELECT route, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM ({ROUTE_SQL}) GROUP BY route",
)
def route_totals(spark, folder):
    routed = _routed(spark, folder).withColumn("amount", money("value"))
    return as_doubles(relational.totals(routed, ["route"], "amount", counted="n"), "total")


def _checked(spark, folder):
    return relational.split_valid(
        load_table(spark, folder, "events").select("event_id", "event_type", "value"),
        {"error event": F.col("event_type") != "error", "too large": F.col("value") < 100},
    )


@query("valid_rows", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'error' AND value < 100")
def valid_rows(spark, folder):
    return _checked(spark, folder)[0]


@query(
    "dead_letters",
    """SELECT event_id, event_type, value,
        CASE WHEN event_type = 'error' THEN 'error event' ELSE 'too large' END AS reason
    FROM events WHERE event_type = 'error' OR value >= 100""",
)
def dead_letters(spark, folder):
    return _checked(spark, folder)[1]


@query("keep_at_least", "SELECT event_id, value FROM events WHERE value >= 25")
def keep_at_least(spark, folder):
    return relational.keep_at_least(load_table(spark, folder, "events").select("event_id", "value"), "value")


@query(
    "exploded_items",
    """SELECT o_orderkey, UNNEST(string_split(o_orderpriority, '-')) AS item FROM orders""",
)
def exploded_items(spark, folder):
    items = load_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return relational.explode_items(items, F.split("o_orderpriority", "-"), "item").drop("o_orderpriority")


@query(
    "numbered_orders",
    """SELECT 'o' || CAST(event_id AS VARCHAR) AS orderId, 'u' || CAST(event_id % 4 AS VARCHAR) AS userId,
        10.0::DOUBLE + (event_id % 5) * 5.0::DOUBLE AS amount FROM events""",
)
def numbered_orders(spark, folder):
    return load_table(spark, folder, "events").select(*order_fields("event_id"))


@query(
    "csv_lines",
    """SELECT CAST(orderId AS VARCHAR) || ',' || CAST(userId AS VARCHAR) || ',' || CAST(amount AS VARCHAR) AS line
    FROM """ + ORDERS_SQL,
)
def csv_lines(spark, folder):
    return orders(spark, folder).select(csv_line("orderId", "userId", "amount").alias("line"))


@query(
    "formatted_amounts",
    "SELECT o_orderkey, printf('%.2f', o_totalprice) AS shown FROM orders",
)
def formatted_amounts(spark, folder):
    return load_table(spark, folder, "orders").select("o_orderkey", two_decimals("o_totalprice").alias("shown"))


@query(
    "totals_by_category",
    f"SELECT category, CAST(SUM(amount) AS DOUBLE) AS total FROM {ORDERS_SQL} GROUP BY category",
)
def totals_by_category(spark, folder):
    return as_doubles(relational.totals(orders(spark, folder), ["category"], "amount"), "total")


@query(
    "totals_and_count",
    f"SELECT category, CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n FROM {ORDERS_SQL} GROUP BY category",
)
def totals_and_count(spark, folder):
    return as_doubles(relational.totals(orders(spark, folder), ["category"], "amount", counted="n"), "total")


@query(
    "totals_with_time",
    f"SELECT category, CAST(SUM(amount) AS DOUBLE) AS total, TRUE AS stamped FROM {ORDERS_SQL} GROUP BY category",
)
def totals_with_time(spark, folder):
    stamped = relational.totals_with_time(orders(spark, folder), ["category"], "amount")
    return as_doubles(stamped, "total").withColumn("stamped", F.col("last_updated").isNotNull()).drop("last_updated")


@query(
    "folded_max",
    "SELECT event_type, MAX(value) AS top FROM events GROUP BY event_type",
)
def folded_max(spark, folder):
    return relational.fold_per_key(
        load_table(spark, folder, "events").select("event_type", "value"),
        ["event_type"], "value", lambda values: values.max(), "double", "top",
    )


@query(
    "idle_total",
    f"""SELECT user_id, CAST(SUM(amount) AS DOUBLE) AS total, MAX(ts) AS last_seen FROM {EVENTS_SQL}
    GROUP BY user_id HAVING MAX(ts) > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 HOURS""",
)
def idle_total(spark, folder):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    kept = relational.idle_total(
        events(spark, folder), ["user_id"], "ts", "amount", now, timedelta(hours=12)
    )
    return as_doubles(kept, "total")


VARIANT_SQL = {
    "v0_baseline": "SELECT category, SUM(amount) AS revenue FROM {o} GROUP BY category",
    "v1_projection": "SELECT category, SUM(amount) * 1.0 AS revenue FROM {o} GROUP BY category",
    "v2_filter_after": "SELECT category, SUM(amount) AS revenue FROM {o} GROUP BY category HAVING SUM(amount) > 400000000",
    "v3_filter_before": "SELECT category, SUM(amount) AS revenue FROM {o} WHERE amount > 250000 GROUP BY category",
    "v4_extra_key": "SELECT category, userId, SUM(amount) AS revenue FROM {o} GROUP BY category, userId",
}


def _variant(name):
    def run(spark, folder):
        shown = relational.query_variant(orders(spark, folder), name, after=400_000_000, before=250_000)
        return as_doubles(shown, "revenue")

    run.__name__ = name
    return run


for _name, _sql in VARIANT_SQL.items():
    query(
        _name, f"SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM ({_sql.format(o=ORDERS_SQL)})"
    )(_variant(_name))


@query(
    "compare_outputs",
    f"""SELECT COALESCE(a.category, b.category) AS category, a.userId AS userId,
        CAST(a.revenue AS DOUBLE) AS old_revenue, CAST(b.revenue AS DOUBLE) AS new_revenue,
        CASE WHEN b.category IS NULL THEN 'only_old' WHEN a.category IS NULL THEN 'only_new'
             WHEN a.revenue IS NOT DISTINCT FROM b.revenue THEN 'same' ELSE 'changed' END AS difference
    FROM (SELECT category, userId, SUM(amount) AS revenue FROM {ORDERS_SQL} GROUP BY 1, 2) a
    FULL JOIN (SELECT category, userId, SUM(amount) AS revenue FROM {ORDERS_SQL} WHERE amount > 150000 GROUP BY 1, 2) b
    ON a.category = b.category AND a.userId = b.userId""",
)
def compare(spark, folder):
    every = orders(spark, folder)
    keys = ["category", "userId"]
    old = relational.totals(every, keys, "amount", "revenue")
    new = relational.totals(every.where(F.col("amount") > 150_000), keys, "amount", "revenue")
    return as_doubles(compare_outputs(old, new, keys, ["revenue"]), "old_revenue", "new_revenue")


def _top_sql(n):
    return f"""SELECT category, userId, CAST(total AS DOUBLE) AS total, rn FROM (
        SELECT category, userId, total, ROW_NUMBER() OVER (PARTITION BY category ORDER BY total DESC, userId) AS rn
        FROM (SELECT category, userId, SUM(amount) AS total FROM {ORDERS_SQL} GROUP BY 1, 2)) WHERE rn <= {n}"""


@query("top_spender", _top_sql(1))
def top_spender(spark, folder):
    return _ranked(spark, folder, 1)


@query("top_n_spenders", _top_sql(10))
def top_n_spenders(spark, folder):
    return _ranked(spark, folder, 10)


def _ranked(spark, folder, n):
    ranked = ranking.top_spenders(orders(spark, folder), n)
    return as_doubles(ranked, "total").withColumn("rn", F.col("rn").cast("long"))


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type, ts, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""",
)
def latest_per_key(spark, folder):
    return ranking.latest_per_key(
        load_table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "ts", "value"]
    )


@query(
    "salted_totals",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
        COUNT(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def salted_totals(spark, folder):
    lines = load_table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", money("l_extendedprice").alias("amount")
    )
    summed = partitioning.salted_totals(
        lines, ["l_returnflag", "l_linestatus"], "amount", ["l_orderkey", "l_linenumber"]
    )
    return as_doubles(summed, "total")


@query(
    "salted_window_totals",
    f"""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
        CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n FROM {EVENTS_SQL} GROUP BY 1, 2""",
)
def salted_window_totals(spark, folder):
    summed = partitioning.salted_window_totals(
        events(spark, folder), ["event_type"], F.window("ts", "1 day"), "amount", ["event_id"]
    )
    return as_doubles(
        summed.select("event_type", F.col("window.end").alias("window_end"), "total", "n"), "total"
    )


@query(
    "salted_partials",
    f"""SELECT event_type, CAST(event_id % 8 AS INTEGER) AS salt, CAST(SUM(amount) AS DOUBLE) AS total,
        COUNT(*) AS n FROM {EVENTS_SQL} GROUP BY 1, 2""",
)
def salted_partials(spark, folder):
    parts = partitioning.salted_partials(
        events(spark, folder), ["event_type"], "amount", F.col("event_id")
    )
    return as_doubles(parts, "total")


@query(
    "price_buckets",
    """SELECT o_orderkey, CASE WHEN o_totalprice / 1000 < 50 THEN 0 WHEN o_totalprice / 1000 < 200 THEN 1
        WHEN o_totalprice / 1000 < 1000 THEN 2 ELSE 3 END AS bucket FROM orders""",
)
def price_buckets(spark, folder):
    priced = load_table(spark, folder, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("price"))
    spread = max(1, _tasks(spark) // 4)
    return partitioning.by_price_bucket(priced, 4, spread=spread, row_id=["o_orderkey"]).drop("price")


def _tasks(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("key_shares", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id")
def key_shares(spark, folder):
    return partitioning.key_shares(load_table(spark, folder, "events"), ["user_id"])


@query(
    "skew_report",
    """SELECT event_type, n, n / SUM(n) OVER () AS share, n * COUNT(*) OVER () / SUM(n) OVER () AS ratio,
        n * COUNT(*) OVER () / SUM(n) OVER () > 5 AS skewed
    FROM (SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type)""",
)
def skew_report(spark, folder):
    return partitioning.skew_report(load_table(spark, folder, "events"), ["event_type"])


@query("partition_report", "SELECT user_id, 1 AS partitions, COUNT(*) AS n FROM events GROUP BY user_id")
def partition_report(spark, folder):
    """Placement by key puts each key into one partition."""
    users = load_table(spark, folder, "events").select("user_id")
    return partitioning.key_placement(partitioning.by_key(users, _tasks(spark), "user_id"), ["user_id"])
