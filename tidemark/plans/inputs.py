"""The given tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import money
from tidemark.sources.tables import load_table


def events(spark: SparkSession, folder: str, hot: bool = False) -> DataFrame:
    """Events with exact amounts; event_id is the arrival order.

    With `hot`, every third user counts as user 0, who then has a third of the rows.
    """
    user = hot_key("user_id") if hot else F.col("user_id")
    return load_table(spark, folder, "events").select(
        "event_id", "ts", user.alias("user_id"), "event_type", money("value").alias("amount")
    )


def hot_key(column: str) -> Column:
    return F.when(F.col(column) % 3 == 0, F.lit(0).cast("long")).otherwise(F.col(column))


def with_hot_key(sql: str, table: str, column: str) -> str:
    """The same in SQL: read the table with its key column made hot."""
    hot = f"(SELECT * REPLACE (CASE WHEN {column} % 3 = 0 THEN 0 ELSE {column} END AS {column}) FROM {table})"
    return sql.replace(f"FROM {table}", f"FROM {hot}")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer's market segment as category."""
    customer = load_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return (
        load_table(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("orderId"),
            F.col("o_custkey").alias("userId"),
            F.col("c_mktsegment").alias("category"),
            money("o_totalprice").alias("amount"),
        )
    )


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# the SQL form of the two views above
EVENTS_SQL = "(SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS amount FROM events)"
ORDERS_SQL = """(SELECT o_orderkey AS orderId, o_custkey AS userId, c_mktsegment AS category,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey)"""
