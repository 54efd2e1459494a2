"""Top-N per group and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_spenders(
    orders: DataFrame,
    n: int = 1,
    category: str = "category",
    user: str = "userId",
    amount: str = "amount",
) -> DataFrame:
    """The n users with the highest total per category; equal totals rank by user.

    `row_number() <= n` lets Spark keep only n rows per category and task
    before the shuffle, so a large category does not gather in one task.
    """
    spent = orders.groupBy(category, user).agg(F.sum(amount).alias("total"))
    ranked = Window.partitionBy(category).orderBy(F.col("total").desc(), F.col(user))
    return spent.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= n)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], values: Sequence[str]
) -> DataFrame:
    """The last row per key, combined before the shuffle."""
    last = F.max_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
