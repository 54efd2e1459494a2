"""Projection, filtering, routing and grouped totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import timedelta
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import interval


def purchase_tuples(
    events: DataFrame, action: str = "action", category: str = "category", price: str = "price"
) -> DataFrame:
    """(category, price) of the purchases."""
    return events.where(F.col(action).eqNullSafe("purchase")).select(category, price)


def number_chain(df: DataFrame, column: str) -> DataFrame:
    """Add one, drop multiples of seven, turn into text."""
    plus_one = df.select((F.col(column) + 1).alias("x"))
    return plus_one.where(F.col("x") % 7 != 0).select(F.col("x").cast("string").alias("x"))


def letter_chain(df: DataFrame, column: str, dropped: str = "B") -> DataFrame:
    """Upper case, drop one value, put the rest in angle brackets."""
    upper = df.select(F.upper(column).alias("s"))
    return upper.where(F.col("s") != dropped).select(F.concat(F.lit("<"), "s", F.lit(">")).alias("s"))


def prefixed(df: DataFrame, column: str, prefix: str = "deployed-") -> DataFrame:
    return df.select(F.concat(F.lit(prefix), F.col(column).cast("string")).alias(column))


def route_by_value(
    events: DataFrame, threshold: float = 500, action: str = "action", price: str = "price"
) -> DataFrame:
    """Add `route`: every row has exactly one of high, regular, non_purchase.

    A purchase at the threshold itself is regular. Consumers filter on the
    column, so one pass over the input feeds them all.
    """
    bought = F.col(action).eqNullSafe("purchase")
    return events.withColumn(
        "route",
        F.when(bought & (F.col(price) > threshold), "high").when(bought, "regular").otherwise("non_purchase"),
    )


def split_valid(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the others with the first failed check as `reason`.

    A check that evaluates to null has failed.
    """
    reason = F.coalesce(
        *[F.when(~F.coalesce(check, F.lit(False)), F.lit(name)) for name, check in checks.items()]
    )
    tagged = df.withColumn("reason", reason)
    return tagged.where("reason IS NULL").drop("reason"), tagged.where("reason IS NOT NULL")


def keep_at_least(df: DataFrame, column: str, threshold: float = 25) -> DataFrame:
    return df.where(F.col(column) >= threshold)


def explode_items(df: DataFrame, items: Column, name: str) -> DataFrame:
    """Zero to many rows per input row."""
    return df.select("*", F.explode(items).alias(name))


def totals(
    df: DataFrame, keys: Sequence[str], amount: str, name: str = "total", counted: str | None = None
) -> DataFrame:
    """Sum per key, with the row count on request."""
    parts = [F.sum(amount).alias(name)]
    if counted:
        parts.append(F.count(F.lit(1)).alias(counted))
    return df.groupBy(*keys).agg(*parts)


def totals_with_time(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Sum per key stamped with the time of the computation."""
    return totals(df, keys, amount).withColumn("last_updated", F.current_timestamp())


def fold_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fold: Callable[[pd.Series], Any],
    result_type: str,
    name: str = "result",
) -> DataFrame:
    """A user-written aggregate that can merge its own results (sum, max, ...).

    `fold` runs per key and Arrow batch where the rows lie, and only its results are
    shuffled and folded again.
    """

    @F.pandas_udf(result_type)
    def folded(values: pd.Series) -> Any:
        return fold(values)

    kept = df.select(*keys, F.col(value).alias("_value"))
    partial = T.StructType([*kept.schema.fields[:-1], T.StructField("_folded", folded.returnType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([("_value", "list")])
            results = [fold(pd.Series(v)) for v in lists["_value_list"].to_pylist()]
            columns = [lists[k].combine_chunks() for k in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(results, from_pandas=True)], names=[*keys, "_folded"])

    return kept.mapInArrow(run, partial).groupBy(*keys).agg(folded(F.col("_folded")).alias(name))


def idle_total(
    df: DataFrame, keys: Sequence[str], at: str, amount: str, now: Column, ttl: timedelta
) -> DataFrame:
    """Sum per key over the keys that were active within `ttl` before `now`."""
    per_key = df.groupBy(*keys).agg(F.sum(amount).alias("total"), F.max(at).alias("last_seen"))
    return per_key.where(F.col("last_seen") > now - interval(ttl))


VARIANTS = {
    "v0_baseline": "SELECT category, SUM(amount) AS revenue FROM {orders} GROUP BY category",
    "v1_projection": "SELECT category, SUM(amount) * 1.0 AS revenue FROM {orders} GROUP BY category",
    "v2_filter_after": """
        SELECT category, revenue
        FROM (SELECT category, SUM(amount) AS revenue FROM {orders} GROUP BY category)
        WHERE revenue > {after}""",
    "v3_filter_before": """
        SELECT category, SUM(amount) AS revenue FROM {orders}
        WHERE amount > {before} GROUP BY category""",
    "v4_extra_key": """
        SELECT category, userId, SUM(amount) AS revenue FROM {orders}
        GROUP BY category, userId""",
}


def query_variant(orders: DataFrame, variant: str, after: float = 1.0, before: float = 5.0) -> DataFrame:
    """One of the five variants of the revenue query, as SQL over any orders table."""
    return orders.sparkSession.sql(
        VARIANTS[variant].format(orders="{orders}", after=after, before=before), orders=orders
    )
