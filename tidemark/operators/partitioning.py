"""Placement of rows, and grouping that stands hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 8

# fixed values: upper price limits of the buckets 0, 1 and 2; dearer goes to 3
PRICE_LIMITS = (50, 200, 1000)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round robin over n tasks."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer tasks without a shuffle; more tasks need one."""
    return df.coalesce(n) if n <= df.rdd.getNumPartitions() else df.repartition(n)


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def price_bucket(price: Column | str) -> Column:
    p = F.col(price) if isinstance(price, str) else price
    result = None
    for bucket, limit in enumerate(PRICE_LIMITS):
        small = p < limit
        result = F.when(small, bucket) if result is None else result.when(small, bucket)
    return result.otherwise(len(PRICE_LIMITS))


def by_price_bucket(
    df: DataFrame, n: int, price: str = "price", spread: int = 1, row_id: Sequence[str] = ()
) -> DataFrame:
    """Place each row by its price bucket, modulo n.

    With `spread` each bucket gets that many neighbouring partitions instead of
    one, and a hash of the row's identity picks among them, so a bucket that
    holds much of the data does not end up in a single task.
    """
    bucketed = df.withColumn("bucket", price_bucket(price))
    if spread == 1:
        return bucketed.repartitionById(n, F.col("bucket"))
    place = F.pmod(F.xxhash64(*row_id), F.lit(spread)).cast("int")
    return bucketed.repartitionById(n * spread, F.pmod("bucket", F.lit(n)) * spread + place)


def tag_partition(df: DataFrame) -> DataFrame:
    return df.withColumn("partition", F.spark_partition_id())


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per partition as the data lies now."""
    return df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n")
    )


def salted_partials(
    df: DataFrame, keys: Sequence[str], amount: str, row_id: Sequence[str] | Column, salts: int = SALTS
) -> DataFrame:
    """Phase one: sum and count per key and salt.

    The salt is a hash of the row's identity, so a repeated task salts alike. A
    number that is spread evenly anyway, such as a running id, can be given as it is.
    """
    number = row_id if isinstance(row_id, Column) else F.xxhash64(*row_id)
    salt = F.pmod(number, F.lit(salts)).cast("int")
    return df.groupBy(*keys, salt.alias("salt")).agg(
        F.sum(amount).alias("total"), F.count(F.lit(1)).alias("n")
    )


def salted_totals(
    df: DataFrame, keys: Sequence[str], amount: str, row_id: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Phase two: one row per key from the salted parts."""
    parts = salted_partials(df, keys, amount, row_id, salts)
    return parts.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def salted_window_totals(
    df: DataFrame,
    keys: Sequence[str],
    window: Column,
    amount: str,
    row_id: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Both phases per time window: phase two sees at most `salts` rows per key and window."""
    framed = df.withColumn("window", window)
    return salted_totals(framed, [*keys, "window"], amount, row_id, salts)


def key_shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def key_placement(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: in how many partitions it lies now, and its rows."""
    placed = tag_partition(df.select(*keys)).groupBy(*keys, "partition").agg(F.count(F.lit(1)).alias("n"))
    return placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n"))


def skew_report(df: DataFrame, keys: Sequence[str], factor: float = 5.0) -> DataFrame:
    """Per key: rows, share of all rows, ratio to the mean of the keys, and whether that exceeds `factor`.

    Says how uneven the keys are, whatever number of tasks they would be dealt to.
    """
    counts = key_shares(df, keys)
    whole = counts.agg(F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_keys"))
    ratio = F.col("n") * F.col("_keys") / F.col("_rows")
    # `whole` is one row
    return counts.join(F.broadcast(whole), F.lit(True)).select(
        *keys, "n", (F.col("n") / F.col("_rows")).alias("share"), ratio.alias("ratio"), (ratio > factor).alias("skewed")
    )
