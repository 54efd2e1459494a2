"""Generated rows: numbered orders, skewed keys, random fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def order_fields(i: Column | str) -> list[Column]:
    """The order with number i: id, one of four users, one of five amounts."""
    n = F.col(i) if isinstance(i, str) else i
    return [
        F.concat(F.lit("o"), n.cast("string")).alias("orderId"),
        F.concat(F.lit("u"), (n % 4).cast("string")).alias("userId"),
        (F.lit(10.0) + (n % 5) * F.lit(5.0)).alias("amount"),
    ]


def numbered_orders(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(*order_fields("id"))


def numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def skewed_events(spark: SparkSession, n: int, hot: str = "VIP", share: float = 0.9) -> DataFrame:
    """About `share` of the rows on one key, the rest evenly on u1 to u3, value 1.

    The draw is a hash of the row number: the same rows in every run and retry.
    """
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    other = F.concat(F.lit("u"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) + 1).cast("string"))
    return spark.range(n).select(
        "id", F.when(draw < share, hot).otherwise(other).alias("k"), F.lit(1).cast("long").alias("v")
    )


def random_amounts(spark: SparkSession, n: int, low: int = 5, values: int = 50) -> DataFrame:
    """Whole amounts from `low` on, `values` different ones."""
    drawn = F.pmod(F.xxhash64("id"), F.lit(values)) + low
    return spark.range(n).select("id", drawn.cast("double").alias("amount"))


def random_text(row: Column, length: int, salt: int) -> Column:
    """Hex digits; length 1 gives 16 different values."""
    digests = [F.sha2(F.concat_ws(":", row, F.lit(salt), F.lit(i)), 256) for i in range(-(-length // 64))]
    return F.substring(F.concat(*digests), 1, length)


def random_between(row: Column, low: float, high: float, salt: int) -> Column:
    unit = F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(1_000_000_007)) / 1_000_000_007
    return F.lit(low) + unit * (high - low)


def datagen(spark: SparkSession, n: int, fields: Mapping[str, Mapping], start: int = 0) -> DataFrame:
    """Random rows. Fields: `{"length": 4}` for text, `{"min": 1, "max": 50}` for doubles,
    `{"kind": "sequence", "start": 0}` for consecutive numbers."""
    return generated(spark.range(start, start + n), "id", fields)


def generated(rows: DataFrame, row: str, fields: Mapping[str, Mapping]) -> DataFrame:
    columns = []
    for salt, (name, spec) in enumerate(fields.items()):
        if spec.get("kind") == "sequence":
            column = F.col(row) + spec.get("start", 0)
        elif "length" in spec:
            column = random_text(F.col(row), spec["length"], salt)
        else:
            column = random_between(F.col(row), spec["min"], spec["max"], salt)
        columns.append(column.alias(name))
    return rows.select(*columns)


def paced_datagen(spark: SparkSession, per_second: int, fields: Mapping[str, Mapping]) -> DataFrame:
    """The same random rows as an endless stream; `proc_time` is the clock time of each."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return generated(rate, "value", fields).withColumn("proc_time", F.current_timestamp())
