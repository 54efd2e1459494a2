"""Tables, literal rows and the bridge from records to event time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.scalars import duration, from_epoch_millis


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def with_zone(df: DataFrame) -> DataFrame:
    """Times without a zone read as UTC instants, as watermarks require."""
    return _recast(df, T.TimestampNTZType, T.TimestampType())


def without_zone(df: DataFrame) -> DataFrame:
    return _recast(df, T.TimestampType, T.TimestampNTZType())


def _recast(df: DataFrame, kind: type, to: T.DataType) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast(to).alias(f.name) if isinstance(f.dataType, kind) else F.col(f.name)
            for f in df.schema
        ]
    )


def literal_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: str, seq: str = "seq"
) -> DataFrame:
    """Given rows with their position, from 1, as the arrival order."""
    numbered = [(i, *row) for i, row in enumerate(rows, 1)]
    return spark.createDataFrame(numbered, f"{seq} int, {schema}")


def event_table(
    df: DataFrame,
    view: str,
    millis: str = "ts",
    event_time: str = "event_time",
    bound: timedelta = timedelta(seconds=2),
) -> DataFrame:
    """Records as a named table with a computed event time and its watermark.

    The watermark takes effect on streams; bounded tables ignore it.
    """
    table = df.withColumn(event_time, from_epoch_millis(millis)).withWatermark(
        event_time, duration(bound)
    )
    table.createOrReplaceTempView(view)
    return table


def keep_table(df: DataFrame, name: str) -> None:
    """Store a table in the catalog, visible to later sessions on the same metastore."""
    df.write.mode("overwrite").saveAsTable(name)
