"""Event-time windows, watermarks and late rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import duration, interval
from tidemark.operators.ordered import OrderedGroups, following, running_max, running_sum, scan

MILLISECOND = timedelta(milliseconds=1)


def tumbling_totals(
    df: DataFrame, keys: Sequence[str], at: str, size: timedelta, amount: str
) -> DataFrame:
    """Sum per key and window `[start, end)`, aligned to the epoch."""
    return _windowed(df, keys, F.window(at, duration(size)), amount)


def sliding_totals(
    df: DataFrame, keys: Sequence[str], at: str, size: timedelta, slide: timedelta, amount: str
) -> DataFrame:
    """Sum per key and overlapping window."""
    return _windowed(df, keys, F.window(at, duration(size), duration(slide)), amount)


def _windowed(df: DataFrame, keys: Sequence[str], window: Column, amount: str) -> DataFrame:
    grouped = df.groupBy(window.alias("_w"), *keys).agg(
        F.sum(amount).alias("total"), F.count(F.lit(1)).alias("n")
    )
    return grouped.select(
        *keys,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        (F.col("_w.end") - interval(MILLISECOND)).alias("window_time"),
        "total",
        "n",
    )


def tumbling_totals_sql(df: DataFrame, key: str, at: str, seconds: int, amount: str) -> DataFrame:
    """The same tumbling window written as SQL."""
    return df.sparkSession.sql(
        f"""SELECT {key}, window.start AS window_start, window.end AS window_end,
                   SUM({amount}) AS total, COUNT(*) AS n
            FROM {{df}} GROUP BY {key}, window({at}, '{seconds} seconds')""",
        df=df,
    )


def with_watermark_before(
    df: DataFrame,
    arrival: Sequence[str],
    at: str,
    bound: timedelta,
    moved_by: Column | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Add `watermark`: how far event time had got before each row arrived.

    It is the highest event time of the earlier arrivals minus the bound and one
    millisecond, null for the first row. With `moved_by` only the rows that
    satisfy it move the watermark (punctuated watermarks).
    """
    source = F.col(at) if moved_by is None else F.when(moved_by, F.col(at))
    groups = OrderedGroups(df, [], arrival, max_rows)
    seen = groups.done(groups.scan(groups.rows, _seen=running_max(source, before=True)))
    return seen.withColumn("watermark", F.col("_seen") - interval(bound + MILLISECOND)).drop("_seen")


def late_disposition(
    df: DataFrame,
    arrival: Sequence[str],
    at: str,
    size: timedelta,
    bound: timedelta,
    lateness: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Tag each row on_time, late_update or too_late for its tumbling window.

    The window is complete once the watermark reaches its last millisecond. It
    still takes rows for `lateness` after that.
    """
    seen = with_watermark_before(df, arrival, at, bound, None, max_rows)
    window = F.window(at, duration(size))
    last = F.col("window_end") - interval(MILLISECOND)
    return (
        seen.withColumn("window_end", window["end"])
        .withColumn(
            "disposition",
            F.when(F.col("watermark") >= last + interval(lateness), "too_late")
            .when(F.col("watermark") >= last, "late_update")
            .otherwise("on_time"),
        )
    )


def window_firings(
    tagged: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    amount: str,
    max_rows: int | None = None,
) -> DataFrame:
    """What a window with allowed lateness emits: its total when it closes, and again per late row.

    `tagged` comes from `late_disposition`; it is read more than once, so write it
    first when it is large. Rows that are too late take no part.
    """
    kept = tagged.where(F.col("disposition") != "too_late")
    seen = scan(
        kept, [*keys, "window_end"], arrival, max_rows,
        total=running_sum(amount), _next=following("disposition"),
    )
    late = F.col("disposition") == "late_update"
    closes = ~late & (F.col("_next").isNull() | (F.col("_next") == "late_update"))
    return seen.where(late | closes).select(
        *keys, *arrival, "window_end", "total", F.when(late, "update").otherwise("fire").alias("firing")
    )


def late_rows(tagged: DataFrame) -> DataFrame:
    """The rows that came too late for their window (the side output)."""
    return tagged.where(F.col("disposition") == "too_late")
