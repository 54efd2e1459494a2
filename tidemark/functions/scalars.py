"""Scalar expressions used by the operators."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, functions as F, types as T


def from_epoch_millis(millis: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(F.col(millis) if isinstance(millis, str) else millis)


def interval(length: timedelta) -> Column:
    return F.lit(length)


def duration(length: timedelta) -> str:
    """The duration string that windows and watermarks take."""
    micros = length // timedelta(microseconds=1)
    return f"{micros // 1000} milliseconds" if micros % 1000 == 0 else f"{micros} microseconds"


def money(amount: Column | str) -> Column:
    """Amounts with two decimals; their sums do not depend on the row order."""
    return (F.col(amount) if isinstance(amount, str) else amount).cast(T.DecimalType(18, 2))


def two_decimals(amount: Column | str) -> Column:
    """Text with exactly two decimals."""
    return F.format_string("%.2f", (F.col(amount) if isinstance(amount, str) else amount).cast("double"))


def joined(items: Column) -> Column:
    return F.array_join(items, ",")


def list_tail(items: Column, n: int) -> Column:
    """The last n elements of an array."""
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)


def csv_line(*columns: str) -> Column:
    """Fields as one comma-separated line; an absent field stays as an empty place."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def lookup(key: Column | str, table: Mapping[str, str], default: str) -> Column:
    """Value of a small fixed mapping, or the default for unknown keys."""
    key = F.col(key) if isinstance(key, str) else key
    if not table:
        return F.lit(default)
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def order_number(column: str, dtype: T.DataType) -> Column | None:
    """The column as a number that sorts the same way, or None if there is none.

    Times without a zone are taken apart by hand, so the session time zone
    cannot disturb their order.
    """
    c = F.col(column)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        micros = (
            F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
            + F.hour(c).cast("long") * 3_600_000_000
            + F.minute(c).cast("long") * 60_000_000
            + (F.expr(f"extract(SECOND FROM `{column}`)") * 1_000_000).cast("long")
        )
        return micros.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (T.IntegralType, T.FractionalType, T.BooleanType)):
        return c.cast("double")
    return None
