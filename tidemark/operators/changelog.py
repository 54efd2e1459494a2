"""Running totals and change rows (+I, -U, +U, -D)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import running_count, running_min, running_sum, scan


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    amount: str,
    name: str = "total",
    max_rows: int | None = None,
) -> DataFrame:
    """One output per input row: the total of its key up to that row."""
    return scan(df, keys, [seq], max_rows, **{name: running_sum(amount)})


def _change(op: str, order: int, **fields: Column) -> Column:
    return F.struct(
        F.lit(op).alias("op"), F.lit(order).alias("step"), *[c.alias(n) for n, c in fields.items()]
    )


def _unfold(df: DataFrame, columns: Sequence[str], changes: Column) -> DataFrame:
    return df.select(*columns, F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("_c")).select(
        *columns, "_c.*"
    )


def to_changelog(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    amount: str,
    name: str = "total",
    max_rows: int | None = None,
) -> DataFrame:
    """The change rows of a running SUM per key.

    The first row of a key gives +I. Each later one takes the old total back
    (-U) and gives the new one (+U). `step` orders the two rows of one `seq`.
    """
    seen = scan(
        df, keys, [seq], max_rows,
        _new=running_sum(amount), _old=running_sum(amount, before=True), _n=running_count(),
    )
    later = F.col("_n") > 1
    changes = F.array(
        F.when(later, _change("-U", 0, **{name: F.col("_old")})),
        F.when(later, _change("+U", 1, **{name: F.col("_new")})).otherwise(
            _change("+I", 1, **{name: F.col("_new")})
        ),
    )
    return _unfold(seen, [*keys, seq], changes)


def collapse(changes: DataFrame, keys: Sequence[str], seq: str, name: str = "total") -> DataFrame:
    """The table that the change rows describe: the last write per key, minus deleted keys."""
    last = F.max_by(F.struct("op", name), F.struct(seq, "step"))
    current = changes.where(F.col("op") != "-U").groupBy(*keys).agg(last.alias("_last"))
    return current.where(F.col("_last.op") != "-D").select(*keys, f"_last.{name}")


def leader_changelog(
    df: DataFrame,
    group: str,
    member: str,
    seq: str,
    amount: str,
    max_rows: int | None = None,
) -> DataFrame:
    """Change rows of "the member with the highest total per group".

    Among equal totals the smallest member leads. Totals must only grow, so that the
    leader is the best (total, member) seen so far: a negative amount is an error.
    """
    refused = F.raise_error(F.lit(f"{amount} must not be negative")).cast(df.schema[amount].dataType)
    spent = running_sum(F.when(F.col(amount) < 0, refused).otherwise(F.coalesce(F.col(amount), F.lit(0))))
    summed = scan(df, [group, member], [seq], max_rows, True, _sum=spent)
    best = F.struct((-F.col("_sum")).alias("under"), F.col(member).alias("member"))
    led = scan(
        summed, [group], [seq], max_rows, like=df,
        _best=running_min(best), _was=running_min(best, before=True),
    )
    changed = led.where(F.col("_was").isNull() | (F.col("_best") != F.col("_was")))

    def fields(box: str) -> dict[str, Column]:
        return {member: F.col(f"{box}.member"), "total": -F.col(f"{box}.under")}

    first = F.col("_was").isNull()
    rows = F.array(
        F.when(~first, _change("-U", 0, **fields("_was"))),
        F.when(first, _change("+I", 1, **fields("_best"))).otherwise(_change("+U", 1, **fields("_best"))),
    )
    return _unfold(changed, [group, seq], rows)


def require_append_only(df: DataFrame) -> DataFrame:
    """Pass rows on, but refuse a changelog that takes rows back.

    On a stream the append output mode does the same check when the query starts.
    """
    if "op" not in df.columns:
        return df
    refused = F.raise_error(F.concat(F.lit("not an append-only table: found "), F.col("op")))
    return df.where(F.when(F.col("op") == "+I", True).otherwise(refused.cast("boolean"))).drop("op", "step")
