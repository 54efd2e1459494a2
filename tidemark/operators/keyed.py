"""Per-key event logic: history, session counters, abandonment, batching."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import interval
from tidemark.operators.ordered import (
    OrderedGroups,
    following,
    latest,
    previous,
    running_count,
    running_sum,
    scan,
    tail,
)


def click_history(
    events: DataFrame,
    user: str,
    seq: str,
    category: str,
    n: int = 5,
    max_rows: int | None = None,
) -> DataFrame:
    """Per event: how many the user has had so far, and the last n categories, newest last."""
    return scan(
        events, [user], [seq], max_rows, count=running_count(), last_categories=tail(category, n)
    )


#: most values of a column that may become map keys or columns without being declared
MOST_CATEGORIES = 200


def distinct_values(df: DataFrame, column: str, most: int = MOST_CATEGORIES) -> list:
    """The values of a category column, sorted; more than `most` are an error."""
    known = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(known) > most:
        raise ValueError(f"{column} has more than {most} values: declare those wanted, or use category_counts")
    return sorted(r[0] for r in known)


def category_counts(
    events: DataFrame, user: str, seq: str, category: str, amount: str, max_rows: int | None = None
) -> DataFrame:
    """Per event: the user's spend so far, and as `category_count` how often its own category came so far.

    The summary for any number of categories: the counts are rows, so nothing is looked up
    first and nothing grows with the number of categories.
    """
    spent = scan(events, [user], [seq], max_rows, settled=True, spend=running_sum(amount))
    return scan(spent, [user, category], [seq], max_rows, category_count=running_count())


def spend_summary(
    events: DataFrame,
    user: str,
    seq: str,
    category: str,
    amount: str,
    categories: Sequence | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Per event: the user's spend so far and how often each category occurred (`counts`, a map).

    Each output row carries every category of its user, so the result is rows
    times categories by definition; the counts are one running count each. Without
    `categories` their values are looked up first, up to MOST_CATEGORIES; a value that is
    not among the given ones is an error. `category_counts` takes any number.
    """
    if categories is not None:
        strange = F.raise_error(F.concat(F.lit("not a declared category: "), F.col(category).cast("string")))
        known = F.col(category).isNull() | F.col(category).isin(list(categories))
        kind = events.schema[category].dataType
        events = events.withColumn(category, F.when(known, F.col(category)).otherwise(strange.cast(kind)))
    names = list(categories) if categories is not None else distinct_values(events, category)
    counters = {
        f"_count{i}": running_sum(F.when(F.col(category) == name, 1).otherwise(0))
        for i, name in enumerate(names)
    }
    seen = scan(events, [user], [seq], max_rows, spend=running_sum(amount), **counters)
    if not names:
        return seen.withColumn("counts", F.create_map().cast("map<string,bigint>"))
    every = F.map_from_arrays(
        F.array(*[F.lit(name) for name in names]), F.array(*[F.col(c) for c in counters])
    )
    return seen.withColumn("counts", F.map_filter(every, lambda _, count: count > 0)).drop(*counters)


def _with_sessions(
    groups: OrderedGroups, at: str, starts_new: Column, amount: Column | None
) -> DataFrame:
    """Add `_start` (time), `_skip` (rows before the session) and `_skip_sum`."""
    values = {"_prev": previous(at), "_n": running_count()}
    if amount is not None:
        values["_sum"] = running_sum(amount)
    step = groups.settle(groups.scan(groups.rows, **values))
    first = F.col("_prev").isNull() | starts_new
    marks = {
        "_start": latest(F.when(first, F.col(at))),
        "_skip": latest(F.when(first, F.col("_n") - 1)),
    }
    if amount is not None:
        marks["_skip_sum"] = latest(F.when(first, F.col("_sum") - amount))
    return groups.done(groups.scan(step, **marks))


def session_counter(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    ttl: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Count per key that starts again at 1 once the key was silent for `ttl` or longer."""
    groups = OrderedGroups(events, keys, [at, tie], max_rows)
    silent = F.col(at) - F.col("_prev") >= interval(ttl)
    seen = _with_sessions(groups, at, silent, None)
    return seen.withColumn("counter", F.col("_n") - F.col("_skip")).drop("_prev", "_n", "_start", "_skip")


def expiring_sum(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    amount: str,
    ttl: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Running sum per key that is dropped once the key was silent for `ttl` or longer."""
    groups = OrderedGroups(events, keys, [at, tie], max_rows)
    silent = F.col(at) - F.col("_prev") >= interval(ttl)
    value = F.coalesce(F.col(amount), F.lit(0))
    seen = _with_sessions(groups, at, silent, value)
    return seen.withColumn("total", F.col("_sum") - F.col("_skip_sum")).drop(
        "_prev", "_n", "_sum", "_start", "_skip", "_skip_sum"
    )


def sessions(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    gap: timedelta,
    amount: str,
    max_rows: int | None = None,
) -> DataFrame:
    """Session windows `[first, last + gap)` per key with row count and sum.

    A row exactly one gap after the last one still belongs to the session, as
    with the built-in session window: windows that touch are one. The built-in
    one merges all rows of a key in one task; here hot keys are split and the
    final grouping is combined before its shuffle.
    """
    groups = OrderedGroups(events, keys, [at, tie], max_rows)
    silent = F.col(at) - F.col("_prev") > interval(gap)
    step = groups.settle(groups.scan(groups.rows, _prev=previous(at)))
    first = F.col("_prev").isNull() | silent
    marked = groups.done(groups.scan(step, session_start=latest(F.when(first, F.col(at)))))
    return marked.groupBy(*keys, "session_start").agg(
        (F.max(at) + interval(gap)).alias("session_end"),
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("total"),
    )


def abandoned_carts(
    events: DataFrame,
    user: str,
    at: str,
    tie: str,
    action: str,
    timeout: timedelta,
    cart: str = "add_to_cart",
    purchase: str = "purchase",
    max_rows: int | None = None,
) -> DataFrame:
    """An alert at cart time + timeout unless the user's next cart or purchase comes by then.

    Other actions do not matter. A further cart event starts the wait anew.
    """
    relevant = events.where(F.col(action).isin(cart, purchase)).select(user, at, tie, action)
    seen = scan(relevant, [user], [at, tie], max_rows, _next=following(at))
    deadline = F.col(at) + interval(timeout)
    open_cart = (F.col(action) == cart) & (F.col("_next").isNull() | (F.col("_next") > deadline))
    return seen.where(open_cart).select(
        user, deadline.alias("alert_time"), F.lit("abandoned cart").alias("reason")
    )


def batch_flush(
    events: DataFrame,
    shard: Sequence[str],
    seq: str,
    category: str,
    n: int = 3,
    max_rows: int | None = None,
) -> DataFrame:
    """Per event either the fill of its buffer, or the flushed list at every n-th event of a shard."""
    seen = scan(events, shard, [seq], max_rows, _n=running_count(), _items=tail(category, n))
    size = (F.pmod(F.col("_n") - 1, F.lit(n)) + 1).cast("int")
    flushes = F.col("size") == n
    return (
        seen.withColumn("size", size)
        .withColumn("flushed", F.when(flushes, F.col("_items")))
        .withColumn(
            "message",
            F.when(
                flushes,
                F.concat(F.lit(f"FLUSH {n} events: "), F.array_join(F.transform("_items", lambda c: c.cast("string")), ",")),
            ).otherwise(F.format_string("buffering: %s (size=%d)", F.col(category), F.col("size"))),
        )
        .drop("_n", "_items")
    )
