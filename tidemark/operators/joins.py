"""Enrichment: as-of, broadcast and lookup joins, and output comparison."""

from __future__ import annotations

import time
from collections import OrderedDict, deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import timedelta
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.scalars import interval
from tidemark.operators.ordered import Running, latest, next_known, scan
from tidemark.operators.ranking import latest_per_key

# fixed values: what a lookup says where the service has no answer, or none in time
UNKNOWN, TIMED_OUT = "?", "?TIMEOUT?"


def _with_versions(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    version_at: str,
    tie: str,
    version_tie: str,
    values: Sequence[str],
    max_rows: int | None,
    **found: Running,
) -> DataFrame:
    """Both sides in one order per key, versions first at equal times; facts are kept."""
    left = facts.select(
        "*", F.col(at).alias("_at"), F.lit(1).alias("_side"), F.col(tie).alias("_tie")
    )
    right = versions.select(
        *keys,
        F.col(version_at).alias("_at"),
        F.lit(0).alias("_side"),
        F.col(version_tie).alias("_tie"),
        F.struct(F.col(version_at).alias("at"), *values).alias("_version"),
    )
    both = left.unionByName(right, allowMissingColumns=True)
    seen = scan(both, keys, ["_at", "_side", "_tie"], max_rows, **found)
    return seen.where(F.col("_side") == 1).drop("_at", "_side", "_tie", "_version")


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    version_at: str,
    tie: str,
    version_tie: str,
    values: Sequence[str],
    inner: bool = True,
    max_rows: int | None = None,
) -> DataFrame:
    """Each fact with the version valid at its time: the last one with `version_at <= at`.

    Facts before the first version are dropped, or kept with nulls if not `inner`.
    One shuffle, no pairs: both sides are windowed together.
    """
    seen = _with_versions(
        facts, versions, keys, at, version_at, tie, version_tie, values, max_rows,
        _found=latest("_version"),
    )
    if inner:
        seen = seen.where(F.col("_found").isNotNull())
    return seen.select(*facts.columns, *[F.col(f"_found.{v}").alias(v) for v in values])


def enrich_with_tier(
    clicks: DataFrame,
    profiles: DataFrame,
    user: str,
    seq: str,
    tier: str = "tier",
    default: str = "unknown",
    max_rows: int | None = None,
) -> DataFrame:
    """Each click with the latest profile that arrived before it, else the default.

    `seq` is the common arrival order of both inputs. A later profile does not
    change earlier clicks.
    """
    seen = as_of(clicks, profiles, [user], seq, seq, seq, seq, [tier], False, max_rows)
    return seen.withColumn(tier, F.coalesce(F.col(tier), F.lit(default)))


def enrich_with_hold(
    clicks: DataFrame,
    profiles: DataFrame,
    user: str,
    at: str,
    tie: str,
    hold: timedelta,
    tier: str = "tier",
    default: str = "unknown",
    max_rows: int | None = None,
) -> DataFrame:
    """Strict join: a click without an earlier profile waits up to `hold` for the next one."""
    seen = _with_versions(
        clicks, profiles, [user], at, at, tie, tie, [tier], max_rows,
        _before=latest("_version"), _after=next_known("_version"),
    )
    in_time = F.col("_after.at") <= F.col(at) + interval(hold)
    value = F.coalesce(
        F.col(f"_before.{tier}"), F.when(in_time, F.col(f"_after.{tier}")), F.lit(default)
    )
    return seen.select(*clicks.columns, value.alias(tier))


def apply_multiplier(
    clicks: DataFrame,
    multipliers: DataFrame,
    category: str = "category",
    price: str = "price",
    multiplier: str = "multiplier",
    order: Sequence[str] = (),
) -> DataFrame:
    """Price times the category's multiplier, from a small table that the planner broadcasts.

    With `order` the table may hold several versions per category; the last wins.
    status is "adjusted", or "unknown" without a multiplier.
    """
    table = multipliers.select(category, multiplier)
    if order:
        table = latest_per_key(multipliers, [category], list(order), [multiplier])
    joined = clicks.join(table, category, "left")
    return joined.withColumn("adjusted", F.col(price) * F.col(multiplier)).withColumn(
        "status", F.when(F.col(multiplier).isNull(), "unknown").otherwise("adjusted")
    )


def lookup_dimension(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with a dimension table: null where it has no entry.

    The planner broadcasts a dimension below its threshold, also when it finds out its
    size only at run time, and splits hot keys of a larger one.
    """
    return facts.join(dimension, list(keys), "left")


def lookup_or_default(facts: DataFrame, table: DataFrame, key: str, value: str, default: str = UNKNOWN) -> DataFrame:
    joined = lookup_dimension(facts, table.select(key, value), [key])
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def lateral_lookup(facts: DataFrame, table: DataFrame, key: str, value: str, default: str = UNKNOWN) -> DataFrame:
    """The same as a lateral subquery per row, which Catalyst turns into a join."""
    return facts.sparkSession.sql(
        f"""SELECT f.*, COALESCE(l.v, :default) AS `{value}` FROM {{facts}} AS f
        LEFT JOIN LATERAL (SELECT t.`{value}` AS v FROM {{table}} AS t WHERE t.`{key}` = f.`{key}`) AS l""",
        args={"default": default},
        facts=facts,
        table=table,
    )


def compare_outputs(
    old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per key of two result tables: only_old, only_new, changed or same."""
    left = old.select(
        *[F.col(k).alias(f"_l_{k}") for k in keys],
        *[F.col(v).alias(f"old_{v}") for v in values],
        F.lit(True).alias("_old"),
    )
    right = new.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(v).alias(f"new_{v}") for v in values],
        F.lit(True).alias("_new"),
    )
    match = reduce(lambda a, b: a & b, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}")) for v in values])
    return left.join(right, match, "full_outer").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        *[c for v in values for c in (f"old_{v}", f"new_{v}")],
        F.when(F.col("_new").isNull(), "only_old")
        .when(F.col("_old").isNull(), "only_new")
        .when(same, "same")
        .otherwise("changed")
        .alias("difference"),
    )


class _Calls:
    """At most `capacity` calls at once; each has `timeout` seconds from its start.

    A call that is given up keeps its place until it ends, so no more than `capacity` are
    ever alive. If all places are held by such calls for another `timeout`, what still
    waits is given up, too.
    """

    def __init__(self, fn: Callable, capacity: int, timeout: float):
        self.fn, self.capacity, self.timeout = fn, capacity, timeout
        self.pool = ThreadPoolExecutor(capacity)
        self.given_up: set[Future] = set()

    def run(self, keys: Sequence, default: str, timed_out: str) -> dict:
        answers, waiting, asked, stuck = {}, deque(keys), {}, None
        while waiting or asked:
            self.given_up = {call for call in self.given_up if not call.done()}
            while waiting and len(asked) + len(self.given_up) < self.capacity:
                key = waiting.popleft()
                asked[self.pool.submit(self.fn, key)] = (key, time.monotonic() + self.timeout)
            now = time.monotonic()
            stuck = None if asked else stuck or now + self.timeout
            until = min((deadline for _, deadline in asked.values()), default=stuck)
            done, _ = wait([*asked, *self.given_up], max(0.0, until - now), FIRST_COMPLETED)
            for call in done & asked.keys():
                value = call.result()  # an error of the service ends the task
                answers[asked.pop(call)[0]] = default if value is None else value
            now = time.monotonic()
            for call in [c for c, (_, deadline) in asked.items() if deadline <= now]:
                answers[asked.pop(call)[0]] = timed_out
                self.given_up.add(call)
            if stuck and stuck <= now and not done:
                answers.update(dict.fromkeys(waiting, timed_out))
                waiting.clear()
        return answers

    def close(self) -> None:
        self.pool.shutdown(wait=False, cancel_futures=True)


def async_lookup(
    df: DataFrame,
    key: str,
    fn: Callable[[Any], str | None],
    result: str = "result",
    timeout: timedelta = timedelta(seconds=1),
    capacity: int = 4,
    default: str = UNKNOWN,
    timed_out: str = TIMED_OUT,
    remember: int = 10_000,
) -> DataFrame:
    """Ask a service per key: one output row per input row, in the input order.

    Each task asks for the distinct keys of an Arrow batch, no more than `capacity` at
    once, and remembers the last `remember` answers (never timeouts). Nothing is
    shuffled, so a hot key costs one call per task. `fn` gets the key as a Python value
    and must give the same answer when asked twice; a null key is not asked for. All
    columns pass as they are.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(result, T.StringType())])
    seconds = timeout.total_seconds()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        calls = _Calls(fn, capacity, seconds)
        known: OrderedDict = OrderedDict()
        try:
            for batch in batches:
                coded = batch.column(key).dictionary_encode()
                asked = coded.dictionary.to_pylist()
                answers = {}
                for k in asked:
                    if k in known:
                        known.move_to_end(k)
                        answers[k] = known[k]
                fresh = calls.run([k for k in asked if k is not None and k not in answers], default, timed_out)
                answers.update(fresh)
                known.update((k, v) for k, v in fresh.items() if v != timed_out)
                while len(known) > remember:
                    known.popitem(last=False)
                found = pa.array([answers.get(k, default) for k in asked], pa.string())
                column = found.take(coded.indices).fill_null(default)
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, result])
        finally:
            calls.close()

    return df.mapInArrow(run, schema)
