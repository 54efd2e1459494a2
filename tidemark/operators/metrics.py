"""Counters, histograms, rates and alerts over time series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tidemark.functions.scalars import duration, interval
from tidemark.operators.ordered import (
    OrderedGroups,
    following,
    latest,
    previous,
    remaining_count,
    running_sum,
    scan,
)

RESERVOIR = 1024
SPREAD = 64
TICKS_PER_ROW = 10_000


def drop_counter(value: str, threshold: float) -> Column:
    return F.count_if(F.col(value) < threshold)


def latest_gauge(value: str, seq: str) -> Column:
    return F.max_by(value, seq)


def observed_filter(
    df: DataFrame, value: str, seq: str, threshold: float = 25
) -> tuple[DataFrame, Observation]:
    """Keep values from the threshold on; the counters are filled when the result is first used."""
    observation = Observation()
    seen = df.observe(
        observation,
        drop_counter(value, threshold).alias("dropped"),
        F.count_if(F.col(value) >= threshold).alias("kept"),
        latest_gauge(value, seq).alias("latest"),
    )
    return seen.where(F.col(value) >= threshold), observation


def counters(df: DataFrame, value: str, seq: str, threshold: float = 25) -> DataFrame:
    """The same counters as a one-row table."""
    return df.agg(
        drop_counter(value, threshold).alias("dropped"),
        F.count_if(F.col(value) >= threshold).alias("kept"),
        latest_gauge(value, seq).alias("latest"),
    )


def reservoir_histogram(
    df: DataFrame,
    value: str,
    seq: str,
    keys: Sequence[str] = (),
    shares: Sequence[float] = (0.5, 0.95, 0.99),
    size: int = RESERVOIR,
) -> DataFrame:
    """Percentiles of the last `size` values per key.

    A key's rows are first ranked in SPREAD parts, so that no task ranks all of a hot
    key; what each part keeps is ranked again.
    """
    if keys:
        kept = df.select(*keys, value, seq, F.pmod(F.xxhash64(seq), F.lit(SPREAD)).alias("_part"))
        for parts in (["_part"], []):
            newest = Window.partitionBy(*keys, *parts).orderBy(F.col(seq).desc())
            kept = kept.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= size)
    else:
        kept = df.select(value, seq).orderBy(F.col(seq).desc()).limit(size)
    return kept.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        *[F.percentile(F.col(value).cast("double"), s).alias(f"p{round(s * 100)}") for s in shares],
    )


def throughput_ticks(df: DataFrame, at: str, tick: timedelta) -> DataFrame:
    """Rows per tick from the first to the last one, empty ticks as zero."""
    counts = df.groupBy(F.window(at, duration(tick)).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.col("_w.start").alias("tick"), "n")
    # first every TICKS_PER_ROW-th tick, spread over the tasks, then the ones between
    ends = counts.agg(F.min("tick").alias("a"), F.max("tick").alias("b"))
    coarse = ends.select(
        F.explode(F.sequence("a", "b", interval(tick * TICKS_PER_ROW))).alias("from"), "b"
    ).repartition("from")
    until = F.least(F.col("b"), F.col("from") + interval(tick * (TICKS_PER_ROW - 1)))
    ticks = coarse.select(F.explode(F.sequence("from", until, interval(tick))).alias("tick"))
    return ticks.join(counts, "tick", "left").select("tick", F.coalesce("n", F.lit(0)).alias("n"))


def _enter_and_leave(df: DataFrame, columns: Sequence[str], enter: Column, leave: Column) -> DataFrame:
    """Each row as it enters a sliding range and, where `leave` is not null, as it leaves it."""
    both = F.array(enter, leave)
    return df.select(*columns, F.explode(F.filter(both, lambda c: c.isNotNull())).alias("_c")).select(
        *columns, "_c.*"
    )


def sustained_average(
    samples: DataFrame,
    series: Sequence[str],
    at: str,
    value: str,
    over: timedelta,
    threshold: float,
    hold: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Average over `[t - over, t]` at each sample time, and whether it fires.

    It fires when the average has been above the threshold at every sample for
    at least `hold`. Each value enters the sum at its time and leaves it once
    the range has passed, so the cost does not depend on the range. Use decimal
    values: they cancel exactly.
    """
    points = samples.groupBy(*series, at).agg(F.sum(value).alias("_v"), F.count(value).alias("_k"))

    def step(time: Column, side: int, sign: int) -> Column:
        return F.struct(
            time.alias("_t"), F.lit(side).alias("_side"),
            (F.col("_v") * sign).alias("_dv"), (F.col("_k") * sign).alias("_dk"),
        )

    moves = _enter_and_leave(
        points, list(series), step(F.col(at), 0, 1), step(F.col(at) + interval(over), 1, -1)
    )
    like = samples.withColumns({"_t": F.col(at), "_side": F.lit(0)})
    groups = OrderedGroups(moves, series, ["_t", "_side"], max_rows, like)
    summed = groups.scan(groups.rows, _sum=running_sum("_dv"), _n=running_sum("_dk"))
    average = F.col("_sum").cast("double") / F.when(F.col("_n") != 0, F.col("_n"))
    level = groups.settle(summed.where("_side = 0").withColumn("average", average))
    fired = _held(groups, level, F.col("average") > threshold, "_t", hold)
    return fired.select(*series, F.col("_t").alias(at), "average", "firing")


def _held(
    groups: OrderedGroups, level: DataFrame, breach: Column, at: str, hold: timedelta
) -> DataFrame:
    """Add `firing`: the breach has been seen at every sample for at least `hold`."""
    level = level.withColumn("_above", F.coalesce(breach, F.lit(False)))
    edge = groups.settle(groups.scan(level, _was=previous("_above")))
    rises = F.col("_above") & ~F.coalesce(F.col("_was"), F.lit(False))
    since = groups.done(groups.scan(edge, _since=latest(F.when(rises, F.col(at)))))
    lasted = F.col(at) - F.col("_since") >= interval(hold)
    return since.withColumn("firing", F.coalesce(F.col("_above") & lasted, F.lit(False)))


def range_increase(
    samples: DataFrame,
    series: Sequence[str],
    at: str,
    tie: str,
    value: str,
    over: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """How much a counter grew within `[t - over, t]` at each sample.

    A drop counts as a reset: the new value is the growth. A step counts while
    both of its samples lie in the range.
    """
    before = scan(
        samples.select(*series, at, tie, value), series, [at, tie], max_rows, True,
        _pv=previous(value), _pt=previous(at),
    )
    gone = F.col("_pt") + interval(over)
    in_range = F.col("_pt").isNotNull() & (gone >= F.col(at))
    grew = F.when(F.col(value) >= F.col("_pv"), F.col(value) - F.col("_pv")).otherwise(F.col(value))
    steps = before.withColumn("_d", F.when(in_range, grew))

    def step(time: Column, side: int, delta: Column) -> Column:
        return F.struct(time.alias("_t"), F.lit(side).alias("_side"), delta.alias("_dv"))

    moves = _enter_and_leave(
        steps,
        [*series, tie],
        step(F.col(at), 0, F.col("_d")),
        F.when(F.col("_d").isNotNull(), step(gone, 1, -F.col("_d"))),
    )
    like = samples.withColumns({"_t": F.col(at), "_side": F.lit(0)})
    summed = scan(
        moves, series, ["_t", "_side", tie], max_rows, True, like, increase=running_sum("_dv")
    )
    return summed.where("_side = 0").select(
        *series, F.col("_t").alias(at), tie, F.coalesce("increase", F.lit(0)).alias("increase")
    )


def increase_alert(
    samples: DataFrame,
    series: Sequence[str],
    at: str,
    tie: str,
    value: str,
    over: timedelta,
    threshold: float,
    hold: timedelta = timedelta(0),
    max_rows: int | None = None,
) -> DataFrame:
    """Fires while the increase has been above the threshold for at least `hold`."""
    grown = range_increase(samples, series, at, tie, value, over, max_rows)
    groups = OrderedGroups(grown, series, [at, tie], max_rows, like=samples)
    fired = _held(groups, groups.rows, F.col("increase") > threshold, at, hold)
    return fired.select(*series, at, tie, "increase", "firing")


def gap_alert(
    samples: DataFrame,
    series: Sequence[str],
    at: str,
    tie: str,
    absent: timedelta,
    max_rows: int | None = None,
    now: Column | None = None,
) -> DataFrame:
    """A series that gives no sample for longer than `absent`; `resumed` is null at its end.

    At its end a series alerts only if `now` is past the deadline; without `now` the
    input has ended for good.
    """
    seen = scan(samples.select(*series, at, tie), series, [at, tie], max_rows, _next=following(at))
    due = F.col(at) + interval(absent)
    silent = F.coalesce(F.col("_next"), now) > due if now is not None else F.col("_next").isNull() | (F.col("_next") > due)
    return seen.where(silent).select(
        *series, due.alias("alert_time"), F.col("_next").alias("resumed")
    )


def retention(
    snapshots: DataFrame,
    job: str,
    at: str,
    tie: str,
    now: Column,
    newest: int = 5,
    weekly_for: timedelta = timedelta(days=90),
    max_rows: int | None = None,
) -> DataFrame:
    """Mark each snapshot keep or delete.

    Kept are the newest few per job, and the newest one of each week (from
    Monday) as long as it is not older than `weekly_for`. A snapshot without a time is
    the oldest of its job.
    """
    ranked = scan(
        snapshots.withColumn("_week", F.trunc(F.col(at).cast("date"), "week")), [job], [at, tie], max_rows,
        _rank=remaining_count(), _week_after=following("_week"),
    )
    newest_of_week = F.col("_week_after").isNull() | (F.col("_week_after") != F.col("_week"))
    recent = F.coalesce(F.col(at) >= now - interval(weekly_for), F.lit(False))
    keep = (F.col("_rank") <= newest) | (newest_of_week & recent)
    return ranked.select(
        *snapshots.columns, F.when(keep, "keep").otherwise("delete").alias("verdict")
    )
