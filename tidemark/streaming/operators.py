"""Streaming DataFrames in, streaming DataFrames out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, functions as F, types as T

from tidemark.functions.scalars import duration
from tidemark.session import prepare_packed, prepare_streaming
from tidemark.streaming import processors as p


def _total(df: DataFrame, amount: str) -> T.DataType:
    """The type of a column's sums, as in bounded tables: exact at the column's own scale, doubles for doubles."""
    kind = df.schema[amount].dataType
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    return T.DecimalType(38, 0) if isinstance(kind, T.IntegralType) else T.DoubleType()


def _micros(length: timedelta) -> int:
    return length // timedelta(microseconds=1)


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _stateful(
    df: DataFrame,
    keys: Sequence[str],
    processor: p.StatefulProcessor,
    schema: T.StructType,
    time_mode: str = "None",
    initial=None,
    at: str | None = None,
) -> DataFrame:
    """`at`: a time column with a watermark; rows are then handed over in its order, and those without a time
    left out, as windows leave them out."""
    prepare_streaming(df.sparkSession)
    if at is not None:
        df = df.where(F.col(at).isNotNull())
        df = df.withColumn("_held_us", F.unix_micros(at)).drop(at)
        fields = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name not in keys]
        processor, time_mode = p.InTimeOrder(processor, "_held_us", fields), "EventTime"
    processor.row = Row(*schema.names)
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode=time_mode,
        initialState=initial,
    )


#: bytes of rows that are dealt to shards at a time
DEALT = 4 << 20
PACKED = T.StructType([T.StructField("_rows", T.BinaryType())])


def _packed(df: DataFrame, shard: str | None = None) -> DataFrame:
    """The rows as Arrow tables (`_rows`), each of one shard where a column tells it."""
    schema = T.StructType([*([] if shard is None else [T.StructField(shard, T.IntegerType())]), *PACKED])

    def dealt(rows: pa.Table) -> pa.RecordBatch:
        if shard is None:
            return pa.record_batch({"_rows": pa.array([p.to_bytes(rows)], pa.binary())})
        by, rest = rows[shard], rows.drop_columns([shard])
        shards = by.unique().to_pylist()
        packs = [p.to_bytes(rest.filter(pc.equal(by, s))) for s in shards]
        return pa.record_batch({shard: pa.array(shards, pa.int32()), "_rows": pa.array(packs, pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, size = [], 0
        for batch in batches:
            if batch.num_rows:
                fresh.append(batch)
                size += batch.nbytes
            if size >= (DEALT if shard else 1):
                yield dealt(pa.Table.from_batches(fresh))
                fresh, size = [], 0
        if fresh:
            yield dealt(pa.Table.from_batches(fresh))

    return df.mapInArrow(pack, schema)


def _stateful_packed(packed: DataFrame, processor: p.StatefulProcessor, schema: T.StructType, at: str) -> DataFrame:
    """As `_stateful` with a time, for shards with any number of rows: `_shard`, and the rows as `_packed` makes them.
    `at`: the column with their time in microseconds."""
    prepare_packed(packed.sparkSession)
    processor = p.PackedInTimeOrder(processor, at)
    processor.row = Row(*PACKED.names)
    out = packed.groupBy("_shard").transformWithState(
        statefulProcessor=processor, outputStructType=PACKED, outputMode="Append", timeMode="EventTime"
    )
    names = schema.names

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed_rows in batch.column(0):
                yield from p.from_bytes(packed_rows.as_py()).select(names).to_batches()

    return out.mapInArrow(unpack, schema)


def with_watermark(df: DataFrame, at: str, bound: timedelta = timedelta(0)) -> DataFrame:
    """Event time may run `bound` behind the latest row. A silent partition does not hold it up."""
    return df.withWatermark(at, duration(bound))


def watermark_policy(spark, slowest: bool = True) -> None:
    """With several sources: wait for the slowest one, or go with the fastest so idle ones do not matter."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min" if slowest else "max")


def running_total(
    df: DataFrame, keys, seq: str, amount: str, initial: DataFrame | None = None, at: str | None = None
) -> DataFrame:
    """One row per input row. `initial` seeds the totals: key columns and `total`.

    Here and below: with `at`, a column with a watermark, the rows of a key are taken in
    its order over all micro-batches; without, in the order of `seq` within each.
    """
    kind = _total(df, amount)
    schema = T.StructType([*_fields(df, [*keys, seq]), T.StructField("total", kind)])
    seed = None
    if initial is not None:
        seed = initial.select(*keys, F.col("total").cast(kind).alias("total")).groupBy(*keys)
    rows = df.select(*keys, seq, F.col(amount).cast(kind).alias(amount), *_held(at))
    processor = p.RunningTotals(seq, amount, kind.simpleString())
    return _stateful(rows, keys, processor, schema, initial=seed, at=at)


def _held(at: str | None) -> list[str]:
    return [] if at is None else [at]


def to_changelog(df: DataFrame, keys, seq: str, amount: str, at: str | None = None) -> DataFrame:
    kind = _total(df, amount)
    schema = T.StructType(
        [
            *_fields(df, [*keys, seq]),
            T.StructField("op", T.StringType()),
            T.StructField("step", T.IntegerType()),
            T.StructField("total", kind),
        ]
    )
    rows = df.select(*keys, seq, F.col(amount).cast(kind).alias(amount), *_held(at))
    return _stateful(rows, keys, p.ChangelogTotals(seq, amount, kind.simpleString()), schema, at=at)


def click_history(
    df: DataFrame, keys, seq: str, category: str, n: int = 5, at: str | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """`initial` seeds the state: key columns, `count`, and `last`, an array of the last categories."""
    return _history(df, keys, seq, category, at, initial, p.ClickHistory(seq, category, n))


def moved_history(
    df: DataFrame, keys, seq: str, category: str, initial: DataFrame, n: int = 5, at: str | None = None
) -> DataFrame:
    """The next version of `click_history`, whose state and rows have one field more: `moved`, the count that a key
    came over with. `initial` is what the version before had, as `state.carried` reads it."""
    moved = T.StructField("moved", T.LongType())
    return _history(df, keys, seq, category, at, initial, p.MovedHistory(seq, category, n), moved)


def _history(df: DataFrame, keys, seq, category, at, initial, processor, *more: T.StructField) -> DataFrame:
    schema = T.StructType(
        [
            *_fields(df, [*keys, seq]),
            T.StructField("count", T.LongType()),
            T.StructField("last_categories", T.ArrayType(T.StringType())),
            *more,
        ]
    )
    seed = None
    if initial is not None:
        last = F.col("last").cast("array<string>").alias("last")
        seed = initial.select(*keys, F.col("count").cast("long").alias("count"), last).groupBy(*keys)
    rows = df.select(*keys, seq, category, *_held(at))
    return _stateful(rows, keys, processor, schema, initial=seed, at=at)


def spend_summary(
    df: DataFrame, keys, seq: str, category: str, amount: str, at: str | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """`initial` seeds the state: key columns, `spend`, and `counts`, a map of categories to counts."""
    kind = _total(df, amount)
    seed = None
    if initial is not None:
        counts = F.col("counts").cast("map<string,bigint>").alias("counts")
        seed = initial.select(*keys, F.col("spend").cast(kind).alias("spend"), counts).groupBy(*keys)
    rows = df.select(*keys, seq, category, F.col(amount).cast(kind).alias(amount), *_held(at))
    schema = T.StructType(
        [
            *_fields(df, [*keys, seq]),
            T.StructField("spend", kind),
            T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
        ]
    )
    processor = p.SpendSummary(seq, category, amount, kind.simpleString())
    return _stateful(rows, keys, processor, schema, initial=seed, at=at)


def session_counter(df: DataFrame, keys, at: str, seq: str, ttl: timedelta, hold: bool = False) -> DataFrame:
    """`hold`: take the rows in the order of `at` over all micro-batches; it then needs a watermark."""
    timed = df.select(*keys, seq, F.unix_micros(at).alias("_us"), *_held(at if hold else None))
    schema = T.StructType([*_fields(df, [*keys, seq]), T.StructField("counter", T.LongType())])
    return _stateful(timed, keys, p.SessionCounter("_us", seq, _micros(ttl)), schema, at=at if hold else None)


def expiring_sum(
    df: DataFrame, keys, at: str, seq: str, amount: str, ttl: timedelta, hold: bool = False
) -> DataFrame:
    kind = _total(df, amount)
    timed = df.select(
        *keys,
        seq,
        F.col(amount).cast(kind).alias(amount),
        F.unix_micros(at).alias("_us"),
        *_held(at if hold else None),
    )
    schema = T.StructType([*_fields(df, [*keys, seq]), T.StructField("total", kind)])
    processor = p.ExpiringSum("_us", seq, amount, _micros(ttl), kind.simpleString())
    return _stateful(timed, keys, processor, schema, at=at if hold else None)


def batch_flush(df: DataFrame, shard, seq: str, category: str, n: int = 3, at: str | None = None) -> DataFrame:
    """Buffers of n events per shard; an incomplete one waits for the next rows."""
    schema = T.StructType(
        [
            *_fields(df, [*shard, seq]),
            T.StructField("size", T.IntegerType()),
            T.StructField("flushed", T.ArrayType(T.StringType())),
        ]
    )
    rows = df.select(*shard, seq, category, *_held(at))
    return _stateful(rows, shard, p.BatchFlush(seq, category, n), schema, at=at)


def expiring_counter(df: DataFrame, keys, seq: str, ttl: timedelta) -> DataFrame:
    """Counter on the clock: restarts once a key got no row for `ttl` of processing time."""
    schema = T.StructType([*_fields(df, [*keys, seq]), T.StructField("counter", T.LongType())])
    ttl_ms = _micros(ttl) // 1000
    return _stateful(df.select(*keys, seq), keys, p.ExpiringCounter(seq, ttl_ms), schema, "ProcessingTime")


def abandoned_carts(
    df: DataFrame,
    user: str,
    at: str,
    seq: str,
    action: str,
    timeout: timedelta,
    cart: str = "add_to_cart",
    purchase: str = "purchase",
) -> DataFrame:
    """`df` must carry a watermark on `at`; alerts appear once it passes their time. Steps are taken in the
    order of `at` over all micro-batches; a step without a time is left out."""
    timed = df.where(F.col(action).isin(cart, purchase)).select(user, seq, action, at, F.unix_micros(at).alias("_us"))
    schema = T.StructType(
        [*_fields(df, [user]), T.StructField("_us", T.LongType()), T.StructField("reason", T.StringType())]
    )
    processor = p.AbandonedCart("_us", seq, action, _micros(timeout), cart, purchase)
    alerts = _stateful(timed, [user], processor, schema, at=at)
    return alerts.select(user, F.timestamp_micros("_us").alias("alert_time"), "reason")


def enrich_with_tier(
    clicks: DataFrame,
    profiles: DataFrame,
    user: str,
    seq: str,
    tier: str = "tier",
    default: str = "unknown",
    at: str | None = None,
) -> DataFrame:
    """`at`: a time column of both inputs, each with a watermark."""
    left = clicks.withColumns({"_side": F.lit(1), tier: F.lit(None).cast("string")})
    right = profiles.select(user, seq, F.col(tier).cast("string"), F.lit(0).alias("_side"), *_held(at))
    kept = [c for c in clicks.columns if c != at]
    both = left.unionByName(right, allowMissingColumns=True)
    schema = T.StructType([*_fields(clicks, kept), T.StructField(tier, T.StringType())])
    return _stateful(both, [user], p.LatestValue(seq, tier, default, kept, user), schema, at=at)


def as_of(
    facts: DataFrame, versions: DataFrame, key: str, at: str, tie: str, value: str
) -> DataFrame:
    """Both inputs must carry a watermark on `at`. Facts without a version, or without a time, are dropped."""
    kept = [c for c in facts.columns if c != at]
    left = facts.withColumns({"_us": F.unix_micros(at), "_side": F.lit(1)})
    right = versions.select(key, at, tie, value, F.unix_micros(at).alias("_us"), F.lit(0).alias("_side"))
    both = left.unionByName(right, allowMissingColumns=True)
    fact_fields = _fields(facts, kept) + [T.StructField("_us", T.LongType())]
    found = T.StructField(value, versions.schema[value].dataType)
    names = [None if f.name == key else f.name for f in fact_fields]
    processor = p.AsOfVersion("_us", tie, names, found.dataType.simpleString(), value)
    joined = _stateful(both, [key], processor, T.StructType([*fact_fields, found]), at=at)
    return joined.withColumn(at, F.timestamp_micros("_us")).select(*facts.columns, value)


def enrich_with_hold(
    clicks: DataFrame,
    profiles: DataFrame,
    user: str,
    at: str,
    tie: str,
    hold: timedelta,
    tier: str = "tier",
    default: str = "unknown",
) -> DataFrame:
    """Strict join, a row per click: without an earlier profile a click waits up to `hold` for the next one.

    Both inputs must carry a watermark on `at`. Clicks without a time are left out.
    """
    kept = [c for c in clicks.columns if c != at]
    left = clicks.withColumns({"_us": F.unix_micros(at), "_side": F.lit(1)})
    value = F.col(tier).cast("string").alias(tier)
    right = profiles.select(user, at, tie, value, F.unix_micros(at).alias("_us"), F.lit(0).alias("_side"))
    both = left.unionByName(right, allowMissingColumns=True)
    fields = [*_fields(clicks, kept), T.StructField("_us", T.LongType())]
    types = [(f.name, f.dataType.simpleString()) for f in fields]
    processor = p.HeldFacts("_us", tie, types, user, _micros(hold), tier, default)
    schema = T.StructType([*fields, T.StructField(tier, T.StringType())])
    joined = _stateful(both, [user], processor, schema, at=at)
    return joined.withColumn(at, F.timestamp_micros("_us")).select(*clicks.columns, tier)


def refreshed_dimension(
    facts: DataFrame, changes: DataFrame, key: str, at: str, tie: str, value: str, shards: int = 8
) -> DataFrame:
    """Each fact with the value of a small dimension as it stood at its time, null where it had none.

    Facts are dealt to shards by all of their columns, so a hot key is spread. Every change (key, at, tie, value; a null
    value takes the key out) goes to every shard, and all apply the changes in the same order of time. A shard holds
    the whole dimension: for lookup tables; join a large one by key (`as_of`). Both inputs must carry a watermark on
    `at`; rows without a time, and changes without a key, are left out. The state hangs on `shards`: keep it when a
    stream goes on.
    """
    kept = [c for c in facts.columns if c != at]
    dealt = F.pmod(F.xxhash64(*kept), F.lit(shards)).cast("int").alias("_shard")
    left = facts.where(F.col(at).isNotNull()).select(*kept, F.unix_micros(at).alias("_us"), F.lit(1).alias("_side"))
    right = changes.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key, tie, value, F.unix_micros(at).alias("_us"), F.lit(0).alias("_side")
    )
    both = left.unionByName(right, allowMissingColumns=True).schema

    def alike(side: DataFrame) -> list:
        return [(F.col(f.name) if f.name in side.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in both]

    left = _packed(left.select(dealt, *alike(left)), "_shard")
    # a change is packed once, then goes to every shard
    right = _packed(right.select(*alike(right))).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), "_rows")
    fields = [*_fields(facts, kept), T.StructField("_us", T.LongType())]
    found = changes.schema[value]
    processor = p.ReplicatedDimension(
        "_us", tie, [f.name for f in fields], (key, facts.schema[key].dataType.simpleString()),
        (value, found.dataType.simpleString()),
    )
    schema = T.StructType([*fields, T.StructField(value, found.dataType)])
    joined = _stateful_packed(left.unionByName(right), processor, schema, "_us")
    return joined.withColumn(at, F.timestamp_micros("_us")).select(*facts.columns, value)


def clock_windows(df: DataFrame, keys, size: timedelta, amount: str) -> DataFrame:
    """Windows on the clock: key columns, window_start, window_end, n and total of the rows that were taken in it.

    A window is given out by a timer once the clock has passed its end, also when no more rows come. Which window a
    row falls in depends on when its batch runs. Needs a processing-time trigger; see `sinks.run_on_clock`.
    """
    kind = _total(df, amount)
    schema = T.StructType(
        [
            *_fields(df, keys),
            T.StructField("_end", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("total", kind),
        ]
    )
    processor = p.ClockWindows(amount, max(1, _micros(size) // 1000), kind.simpleString())
    rows = df.select(*keys, F.col(amount).cast(kind).alias(amount))
    closed = _stateful(rows, keys, processor, schema, "ProcessingTime")
    end = F.timestamp_micros("_end")
    return closed.select(
        *keys, (end - F.expr(f"INTERVAL {_micros(size)} MICROSECONDS")).alias("window_start"), end.alias("window_end"), "n", "total"
    )


def late_disposition(
    df: DataFrame, at: str, size: timedelta, lateness: timedelta, row_id: str
) -> DataFrame:
    """Tag rows against the watermark of `df` (declare it with the bound alone).

    Needs no state; the row's own id is the key, so rows spread over all tasks. The time
    goes in as a plain number, or Spark would drop the late rows before they could be tagged.
    """
    timed = df.where(F.col(at).isNotNull()).withColumns({"_us": F.unix_micros(at), "_key": F.col(row_id)})
    kept = [c for c in df.columns if c != at] + ["_us"]
    schema = T.StructType(
        [*_fields(timed, kept), T.StructField("_end", T.LongType()), T.StructField("disposition", T.StringType())]
    )
    processor = p.LateTagger("_us", _micros(size), _micros(lateness), kept)
    tagged = _stateful(timed.select(*kept, "_key"), ["_key"], processor, schema, "EventTime")
    return tagged.withColumns(
        {at: F.timestamp_micros("_us"), "window_end": F.timestamp_micros("_end")}
    ).select(*df.columns, "window_end", "disposition")


def windowed_totals(
    df: DataFrame,
    keys,
    at: str,
    size: timedelta,
    amount: str,
    bound: timedelta = timedelta(seconds=2),
    lateness: timedelta = timedelta(0),
    slide: timedelta | None = None,
) -> DataFrame:
    """Tumbling or sliding totals.

    In append mode each window appears once, when the watermark passes it; later
    rows are dropped. In update mode with a lateness the window shows again
    with its new total for every batch that changes it.
    """
    window = F.window(at, duration(size), duration(slide) if slide else None)
    totals = with_watermark(df, at, bound + lateness).groupBy(window.alias("w"), *keys)
    return totals.agg(F.sum(amount).alias("total")).select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total"
    )


def windows_with_lateness(
    df: DataFrame,
    keys,
    at: str,
    size: timedelta,
    amount: str,
    seq: str,
    arrival: str,
    tick: timedelta,
    disorder: timedelta,
    bound: timedelta = timedelta(0),
    lateness: timedelta = timedelta(0),
    source: str | None = None,
    idle: timedelta | None = None,
    shards: int = 8,
) -> DataFrame:
    """Tumbling totals that fire once event time has passed a window, again for every row that comes at most
    `lateness` after that, and rows that come later still, all from one state: key columns, `seq`, window_end, total, firing
    (`fire`, `update`, or `too_late`: the side output, with the row's own amount).

    Event time is what the rows tell, in order of their `arrival` (a timestamp, by ticks): the latest `at` of a
    source in the ticks before, the least over the sources, less `bound`. A source that was silent for more than
    `idle` does not hold the others up; when it comes back, event time stays where it is. Sources not heard of yet
    hold nothing up.

    `disorder` is how far rows of the stream come behind in arrival: results do not depend on the micro-batches,
    nor on the number of shards. The progress of a tick is a row for each source, combined before the shuffle and
    given to every shard, so all see event time move in the same order; rows go to shards by key and window, so a
    hot key is spread over its windows. Rows without an arrival or event time are left out.
    """
    kind = _total(df, amount)
    timed = with_watermark(df.where(F.col(at).isNotNull() & F.col(arrival).isNotNull()), arrival, disorder)
    names = F.coalesce(F.col(source).cast("string"), F.lit("")) if source else F.lit("")
    shard = F.pmod(F.xxhash64(*keys, "_end"), F.lit(shards)).cast("int").alias("_shard")

    def begin(column: str, length: timedelta):
        us = F.unix_micros(column)
        return us - F.pmod(us, F.lit(_micros(length)))

    facts = timed.select(
        *keys, seq, F.col(amount).cast(kind).alias(amount), (begin(at, size) + _micros(size)).alias("_end"),
        begin(arrival, tick).alias("_tick"),
    )
    # before the tick's marks
    facts = facts.withColumn("_due", F.timestamp_micros(F.col("_tick") + _micros(tick) - 1000))
    facts = facts.select("*", shard, F.lit(0).alias("_side"))
    marks = timed.groupBy(F.window(arrival, duration(tick)).alias("_w"), names.alias("_source")).agg(F.max(F.unix_micros(at)).alias("_seen"))
    marks = marks.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), "_source", "_seen",
        F.unix_micros("_w.start").alias("_tick"), F.col("_w.end").alias("_due"), F.lit(1).alias("_side"),
    )
    both = facts.unionByName(marks, allowMissingColumns=True)
    fields = _fields(df, [*keys, seq])
    schema = T.StructType(
        [*fields, T.StructField("_end", T.LongType()), T.StructField("total", kind), T.StructField("firing", T.StringType())]
    )
    *key_fields, seq_field = [(f.name, f.dataType.simpleString()) for f in fields]
    processor = p.LateWindows(
        key_fields, seq_field, amount, kind.simpleString(), _micros(bound), _micros(lateness), None if idle is None else _micros(idle)
    )
    both = both.where(F.col("_due").isNotNull()).withColumn("_due", F.unix_micros("_due"))
    fired = _stateful_packed(_packed(both, "_shard"), processor, schema, "_due")
    return fired.select(*keys, seq, F.timestamp_micros("_end").alias("window_end"), "total", "firing")


def ranked(df: DataFrame, group: str, member: str, amount: str, n: int, shards: int = 8) -> DataFrame:
    """The n members with the highest totals per group, as changes of places: group, rn, member, total, op (+I, +U).

    Amounts may be negative. Totals and a list of the n best are kept by group and shard of its members; only lists
    that change go on, and are merged per group. So the work of a batch follows its changed members, and a hot group
    is spread over its shards. A later row for a place replaces the earlier one: upsert by group and rn.
    """
    kind = _total(df, amount)
    fields = _fields(df, [group, member])
    listed = T.ArrayType(T.StructType([T.StructField("total", kind), T.StructField("member", fields[1].dataType)]))
    shard = F.pmod(F.xxhash64(member), F.lit(shards)).cast("int").alias("_shard")
    rows = df.select(group, member, F.col(amount).cast(kind).alias(amount), shard)
    names = fields[1].dataType.simpleString()
    first = T.StructType([fields[0], T.StructField("_shard", T.IntegerType()), T.StructField("_top", listed)])
    lists = _stateful(rows, [group, "_shard"], p.RankedShard((member, names), amount, kind.simpleString(), n), first)
    places = T.StructType(
        [fields[0], T.StructField("rn", T.LongType()), fields[1], T.StructField("total", kind), T.StructField("op", T.StringType())]
    )
    return _stateful(lists, [group], p.MergedRanks(names, kind.simpleString(), n), places)


def sessions(
    df: DataFrame, keys, at: str, gap: timedelta, amount: str, bound: timedelta = timedelta(0)
) -> DataFrame:
    window = F.session_window(at, duration(gap))
    found = with_watermark(df, at, bound).groupBy(window.alias("w"), *keys)
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total")).select(
        *keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total"
    )


def salted_window_totals(
    df: DataFrame,
    keys,
    at: str,
    size: timedelta,
    amount: str,
    row_id: str,
    bound: timedelta = timedelta(seconds=2),
    salts: int = 8,
) -> DataFrame:
    """Two chained aggregations: per salt, then per key (append mode)."""
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).alias("salt")
    window = F.window(at, duration(size)).alias("w")
    parts = with_watermark(df, at, bound).groupBy(window, *keys, salt).agg(F.sum(amount).alias("total"))
    again = F.window(F.window_time("w"), duration(size)).alias("w2")
    return parts.groupBy(again, *keys).agg(F.sum("total").alias("total")).select(
        *keys, F.col("w2.start").alias("window_start"), F.col("w2.end").alias("window_end"), "total"
    )


def held_join(
    clicks: DataFrame,
    profiles: DataFrame,
    user: str,
    at: str,
    profile_at: str,
    hold: timedelta,
    bound: timedelta = timedelta(0),
    how: str = "leftOuter",
) -> DataFrame:
    """Stream-stream join: clicks wait up to `hold` for profiles of their user."""
    left = with_watermark(clicks, at, bound)
    right = with_watermark(
        profiles.withColumnRenamed(user, "_profile_user"), profile_at, bound
    )
    close = (
        (F.col(user) == F.col("_profile_user"))
        & (F.col(profile_at) >= F.col(at))
        & (F.col(profile_at) <= F.col(at) + F.expr(f"INTERVAL {_micros(hold)} MICROSECONDS"))
    )
    return left.join(right, close, how).drop("_profile_user")
