"""Per-key logic that needs state beyond the built-in streaming aggregations.

Times reach the processors as epoch microseconds, so the time zone of a worker
plays no part. A micro-batch hands over a key's rows in no particular order.
`InTimeOrder` holds them in state until the watermark has passed them, so a
processor sees a key's rows in order across micro-batches too, and at a time only
those between two watermarks. Without it rows are in order within a micro-batch
alone. `PackedInTimeOrder` does the same for keys with more rows than a task has memory for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from decimal import Decimal
from itertools import pairwise
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MILLI = 1000  # microseconds
HANDED = 10_000  # rows of whole buckets that are handed over at a time

# packed rows: bytes of them that are sorted and written at a time, bytes of a bucket that are read at a time, of one
# that a watermark cuts, and rows that are handed over at a time
WRITTEN, WHOLE, CUT, HANDED_PACKED = 8 << 20, 16 << 20, 1 << 20, 50_000
BUCKET_BITS, FINER_BITS, SPLIT = 34, 5, -1  # buckets of 2^34 us, 4.8 hours; large ones are split in 32


def in_order(rows: Iterator[Row], *columns: str) -> list[Row]:
    return sorted(rows, key=lambda r: tuple(r[c] for c in columns))


class _Keyed(StatefulProcessor):
    """`row` makes output rows; whoever applies the processor sets it to the output columns."""

    row = Row()
    kind = "double"

    def _zero(self):
        return 0.0 if self.kind == "double" else Decimal(0)

    def close(self) -> None:
        pass

    def passed(self, key, upto: int) -> Iterator[Row]:
        """In time order: all rows up to a time (us) have been handed over."""
        return iter(())

    def wake_at(self) -> int | None:
        """In time order: the time (us) that `passed` must be told of."""
        return None


class _OneTimer:
    """A single timer per key, at the earliest time asked for."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.next = handle.getValueState("next_timer", "at bigint")

    def at(self, micros: int) -> None:
        wanted = -(-micros // MILLI)
        if self.next.exists():
            (now,) = self.next.get()
            if now <= wanted:
                return
            self.handle.deleteTimer(now)
        self.next.update((wanted,))
        self.handle.registerTimer(wanted)

    def fired(self) -> None:
        self.next.clear()


class InTimeOrder(_Keyed):
    """Hands a processor the rows of a key in event-time order.

    Rows wait in state until the watermark has passed their time, in buckets of `width_us`:
    a batch touches the buckets of its own rows, a watermark those that it passes. They are
    handed over in order, about HANDED rows at a time. A row that comes later than the watermark is handed
    over with the next one, after rows it should have preceded.

    A processor may have something to say when time passes (`passed`) and ask to be told of
    a time (`wake_at`).
    """

    def __init__(self, inner: _Keyed, at: str, fields: Sequence[tuple[str, str]], width_us: int = 6 * 3_600_000_000):
        self.inner, self.time, self.width_us = inner, at, width_us
        self.names = [name for name, _ in fields]
        self.schema = ", ".join(f"`{name}`: {kind}" for name, kind in fields)

    def init(self, handle):
        self.waiting = handle.getMapState("waiting_rows", "bucket bigint", f"held array<struct<{self.schema}>>")
        self.buckets = handle.getValueState("waiting_buckets", "buckets array<bigint>")
        self.timer = _OneTimer(handle)
        self.inner.row = self.row
        self.inner.init(handle)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.inner.handleInitialState(key, initialState, timerValues)

    def _known(self) -> list[int]:
        return list(self.buckets.get()[0]) if self.buckets.exists() else []

    def _held(self, bucket: int) -> list[tuple]:
        return [tuple(r) for r in self.waiting.getValue((bucket,))[0]]

    def handleInputRows(self, key, rows, timerValues):
        at = self.names.index(self.time)
        fresh: dict[int, list[tuple]] = {}
        for row in rows:
            values = tuple(row[n] for n in self.names)
            fresh.setdefault(values[at] // self.width_us, []).append(values)
        if fresh:
            known = self._known()
            for bucket, held in fresh.items():
                self.waiting.updateValue((bucket,), ((self._held(bucket) if bucket in known else []) + held,))
            self.buckets.update((sorted({*known, *fresh}),))
            self.timer.at(min(r[at] for r in fresh[min(fresh)]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.fired()
        upto = timerValues.getCurrentWatermarkInMs() * MILLI
        at, make = self.names.index(self.time), Row(*self.names)
        left, due = self._known(), []
        while left and left[0] * self.width_us <= upto:
            held = self._held(left[0])
            due += [make(*r) for r in held if r[at] <= upto]
            later = [r for r in held if r[at] > upto]
            if len(due) >= HANDED:
                yield from self.inner.handleInputRows(key, iter(due), timerValues)
                due = []
            if later:
                self.waiting.updateValue((left[0],), (later,))
                self.timer.at(min(r[at] for r in later))
                break
            self.waiting.removeKey((left.pop(0),))
        else:
            if left:
                self.timer.at(left[0] * self.width_us)
        if due:
            yield from self.inner.handleInputRows(key, iter(due), timerValues)
        if left:
            self.buckets.update((left,))
        else:
            self.buckets.clear()
        yield from self.inner.passed(key, upto)
        wanted = self.inner.wake_at()
        if wanted is not None:
            self.timer.at(wanted)


def to_bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def from_bytes(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(packed)).read_all()


class _Packed(_Keyed):
    """Takes tables of rows in time order (`take`) and gives tables of output rows."""

    def take(self, rows: pa.Table) -> Iterator[pa.Table]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues):
        for row in rows:
            for out in self.take(from_bytes(row["_rows"])):
                if out.num_rows:
                    yield self.row(to_bytes(out))


class PackedInTimeOrder(_Keyed):
    """`InTimeOrder` for keys with any number of rows: rows come, wait and go as Arrow tables (column `_rows`).

    What comes is sorted and written by the piece, each to the buckets of its rows' times; nothing that waits is read
    again before its time. A bucket that is large when it is due, or that a watermark cuts, is split into smaller ones
    first. So a task holds WHOLE bytes of rows about, or those of one microsecond. They are handed over in order,
    HANDED_PACKED rows at a time, those of one time together: the inner processor's `take` gets a table of them and
    gives tables of output rows. What is given out between two watermarks is still in memory at once, packed.
    """

    def __init__(self, inner: _Packed, at: str):
        self.inner, self.time = inner, at

    def init(self, handle):
        self.waiting = handle.getMapState("packed_rows", "bits int, bucket bigint, chunk int", "held binary")
        self.index = handle.getValueState(
            "packed_buckets", "buckets array<struct<bits: int, bucket: bigint, chunks: int, size: bigint>>"
        )
        self.timer = _OneTimer(handle)
        self.inner.init(handle)

    def _load(self) -> None:
        """By bits and number of a bucket: its chunks and bytes. A bucket that was split has SPLIT for chunks."""
        held = self.index.get()[0] if self.index.exists() else []
        self.buckets = {(bits, bucket): (chunks, size) for bits, bucket, chunks, size in map(tuple, held)}

    def _save(self) -> None:
        if self.buckets:
            self.index.update(([(*place, *held) for place, held in sorted(self.buckets.items())],))
        else:
            self.index.clear()

    def _times(self, rows: pa.Table) -> np.ndarray:
        return rows[self.time].to_numpy()

    def _in_order(self, tables: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(tables, promote_options="default").combine_chunks()
        return rows.take(pc.sort_indices(rows[self.time]))

    def _put(self, rows: pa.Table, bits: int = BUCKET_BITS) -> None:
        """Rows in order of their time, to the buckets of so many bits, or smaller ones where those are split."""
        buckets = self._times(rows) >> bits
        for start, stop in pairwise([0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]):
            place, part = (bits, int(buckets[start])), rows.slice(start, stop - start)
            chunks, size = self.buckets.get(place, (0, 0))
            if chunks == SPLIT:
                self._put(part, max(0, bits - FINER_BITS))
            else:
                self.waiting.updateValue((*place, chunks), (to_bytes(part),))
                self.buckets[place] = (chunks + 1, size + part.nbytes)

    def _put_all(self, tables: Iterator[pa.Table], bits: int = BUCKET_BITS) -> int | None:
        """By the piece; gives the least time."""
        firsts, fresh, size = [], [], 0

        def put():
            rows = self._in_order(fresh)
            self._put(rows, bits)
            firsts.append(rows[self.time][0].as_py())

        for rows in tables:
            if rows.num_rows:
                fresh.append(rows)
                size += rows.nbytes
            if size >= WRITTEN:
                put()
                fresh, size = [], 0
        if fresh:
            put()
        return min(firsts, default=None)

    def _chunks(self, place: tuple[int, int], n: int) -> Iterator[pa.Table]:
        """The rows of a bucket, which are no longer in state afterwards."""
        for chunk in range(n):
            packed = self.waiting.getValue((*place, chunk))[0]
            self.waiting.removeKey((*place, chunk))
            yield from_bytes(packed)

    def _next(self) -> tuple[int, tuple[int, int]] | None:
        """The first bucket that has rows, and where it begins."""
        return min(((b << bits, (bits, b)) for (bits, b), held in self.buckets.items() if held[0] != SPLIT), default=None)

    def handleInputRows(self, key, rows, timerValues):
        self._load()
        first = self._put_all(from_bytes(row["_rows"]) for row in rows)
        if first is not None:
            self._save()
            self.timer.at(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.fired()
        upto = timerValues.getCurrentWatermarkInMs() * MILLI
        self._load()
        ahead = None
        while (found := self._next()) is not None and ahead is None:
            begin, place = found
            bits = place[0]
            if begin > upto:
                ahead = begin
                continue
            whole = begin + (1 << bits) <= upto + 1
            if bits and self.buckets[place][1] > (WHOLE if whole else CUT):
                chunks, self.buckets[place] = self._chunks(place, self.buckets[place][0]), (SPLIT, 0)
                self._put_all(chunks, bits)
                continue
            rows = self._in_order(list(self._chunks(place, self.buckets.pop(place)[0])))
            due = int(np.searchsorted(self._times(rows), upto, side="right"))
            if due < rows.num_rows:
                ahead = rows[self.time][due].as_py()
                self._put(rows.slice(due), bits)
            yield from self._hand(rows.slice(0, due))
        for bits, bucket in [place for place, held in self.buckets.items() if held[0] == SPLIT]:
            if (bucket + 1) << bits <= upto + 1:
                del self.buckets[bits, bucket]
        self._save()
        if ahead is not None:
            self.timer.at(ahead)

    def _hand(self, rows: pa.Table) -> Iterator[Row]:
        times, start = self._times(rows), 0
        while start < len(times):
            last = times[min(start + HANDED_PACKED, len(times)) - 1]
            stop = int(np.searchsorted(times, last, side="right"))
            for out in self.inner.take(rows.slice(start, stop - start)):
                if out.num_rows:
                    yield self.row(to_bytes(out))
            start = stop


class RunningTotals(_Keyed):
    """One row per input row: key columns, seq, total so far."""

    def __init__(self, seq: str, amount: str, kind: str = "decimal(38,2)"):
        self.seq, self.amount, self.kind = seq, amount, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", f"total {self.kind}")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.total.update((initialState["total"],))

    def _steps(self, rows):
        old = self.total.get()[0] if self.total.exists() else None
        new = old
        for row in in_order(rows, self.seq):
            amount = row[self.amount]
            new = old if amount is None else (old or 0) + amount
            yield row, old, new
            old = new
        if new is not None:
            self.total.update((new,))

    def handleInputRows(self, key, rows, timerValues):
        for row, _, new in self._steps(rows):
            yield self.row(*key, row[self.seq], new)


class ChangelogTotals(RunningTotals):
    """Change rows: key columns, seq, op, step, total."""

    def init(self, handle):
        super().init(handle)
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues):
        first = not self.seen.exists()
        for row, old, new in self._steps(rows):
            seq = row[self.seq]
            if first:
                self.seen.update((True,))
            else:
                yield self.row(*key, seq, "-U", 0, old)
            yield self.row(*key, seq, "+I" if first else "+U", 1, new)
            first = False


class ClickHistory(_Keyed):
    """Key columns, seq, count so far, last n categories."""

    def __init__(self, seq: str, category: str, n: int):
        self.seq, self.category, self.n = seq, category, n

    def init(self, handle):
        self.count = handle.getValueState("count", "count bigint")
        self.last = handle.getListState("last", "category string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.count.update((initialState["count"],))
        _replace(self.last, [(c,) for c in initialState["last"] or []])

    def more(self) -> tuple:
        """Columns that a later version of the state adds."""
        return ()

    def handleInputRows(self, key, rows, timerValues):
        more = self.more()
        count = self.count.get()[0] if self.count.exists() else 0
        last = [item[0] for item in self.last.get()] if self.last.exists() else []
        for row in in_order(rows, self.seq):
            count += 1
            last = [*last, row[self.category]][-self.n :]
            yield self.row(*key, row[self.seq], count, last, *more)
        self.count.update((count,))
        self.last.put([(c,) for c in last])


class MovedHistory(ClickHistory):
    """The next version of that state, with a field more: the count at the move, which is 0 for a key that is new."""

    def init(self, handle):
        super().init(handle)
        self.moved = handle.getValueState("moved", "count bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        super().handleInitialState(key, initialState, timerValues)
        self.moved.update((initialState["count"],))

    def more(self) -> tuple:
        return self.moved.get() if self.moved.exists() else (0,)


class SpendSummary(_Keyed):
    """Key columns, seq, spend so far, count per category so far."""

    def __init__(self, seq: str, category: str, amount: str, kind: str = "decimal(38,2)"):
        self.seq, self.category, self.amount, self.kind = seq, category, amount, kind

    def init(self, handle):
        self.spend = handle.getValueState("spend", f"spend {self.kind}")
        self.counts = handle.getMapState("counts", "category string", "n bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["spend"] is not None:
            self.spend.update((initialState["spend"],))
        for category, n in dict(initialState["counts"] or ()).items():  # a map comes as pairs
            self.counts.updateValue((category,), (n,))

    def handleInputRows(self, key, rows, timerValues):
        spend = self.spend.get()[0] if self.spend.exists() else self._zero()
        counts = {k[0]: v[0] for k, v in self.counts.iterator()} if self.counts.exists() else {}
        touched = set()
        for row in in_order(rows, self.seq):
            category = row[self.category]
            spend += row[self.amount] or 0
            counts[category] = counts.get(category, 0) + 1
            touched.add(category)
            yield self.row(*key, row[self.seq], spend, dict(counts))
        self.spend.update((spend,))
        for category in touched:
            self.counts.updateValue((category,), (counts[category],))


class SessionCounter(_Keyed):
    """Key columns, seq, counter that restarts after `ttl_us` of event-time silence."""

    def __init__(self, at: str, seq: str, ttl_us: int):
        self.at, self.seq, self.ttl_us = at, seq, ttl_us

    def init(self, handle):
        self.session = handle.getValueState("session", "last bigint, counter bigint")

    def handleInputRows(self, key, rows, timerValues):
        last, counter = self.session.get() if self.session.exists() else (None, 0)
        for row in in_order(rows, self.at, self.seq):
            counter = counter + 1 if last is not None and row[self.at] - last < self.ttl_us else 1
            last = row[self.at]
            yield self.row(*key, row[self.seq], counter)
        self.session.update((last, counter))


class ExpiringSum(_Keyed):
    """Key columns, seq, sum that starts anew after `ttl_us` of event-time silence."""

    def __init__(self, at: str, seq: str, amount: str, ttl_us: int, kind: str = "decimal(38,2)"):
        self.at, self.seq, self.amount, self.ttl_us, self.kind = at, seq, amount, ttl_us, kind

    def init(self, handle):
        self.sum = handle.getValueState("sum", f"last bigint, total {self.kind}")

    def handleInputRows(self, key, rows, timerValues):
        last, total = self.sum.get() if self.sum.exists() else (None, self._zero())
        for row in in_order(rows, self.at, self.seq):
            if last is not None and row[self.at] - last >= self.ttl_us:
                total = self._zero()
            total += row[self.amount] or 0
            last = row[self.at]
            yield self.row(*key, row[self.seq], total)
        self.sum.update((last, total))


class BatchFlush(_Keyed):
    """Key columns, seq, fill of the buffer, and the buffered categories when it is full."""

    def __init__(self, seq: str, category: str, n: int):
        self.seq, self.category, self.n = seq, category, n

    def init(self, handle):
        self.buffer = handle.getListState("buffer", "category string")

    def handleInputRows(self, key, rows, timerValues):
        items = [i[0] for i in self.buffer.get()] if self.buffer.exists() else []
        for row in in_order(rows, self.seq):
            items.append(row[self.category])
            full = len(items) == self.n
            yield self.row(*key, row[self.seq], len(items), list(items) if full else None)
            if full:
                items = []
        _replace(self.buffer, [(i,) for i in items])


class ExpiringCounter(_Keyed):
    """The same on the clock: state that was not written for `ttl_ms` is gone."""

    def __init__(self, seq: str, ttl_ms: int):
        self.seq, self.ttl_ms = seq, ttl_ms

    def init(self, handle):
        self.counter = handle.getValueState("counter", "counter bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        counter = self.counter.get()[0] if self.counter.exists() else 0
        for row in in_order(rows, self.seq):
            counter += 1
            yield self.row(*key, row[self.seq], counter)
        self.counter.update((counter,))


class AbandonedCart(_Keyed):
    """Key columns, deadline (us), reason, for carts without a next step by their deadline. Needs rows in time order."""

    def __init__(self, at: str, seq: str, action: str, timeout_us: int, cart: str, purchase: str):
        self.at, self.seq, self.action = at, seq, action
        self.timeout_us, self.cart, self.purchase = timeout_us, cart, purchase

    def init(self, handle):
        self.deadline = handle.getValueState("deadline", "deadline bigint")

    def wake_at(self) -> int | None:
        return self.deadline.get()[0] if self.deadline.exists() else None

    def _set(self, pending: int | None) -> None:
        if pending is None:
            self.deadline.clear()
        else:
            self.deadline.update((pending,))

    def handleInputRows(self, key, rows, timerValues):
        pending = self.wake_at()
        for row in in_order(rows, self.at, self.seq):
            if row[self.action] not in (self.cart, self.purchase):
                continue
            if pending is not None and row[self.at] > pending:
                yield self.row(*key, pending, "abandoned cart")
            pending = row[self.at] + self.timeout_us if row[self.action] == self.cart else None
        self._set(pending)

    def passed(self, key, upto):
        pending = self.wake_at()
        if pending is not None and pending <= upto:
            self._set(None)
            yield self.row(*key, pending, "abandoned cart")


class LatestValue(_Keyed):
    """Facts with the value that arrived last before them; side 0 rows carry values."""

    def __init__(self, seq: str, value: str, default: str, kept: Sequence[str], key: str):
        self.seq, self.value, self.default = seq, value, default
        self.kept, self.key = list(kept), key

    def init(self, handle):
        self.latest = handle.getValueState("latest", "value string")

    def handleInputRows(self, key, rows, timerValues):
        value = self.latest.get()[0] if self.latest.exists() else None
        for row in in_order(rows, self.seq, "_side"):
            if row["_side"] == 0:
                value = row[self.value]
            else:
                own = [key[0] if c == self.key else row[c] for c in self.kept]
                yield self.row(*own, self.default if value is None else value)
        if value is not None:
            self.latest.update((value,))


class AsOfVersion(_Keyed):
    """Facts with the version valid at their event time; side 0 rows are versions. Needs rows in time order.

    Of all versions only the last one before the rows at hand is kept.
    """

    def __init__(self, at: str, tie: str, names: Sequence[str], value_type: str, value: str):
        self.at, self.tie, self.names = at, tie, list(names)
        self.value, self.value_type = value, value_type

    def init(self, handle):
        self.version = handle.getValueState("version", f"value {self.value_type}")

    def handleInputRows(self, key, rows, timerValues):
        known = self.version.exists()
        value = self.version.get()[0] if known else None
        new = False

        def place(row):
            tie = row[self.tie]
            return row[self.at], row["_side"], tie is not None, 0 if tie is None else tie

        for row in sorted(rows, key=place):
            if row["_side"] == 0:
                value, known, new = row[self.value], True, True
            elif known:
                yield self.row(*[key[0] if n is None else row[n] for n in self.names], value)
        if new:
            self.version.update((value,))


def _by_time(rows: Iterator[Row], at: str, tie: str) -> list[Row]:
    """In order of their time; side 0 rows first, then by `tie`, null first."""
    return sorted(rows, key=lambda r: (r[at], r["_side"], r[tie] is not None, 0 if r[tie] is None else r[tie]))


def _sorted(rows: pa.Table, *columns: str) -> pa.Table:
    """Null first."""
    keys = [(c, "ascending") for c in columns]
    return rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start"))


class HeldFacts(_Keyed):
    """Facts with the last version before them; side 0 rows are versions. Needs rows in time order.

    Facts that have no version yet wait for the first one, each for `hold_us`, and then go with the default: one row
    per fact. They lie in state in buckets of an eighth of that time, so at most ten buckets of a key are alive.
    """

    def __init__(
        self, at: str, tie: str, fields: Sequence[tuple[str, str]], key: str, hold_us: int, value: str, default: str
    ):
        self.at, self.tie, self.key = at, tie, key
        self.names = [n for n, _ in fields]
        self.own = [n for n in self.names if n != key]
        self.schema = ", ".join(f"`{n}`: {kind}" for n, kind in fields if n != key)
        self.hold_us, self.value, self.default = hold_us, value, default
        self.width_us = max(1, hold_us // 8)

    def init(self, handle):
        self.version = handle.getValueState("version", "value string")
        self.waiting = handle.getMapState("held_facts", "bucket bigint", f"held array<struct<{self.schema}>>")
        self.buckets = handle.getValueState("held_buckets", "buckets array<bigint>, first bigint")

    def _out(self, key, held: tuple, value: str | None) -> Row:
        row = dict(zip(self.own, held, strict=True)) | {self.key: key[0]}
        return self.row(*[row[n] for n in self.names], self.default if value is None else value)

    def _buckets(self) -> list[int]:
        return list(self.buckets.get()[0]) if self.buckets.exists() else []

    def _release(self, key, upto: int | None, value: str | None = None, since: int | None = None) -> Iterator[Row]:
        """Waiting facts with a time up to `upto` (None: all) go, with `value` where their time is `since` or later."""
        at, left = self.own.index(self.at), self._buckets()
        first = None
        while left and (upto is None or left[0] * self.width_us <= upto):
            held = [tuple(r) for r in self.waiting.getValue((left[0],))[0]]
            for fact in held:
                if upto is None or fact[at] <= upto:
                    yield self._out(key, fact, value if since is None or fact[at] >= since else None)
            later = [] if upto is None else [fact for fact in held if fact[at] > upto]
            if later:
                self.waiting.updateValue((left[0],), (later,))
                first = min(fact[at] for fact in later)
                break
            self.waiting.removeKey((left.pop(0),))
        if left:
            self.buckets.update((left, left[0] * self.width_us if first is None else first))
        else:
            self.buckets.clear()

    def _hold(self, facts: list[tuple]) -> None:
        at, fresh = self.own.index(self.at), {}
        for fact in facts:
            fresh.setdefault(fact[at] // self.width_us, []).append(fact)
        known = self._buckets()
        first = min([fact[at] for fact in facts] + ([self.buckets.get()[1]] if known else []))
        for bucket, held in fresh.items():
            before = [tuple(r) for r in self.waiting.getValue((bucket,))[0]] if bucket in known else []
            self.waiting.updateValue((bucket,), (before + held,))
        self.buckets.update((sorted({*known, *fresh}), first))

    def handleInputRows(self, key, rows, timerValues):
        known = self.version.exists()
        value = self.version.get()[0] if known else None
        new, early = False, []
        for row in _by_time(rows, self.at, self.tie):
            if row["_side"] == 0:
                if not known:
                    if early:
                        self._hold(early)
                        early = []
                    yield from self._release(key, None, row[self.value], row[self.at] - self.hold_us)
                value, known, new = row[self.value], True, True
            elif known:
                yield self._out(key, tuple(row[n] for n in self.own), value)
            else:
                early.append(tuple(row[n] for n in self.own))
        if early:
            self._hold(early)
        if new:
            self.version.update((value,))

    def passed(self, key, upto):
        if self.buckets.exists():
            yield from self._release(key, upto - self.hold_us)

    def wake_at(self) -> int | None:
        return self.buckets.get()[1] + self.hold_us if self.buckets.exists() else None


class ReplicatedDimension(_Packed):
    """Facts of one shard with the dimension as it stood at their time. Needs packed rows in time order.

    Every shard gets all changes (side 0), so all of them hold the same rows at the same time. A change without a
    value takes the key out.
    """

    def __init__(self, at: str, tie: str, names: Sequence[str], key: tuple[str, str], value: tuple[str, str]):
        self.at, self.tie, self.names = at, tie, list(names)
        self.key, self.key_type = key
        self.value, self.value_type = value

    def init(self, handle):
        self.dimension = handle.getMapState("dimension", f"k {self.key_type}", f"value {self.value_type}")

    def take(self, rows: pa.Table) -> Iterator[pa.Table]:
        rows = _sorted(rows, self.at, "_side", self.tie)
        values, keys = rows[self.value], rows[self.key].to_pylist()
        seen: dict = {}  # by key, the place of its value in this table, or after it where it was known before
        changed, before, found = set(), [], []
        for place, side in enumerate(rows["_side"].to_pylist()):
            k = keys[place]
            if side == 0:
                seen[k] = place
                changed.add(k)
                continue
            if k is not None and k not in seen:
                seen[k] = len(values) + len(before)
                before.append(self.dimension.getValue((k,))[0] if self.dimension.containsKey((k,)) else None)
            found.append(None if k is None else seen[k])
        for k in changed:
            value = values[seen[k]].as_py()
            if value is not None:
                self.dimension.updateValue((k,), (value,))
            elif self.dimension.containsKey((k,)):
                self.dimension.removeKey((k,))
        known = pa.chunked_array([*values.chunks, pa.array(before, values.type)])
        facts = rows.filter(pc.equal(rows["_side"], 1)).select(self.names)
        yield facts.append_column(self.value, known.take(pa.array(found, pa.int64())))


class ClockWindows(_Keyed):
    """Key columns, window end (us), rows and total, by the clock: a row belongs to the window in which its batch runs,
    and the window is given out when the clock has passed its end."""

    def __init__(self, amount: str, size_ms: int, kind: str = "decimal(38,2)"):
        self.amount, self.size_ms, self.kind = amount, size_ms, kind

    def init(self, handle):
        self.handle = handle
        self.windows = handle.getMapState("windows", "ends bigint", f"n bigint, total {self.kind}")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        end = now - now % self.size_ms + self.size_ms
        n, total = self.windows.getValue((end,)) if self.windows.containsKey((end,)) else (0, None)
        for row in rows:
            n, amount = n + 1, row[self.amount]
            if amount is not None:
                total = amount if total is None else total + amount
        self.windows.updateValue((end,), (n, total))
        self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        end = expiredTimerInfo.getExpiryTimeInMs()
        if self.windows.containsKey((end,)):
            yield self.row(*key, end * MILLI, *self.windows.getValue((end,)))
            self.windows.removeKey((end,))


def _replace(state: Any, items: list[tuple]) -> None:
    if items:
        state.put(items)
    else:
        state.clear()


class LateTagger(_Keyed):
    """Input columns, window end (us) and whether the row is on time for it."""

    def __init__(self, at: str, size_us: int, lateness_us: int, columns: Sequence[str]):
        self.at, self.size_us, self.lateness_us = at, size_us, lateness_us
        self.columns = list(columns)

    def init(self, handle):
        pass

    def handleInputRows(self, key, rows, timerValues):
        watermark = (timerValues.getCurrentWatermarkInMs() - 1) * MILLI
        for row in rows:
            end = row[self.at] - row[self.at] % self.size_us + self.size_us
            last = end - MILLI
            if watermark >= last + self.lateness_us:
                tag = "too_late"
            elif watermark >= last:
                tag = "late_update"
            else:
                tag = "on_time"
            yield self.row(*[row[c] for c in self.columns], end, tag)


class LateWindows(_Packed):
    """Windows that fire when event time has passed them, again for each late row, and refuse rows that are later still.

    Keyed by shard; packed rows come in order of their arrival tick. Side 0 rows are facts (window end, key, seq, amount),
    side 1 rows tell every shard alike how far a source had got by the end of a tick. Event time is the least of the
    sources that are not idle, less the bound, and never goes back. So all shards see the same event time at the same
    tick, and a row is judged by what had arrived in earlier ticks.

    Open windows lie in state by their end, and stay for the lateness. Gives key columns, seq, window end (us), total,
    firing: `fire` (seq of the last row on time), `update` (of the late row), or `too_late` (its own amount).
    """

    def __init__(
        self, keys: Sequence[tuple[str, str]], seq: tuple[str, str], amount: str, kind: str,
        bound_us: int, lateness_us: int, idle_us: int | None,
    ):
        self.keys, self.types = [k for k, _ in keys], [t for _, t in keys]
        self.seq, self.seq_type = seq
        self.amount, self.kind = amount, kind
        self.bound_us, self.lateness_us, self.idle_us = bound_us, lateness_us, idle_us

    def init(self, handle):
        self.sources = handle.getMapState("sources", "source string", "seen bigint, tick bigint")
        self.event_time = handle.getValueState("event_time", "at bigint")
        keys = "".join(f"k{i}: {t}, " for i, t in enumerate(self.types))
        self.windows = handle.getMapState(
            "windows", "ends bigint", f"open array<struct<{keys}total: {self.kind}, seq: {self.seq_type}, fired: boolean>>"
        )
        self.ends = handle.getValueState("ends", "ends array<bigint>")

    def _open(self, end: int) -> dict[tuple, list]:
        """Of the windows with this end, by key: total, seq of the last row on time, has it fired?"""
        if end not in self.cache:
            n, held = len(self.keys), []
            if end in self.known:
                held = [tuple(r) for r in self.windows.getValue((end,))[0]]
            self.cache[end] = {r[:n]: list(r[n:]) for r in held}
        return self.cache[end]

    def _passed(self, end: int, later: int = 0) -> bool:
        return self.now is not None and self.now >= end - MILLI + later

    def _advance(self, tick: int) -> Iterator[tuple]:
        active = [seen for seen, last in self.progress.values() if self.idle_us is None or tick - last <= self.idle_us]
        now = min(active) - self.bound_us - MILLI
        if self.now is not None and now <= self.now:
            return
        self.now = now
        for end in sorted(self.known | self.cache.keys()):
            if not self._passed(end):
                break
            for key, window in self._open(end).items():
                if not window[2]:
                    window[2] = True
                    if window[1] is not None:
                        yield *key, window[1], end, window[0], "fire"
            if self._passed(end, self.lateness_us):
                self.cache[end] = {}

    def _fact(self, key: tuple, seq, amount, end: int) -> Iterator[tuple]:
        if self._passed(end, self.lateness_us):
            yield *key, seq, end, amount, "too_late"
            return
        window = self._open(end).setdefault(key, [None, None, False])
        if amount is not None:
            window[0] = amount if window[0] is None else window[0] + amount
        if self._passed(end):
            window[2] = True
            yield *key, seq, end, window[0], "update"
        else:
            window[1] = seq

    def take(self, rows: pa.Table) -> Iterator[pa.Table]:
        out = list(self._taken(_sorted(rows, "_tick", "_side", self.seq)))
        kinds = [rows.schema.field(c).type for c in (*self.keys, self.seq, "_end", self.amount)] + [pa.string()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds, strict=True)] if out else []
        yield pa.table(columns, names=[*self.keys, self.seq, "_end", "total", "firing"] if out else [])

    def _taken(self, rows: pa.Table) -> Iterator[tuple]:
        self.cache: dict[int, dict[tuple, list]] = {}
        self.known = set(self.ends.get()[0]) if self.ends.exists() else set()
        self.now = self.event_time.get()[0] if self.event_time.exists() else None
        self.progress = {k[0]: tuple(v) for k, v in self.sources.iterator()} if self.sources.exists() else {}
        marked, heard = None, set()
        columns = (*self.keys, self.seq, self.amount, "_end", "_tick", "_side", "_source", "_seen")
        for *key, seq, amount, end, tick, side, source, seen in zip(*(rows[c].to_pylist() for c in columns), strict=True):
            if marked is not None and marked != tick:
                yield from self._advance(marked)
                marked = None
            if side:
                marked = tick
                self.progress[source] = (max(seen, self.progress.get(source, (seen,))[0]), marked)
                heard.add(source)
            else:
                yield from self._fact(tuple(key), seq, amount, end)
        if marked is not None:
            yield from self._advance(marked)
        for source in heard:
            self.sources.updateValue((source,), self.progress[source])
        self._keep()

    def _keep(self) -> None:
        for end, found in self.cache.items():
            if found:
                self.windows.updateValue((end,), ([(*k, *w) for k, w in found.items()],))
                self.known.add(end)
            elif end in self.known:
                self.windows.removeKey((end,))
                self.known.discard(end)
        if self.known:
            self.ends.update((sorted(self.known),))
        else:
            self.ends.clear()
        if self.now is not None:
            self.event_time.update((self.now,))


def _place(total, member) -> tuple:
    """Sorts by falling total, then by member, null first."""
    return -total, member is not None, member


class RankedShard(_Keyed):
    """Totals of the members of one shard of a group, and the list of the n best, given out when it changes.

    A member that rises enters the list by itself. Only where a listed member falls below what was the last place of
    a full list may one that is not listed come up; then the totals of this shard are gone through.
    """

    def __init__(self, member: tuple[str, str], amount: str, kind: str, n: int):
        self.member, self.member_type = member
        self.amount, self.kind, self.n = amount, kind, n

    def init(self, handle):
        self.totals = handle.getMapState("totals", f"member {self.member_type}", f"total {self.kind}")
        self.top = handle.getValueState("top", f"top array<struct<total: {self.kind}, member: {self.member_type}>>")

    def handleInputRows(self, key, rows, timerValues):
        added: dict = {}
        for row in rows:
            added[row[self.member]] = added.get(row[self.member], self._zero()) + (row[self.amount] or 0)
        before = [tuple(x) for x in self.top.get()[0]] if self.top.exists() else []
        listed = {member: total for total, member in before}
        for member, amount in added.items():
            if self.totals.containsKey((member,)):
                amount += self.totals.getValue((member,))[0]
            self.totals.updateValue((member,), (amount,))
            listed[member] = amount
        top = heapq.nsmallest(self.n, ((t, m) for m, t in listed.items()), key=lambda x: _place(*x))
        if len(before) == self.n and _place(*top[-1]) > _place(*before[-1]):
            every = ((v[0], k[0]) for k, v in self.totals.iterator())
            top = heapq.nsmallest(self.n, every, key=lambda x: _place(*x))
        if top != before:
            self.top.update((top,))
            yield self.row(*key, [Row(total=total, member=member) for total, member in top])


class MergedRanks(_Keyed):
    """The n best of a group from the lists of its shards: a row for every place that changes."""

    def __init__(self, member_type: str, kind: str, n: int):
        self.list_type = f"array<struct<total: {kind}, member: {member_type}>>"
        self.n = n

    def init(self, handle):
        self.shards = handle.getMapState("shards", "shard int", f"top {self.list_type}")
        self.published = handle.getValueState("published", f"top {self.list_type}")

    def handleInputRows(self, key, rows, timerValues):
        for row in rows:
            self.shards.updateValue((row["_shard"],), ([(x["total"], x["member"]) for x in row["_top"]],))
        every = (tuple(x) for _, value in self.shards.iterator() for x in value[0])
        top = heapq.nsmallest(self.n, every, key=lambda x: _place(*x))
        before = [tuple(x) for x in self.published.get()[0]] if self.published.exists() else []
        for rank, (total, member) in enumerate(top):
            known = rank < len(before)
            if not known or before[rank] != (total, member):
                yield self.row(*key, rank + 1, member, total, "+U" if known else "+I")
        self.published.update((top,))
