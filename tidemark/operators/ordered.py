"""Running values per key in a given order, with hot keys split over tasks.

A plain window puts every row of a key into one task. With few keys, or one
that holds a third of the rows, that task becomes the whole job. Here each key
whose share is too large is cut into consecutive stretches of its order:

1. the keys are counted (combined before the shuffle) and the few that exceed
   the limit are marked;
2. quantiles of the order column within each marked key give its own cut points.
   Values that fill a stretch by themselves are cut again by the next order column;
3. the rows are windowed by key and stretch in one shuffle;
4. each stretch is reduced to one summary row, a window over these few rows
   yields what every stretch takes over from the ones before (or after) it,
   and a join adds that to the rows.

Cut points only balance the work. Any choice gives the same result. The input
must be deterministic, because it is read for the profile, the summaries and
the rows; `settle` writes intermediate results where reading twice is dear.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.scalars import list_tail, order_number
from tidemark.session import write_and_read

ROWS_PER_STRETCH = 1_000_000
ROWS_PER_CUT = 2_000  # rows looked at per cut point
GRID = 1000  # least number of quantiles that are looked at per hot key
BROADCAST_VALUES = 500_000  # most values of stretches that are sent to every task


@dataclass(frozen=True)
class Running:
    """One running value: inside a stretch, per stretch, and across stretches."""

    local: Callable[[_Windows], Column]
    summary: Callable[[Column], Column]
    carried: Callable[[str, _Windows], Column]
    combine: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda result: result


@dataclass(frozen=True)
class _Windows:
    keys: list[str]
    order: list[str]

    @property
    def forward(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    @property
    def backward(self):
        return Window.partitionBy(*self.keys).orderBy(*[F.col(c).desc() for c in self.order])

    def upto(self, before: bool):
        return self.forward.rowsBetween(Window.unboundedPreceding, -1 if before else 0)

    @property
    def earlier(self):
        return self.upto(before=True)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _first_known(*options: Column) -> Column:
    return F.coalesce(*options)


def running_sum(value: Column | str, before: bool = False) -> Running:
    """Sum of the values so far; `before` leaves out the row itself."""
    v = _column(value)
    zero = F.lit(0)
    return Running(
        local=lambda w: F.sum(v).over(w.upto(before)),
        summary=lambda at: F.sum(v),
        carried=lambda part, w: F.sum(part).over(w.earlier),
        combine=lambda own, old: F.when(
            own.isNotNull() | old.isNotNull(), F.coalesce(own, zero) + F.coalesce(old, zero)
        ),
    )


def running_count(before: bool = False) -> Running:
    """Number of rows so far."""
    one = F.lit(1)
    return Running(
        local=lambda w: F.count(one).over(w.upto(before)),
        summary=lambda at: F.count(one),
        carried=lambda part, w: F.sum(part).over(w.earlier),
        combine=lambda own, old: own + F.coalesce(old, F.lit(0)),
    )


def remaining_count() -> Running:
    """Number of rows from the row itself to the last one."""
    one = F.lit(1)
    return Running(
        local=lambda w: F.count(one).over(w.backward.rowsBetween(Window.unboundedPreceding, 0)),
        summary=lambda at: F.count(one),
        carried=lambda part, w: F.sum(part).over(w.backward.rowsBetween(Window.unboundedPreceding, -1)),
        combine=lambda own, old: own + F.coalesce(old, F.lit(0)),
    )


def running_max(value: Column | str, before: bool = False) -> Running:
    v = _column(value)
    return Running(
        local=lambda w: F.max(v).over(w.upto(before)),
        summary=lambda at: F.max(v),
        carried=lambda part, w: F.max(part).over(w.earlier),
        combine=lambda own, old: F.greatest(own, old),
    )


def running_min(value: Column | str, before: bool = False) -> Running:
    """Smallest value so far; structs compare field by field."""
    v = _column(value)
    return Running(
        local=lambda w: F.min(v).over(w.upto(before)),
        summary=lambda at: F.min(v),
        carried=lambda part, w: F.min(part).over(w.earlier),
        combine=lambda own, old: F.when(own.isNull() | (old < own), old).otherwise(own),
    )


def latest(value: Column | str, before: bool = False) -> Running:
    """Last value so far that is not null."""
    v = _column(value)
    return Running(
        local=lambda w: F.last(v, ignorenulls=True).over(w.upto(before)),
        summary=lambda at: F.max_by(v, F.when(v.isNotNull(), at)),
        carried=lambda part, w: F.last(part, ignorenulls=True).over(w.earlier),
        combine=_first_known,
    )


def next_known(value: Column | str) -> Running:
    """First value after the row that is not null."""
    v = _column(value)
    return Running(
        local=lambda w: F.last(v, ignorenulls=True).over(
            w.backward.rowsBetween(Window.unboundedPreceding, -1)
        ),
        summary=lambda at: F.min_by(v, F.when(v.isNotNull(), at)),
        carried=lambda part, w: F.last(part, ignorenulls=True).over(
            w.backward.rowsBetween(Window.unboundedPreceding, -1)
        ),
        combine=_first_known,
    )


def previous(value: Column | str) -> Running:
    """Value of the row before, null for the first row."""
    boxed = F.struct(_column(value).alias("v"))
    return Running(
        local=lambda w: F.lag(boxed).over(w.forward),
        summary=lambda at: F.max_by(boxed, at),
        carried=lambda part, w: F.lag(part).over(w.forward),
        combine=_first_known,
        finish=lambda box: box["v"],
    )


def following(value: Column | str) -> Running:
    """Value of the row after, null for the last row."""
    boxed = F.struct(_column(value).alias("v"))
    return Running(
        local=lambda w: F.lead(boxed).over(w.forward),
        summary=lambda at: F.min_by(boxed, at),
        carried=lambda part, w: F.lead(part).over(w.forward),
        combine=_first_known,
        finish=lambda box: box["v"],
    )


@dataclass(frozen=True)
class Tail:
    """The last n values up to and including the row, oldest first."""

    value: Column
    n: int

    @property
    def boxed(self) -> Column:
        return F.struct(self.value.alias("v"))


def tail(value: Column | str, n: int) -> Tail:
    return Tail(_column(value), n)


def _splits(own: list, text: bool) -> tuple[list, dict]:
    """Where to cut a key, and the values that fill stretches by themselves with the cuts that fell on them.

    Such a value is cut off on both sides: the next larger text or number is a cut, too.
    Numbers that doubles do not tell apart are left.
    """
    filled = {x: n for x, n in sorted(Counter(own).items()) if n > 1 and (text or abs(x) < 2**53)}
    after = [x + "\0" if text else math.nextafter(x, math.inf) for x in filled]
    return sorted({*own, *after}), filled


def _ranked(df: DataFrame, name: str, points: str, most: int) -> DataFrame:
    """How many of a row's sorted points are not above its `_value`: a binary search, a column per step."""
    df = df.withColumn(name, F.lit(0))
    for step in reversed([1 << i for i in range(most.bit_length())]):
        reached = F.get(points, F.col(name) + (step - 1)) <= F.col("_value")
        df = df.withColumn(name, F.col(name) + F.when(reached, step).otherwise(0))
    return df


class OrderedGroups:
    """Rows grouped by keys and ordered inside each group.

    `rows` is the input with the stretch marks; `scan` adds running values to
    it (or to rows derived from it that keep keys, order and marks), `done`
    removes the marks.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int | None = None,
        like: DataFrame | None = None,
    ):
        """`like` has about the same rows per key as `df` but costs less to read.

        It is profiled in its place, with the cut points of the order columns it has.
        """
        self.keys = list(keys)
        self.order = list(order)
        self.marks: list[str] = []
        self.stretches = 0
        self.rows = df
        self._split(df, df if like is None else like, max_rows)

    def _split(self, df: DataFrame, like: DataFrame, max_rows: int | None) -> None:
        # finer shares than a quarter of a core's would not balance better
        shares = 4 * max(df.sparkSession.sparkContext.defaultParallelism, 16)
        total = like.count()
        limit = max(max_rows or ROWS_PER_STRETCH, total // shares)
        if not self.keys:
            # one group that holds everything: always cut it
            pieces, hot_rows = max(math.ceil(total / limit), min(8, total // 2)), total

            def marked(rows: DataFrame) -> DataFrame:
                return rows.withColumns({"_hot": F.lit(0), "_pieces": F.lit(pieces)})
        else:
            hot = []
            if total > limit:
                # fewer than `shares` keys can exceed the limit
                counts = like.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_rows"))
                hot = counts.where(F.col("_rows") > limit).collect()
            pieces = sum(math.ceil(r["_rows"] / limit) for r in hot)
            hot_rows = sum(r["_rows"] for r in hot)
            names = {k: f"_hot_{k}" for k in self.keys}
            schema = [T.StructField(n, like.schema[k].dataType) for k, n in names.items()]
            small = df.sparkSession.createDataFrame(
                [(*r[:-1], i, math.ceil(r[-1] / limit)) for i, r in enumerate(hot)],
                T.StructType(
                    [*schema, T.StructField("_hot", T.IntegerType()), T.StructField("_pieces", T.IntegerType())]
                ),
            )

            def marked(rows: DataFrame) -> DataFrame:
                match = _all(F.col(k).eqNullSafe(F.col(n)) for k, n in names.items())
                return rows.join(F.broadcast(small), match, "left").drop(*names.values())

        if pieces < 2:
            return
        share = min(1.0, ROWS_PER_CUT * pieces / max(hot_rows, 1))
        grid = max(GRID, pieces)
        self.rows = self._cut(marked(df), marked(like), share, grid).drop("_hot", "_pieces")

    def _cut(self, df: DataFrame, like: DataFrame, share: float, grid: int) -> DataFrame:
        """Mark each hot row with its stretch, one mark per order column used.

        A hot key is cut at its own quantiles and nowhere else, so all keys together get
        at most about twice the stretches that were asked for. A value that fills several
        of them is a group of its own for the next column, with its own share of pieces.
        A share of the rows is enough to find the cut points; all rows are marked.
        """
        for place, name in enumerate(self.order):
            kind = df.schema[name].dataType
            text = isinstance(kind, T.StringType)
            value = F.col(name) if text else order_number(name, kind)
            if value is None:
                raise TypeError(f"rows of a large group cannot be cut by {name}: {kind.simpleString()} has no cut points")
            value = F.coalesce(value, F.lit("" if text else float("-inf")))
            both = set(self.order[: place + 1]) <= set(like.columns)
            probed = like if both else df
            if share < 1:
                probed = probed.sample(share, seed=1)
            cuts, units = [], 0
            for hot, own in self._cut_points(probed.where("_hot IS NOT NULL"), value, text, grid).items():
                splits, filled = _splits(own, text)
                cuts.append((hot, splits, list(filled), [n + 1 for n in filled.values()], units))
                units += len(filled)
            if not any(c[1] for c in cuts):
                break
            self.stretches += sum(len(c[1]) + 1 for c in cuts)
            df = self._marked(df, value, cuts, text)
            if both:
                like = self._marked(like, value, cuts, text)
            self.marks.append(f"_stretch{place}")
            if not units:
                break
        return df

    def _marked(self, df: DataFrame, value: Column, cuts: list[tuple], text: bool) -> DataFrame:
        """Rows with the stretch of their own key's cuts; `_hot` and `_pieces` become those of the next column.

        The table of cuts comes from the driver: one row per hot key, fewer than two cuts per piece.
        """
        kind = "string" if text else "double"
        table = df.sparkSession.createDataFrame(
            cuts, f"_of int, _splits array<{kind}>, _filled array<{kind}>, _into array<int>, _first int"
        )
        df = df.withColumn("_value", value).join(F.broadcast(table), F.col("_hot") == F.col("_of"), "left")
        df = _ranked(df, "_bucket", "_splits", max(len(c[1]) for c in cuts))
        df = _ranked(df, "_unit", "_filled", max(len(c[2]) for c in cuts))
        bucket = F.col("_bucket").cast("long")
        if not self.marks:
            # one number for key and stretch, null for all other keys
            number = F.when(F.col("_hot").isNotNull(), F.col("_hot") * F.lit(2**32) + bucket)
        else:
            number = F.when(F.col("_hot").isNotNull(), bucket).otherwise(-1)
        at = F.col("_unit") - 1
        fills = F.get("_filled", at) == F.col("_value")
        marked = df.withColumns(
            {
                f"_stretch{len(self.marks)}": number,
                "_hot": F.when(fills, F.col("_first") + at),
                "_pieces": F.when(fills, F.get("_into", at)),
            }
        )
        return marked.drop("_value", "_bucket", "_unit", *table.columns)

    def _cut_points(self, hot: DataFrame, value: Column, text: bool, grid: int) -> dict[int, list]:
        """The quantiles of each hot key: one less than its pieces."""
        if text:
            found = hot.groupBy("_hot", "_pieces").agg(F.sort_array(F.collect_list(value)).alias("every"))
        else:
            shares = [i / grid for i in range(1, grid)]
            found = hot.groupBy("_hot", "_pieces").agg(F.percentile_approx(value, shares, 10 * grid).alias("every"))
        n, k = F.size("every"), F.col("_pieces")
        picked = F.transform(
            F.filter(F.sequence(F.lit(0), k - 1), lambda i: i > 0),
            lambda i: F.get("every", F.least(F.floor(i * n / k).cast("int"), n - 1)),
        )
        return {
            r["_hot"]: sorted(x for x in r["cuts"] if x is not None and (text or math.isfinite(x)))
            for r in found.select("_hot", picked.alias("cuts")).collect()
        }

    def scan(self, df: DataFrame, **values: Running | Tail) -> DataFrame:
        """Add one column per running value."""
        spread = _Windows(self.keys + self.marks, self.order)
        columns = {}
        for name, value in values.items():
            if isinstance(value, Tail):
                frame = spread.forward.rowsBetween(-(value.n - 1), 0)
                columns[f"_own_{name}"] = F.collect_list(value.boxed).over(frame)
            else:
                columns[f"_own_{name}"] = value.local(spread)
        result = df.select("*", *[c.alias(n) for n, c in columns.items()])
        if self.marks:
            width = sum(v.n if isinstance(v, Tail) else 1 for v in values.values())
            result = self._join_carried(result, self._carried(df, values), width)
        kept = [c for c in df.columns if c not in values]
        return result.select(*kept, *[self._result(n, v).alias(n) for n, v in values.items()])

    def _result(self, name: str, value: Running | Tail) -> Column:
        own, old = F.col(f"_own_{name}"), F.col(f"_old_{name}")
        if isinstance(value, Tail):
            boxes = own
            if self.marks:
                boxes = list_tail(F.when(old.isNull(), own).otherwise(F.concat(old, own)), value.n)
            return F.transform(boxes, lambda b: b["v"])
        if self.marks:
            split = F.col(self.marks[0]).isNotNull()
            own = F.when(split, value.combine(own, old)).otherwise(own)
        return value.finish(own)

    def _carried(self, df: DataFrame, values: dict[str, Running | Tail]) -> DataFrame:
        """Per stretch of a hot key: what it takes over from the other stretches."""
        groups = self.keys + self.marks
        at = F.struct(*self.order)
        across = _Windows(self.keys, self.marks)
        hot = df.where(F.col(self.marks[0]).isNotNull())
        parts = hot.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[v.summary(at).alias(f"_part_{n}") for n, v in values.items() if isinstance(v, Running)],
        )
        for name, value in values.items():
            if isinstance(value, Tail):
                match = _all(F.col(g).eqNullSafe(F.col(f"_end_{g}")) for g in groups)
                parts = parts.join(self._ends(hot, name, value), match, "left")
                parts = parts.drop(*[f"_end_{g}" for g in groups])
        carried = []
        for name, value in values.items():
            part = f"_part_{name}"
            if isinstance(value, Tail):
                frame = across.forward.rowsBetween(-(value.n - 1), -1) if value.n > 1 else None
                lists = F.flatten(F.collect_list(part).over(frame)) if frame else F.col(part)
                carried.append(lists.alias(f"_old_{name}"))
            else:
                carried.append(value.carried(part, across).alias(f"_old_{name}"))
        return parts.select(*[F.col(g).alias(f"_to_{g}") for g in groups], *carried)

    def _ends(self, hot: DataFrame, name: str, value: Tail) -> DataFrame:
        """The last n-1 rows of each stretch as one short list."""
        groups = self.keys + self.marks
        backward = Window.partitionBy(*groups).orderBy(*[F.col(c).desc() for c in self.order])
        short = (
            hot.select(*groups, F.struct(*self.order, value.boxed.alias("_box")).alias("_row"), *self.order)
            .withColumn("_rank", F.row_number().over(backward))
            .where(F.col("_rank") <= max(value.n - 1, 1))
        )
        lists = short.groupBy(*groups).agg(F.sort_array(F.collect_list("_row")).alias("_rows_end"))
        return lists.select(
            *[F.col(g).alias(f"_end_{g}") for g in groups],
            F.transform("_rows_end", lambda r: r["_box"]).alias(f"_part_{name}"),
        )

    def _join_carried(self, df: DataFrame, carried: DataFrame, width: int) -> DataFrame:
        """Add to each row what its stretch takes over; `width` is the number of values in that.

        There is one row per stretch, and their number is known. Beyond the bound the hot
        rows are joined by shuffle on their stretch and the others pass by.
        """
        match = _all(F.col(m) == F.col(f"_to_{m}") for m in self.marks)
        to = [f"_to_{g}" for g in self.keys + self.marks]
        if self.stretches * width <= BROADCAST_VALUES:
            return df.join(F.broadcast(carried), match, "left").drop(*to)
        hot = F.col(self.marks[0]).isNotNull()
        joined = df.where(hot).join(carried, match, "left").drop(*to)
        return joined.unionByName(df.where(~hot), allowMissingColumns=True) if self.keys else joined

    def settle(self, df: DataFrame) -> DataFrame:
        """Between two scans of split groups: write the rows instead of computing them twice."""
        return write_and_read(df, "scan") if self.marks else df

    def done(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.marks)


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int | None = None,
    settled: bool = False,
    like: DataFrame | None = None,
    **values: Running | Tail,
) -> DataFrame:
    """One pass of running values over the groups.

    `settled` writes the result if keys were split, for callers that scan it again.
    """
    groups = OrderedGroups(df, keys, order, max_rows, like)
    result = groups.done(groups.scan(groups.rows, **values))
    return groups.settle(result) if settled else result
