"""Who leads a group after every row, where totals may fall as well as rise."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.ordered import following, running_count, running_sum, scan
from tidemark.session import write_and_read

#: rows of a group that one call goes through
STRETCH = 4096


def _covered(begin: Column, end: Column, levels: Column) -> Column:
    """The aligned blocks (level, number) that make up the stretches from `begin` to before `end`."""
    kind = "array<struct<level: int, block: bigint>>"

    def block(level: Column, number: Column) -> Column:
        return F.array(F.struct(level.alias("level"), number.alias("block"))).cast(kind)

    def step(done: Column, level: Column) -> Column:
        a, b = done["a"], done["b"]
        open_ = a < b
        odd_a, odd_b = open_ & (a % 2 == 1), open_ & (b % 2 == 1)
        left = F.when(odd_a, block(level, a)).otherwise(F.array().cast(kind))
        # the block at the left may have been the last one
        right = F.when(odd_b & (F.when(odd_a, a + 1).otherwise(a) < b), block(level, b - 1)).otherwise(F.array().cast(kind))
        return F.struct(
            F.floor(F.when(odd_a, a + 1).otherwise(a) / 2).alias("a"),
            F.floor(F.when(odd_b, b - 1).otherwise(b) / 2).alias("b"),
            F.concat(done["blocks"], left, right).alias("blocks"),
        )

    zero = F.struct(begin.cast("long").alias("a"), end.cast("long").alias("b"), F.array().cast(kind).alias("blocks"))
    return F.aggregate(F.sequence(F.lit(0), levels), zero, step, lambda done: done["blocks"])


def _follow(schema: pa.Schema, group: str, member: str, seq: str):
    """The changes of the leader in one stretch of a group."""

    def follow(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["_pos"])
        outer = rows[0]["_outer"]
        best_outer = None if outer is None else _rank(outer["under"], outer["member"])
        totals: dict = {}
        for row in rows:  # what those that change here had before
            if row[member] not in totals:
                totals[row[member]] = None if row["_was"] is None else -row["_was"]
        heap = [_rank(under, name) for name, under in totals.items() if under is not None]
        heapq.heapify(heap)

        def leader():
            while heap and totals[heap[0][2]] != heap[0][0]:
                heapq.heappop(heap)
            return min((x for x in (best_outer, heap[0] if heap else None) if x is not None), default=None)

        now, out = leader(), []
        for row in rows:
            totals[row[member]] = -row["_sum"]
            heapq.heappush(heap, _rank(-row["_sum"], row[member]))
            was, now = now, leader()
            if was != now:
                base = {group: row[group], seq: row[seq]}
                if was is not None:
                    out.append({**base, "op": "-U", "step": 0, member: was[2], "total": -was[0]})
                out.append({**base, "op": "+I" if was is None else "+U", "step": 1, member: now[2], "total": -now[0]})
        return pa.Table.from_pylist(out, schema=schema)

    return follow


def _rank(under, member) -> tuple:
    return under, member is not None, member


def leader_changes(
    df: DataFrame,
    group: str,
    member: str,
    seq: str,
    amount: str,
    max_rows: int | None = None,
    stretch: int = STRETCH,
) -> DataFrame:
    """Change rows of "the member with the highest total per group" (of equal totals the smallest member), for
    amounts of either sign: group, seq, op, step, member, total. A null amount counts as 0; `seq` is unique in a group.

    A group is cut into stretches of its order. In a stretch the members that change there compete in a heap; of all
    others only the best matters, as their totals stand still. A total that stands still over whole stretches is put
    on the aligned blocks that make these up (at most two of each size), each block keeps its best, combined before
    the shuffle, and a stretch takes the best of the blocks that it lies in. So no task sees more of a group than
    a stretch and a row for each block size.
    """
    spent = F.coalesce(F.col(amount), F.lit(0))
    summed = scan(
        df.select(group, member, seq, amount), [group, member], [seq], max_rows, True,
        _sum=running_sum(spent), _was=running_sum(spent, before=True),
    )
    placed = scan(summed, [group], [seq], max_rows, True, like=df, _pos=running_count())
    placed = scan(placed, [group, member], [seq], max_rows, like=df, _next=following("_pos"))
    at = F.floor((F.col("_pos") - 1) / stretch)
    until = F.floor((F.col("_next") - 1) / stretch)
    rows = write_and_read(placed.drop(amount).withColumns({"_stretch": at, "_until": until}), "leaders")

    sizes = rows.groupBy(F.col(group).alias("_in")).agg((F.max("_stretch") + 1).alias("_stretches"))
    sizes = sizes.withColumn("_levels", F.ceil(F.log2(F.col("_stretches") + 1)).cast("int"))
    sizes = write_and_read(sizes, "leader-groups")
    same = F.col(group).eqNullSafe(F.col("_in"))
    still = rows.join(sizes, same).withColumn("_end", F.coalesce("_until", "_stretches")).where("_stretch + 1 < _end")
    best = F.min(F.struct((-F.col("_sum")).alias("under"), F.col(member).alias("member"))).alias("best")
    blocks = (
        still.withColumn("_b", F.explode(_covered(F.col("_stretch") + 1, F.col("_end"), F.col("_levels"))))
        .groupBy(F.col("_in").alias("_of"), "_b.level", "_b.block")
        .agg(best)
    )
    lying = sizes.select("_in", "_levels", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_stretches") - 1)).alias("_at"))
    lying = lying.withColumn("level", F.explode(F.sequence(F.lit(0), F.col("_levels"))))
    lying = lying.withColumn("block", F.call_function("shiftright", F.col("_at"), F.col("level")))
    met = lying.join(blocks, (F.col("_in").eqNullSafe(F.col("_of"))) & (lying["level"] == blocks["level"]) & (lying["block"] == blocks["block"]))
    outer = write_and_read(met.groupBy("_in", "_at").agg(F.min("best").alias("_outer")), "leader-outer")

    joined = rows.join(outer, same & (F.col("_stretch") == F.col("_at")), "left").drop("_in", "_at")
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType(
        [
            T.StructField(group, kinds[group]),
            T.StructField(seq, kinds[seq]),
            T.StructField("op", T.StringType()),
            T.StructField("step", T.IntegerType()),
            T.StructField(member, kinds[member]),
            T.StructField("total", kinds["_sum"]),
        ]
    )
    return joined.groupBy(group, "_stretch").applyInArrow(_follow(to_arrow_schema(schema), group, member, seq), schema)
