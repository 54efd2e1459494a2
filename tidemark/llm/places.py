"""Places of rows in a global order, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import write_and_read


def numbered(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """`rows` with _pos, the place (from 0) among the rows of the same group, and _n, their number.

    Sorted over all tasks, nulls first, and numbered inside each: a group may fill many
    partitions. What each starts at comes from a row for each group and partition. The
    sorted rows are written to the shared folder, so places stay what they are.
    """
    ranked = write_and_read(rows.orderBy(group, *order).withColumn("_m", F.monotonically_increasing_id()), label)
    ranked = ranked.withColumn("_part", F.shiftright("_m", 33))
    parts = ranked.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(
        F.count("*").alias("_rows"), F.min("_m").alias("_first")
    )
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns(
        {
            "_start": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            "_n": F.sum("_rows").over(Window.partitionBy("_g")),
        }
    )
    parts = write_and_read(parts, f"{label}-starts")
    met = ranked.join(parts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return met.select(*rows.columns, (F.col("_m") - F.col("_first") + F.col("_start")).alias("_pos"), "_n")
