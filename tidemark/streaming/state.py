"""Reading the state of a stopped stream, what changed in it, and seeding a new stream with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.joins import compare_outputs

#: the column in which the state reader gives each kind of variable whole
KINDS = {"value": "value", "list": "list_value", "map": "map_value"}


def read_state(
    spark: SparkSession, checkpoint: str, variable: str | None = None, operator: int = 0
) -> DataFrame:
    """Keyed state as a table: one row per key (per entry for lists and maps)."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def state_load(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """Keys per state partition, to see whether some hold far more than others."""
    state = read_state(spark, checkpoint, variable, operator)
    return state.groupBy("partition_id").agg(F.count(F.lit(1)).alias("n"))


def totals_before(history: DataFrame, keys: Sequence[str], amount: str, seq: str, until: int) -> DataFrame:
    """Totals of the rows up to a position, to seed a stream that goes on after it."""
    return history.where(F.col(seq) <= until).groupBy(*keys).agg(F.sum(amount).alias("total"))


def carried(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str],
    variables: Mapping[str, str],
    operator: int = 0,
    batch: int | None = None,
) -> DataFrame:
    """A row per key with the named variables of a state (kind: value, list or map), at a batch or at the end.

    A value of one field is that field, one of several a struct; a list of rows of one field is an array of it, in
    its order; a map's keys and values likewise. What a key does not have is null. This is the shape in which
    operators take `initial`; rename or add columns for a state with other fields.
    """
    found = []
    for name, kind in variables.items():
        reader = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name)
        reader = reader.option("flattenCollectionTypes", False)
        if batch is not None:
            reader = reader.option("batchId", batch)
        table = reader.load(checkpoint)
        value = _unwrapped(F.col(KINDS[kind]), table.schema[KINDS[kind]].dataType, kind)
        found.append(table.select(*[F.col(f"key.{k}").alias(k) for k in keys], value.alias(name)))
    # a key is once in each; null keys are keys like others
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    return every.groupBy(*keys).agg(*[F.first(name, ignorenulls=True).alias(name) for name in variables])


def _unwrapped(column, kind, shape: str):
    def only(struct, c):
        return c[struct.fieldNames()[0]] if len(struct.fields) == 1 else c

    if shape == "value":
        return only(kind, column)
    if shape == "list":
        return F.transform(column, lambda x: only(kind.elementType, x))
    keys = F.transform(F.map_keys(column), lambda x: only(kind.keyType, x))
    return F.map_from_arrays(keys, F.transform(F.map_values(column), lambda x: only(kind.valueType, x)))


def state_changes(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], variable: str, before: int, after: int, operator: int = 0
) -> DataFrame:
    """What changed in a value between the ends of two batches: keys, op (+I, +U, -D), old and new value.

    Both snapshots are read and joined by key, so only batches that the state store still keeps can be asked for.
    """
    old, new = (
        carried(spark, checkpoint, keys, {variable: "value"}, operator, batch) for batch in (before, after)
    )
    compared = compare_outputs(old, new, keys, [variable]).where(F.col("difference") != "same")
    op = F.when(F.col("difference") == "only_new", "+I").when(F.col("difference") == "only_old", "-D").otherwise("+U")
    return compared.select(
        *keys, op.alias("op"), F.col(f"old_{variable}").alias("old"), F.col(f"new_{variable}").alias("new")
    )
