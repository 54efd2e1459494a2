"""Where streams end: files, keyed tables, databases, consoles."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.changelog import running_total
from tidemark.operators.joins import compare_outputs, lookup_dimension
from tidemark.operators.ranking import latest_per_key, top_spenders
from tidemark.streaming.staged import place_once, read_placed


def print_rows(stream: DataFrame, label: str, mode: str = "append") -> DataStreamWriter:
    labelled = stream.select(F.lit(label).alias("label"), "*")
    return labelled.writeStream.outputMode(mode).format("console").option("truncate", False)


def discard(df: DataFrame):
    """Run everything and keep nothing."""
    if df.isStreaming:
        return df.writeStream.format("noop")
    return df.write.format("noop").mode("overwrite").save()


def csv_files(stream: DataFrame, path: str, checkpoint: str, rows_per_file: int = 5) -> DataStreamWriter:
    """CSV files that become visible once their micro-batch is committed: each row exactly once."""
    return (
        stream.writeStream.format("csv")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
    )


def batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: one folder per batch id; a repeated batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def routed_folders(path: str, route: str = "route") -> Callable[[DataFrame, int], None]:
    """For foreachBatch: all routes in one pass, a folder per batch and route."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(route).parquet(f"{path}/batch_id={batch_id}")

    return write


class KeyedTable:
    """A table with one row per key, kept as files: a base and the changes after it.

    Every batch adds only its own changes, under its batch id, so a repeated
    batch replaces itself. Readers take the last change per key, combined before
    the shuffle. `compact` folds changes into a new base, which the sink does after
    every `fold_after` batches, so readers never open more than that many. Nothing is
    kept in the driver: the folders tell which base and which changes count.
    """

    def __init__(self, path: str, keys: Sequence[str], fold_after: int = 50):
        self.path, self.keys, self.fold_after = path.rstrip("/"), list(keys), fold_after

    def _versions(self, spark: SparkSession, kind: str) -> list[int]:
        """Finished folders of a kind, told by their success file."""
        jvm = spark.sparkContext._jvm
        finished = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/v=*/_SUCCESS")
        fs = finished.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(finished)
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in found or [])

    def write(self, batch: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Add a batch. `order` picks the last row where a key comes twice."""
        values = [c for c in batch.columns if c not in self.keys]
        rows = latest_per_key(batch, self.keys, list(order), values) if order else batch
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/v={batch_id}")

    def writer(self, order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            self.write(batch, batch_id, order)
            self.fold(batch.sparkSession)

        return write

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The current rows, or those before a batch."""
        bases, changes = self._versions(spark, "base"), self._versions(spark, "changes")
        if before is not None:
            bases, changes = [v for v in bases if v < before], [v for v in changes if v < before]
        base = bases[-1] if bases else None
        paths = [f"{self.path}/changes/v={v}" for v in changes if base is None or v > base]
        if base is not None:
            paths.insert(0, f"{self.path}/base/v={base}")
        if not paths:
            raise FileNotFoundError(f"no rows yet in {self.path}")
        version = F.regexp_extract(F.col("_metadata.file_path"), "/v=([0-9]+)/", 1).cast("long")
        rows = spark.read.parquet(*paths).withColumn("_version", version)
        if len(paths) == 1:
            return rows.drop("_version")
        values = [c for c in rows.columns if c not in [*self.keys, "_version"]]
        # a base is never newer than the changes that count
        return latest_per_key(rows, self.keys, ["_version"], values)

    def fold(self, spark: SparkSession) -> None:
        """Compact once enough batches lie on the last base; a batch that is repeated after that is in it already."""
        base = max(self._versions(spark, "base"), default=-1)
        if sum(v > base for v in self._versions(spark, "changes")) >= self.fold_after:
            self.compact(spark)

    def compact(self, spark: SparkSession) -> None:
        changes = self._versions(spark, "changes")
        if changes:
            self.read(spark).write.mode("overwrite").parquet(f"{self.path}/base/v={changes[-1]}")


def upsert(stream: DataFrame, table: KeyedTable, checkpoint: str, order: Sequence[str] = ()) -> DataStreamWriter:
    """Updating results into a keyed table; last value per key wins."""
    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(table.writer(order))
    )


def append_only(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Refuses results that change rows already given out: append mode checks that at start."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def streaming_top(
    totals: DataFrame, table: KeyedTable, n: int, checkpoint: str, publish: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """Top n per category of an updating (category, userId, total) stream.

    Each batch goes into the totals table, then the ranking of the whole table
    is published. The ranking is a batch query, so no task holds a category.
    """

    def rank(batch: DataFrame, batch_id: int) -> None:
        table.write(batch, batch_id)
        current = table.read(batch.sparkSession).withColumnRenamed("total", "amount")
        publish(top_spenders(current, n), batch_id)

    return totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(rank)


def publish_places(places: DataFrame, table: KeyedTable, checkpoint: str) -> DataStreamWriter:
    """Changed places of a ranking into a table by group and place: a batch writes no more than what changed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(batch.drop("op"), batch_id)

    return places.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def running_totals_by_batch(
    stream: DataFrame,
    keys: Sequence[str],
    seq: str,
    amount: str,
    table: KeyedTable,
    checkpoint: str,
    publish: Callable[[DataFrame, int], None],
) -> DataStreamWriter:
    """A running total per row for streams with hot keys.

    A stateful processor works through a key in one task. Here every micro-batch
    goes through the batch operator, which splits hot keys, and adds the totals
    of the earlier batches from a keyed table. `keys` must not be null. A
    repeated batch starts from the same totals, so it publishes the same rows.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # it is profiled, summed and given out
        try:
            totals(batch, batch_id)
        finally:
            batch.unpersist()

    def totals(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = running_total(batch, keys, seq, amount, "_own")
        try:
            old = table.read(spark, before=batch_id).withColumnRenamed("total", "_old")
        except FileNotFoundError:
            old = batch.limit(0).select(*keys, F.lit(None).cast("decimal(38,2)").alias("_old"))
        joined = rows.join(old, list(keys), "left")
        total = F.coalesce(F.col("_old"), F.lit(0)) + F.coalesce(F.col("_own"), F.lit(0))
        publish(joined.withColumn("total", total).drop("_own", "_old"), batch_id)
        added = batch.groupBy(*keys).agg(F.sum(amount).alias("_own")).join(old, list(keys), "left")
        table.write(added.select(*keys, total.alias("total")), batch_id)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)


def enrich_each_batch(
    stream: DataFrame,
    read_dimension: Callable[[SparkSession], DataFrame],
    keys: Sequence[str],
    checkpoint: str,
    publish: Callable[[DataFrame, int], None],
) -> DataStreamWriter:
    """Left join with a dimension that is read anew for every micro-batch."""

    def enrich(batch: DataFrame, batch_id: int) -> None:
        publish(lookup_dimension(batch, read_dimension(batch.sparkSession), keys), batch_id)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(enrich)


def dual_run(
    old: DataFrame, new: DataFrame, folder: str, keys: Sequence[str], new_keys: Sequence[str] | None = None
) -> tuple[tuple[DataStreamWriter, KeyedTable], tuple[DataStreamWriter, KeyedTable]]:
    """The old and the new version of a query side by side, each with its own checkpoint and table.

    Compare the tables with `compare_outputs` and switch the readers when they agree.
    """
    sides = []
    for name, stream, side_keys in (("old", old, keys), ("new", new, new_keys or keys)):
        table = KeyedTable(f"{folder}/{name}/table", side_keys)
        sides.append((upsert(stream, table, f"{folder}/{name}/checkpoint"), table))
    return sides[0], sides[1]


class CutOver:
    """Readers follow a pointer that moves from the old table to the new one when both have agreed for some batches.

    `check` compares the two tables as they stood after a batch and notes the verdict; once the last `needed` batches
    in a row agree, the pointer is placed, in one step and for good. A reader asks for the pointer once, so all its
    rows are from one table. Verdicts and pointer are small files beside the tables: both survive a restart, and a
    batch that is checked again keeps its first verdict. Batches are compared by number, so both streams must cut
    their input alike.
    """

    def __init__(self, folder: str, old: KeyedTable, new: KeyedTable, values: Sequence[str], needed: int = 3):
        self.folder, self.old, self.new = folder.rstrip("/"), old, new
        self.values, self.needed = list(values), needed

    def _verdict(self, batch: int) -> bool | None:
        found = read_placed(f"{self.folder}/check-{batch:010d}.json")
        return None if found is None else json.loads(found)["same"]

    def check(self, spark: SparkSession, batch: int) -> bool:
        """Whether the tables agree after this batch."""
        same = self._verdict(batch)
        if same is None:
            old, new = self.old.read(spark, before=batch + 1), self.new.read(spark, before=batch + 1)
            same = compare_outputs(old, new, self.old.keys, self.values).where("difference <> 'same'").isEmpty()
            place_once(f"{self.folder}/check-{batch:010d}.json", json.dumps({"same": same}))
        first = batch - self.needed + 1
        if first >= 0 and all(self._verdict(b) for b in range(first, batch + 1)):
            place_once(f"{self.folder}/pointer.json", json.dumps({"after": batch}))
        return same

    def moved(self) -> bool:
        return read_placed(f"{self.folder}/pointer.json") is not None

    def read(self, spark: SparkSession) -> DataFrame:
        return (self.new if self.moved() else self.old).read(spark)


def merge_statement(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Standard SQL MERGE from a staging table, by key."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{c} = s.{c}" for c in columns if c not in keys)
    update = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def database_upsert(
    url: str, table: str, keys: Sequence[str], properties: dict[str, str]
) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: executors fill a staging table, then one MERGE moves it over.

    The batch must hold each key once, as update mode delivers it. Repeating a
    batch refills the staging table and merges the same rows again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        staging = f"{table}_staging"
        batch.write.jdbc(url, staging, mode="overwrite", properties=properties)
        jvm = batch.sparkSession.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for name, value in properties.items():
            settings.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            connection.createStatement().execute(merge_statement(table, staging, keys, batch.columns))
        finally:
            connection.close()

    return write


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_on_clock(writer: DataStreamWriter, done: Callable[[], bool], every: str = "1 second", limit: float = 600) -> None:
    """Run with a trigger on the clock until `done()`, then stop; windows on the clock have no end of their own."""
    query = writer.trigger(processingTime=every).start()
    try:
        until = time.monotonic() + limit
        while not done():
            if time.monotonic() > until:
                raise TimeoutError(f"not done after {limit} seconds")
            if query.awaitTermination(1):
                raise RuntimeError("the stream ended by itself")
    finally:
        query.stop()
