"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app_name: str = "tidemark", cores: int | None = None, **extra: str) -> SparkSession.Builder:
    """A session builder with the settings the operators are written for.

    With the cluster's `cores`, shuffles start with eight partitions per core and
    adaptive execution merges the small ones.
    """
    settings = dict(DEFAULTS)
    if cores:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(8 * cores)
        settings["spark.sql.shuffle.partitions"] = str(8 * cores)
    result = SparkSession.builder.appName(app_name)
    for name, value in {**settings, **extra}.items():
        result = result.config(name, value)
    return result


def prepare_streaming(spark: SparkSession) -> None:
    """Stateful processors keep their state in the RocksDB provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def prepare_packed(spark: SparkSession) -> None:
    """State in large values: less of it waits in an executor's memory to be written, unless the session says how much."""
    prepare_streaming(spark)
    buffer = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB"
    if spark.conf.get(buffer, "-1") == "-1":
        spark.conf.set(buffer, "16")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a folder of one machine would not be seen by the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


#: while a step is written: its shuffle files go once it is there, Python gets its rows in small batches, unions
#: are not taken for partitioned (Spark 4.1 then zips them with joins of fewer partitions, and fails), and tables
#: dealt by a key are read as they were dealt (else a broadcast next to them makes many files of each key's share)
WRITING = {
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the actions inside, put back after them."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: lists of the written tables' paths, the innermost scope last
_SCOPES: list[list[str]] = []


@contextmanager
def written_tables() -> Iterator[list[str]]:
    """The paths of the tables that `write_and_read` writes inside."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.remove(paths)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Empty written tables that nothing reads any more: their files go, by Spark's own overwrite."""
    for path in paths:
        spark.createDataFrame([], "gone int").coalesce(1).write.mode("overwrite").parquet(path)


def settled(build: Callable[[], DataFrame | None], label: str = "step") -> DataFrame | None:
    """The written rows of `build()`; the tables that it wrote on its way are emptied once they are there."""
    with written_tables() as paths:
        df = build()
    out = None if df is None else write_and_read(df, label)
    if paths:
        discard(SparkSession.active(), paths)
    return out


def write_and_read(df: DataFrame, label: str = "step", small: bool = False) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    The written files outlive lost executors and keep column pruning for the
    readers. Whoever owns the shared folder clears it after the job. `small`
    tables are not worth emptying before that.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _SCOPES and not small:
        _SCOPES[-1].append(path)
    with settings(spark, WRITING):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_by_key(df: DataFrame, key: str, label: str = "step", dealt: bool = False) -> DataFrame:
    """As `write_and_read`, with the rows dealt by `key`: joins by it then move their other side only.

    `dealt`: the rows come from a join by the key with such a table, and stay where they are.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tidemark_{uuid.uuid4().hex}"
    with settings(spark, WRITING):
        rows = df if dealt else df.repartition(parts, key)
        rows.write.bucketBy(parts, key).option("path", path).saveAsTable(name, format="parquet")
    out = spark.read.table(name)
    # the name goes, the files stay
    spark.sql(f"DROP TABLE {name}")
    return out
