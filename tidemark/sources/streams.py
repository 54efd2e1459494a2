"""Streaming inputs: files, message topics and a replayable numbered source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.sources.tables import with_zone


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they appear in a folder, oldest first; times become UTC instants."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_zone(reader.parquet(folder))


def table_input(spark: SparkSession, folder: str, schema: T.StructType, bounded: bool) -> DataFrame:
    """The same files as a bounded table or as a stream, for operators that take either."""
    if bounded:
        return with_zone(spark.read.schema(schema).parquet(folder))
    return file_stream(spark, folder, schema)


def with_file_time(df: DataFrame, name: str = "event_time") -> DataFrame:
    """Event time from the metadata of the source: when the row's file was written."""
    return df.select("*", F.col("_metadata.file_modification_time").alias(name))


STARTS = {"earliest": "earliest", "latest": "latest", "group-offsets": "earliest"}  # fixed values


def topic_options(servers: str, topic: str, group: str, start: str = "group-offsets") -> dict[str, str]:
    """Options for Spark's kafka source.

    Spark keeps the consumed offsets in the query's checkpoint, so a start "at
    the group's offsets" means: from the checkpoint, at first from the earliest.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": STARTS[start],
    }


def topic_stream(spark: SparkSession, options: Mapping[str, str], avro_schema: str) -> DataFrame:
    """Avro records of a topic with the record time as `event_time`, 5 s watermark.

    Needs Spark's kafka and avro packages on the class path. Registry-framed
    records carry five bytes before the Avro body.
    """
    from pyspark.sql.avro.functions import from_avro

    raw = spark.readStream.format("kafka").options(**options).load()
    return decode_topic(raw, lambda body: from_avro(body, avro_schema))


def decode_topic(raw: DataFrame, decode) -> DataFrame:
    """Records of a topic table (value, timestamp) as columns plus `event_time`.

    A record that does not begin with the frame's zero byte is an error.
    """
    framed = F.expr("substring(value, 1, 1) = X'00' AND octet_length(value) >= 5")
    refused = F.raise_error(F.lit("not a registry-framed record")).cast("binary")
    body = F.when(F.col("value").isNull() | framed, F.expr("substring(value, 6)")).otherwise(refused)
    rows = raw.select(decode(body).alias("_r"), F.col("timestamp").alias("event_time"))
    return rows.select("_r.*", "event_time").withWatermark("event_time", "5 seconds")


class _Count(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__(start)
        self.start, self.end = start, end


def _ranges(start: int, end: int, size: int) -> list[_Count]:
    return [_Count(i, min(end, i + size)) for i in range(start, end, size)]


class NumberedReader(DataSourceReader):
    def __init__(self, n: int, per_task: int):
        self.n, self.per_task = n, per_task

    def partitions(self):
        return _ranges(0, self.n, self.per_task)

    def read(self, partition):
        return ((i,) for i in range(partition.start, partition.end))


class NumberedStreamReader(DataSourceStreamReader):
    """The cursor is the stream offset: a restart goes on from the checkpoint.

    Tasks make the numbers; the driver only hands out ranges.
    """

    def __init__(self, n: int, per_task: int):
        self.n, self.per_task = n, per_task

    def initialOffset(self):
        return {"c": 0}

    def latestOffset(self):
        return {"c": self.n}

    def partitions(self, start, end):
        return _ranges(start["c"], end["c"], self.per_task)

    def read(self, partition):
        return ((i,) for i in range(partition.start, partition.end))

    def commit(self, end):
        pass


class NumberedSource(DataSource):
    """`format("numbered")` with options n and perTask: the numbers 0..n-1."""

    @classmethod
    def name(cls):
        return "numbered"

    def schema(self):
        return "value bigint"

    def _size(self):
        return int(self.options["n"]), int(self.options.get("perTask", 1_000_000))

    def reader(self, schema):
        return NumberedReader(*self._size())

    def streamReader(self, schema):
        return NumberedStreamReader(*self._size())


def register_numbered(spark: SparkSession) -> None:
    spark.dataSource.register(NumberedSource)
