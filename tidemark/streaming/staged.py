"""A two-phase sink: tasks stage their files, the commit of a batch makes them visible at once.

Tasks write Parquet files under ``_staged`` with names of their own and report them. The commit
writes one manifest for the batch, which lists the files; moving it to its place is the single
step that makes them visible. A batch that is repeated after a crash finds its manifest and
throws its new files away, so every batch appears once. Readers take the files of the
manifests; what was staged and never committed is seen by nobody.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

FORMAT = "tidemark_staged"
#: bytes of a row group
GROUP = 32 << 20


def _store(path: str):
    """The file system of a path in a folder that driver and executors share, and the path in it."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)
    return system, inside.rstrip("/")


def read_placed(path: str) -> str | None:
    """A small file's text, if it is there."""
    from pyarrow import fs

    system, inside = _store(path)
    if system.get_file_info(inside).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(inside) as known:
        return known.read().decode()


def place_once(path: str, text: str) -> None:
    """A small file that appears whole, in one step; one that is there stays."""
    if read_placed(path) is not None:
        return
    system, inside = _store(path)
    folder = inside.rsplit("/", 1)[0]
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(text.encode())
    system.move(hidden, inside)


@dataclass
class Staged(WriterCommitMessage):
    files: list[str]


class StagedWriter(DataSourceStreamArrowWriter):
    """`path`: the table's folder; `query`: a name for the stream, as batches are told apart by it and their number."""

    def __init__(self, path: str, query: str):
        self.path, self.query = path, query

    def manifest(self, batch: int) -> str:
        return f"_committed/{self.query}-{batch:010d}.json"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """In a task: one file, or none without rows."""
        import pyarrow.parquet as pq

        system, root = _store(self.path)
        name, writer = f"_staged/{uuid.uuid4().hex}.parquet", None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(f"{root}/_staged", recursive=True)
                writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch, row_group_size=max(1, batch.num_rows * GROUP // max(GROUP, batch.nbytes)))
        if writer is None:
            return Staged([])
        writer.close()
        return Staged([name])

    def _drop(self, messages) -> None:
        from pyarrow import fs

        system, root = _store(self.path)
        for message in messages:
            for name in message.files if message else []:
                if system.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
                    system.delete_file(f"{root}/{name}")

    def commit(self, messages, batchId: int) -> None:
        """In the driver: may be called again for a batch, with the same messages or those of a repeated run."""
        place = f"{self.path.rstrip('/')}/{self.manifest(batchId)}"
        files = sorted(name for message in messages if message for name in message.files)
        known = read_placed(place)
        if known is not None:
            seen = set(json.loads(known)["files"])
            self._drop([Staged([name for name in files if name not in seen])])
            return
        place_once(place, json.dumps({"files": files}))

    def abort(self, messages, batchId: int) -> None:
        """What the tasks of a failed batch had staged goes; None stands for tasks that did not report."""
        self._drop(messages)


class StagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> StagedWriter:
        return StagedWriter(self.options["path"], self.options.get("query", "stream"))


def staged_files(stream: DataFrame, path: str, checkpoint: str, query: str = "stream") -> DataStreamWriter:
    """Each row exactly once in the table at `path`, with a replayable input and this checkpoint."""
    stream.sparkSession.dataSource.register(StagedSource)
    return (
        stream.writeStream.outputMode("append")
        .format(FORMAT)
        .option("path", path)
        .option("query", query)
        .option("checkpointLocation", checkpoint)
    )


def committed_files(path: str) -> list[str]:
    """The visible files, in order of their batches."""
    from pyarrow import fs

    system, root = _store(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/_committed", allow_not_found=True))
    files = []
    for info in sorted(found, key=lambda i: i.path):
        if not info.base_name.startswith("."):
            with system.open_input_stream(info.path) as manifest:
                files += json.loads(manifest.read())["files"]
    return [f"{path.rstrip('/')}/{name}" for name in files]


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    files = committed_files(path)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)
