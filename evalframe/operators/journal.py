"""A journal of paid results: what a task got from the caller's function is written before the task goes on, and found again by
whoever runs the same work next, be it the retried task, the query run twice or a restarted driver.

A journal is a folder on storage that driver and executors share, with a Parquet file for each call under ``part=<task>``: the keys and the result. Files appear
whole (written under a hidden name, then moved). A task reads its own part when it starts; what other parts hold (a run with
another number of tasks) is joined by the query. A call whose executor is lost before its file is moved is made again: at most
``rows`` rows for each task that runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Rows of one call, and so of one journal file.
DEFAULT_ROWS = 256


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


class Part:
    """The journal of one task."""

    def __init__(self, path: str, part: int, keys: Sequence[str], result: str):
        self.fs, root = _place(path)
        self.folder, self.keys, self.result = f"{root}/part={part}", list(keys), result
        self.fs.create_dir(self.folder, recursive=True)
        self.known: dict[tuple, str | None] = {}
        for f in self.fs.get_file_info(pafs.FileSelector(self.folder)):
            if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._":
                with self.fs.open_input_file(f.path) as stream:
                    table = pq.ParquetFile(stream).read([*self.keys, result])
                self._learn(table)

    def _learn(self, table: pa.Table | pa.RecordBatch) -> None:
        columns = [table.column(c).to_pylist() for c in self.keys]
        self.known.update(zip(zip(*columns), table.column(self.result).to_pylist()))

    def write(self, rows: pa.RecordBatch) -> None:
        """Keep the results of one call."""
        name = f"{uuid.uuid4().hex}.parquet"
        with self.fs.open_output_stream(f"{self.folder}/.{name}") as out:
            pq.write_table(pa.Table.from_batches([rows]), out)
        self.fs.move(f"{self.folder}/.{name}", f"{self.folder}/{name}")
        self._learn(rows)


def journaled(path: str, call, keys: Sequence[str], result: str, rows: int = DEFAULT_ROWS):
    """A ``mapInArrow`` function: ``call(batch) -> results`` for the rows whose keys the task's journal doesn't hold, ``rows`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = Part(path, TaskContext.get().partitionId(), keys, result)
        for b in batches:
            if not b.num_rows:
                continue
            own = list(zip(*[b.column(c).to_pylist() for c in keys]))
            todo = [i for i, k in enumerate(own) if k not in part.known]
            for at in range(0, len(todo), rows):
                some = b.take(pa.array(todo[at:at + rows]))
                got = pa.array(call(some), pa.string())
                part.write(pa.RecordBatch.from_arrays([*(some.column(c) for c in keys), got], names=[*keys, result]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), pa.array([part.known[k] for k in own], pa.string())], names=[*keys, result])
    return run


def read_journal(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """All results kept so far, one row a key; None without a journal."""
    fs, root = _place(path)
    found = [f for f in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] != "."]
    if not found:
        return None
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).dropDuplicates(schema.names[:-1])
