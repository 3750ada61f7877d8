"""Plain text job logs, read as they grow: the ``joblog`` data source.

A job appends lines to a text file of its own. The source reads such files as a table or as a stream of

    job_id string, seq bigint, ts timestamp_ntz, line string

``seq`` is the byte at which the line begins, so it orders a job's lines, never changes, and needs no counter. ``job_id`` is the value of a
``job_id=`` folder in the file's path, else the file's name without its last suffix. ``ts`` is the file's modification time (UTC) when its
range was planned: a plain log says no more about when a line came.

A task reads a range of bytes of one file: the lines that begin in it, however far the last of them reaches. A large log
is therefore many tasks, short logs share one (and so do ranges, where there are very many), and a task holds one block of bytes and the line it is in. A stream's offset is the byte behind the last complete line of every file; what a job
has written of its next line is left for the batch that sees its end. A file that has become shorter than the offset fails the stream.
The table reads a last line without an end as well.

A stream's planner lists the folder once a batch and looks at the end of the files that have changed, no further back than their last line end; the tasks read the rest.

Files are reached by ``pyarrow.fs``: plain paths, ``file:``, ``hdfs:``, ``s3:`` and ``gs:`` addresses.
"""

from __future__ import annotations

import base64
import datetime as dt
import fnmatch
import json
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "job_id string, seq bigint, ts timestamp_ntz, line string"
DEFAULT_RANGE = 64 << 20
BLOCK = 1 << 20
ROWS = 8192

_ESCAPED = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\{[]^\x7f"}
_ARROW = pa.schema([("job_id", pa.string()), ("seq", pa.int64()), ("ts", pa.timestamp("us")), ("line", pa.string())])


#: Tasks of a read, as long as none reads more than DEFAULT_RANGE.
MOST_TASKS = 1024

#: What the planner reads of a log's end at first; it goes on in larger steps, up to BLOCK.
TAIL = 1 << 10

#: Logs that the planner looks into at a time where each look waits for a store (on local disks threads would only wait for each other),
#: and how many a thread takes in turn.
LOOKS, IN_TURN = 16, 256

#: Logs in an offset that stays plain. Spark keeps the offsets of its last 100 batches as text on the driver, and writes one a batch.
PLAIN_LOGS = 10_000


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


def folder_name(value: str | None) -> str:
    """A value in the name of a ``key=value`` folder, spelled as Spark's table writers do."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value) if value else "__HIVE_DEFAULT_PARTITION__"


def packed(ends: dict[str, int]) -> dict:
    """``{path: byte}`` as an offset: as it is or, of many logs, packed into one text."""
    if len(ends) <= PLAIN_LOGS:
        return ends
    return {"packed": base64.b64encode(zlib.compress(json.dumps(ends).encode())).decode()}


def unpacked(offset: dict) -> dict[str, int]:
    text = offset.get("packed")
    return json.loads(zlib.decompress(base64.b64decode(text))) if isinstance(text, str) else offset


class LogRange(NamedTuple):
    """Lines that begin in bytes ``[start, end)`` of a file; nothing behind ``limit`` is read."""

    path: str
    job: str
    start: int
    end: int
    limit: int
    modified: int


class LogTask(InputPartition):
    """What one task reads: a range, or the ranges of several short files."""

    def __init__(self, ranges: list[LogRange]):
        self.ranges = ranges


class LogFiles:
    """The log files under a folder (or one file)."""

    def __init__(self, options):
        self.named = re.compile(fnmatch.translate(options.get("glob", "*"))).match
        self.range_bytes = int(options.get("rangebytes", DEFAULT_RANGE))
        path = options.get("path")
        if not path:
            raise ValueError("joblog needs a path")
        self.fs, self.root = file_system(path)

    def listed(self) -> list[tuple[str, int, int]]:
        """(path, size, modification time in microseconds) by path. Hidden files, and files in hidden folders, are none of a job's."""
        info = self.fs.get_file_info(self.root)
        if info.type == pafs.FileType.Directory:
            infos = self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True))
        else:
            infos = [info] if info.type == pafs.FileType.File else []
        out = []
        for i in infos:
            if i.type == pafs.FileType.File:
                inner = "/" + i.path[len(self.root):]
                if "/." not in inner and "/_" not in inner and self.named(i.base_name):
                    out.append((i.path, i.size, (i.mtime_ns or 0) // 1000))
        return sorted(out)

    @staticmethod
    def job_of(path: str) -> str:
        parts = path.split("/")
        named = [p[7:] for p in parts[:-1] if p.startswith("job_id=")]
        return named[-1] if named else parts[-1].rpartition(".")[0] or parts[-1]

    def ranges(self, path: str, start: int, end: int, limit: int, modified: int) -> list[LogRange]:
        job, step = self.job_of(path), self.range_bytes
        return [LogRange(path, job, at, min(at + step, end), limit, modified) for at in range(start, end, step)]

    def tasks(self, ranges: list[LogRange]) -> list[LogTask]:
        """Ranges dealt to tasks, in order, ``range_bytes`` a task at most; more where that would make over MOST_TASKS of them, up to DEFAULT_RANGE."""
        out, room = [], 0
        most = max(self.range_bytes, min(DEFAULT_RANGE, -(-sum(r.end - r.start for r in ranges) // MOST_TASKS)))
        for r in ranges:
            if not out or r.end - r.start > room:
                out.append(LogTask([]))
                room = most
            out[-1].ranges.append(r)
            room -= r.end - r.start
        return out

    def whole_lines(self, path: str, size: int, least: int) -> int:
        """The byte behind the last line end before ``size``; ``least`` is known to be one (or 0)."""
        with self.fs.open_input_file(path) as f:
            to, step = size, min(TAIL, BLOCK)
            while to > least:
                at = max(least, to - step)
                f.seek(at)
                found = f.read(to - at).rfind(b"\n")
                if found >= 0:
                    return at + found + 1
                to, step = at, min(4 * step, BLOCK)
        return least

    def read_all(self, ranges: Iterable[LogRange]) -> Iterator[pa.RecordBatch]:
        """The lines of ranges; those of short logs share batches."""
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for r in ranges:
            for b in self.read(r):
                if held and (rows + b.num_rows > ROWS or size + b.nbytes > 4 * BLOCK):
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, rows, size = [], 0, 0
                held.append(b)
                rows, size = rows + b.num_rows, size + b.nbytes
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def read(self, r: LogRange) -> Iterator[pa.RecordBatch]:
        """The lines of a range as Arrow batches."""
        job, ts = r.job, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=r.modified)
        seqs: list[int] = []
        lines: list[str] = []

        def batch():
            n = len(seqs)
            out = pa.RecordBatch.from_arrays([pa.array([job] * n, pa.string()), pa.array(seqs, pa.int64()), pa.array([ts] * n, pa.timestamp("us")),
                                              pa.array(lines, pa.string())], schema=_ARROW)
            seqs.clear()
            lines.clear()
            return out

        with self.fs.open_input_file(r.path) as f:
            at = max(r.start - 1, 0)        # the byte before tells whether a line begins at the start
            f.seek(at)
            skip, head, begin, size = r.start > 0, [], at, 0
            while True:
                block = f.read(min(BLOCK, r.limit - at)) if at < r.limit else b""
                at += len(block)
                parts = block.split(b"\n")
                for i, part in enumerate(parts):
                    head.append(part)
                    if i == len(parts) - 1 and block:
                        break                # the line goes on in the next block
                    raw = b"".join(head)
                    head = []
                    if not block and not raw:
                        break                # the file's end, right behind a line end
                    if not skip:
                        if begin >= r.end:
                            break
                        seqs.append(begin)
                        lines.append((raw[:-1] if raw.endswith(b"\r") else raw).decode("utf-8", "replace"))
                        size += len(raw)
                    begin, skip = begin + len(raw) + 1, False
                    if len(seqs) >= ROWS or size >= 4 * BLOCK:
                        yield batch()
                        size = 0
                if not block or (begin >= r.end and not skip):
                    break
        if seqs:
            yield batch()


class LogTableReader(DataSourceReader):
    def __init__(self, options):
        self.files = LogFiles(options)

    def partitions(self) -> Sequence[LogTask]:
        return self.files.tasks([r for path, size, modified in self.files.listed() for r in self.files.ranges(path, 0, size, size, modified)]) or [LogTask([])]

    def read(self, partition: LogTask) -> Iterator[pa.RecordBatch]:
        return self.files.read_all(partition.ranges)


class LogStreamReader(DataSourceStreamReader):
    """Offsets are ``{path: byte}``, ``packed`` where there are many. The reader remembers what it has seen of each file, so that only files that have changed are looked into."""

    def __init__(self, options):
        self.files = LogFiles(options)
        self.seen: dict[str, tuple[int, int, int]] = {}   # path -> (size, modification time, end of whole lines)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        changed = []
        for path, size, modified in self.files.listed():
            was = self.seen.get(path)
            if was is None or was[:2] != (size, modified):
                changed.append((path, size, modified, was[2] if was and was[2] <= size else 0))

        def look(some):
            return [(path, (size, modified, self.files.whole_lines(path, size, least))) for path, size, modified, least in some]

        with ThreadPoolExecutor(1 if isinstance(self.files.fs, pafs.LocalFileSystem) else LOOKS) as pool:
            for found in pool.map(look, [changed[i:i + IN_TURN] for i in range(0, len(changed), IN_TURN)]):
                self.seen.update(found)
        return packed({path: end for path, (_, _, end) in sorted(self.seen.items()) if end})

    def partitions(self, start: dict, end: dict) -> Sequence[LogTask]:
        start, end = unpacked(start), unpacked(end)
        now, out = self.seen, []
        if any(path not in now for path in end):      # a batch planned by an earlier run of the stream
            now = {path: (size, modified) for path, size, modified in self.files.listed()}
        for path, to in sorted(end.items()):
            at = start.get(path, 0)
            if to < at or to > at and now.get(path, (0, 0))[0] < to:
                raise ValueError(f"{path} is shorter than what was read of it")
            out += self.files.ranges(path, at, to, to, now[path][1]) if to > at else []
        return self.files.tasks(out)

    def read(self, partition: LogTask) -> Iterator[pa.RecordBatch]:
        return self.files.read_all(map(self._whole, partition.ranges))

    def _whole(self, r: LogRange) -> LogRange:
        """The range, of a file that still reaches to its offset."""
        if (self.files.fs.get_file_info(r.path).size or 0) < r.limit:
            raise ValueError(f"{r.path} is shorter than its offset")
        return r


class JobLogSource(DataSource):
    """Options: ``path``, ``glob`` (file names, default all), ``rangeBytes`` (bytes a task reads, default 64 MB)."""

    @classmethod
    def name(cls) -> str:
        return "joblog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogTableReader:
        return LogTableReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)


def scan_raw_lines(spark: SparkSession, path: str, glob: str = "*", stream: bool = False, range_bytes: int = DEFAULT_RANGE) -> DataFrame:
    """The lines of the text logs under ``path`` as a table or, with ``stream``, as a stream that follows them."""
    spark.dataSource.register(JobLogSource)
    r = (spark.readStream if stream else spark.read).format("joblog")
    return r.option("path", path).option("glob", glob).option("rangeBytes", str(range_bytes)).load()


def write_raw_logs(lines: DataFrame, path: str, job_col: str = "job_id", order_col: str = "seq", line_col: str = "line") -> str:
    """A text log for each job (``job_id=<job>/part-*``), its lines in order. (A log is one file, so a job's lines meet in one task.)

    The tasks write the logs themselves: a table writer's steps for each folder, and its commit that moves every file from the driver, take longer than
    the lines of a short log. A log appears under its name when it is whole, and a task that runs again writes the same names."""
    fs, root = file_system(path)
    if fs.get_file_info(root).type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    fs.create_dir(root)
    rows = lines.select(job_col, order_col, line_col).repartition(job_col).sortWithinPartitions(job_col, order_col)
    rows.select(rows[job_col].cast("string").alias("job_id"), rows[line_col].cast("string").alias("line")).mapInArrow(_log_writer(path), "logs bigint").agg(F.sum("logs")).collect()
    return path


def _log_writer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        (fs, root), name, logs = file_system(path), f"part-{task.partitionId():05d}", 0
        held, out = None, None          # the folder being written and its open log

        def close():
            if out is not None:
                out.close()
                whole = f"{root}/{held}/{name}.txt"
                if fs.get_file_info(whole).type == pafs.FileType.File:      # by an earlier run of this task
                    fs.delete_file(whole)
                fs.move(f"{root}/{held}/.{name}-{task.taskAttemptId()}", whole)

        for b in batches:
            jobs, at = b.column(0), 0
            runs = pc.run_end_encode(jobs)
            for job, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if (folder := f"job_id={folder_name(job)}") != held:
                    close()
                    held, logs = folder, logs + 1
                    fs.create_dir(f"{root}/{folder}")
                    out = fs.open_output_stream(f"{root}/{folder}/.{name}-{task.taskAttemptId()}")
                out.write("".join([f"{line or ''}\n" for line in b.column(1).slice(at, end - at).to_pylist()]).encode())
                at = end
        close()
        yield pa.RecordBatch.from_arrays([pa.array([logs], pa.int64())], names=["logs"])
    return run
