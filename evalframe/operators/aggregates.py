"""A user's own aggregate over score rows, merged from parts.

A metric that Spark has no function for is four small functions over a *buffer* of bounded size:

    init()              an empty buffer
    update(buffer, rows)    the buffer with some rows of one group added; ``rows`` maps column names to Arrow arrays
    merge(a, b)         two buffers as one, in any order
    finish(buffer)      the metric, a number or None

Rows are folded into buffers where they are read, batch by batch; a task sends one buffer a group (more only if it
meets over ``HELD`` groups). Buffers of a group meet in two steps, first by (group, salt), so a group that holds a third of all rows, read by any number of
tasks, is never in one task, and neither are all its buffers.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Groups a task holds before it sends their buffers.
HELD = 10_000
#: First-step merges of a group.
SALTS = 64


@dataclass(frozen=True)
class Aggregate:
    """A mergeable aggregate over ``columns`` of the rows."""

    name: str
    columns: tuple[str, ...]
    init: Callable[[], Any]
    update: Callable[[Any, dict[str, pa.Array]], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float | None]


def _groups(columns: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers by group, and where each group begins among them; a null is a value of its own."""
    code = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        found = c.dictionary_encode(null_encoding="encode")
        code = np.unique(code * len(found.dictionary) + found.indices.to_numpy(), return_inverse=True)[1]
    at = np.argsort(code, kind="stable")
    return at, np.flatnonzero(np.concatenate([[True], np.diff(code[at]) != 0]))


def _partial(a: Aggregate, k: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        salt, held, kinds = TaskContext.get().partitionId() % SALTS, {}, None

        def send():
            columns = [pa.array([key[i] for key in held], kinds[i]) for i in range(k)]
            out = pa.RecordBatch.from_arrays([*columns, pa.array([salt] * len(held), pa.int32()), pa.array([cloudpickle.dumps(b) for b in held.values()], pa.binary())], names)
            held.clear()
            return out

        for b in batches:
            if not b.num_rows:
                continue
            kinds = [b.column(i).type for i in range(k)]
            at, starts = _groups(b.columns[:k]) if k else (np.arange(b.num_rows), np.zeros(1, np.int64))
            rows = b.take(pa.array(at))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
                key = tuple(rows.column(i)[start].as_py() for i in range(k))
                buffer = held[key] if key in held else a.init()
                held[key] = a.update(buffer, {c: rows.column(k + i).slice(start, end - start) for i, c in enumerate(a.columns)})
            if len(held) >= HELD:
                yield send()
        if held:
            yield send()
    return run


def _merged(a: Aggregate, k: int, names: list[str], last: bool):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        buffer = None
        for i, raw in enumerate(group.column(group.num_columns - 1)):
            part = pickle.loads(raw.as_py())
            buffer = part if i == 0 else a.merge(buffer, part)
        keys = [group.column(i).slice(0, 1) for i in range(k if last else k + 1)]
        value = a.finish(buffer) if last else cloudpickle.dumps(buffer)
        return pa.Table.from_arrays([*keys, pa.array([value], pa.float64() if last else pa.binary())], names)
    return run


def aggregate(rows: DataFrame, a: Aggregate, keys: Sequence[str]) -> DataFrame:
    """``keys`` and the aggregate (double, named as it is) of each group of ``rows``. Without keys, one row for all rows; no rows give no row."""
    k = len(keys)
    fields = [rows.schema[c] for c in keys]
    part = T.StructType([*fields, T.StructField("_salt", T.IntegerType()), T.StructField("_buffer", T.BinaryType())])
    done = T.StructType([*fields, T.StructField(a.name, T.DoubleType())])
    partial = rows.select(*keys, *a.columns).mapInArrow(_partial(a, k, part.names), part)
    salted = partial.groupBy(*keys, "_salt").applyInArrow(_merged(a, k, part.names, last=False), part)
    return salted.groupBy(*keys).applyInArrow(_merged(a, k, done.names, last=True), done)
