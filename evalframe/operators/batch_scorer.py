"""Scorers that are Python over batches: for what no Column expression can say (a parser, a solver, a local model).

The scorer gets a pandas frame of some rows and returns a column of values, and answers and explanations if it has them. Rows come in Arrow batches cut to a
number of bytes, so long replies don't pile up in one call. A scorer that raises is called again with the halves of its rows, down to the row
that it can't score: that row has no value and says why in ``error``; the others are scored. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

#: rows -> {"value": numbers, "answer": texts, "explanation": texts}; value is needed.
BatchScorerFn = Callable[[pd.DataFrame], dict[str, Sequence]]

DEFAULT_BYTES = 1 << 20
RESULTS = "value double, answer string, explanation string, error string"
_KINDS = {"value": pa.float64(), "answer": pa.string(), "explanation": pa.string()}


def cuts(batch: pa.RecordBatch, most: int) -> list[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes of text each; a longer row is a run of its own."""
    size = np.full(batch.num_rows, 8 * batch.num_columns, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            size += pc.fill_null(pc.binary_length(c), 0).to_numpy()
    upto, out, at = np.concatenate([[0], np.cumsum(size)]), [], 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        out.append((at, to))
        at = to
    return out


def _scored(fn: BatchScorerFn, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n = rows.num_rows
    try:
        got = fn(rows.to_pandas())
        columns = [pa.array(list(got[c]) if c in got else [None] * n, kind) for c, kind in _KINDS.items()]
        if any(len(c) != n for c in columns):
            raise ValueError(f"the scorer gave {[len(c) for c in columns]} results for {n} rows")
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.string())], names=[*_KINDS, "error"])
    except Exception as e:  # noqa: BLE001 - whatever a user's scorer raises is that row's error
        if n == 1:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, kind) for kind in _KINDS.values()), pa.array([f"{type(e).__name__}: {e}"])], names=[*_KINDS, "error"])
        else:
            yield from _scored(fn, rows.slice(0, n // 2))
            yield from _scored(fn, rows.slice(n // 2))


def score_batches(df: DataFrame, fn: BatchScorerFn, keep: Sequence[str], cols: dict[str, Column], batch_bytes: int = DEFAULT_BYTES) -> DataFrame:
    """``keep`` columns and ``value, answer, explanation, error`` of each row. ``cols`` names what the scorer sees."""
    k = len(keep)
    shown = list(cols)
    schema = T.StructType([*(df.schema[c] for c in keep), *T._parse_datatype_string(RESULTS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = pa.RecordBatch.from_arrays(b.columns[k:], names=shown)
            for at, to in cuts(seen, batch_bytes):
                for part in _scored(fn, seen.slice(at, to - at)):
                    yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at, part.num_rows) for i in range(k)), *part.columns], names=schema.names)
                    at += part.num_rows

    return df.select(*keep, *[c.alias(f"_seen_{i}") for i, c in enumerate(cols.values())]).mapInArrow(run, schema)
