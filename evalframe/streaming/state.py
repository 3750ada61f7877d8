"""Per-job state of the live streams, kept by Spark's ``transformWithState``.

Each stream has two parts. A stateless step (Arrow batches, no shuffle) sums up the rows of a batch in the task that read them, so a job
that owns a third of all lines reaches its state as one row a batch and task. A ``StatefulProcessor`` merges these rows into the job's state.

The progress of a job is a sum that can be merged in any order. A line is a function of the running count ``c``: a SET is
``c -> v``, a RAISE ``c -> max(c, v)``. Of a job's lines only these can still matter, whatever lines come later, or late:

* the last SET by ``seq`` (a line before it can't change the count any more);
* of the RAISEs behind it, those larger than every later one (the *stairs*, falling in value as ``seq`` rises): a SET that
  comes late leaves exactly those behind it in force.

Merging keeps the later SET, drops the stairs before it and joins the rest. So lines may come shuffled, late or cut into any batches, and
the count is the one of ``progress_fold``. Stairs are few, since counts rise as a job goes on; there are never more than distinct counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

STAIRS = "array<struct<seq: bigint, value: bigint>>"
SUMMARY = f"set_seq bigint, set_value bigint, stairs {STAIRS}, total_seq bigint, total bigint, last_seq bigint, last_update timestamp_ntz, n_lines bigint"
PROGRESS = "samples_completed bigint, total_samples bigint, last_update timestamp_ntz, n_lines bigint"
_HEAD = "set_seq bigint, set_value bigint, total_seq bigint, total bigint, last_seq bigint, last_update timestamp_ntz, n_lines bigint, samples_completed bigint"

#: The place of a line without one: before all others.
FIRST = -(2 ** 63)
_STAIRS = pa.list_(pa.struct([("seq", pa.int64()), ("value", pa.int64())]))


# ---- merging ----------------------------------------------------------------------------------------

def stairs_of(raises: list[tuple[int, int]], after: int | None = None) -> list[tuple[int, int]]:
    """The (seq, value) pairs behind ``after`` that are larger than every later one, by ``seq``."""
    out: list[tuple[int, int]] = []
    for seq, value in sorted(raises, reverse=True):
        if after is not None and seq <= after:
            break
        if not out or value > out[-1][1]:
            out.append((seq, value))
    return out[::-1]


def merged(a: tuple, b: tuple) -> tuple:
    """Two summaries ``(set_seq, set_value, stairs, total_seq, total, last_seq, last_update, n_lines)`` of a job as one."""
    first = a if b[0] is None or (a[0] is not None and (a[0], a[1]) >= (b[0], b[1])) else b
    total = a if b[3] is None or (a[3] is not None and a[3] >= b[3]) else b
    last = a if b[5] is None or (a[5] is not None and a[5] >= b[5]) else b
    return (first[0], first[1], stairs_of([*a[2], *b[2]], first[0]), total[3], total[4], last[5], last[6], a[7] + b[7])


def count(summary: tuple) -> int:
    """The job's count after its lines: the last SET, or 0, raised by what follows."""
    base = 0 if summary[0] is None else summary[1]
    return max([base, *[v for _, v in summary[2][:1]]])


# ---- stateless steps: one row for each job of an Arrow batch ------------------------------------------

def _sorted_by_job(job: pa.Array, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row numbers by (job, order), the first of each job's run, and the job of each run."""
    codes = job.dictionary_encode(null_encoding="encode")
    code = codes.indices.to_numpy()
    at = np.lexsort((*order[::-1], code))
    starts = np.flatnonzero(np.concatenate([[True], np.diff(code[at]) != 0]))
    return at, starts, codes.dictionary.take(pa.array(code[at][starts]))


def _longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return pc.fill_null(column, 0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (job_id, seq, ts, has_set, contrib, total) to one summary for each job of a batch."""
    for b in batches:
        if not b.num_rows:
            continue
        seq = pc.fill_null(b.column(1), FIRST).to_numpy()
        at, starts, jobs = _sorted_by_job(b.column(0), seq)
        seq, is_set = seq[at], b.column(3).to_numpy(zero_copy_only=False).astype(bool)[at]
        contrib, stated = (x[at] for x in _longs(b.column(4)))
        total, has_total = (x[at] for x in _longs(b.column(5)))
        ends = np.append(starts[1:], len(at))
        here = np.arange(len(at))
        last_set = np.maximum.reduceat(np.where(is_set, here, -1), starts)
        last_total = np.maximum.reduceat(np.where(has_total, here, -1), starts)
        stairs = []
        for start, end, set_at in zip(starts.tolist(), ends.tolist(), last_set.tolist()):
            lines = np.arange(max(start, set_at + 1), end)
            lines = lines[stated[lines] & ~is_set[lines]]
            stairs.append([{"seq": s, "value": v} for s, v in stairs_of(list(zip(seq[lines].tolist(), contrib[lines].tolist())))])
        none = last_set < 0
        yield pa.RecordBatch.from_arrays(
            [jobs, pa.array(seq[last_set], pa.int64(), mask=none), pa.array(contrib[last_set], pa.int64(), mask=none), pa.array(stairs, _STAIRS),
             pa.array(seq[last_total], pa.int64(), mask=last_total < 0), pa.array(total[last_total], pa.int64(), mask=last_total < 0),
             pa.array(seq[ends - 1], pa.int64()), b.column(2).take(pa.array(at[ends - 1])), pa.array((ends - starts).astype(np.int64))],
            ["job_id", "set_seq", "set_value", "stairs", "total_seq", "total", "last_seq", "last_update", "n_lines"])


def newest_lines(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (job_id, seq, line): the last ``n`` of each job of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at, starts, _ = _sorted_by_job(b.column(0), pc.fill_null(b.column(1), FIRST).to_numpy())
                ends = np.append(starts[1:], len(at))
                behind = np.repeat(ends, ends - starts) - np.arange(len(at))
                yield b.take(pa.array(np.sort(at[behind <= n])))
    return run


def newest_rows(order: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The newest row of each ``job_id`` of a batch by ``order`` (nulls oldest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                place = np.empty(b.num_rows, np.int64)
                place[pc.sort_indices(b, sort_keys=[(c, "ascending") for c in order], null_placement="at_start").to_numpy()] = np.arange(b.num_rows)
                at, starts, _ = _sorted_by_job(b.column(b.schema.get_field_index("job_id")), place)
                yield b.take(pa.array(at[np.append(starts[1:], len(at)) - 1]))
    return run


# ---- stateful processors ----------------------------------------------------------------------------

class ProgressState(StatefulProcessor):
    """Merges summaries; emits the job's progress after each batch that moved it."""

    def init(self, handle) -> None:
        self.head = handle.getValueState("head", _HEAD)
        self.stairs = handle.getListState("stairs", "seq bigint, value bigint")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        now, h = (None, None, [], None, None, None, None, 0), self.head.get()   # each call for a state is a trip to the JVM
        if h is not None:
            now = (h[0], h[1], [(s[0], s[1]) for s in self.stairs.get()], h[2], h[3], h[4], h[5], h[6])
        had = now[2]
        for r in rows:
            now = merged(now, (r.set_seq, r.set_value, [(s["seq"], s["value"]) for s in r.stairs], r.total_seq, r.total, r.last_seq, r.last_update, r.n_lines))
        done = count(now)
        self.head.update((now[0], now[1], *now[3:], done))
        if now[2]:
            self.stairs.put(now[2])
        elif had:
            self.stairs.clear()
        yield Row(job_id=key[0], samples_completed=done, total_samples=now[4], last_update=now[6], n_lines=now[7])

    def close(self) -> None:
        pass


class TailState(StatefulProcessor):
    """The last ``n`` lines of a job by ``seq``; emits how many it holds."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle) -> None:
        self.tail = handle.getListState("tail", "seq bigint, line string")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        held = [(x[0], x[1]) for x in self.tail.get()] if self.tail.exists() else []
        held += [(r.seq, r.line) for r in rows]
        held = sorted(held, key=lambda x: FIRST if x[0] is None else x[0])[-self.n:]
        self.tail.put(held)
        yield Row(job_id=key[0], n_lines=len(held))

    def close(self) -> None:
        pass


class NewestState(StatefulProcessor):
    """The newest row of a job; emits what its run loses and gains when the row's run or status changes."""

    def __init__(self, schema: str, columns: list[str], order: list[str]):
        self.schema, self.columns, self.order = schema, columns, order

    def init(self, handle) -> None:
        self.job = handle.getValueState("job", self.schema)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        def age(row):
            return tuple((row[self.columns.index(c)] is not None, row[self.columns.index(c)]) for c in self.order)

        before = tuple(self.job.get()) if self.job.exists() else None
        newest = max([*([before] if before else []), *(tuple(r[c] for c in self.columns) for r in rows)], key=age)
        if newest == before:
            return
        self.job.update(newest)
        run, status = self.columns.index("run_id"), self.columns.index("status")
        if before is None or (before[run], before[status]) != (newest[run], newest[status]):
            if before is not None:
                yield Row(run_id=before[run], status=before[status], change=-1)
            yield Row(run_id=newest[run], status=newest[status], change=1)

    def close(self) -> None:
        pass
