"""Batch generation through a callable the caller supplies.

The callable receives a pandas DataFrame (one Arrow batch of work rows, with
the prompts and options) and returns one completion per row. It is the only
place a model is contacted; everything around it is Spark:

* finished keys are skipped with a left-anti join, so a resumed run never
  pays again for a completion that was written. A task that Spark retries calls the model
  again for its rows, unless there is a ``journal``: then what a task got is found by its retry, by a second run
  of the query and by a restarted driver;
* ``run_in_slices`` commits the work in slices, so what is written grows during the run
  and a failure costs one slice's unfinished tasks;
* ``max_connections`` bounds how many tasks call the model at once; a callable may
  add its own concurrency inside a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.operators import journal as J

GenerateFn = Callable[[pd.DataFrame], Sequence[str]]

WORK_KEYS = ("task", "model", "sample_id", "epoch")
#: Work rows of a task, about, where the caller names no number of tasks.
TASK_ROWS = 250_000
#: What a model is shown: a user prompt, a system prompt and whole message arrays.
PROMPTS = ("system_prompt", "prompt", "messages")


def work_keys(work: DataFrame, keys: Sequence[str] | None = None) -> list[str]:
    """The columns that name a work row: those given, else WORK_KEYS and ``judge_model`` as far as the work has them."""
    return list(keys) if keys is not None else [k for k in (*WORK_KEYS, "judge_model") if k in work.columns]


def tasks_for(rows: DataFrame, most: int) -> int | None:
    """Partitions that keep ``rows`` (which are counted) at about ``most`` a task; None where the session's own number does. What a task sorts
    then doesn't grow with the table."""
    n = -(-rows.count() // most)
    return n if n > rows.sparkSession.sparkContext.defaultParallelism else None


def _run_batches(fn: GenerateFn, keys: list[str], out_col: str, journal: str | None = None, call_rows: int = J.DEFAULT_ROWS):
    """Keys stay as Arrow sent them (pandas would turn integers with a NULL into floats); the callable sees pandas."""
    import pyarrow as pa

    def call(b):
        result = list(fn(b.to_pandas())) if b.num_rows else []
        if len(result) != b.num_rows:
            raise ValueError(f"generator returned {len(result)} completions for {b.num_rows} rows")
        return result

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(call(b), pa.string())], names=[*keys, out_col])
    return J.journaled(journal, call, keys, out_col, call_rows) if journal else run


def generate(work: DataFrame, fn: GenerateFn, keys: Sequence[str] | None = None, prompt_col: str = "prompt",
             options: dict | None = None, done: DataFrame | None = None, partitions: int | None = None,
             out_col: str = "completion", journal: str | None = None, call_rows: int = J.DEFAULT_ROWS) -> DataFrame:
    """One ``out_col`` per work row not already in ``done`` (matched on keys).

    With ``journal``, a folder that driver and executors share, a result is paid once: the callable gets ``call_rows`` rows at a time,
    their results are kept before the next call, and a key that the journal holds comes from there.

    The callable sees the keys, every column of PROMPTS that the work has (``prompt_col`` as ``prompt``) and the
    options. Keys must be unique: a repeated one fails the query before the model is called for it."""
    keys = work_keys(work, keys)
    # an anti join ignores duplicate keys on its right side: no distinct needed
    todo = work if done is None else work.join(done.select(*keys), keys, "left_anti")
    schema = T.StructType([work.schema[k] for k in keys] + [T.StructField(out_col, T.StringType())])
    paid = J.read_journal(work.sparkSession, journal, schema) if journal else None
    if paid is not None:
        paid = paid.join(todo.select(*keys), keys, "left_semi")
        todo = todo.join(paid.select(*keys), keys, "left_anti")
    shown = [F.col(prompt_col if c == "prompt" else c).alias(c) for c in PROMPTS if (prompt_col if c == "prompt" else c) in work.columns]
    cols = [F.col(k) for k in keys] + shown + [F.lit(v).alias(k) for k, v in (options or {}).items()]
    # rows are dealt by key: the same task gets the same rows when it is run again, and sees repeated keys
    todo = todo.select(*cols)
    partitions = partitions or tasks_for(todo, TASK_ROWS)
    names = todo.columns
    # by one column of all keys: a key that is a constant would leave the window, and a second shuffle would set its own number of tasks
    todo = todo.withColumn("_deal", F.xxhash64(*keys))
    todo = todo.repartition(partitions, "_deal") if partitions else todo.repartition("_deal")
    copies = F.row_number().over(Window.partitionBy("_deal", *keys).orderBy(*keys))
    repeated = F.raise_error(F.concat(F.lit("work has a key twice: "), F.to_json(F.struct(*keys))))
    todo = todo.withColumn("_copy", copies).where(F.when(F.col("_copy") > 1, repeated.cast("boolean")).otherwise(F.lit(True))).select(*names)
    made = todo.mapInArrow(_run_batches(fn, keys, out_col, journal, call_rows), schema)
    return made if paid is None else made.unionByName(paid.select(*schema.names))


def generate_completions(work: DataFrame, fn: GenerateFn, max_connections: int | None = None,
                         max_tokens: int | None = None, temperature: float | None = None,
                         done: DataFrame | None = None, keys: Sequence[str] | None = None,
                         prompt_col: str = "prompt", journal: str | None = None, call_rows: int = J.DEFAULT_ROWS) -> DataFrame:
    """Completions for a work grid; knobs are passed to the callable as columns."""
    opts = {k: v for k, v in (("max_tokens", max_tokens), ("temperature", temperature)) if v is not None}
    return generate(work, fn, keys, prompt_col, opts, done, max_connections, journal=journal, call_rows=call_rows)


def generate_judgements(prompts: DataFrame, fn: GenerateFn, judges: Sequence[str] | None = None,
                        keys: Sequence[str] | None = None, prompt_col: str = "prompt",
                        done: DataFrame | None = None, max_connections: int | None = None, journal: str | None = None,
                        call_rows: int = J.DEFAULT_ROWS) -> DataFrame:
    """Grader replies. Work that already names its grader (``judge_model``, as ``suite.grader_work`` gives it) is taken as it
    is; otherwise each prompt is expanded for the ``judges``, run configuration held on the driver, by a generator in the
    scan's stage (no join)."""
    if "judge_model" in prompts.columns:
        if judges is not None:
            raise ValueError("the work already names its graders: pass no judges")
        work = prompts
    else:
        names = [j for j in judges or () if j]
        if not names:
            raise ValueError("At least one grader model must be provided")
        work = prompts.withColumn("judge_model", F.explode(F.array(*[F.lit(j) for j in names])))
    own = None if keys is None else list(dict.fromkeys([*keys, "judge_model"]))
    return generate(work, fn, own, prompt_col, None, done, max_connections, out_col="judge_output", journal=journal, call_rows=call_rows)


def persist_completions(df: DataFrame, path: str, partition_by: Sequence[str] = ("model",)) -> DataFrame:
    """Write generated rows (append: a resumed run adds only new keys) and
    return the table read back, cutting the lineage to the model calls."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_in_slices(work: DataFrame, run: Callable[[DataFrame], DataFrame], path: str, slices: int, keys: Sequence[str] | None = None,
                  partition_by: Sequence[str] = ("model",)) -> DataFrame:
    """``run`` (a generation over some of the work) slice by slice, each appended to ``path`` when it is whole.

    A slice is a range of the keys' hash, so a run that is started again with ``done`` set to the table at
    ``path`` finds the finished slices' keys there."""
    keys = work_keys(work, keys)
    out = None
    for i in range(max(slices, 1)):
        out = persist_completions(run(work.where(F.pmod(F.xxhash64(*keys), F.lit(max(slices, 1))) == i)), path, partition_by)
    return out
