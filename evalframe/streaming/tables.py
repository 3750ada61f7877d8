"""Streaming twins of the batch operators: per-job progress, live log tail, live run status,
scoring completions as files land.

The first three keep their state in Spark's ``transformWithState`` (see ``state``): keyed by job, on RocksDB, restored from the
checkpoint. Lines and updates may arrive in any order, late ones included. What they return is read from the state store itself, as of
the last batch; what a batch changed is written to plain tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.operators import progress as PR
from evalframe.operators import status as ST
from evalframe.streaming import state as S
from evalframe.streaming.runner import BatchTable, read_state, run_available_now

CHANGES_SCHEMA = "run_id string, total long, " + ", ".join(f"{s} long" for s in ST.STATUSES)
UPDATE_ORDER = ("last_update", "update_seq")


def _keyed(df: DataFrame, schema: str) -> T.StructType:
    """``schema`` behind the stream's own kind of job id."""
    return T.StructType([T.StructField("job_id", df.schema["job_id"].dataType), *T._parse_datatype_string(schema).fields])


def progress_stream(lines: DataFrame) -> DataFrame:
    """A line stream (``job_id, seq, ts, line``) as a stream of the progress of each job that a batch moved (update mode)."""
    parsed = PR.line_updates(lines.select("job_id", F.col("seq").cast("bigint").alias("seq"), F.col("ts").cast("timestamp_ntz").alias("ts"), "line"))
    summaries = parsed.select("job_id", "seq", "ts", "has_set", "contrib", "total").mapInArrow(S.summarise, _keyed(lines, S.SUMMARY))
    return summaries.groupBy("job_id").transformWithState(S.ProgressState(), _keyed(lines, S.PROGRESS), "Update", "None")


def stream_progress(spark: SparkSession, lines: DataFrame, table_path: str, checkpoint: str,
                    state_partitions: int | None = None) -> DataFrame:
    """Run the per-job progress fold over a line stream until it is drained;
    returns the progress per job (equal to the batch ``progress_fold``), whatever the order of the lines.

    Lines are parsed by native expressions and summed up in the task that read them; the state of a job takes one row a task and batch
    and holds its last SET, the stairs behind it and four numbers. The progress of the jobs that a batch moved is written to ``table_path``
    (a ``BatchTable``). ``state_partitions`` sets the partitions of the state, which are fixed for the life of a checkpoint."""
    moved = progress_stream(lines)
    table = BatchTable(spark, table_path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in moved.schema.fields))
    run_available_now(moved, checkpoint, table.write, "update", state_partitions, stateful=True)
    head = F.col("value")
    return read_state(spark, checkpoint, "head").select(
        F.col("key.job_id").alias("job_id"), head["samples_completed"].alias("samples_completed"), head["total"].alias("total_samples"),
        head["last_update"].alias("last_update"), head["n_lines"].alias("n_lines"))


def stream_log_tail(spark: SparkSession, lines: DataFrame, table_path: str, checkpoint: str,
                    n: int = 200, state_partitions: int | None = None) -> DataFrame:
    """Last ``n`` lines per job, live, trailing white space removed. A task sends ``n`` lines of a job at most; the state holds ``n``
    lines per job, whatever the stream's length. How many lines the jobs that a batch moved hold is written to ``table_path``."""
    rows = lines.select("job_id", F.col("seq").cast("bigint").alias("seq"), F.regexp_replace("line", r"(?U)\s+\z", "").alias("line"))
    newest = rows.mapInArrow(S.newest_lines(n), rows.schema)
    held = newest.groupBy("job_id").transformWithState(S.TailState(n), _keyed(lines, "n_lines bigint"), "Update", "None")
    table = BatchTable(spark, table_path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema.fields))
    run_available_now(held, checkpoint, table.write, "update", state_partitions, stateful=True)
    line = F.col("list_element")
    return read_state(spark, checkpoint, "tail").select(F.col("key.job_id").alias("job_id"), line["seq"].alias("seq"), line["line"].alias("line"))


def stream_run_status(spark: SparkSession, job_updates: DataFrame, table_path: str, checkpoint: str,
                      jobs_schema: str, state_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Job status rows arrive as a stream; the state holds the newest row per job (by ``last_update``, then ``update_seq``; a late older row
    changes nothing). A batch emits what each run lost and gained, summed per run into ``table_path``; the counts of a run are the sums of its changes.
    Returns (jobs, counts) after the stream is drained."""
    kinds = T._parse_datatype_string(jobs_schema)
    columns = kinds.fieldNames()
    rows = job_updates.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields])
    newest = rows.mapInArrow(S.newest_rows(list(UPDATE_ORDER)), rows.schema)
    state = S.NewestState(jobs_schema, columns, list(UPDATE_ORDER))
    changes = newest.groupBy("job_id").transformWithState(state, "run_id string, status string, change bigint", "Update", "None")
    table = BatchTable(spark, table_path, CHANGES_SCHEMA)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        each = [F.sum(F.when(F.col("status") == s, F.col("change")).otherwise(0)).alias(s) for s in ST.STATUSES]
        table.write(batch.groupBy("run_id").agg(F.sum("change").alias("total"), *each), batch_id)

    run_available_now(changes, checkpoint, on_batch, "update", state_partitions, stateful=True)
    counts = table.read().groupBy("run_id").agg(*[F.sum(c).alias(c) for c in ("total", *ST.STATUSES)]).where("total > 0")
    jobs = read_state(spark, checkpoint, "job").select(*[F.col("value")[c].alias(c) for c in columns])
    return jobs, counts


def stream_score(spark: SparkSession, completions: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                 out_path: str, checkpoint: str) -> DataFrame:
    """Stateless: score each completion as its file lands (the same Column
    scorers as batch), append to a table, return the table."""
    q = (scorer(completions).writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


def stream_eval_results(spark: SparkSession, scores: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ("task", "model")) -> DataFrame:
    """Append a stream of per-sample scores to a result table, ``batch_id=/task=/model=``. A batch that runs again, whole or in part,
    replaces what it has written, so each score is there once. Returns the table."""
    table = BatchTable(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scores.schema.fields), partition_by)
    run_available_now(scores, checkpoint, table.write)
    return table.read().select(*scores.columns)
