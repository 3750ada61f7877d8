"""Run and job status tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalframe.functions import scalars as S

# ---- fixed values: job states ----
STATUSES = ("complete", "failed", "cancelled", "running", "queued")
# ---- end of fixed values ----


def run_status_counts(jobs: DataFrame, run_col: str = "run_id", status_col: str = "status") -> DataFrame:
    """Jobs per run by state plus the total (states outside the list, such as
    ``cancelling``, only count in the total)."""
    st = F.col(status_col)
    return jobs.groupBy(run_col).agg(F.count("*").alias("total"),
                                     *[F.count_if(st == s).alias(s) for s in STATUSES])


def overall_status(total: Column, complete: Column, failed: Column, cancelled: Column,
                   running: Column, queued: Column) -> Column:
    """One status per run. The rules are checked in order and the last that
    holds wins, so the CASE lists them in reverse."""
    return (F.when((running == 0) & (queued == total) & (total > 0), F.lit("queued"))
            .when((complete == total) & (total > 0), F.lit("complete"))
            .when((failed > 0) & (failed + complete + cancelled == total), F.lit("failed"))
            .when((cancelled == total) & (total > 0), F.lit("cancelled"))
            .when(total == 0, F.lit("empty"))
            .otherwise(F.lit("running")))


def run_overall_status(runs: DataFrame, jobs: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Counts and overall status for every run, runs without jobs included
    (counts are aggregated first, then joined: one row per run crosses)."""
    counts = run_status_counts(jobs, run_col)
    r = runs.select(run_col).join(counts, run_col, "left")
    c = {k: F.coalesce(F.col(k), F.lit(0).cast("bigint")) for k in ("total",) + STATUSES}
    return r.select(run_col, *[c[k].alias(k) for k in ("total",) + STATUSES],
                    overall_status(c["total"], c["complete"], c["failed"], c["cancelled"],
                                   c["running"], c["queued"]).alias("status"))


def run_updated_at(runs: DataFrame, jobs: DataFrame, run_col: str = "run_id",
                   created_col: str = "created_at", update_col: str = "last_update") -> DataFrame:
    """Latest of the run's creation and its jobs' last updates, as ISO text."""
    last = jobs.groupBy(run_col).agg(F.max(update_col).alias("_lu"))
    r = runs.select(run_col, created_col).join(last, run_col, "left")
    return r.select(run_col, S.iso_timestamp(F.greatest(F.col(created_col).cast("timestamp"),
                                                        F.col("_lu").cast("timestamp"))).alias("updated_at"))


def _opt(df: DataFrame, name: str) -> Column:
    """A text column that may be absent (NULL then)."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name)


def run_report(runs: DataFrame, jobs: DataFrame, now, run_col: str = "run_id", created_col: str = "created_at",
               update_col: str = "last_update") -> DataFrame:
    """One row per run: task, ISO times, ``overall`` (counts by status and the run's status) and ``models``, the runs' job
    snapshots ordered by job id. ``jobs`` holds what ``job_snapshot`` reads. A run's jobs meet in one row: a
    run has one job per model."""
    overall = run_overall_status(runs, jobs)
    counts = [c for c in overall.columns if c != run_col]
    overall = overall.select(run_col, F.struct(*counts).alias("overall"))
    snaps = job_snapshot(jobs, now, [run_col])
    rows = [c for c in snaps.columns if c != run_col]
    models = snaps.groupBy(run_col).agg(F.array_sort(F.collect_list(F.struct(*rows))).alias("models"))
    head = runs.select(run_col, "task", S.iso_timestamp(created_col).alias("created_at"))
    return (head.join(run_updated_at(runs, jobs, run_col, created_col, update_col), run_col).join(overall, run_col)
            .join(models, run_col, "left")
            .withColumn("models", F.coalesce("models", F.expr("cast(array() as " + models.schema["models"].dataType.simpleString() + ")"))))


def job_snapshot(jobs: DataFrame, now, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One status row per job. Expects ``samples_completed``,
    ``total_samples``, ``started_at``, ``finished_at`` and the job columns;
    ``now`` is an argument (a timestamp literal or column), never the clock."""
    n = F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    done = F.coalesce(F.col("samples_completed"), F.lit(0).cast("bigint"))
    elapsed = S.elapsed_seconds("started_at", "finished_at", n)
    eta = S.estimate_remaining(done, F.col("total_samples"), "started_at", "finished_at", n)
    return jobs.select(
        *keep, "job_id", "model", S.display_name("label", "model").alias("display_name"), _opt(jobs, "provider"), "status",
        done.alias("samples_completed"), "total_samples",
        S.progress_percent(done, F.col("total_samples")).alias("progress_percent"),
        elapsed.alias("elapsed_seconds"), S.format_duration(elapsed).alias("elapsed"),
        eta.alias("eta_seconds"), S.format_duration(eta).alias("eta"),
        "error", S.iso_timestamp("started_at").alias("started_at"),
        S.iso_timestamp("finished_at").alias("finished_at"), "returncode")
