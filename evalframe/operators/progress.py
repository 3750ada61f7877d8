"""Job log lines -> progress, history and tails.

A line is free text or one JSON object. An object carries, in this order, up
to two SETs of the completed count (``results.completed_samples``,
``progress.completed``) and up to three RAISEs (``sample.completed``,
``sample.index + 1``, ``completed`` when ``event`` is a sample event). Because
the SETs come first, a line acts on the running count ``c`` as

    c -> max(set, raise)   if the line has a SET
    c -> max(c, raise)     otherwise

so the count after a line is the running max of the line contributions since
the last SET line (floored at 0 before the first SET). Only JSON integers
count (a bigint field of ``json_object`` is NULL for anything else).

Scale: a job may own a third of all lines, so nothing is partitioned by job
alone. Lines are cut into ``(job, seq // bucket)`` pieces of bounded size;
each piece is folded with a window of its own, and the per-job step runs
over one summary row per piece. ``bucket`` is a span of ``seq``: where ``seq`` is no
dense count (microseconds, byte offsets), pass a span that holds some ten
thousand lines, else the pieces are as many as the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalframe.functions import parse as P

DEFAULT_BUCKET = 1 << 16

PAYLOAD = ("results: struct<total_samples: bigint, completed_samples: bigint>, progress: struct<total: bigint, completed: bigint>, "
           "sample: struct<total: bigint, completed: bigint, index: bigint>, event: string, completed: bigint")

# ---- fixed values: events whose ``completed`` raises the count ----
SAMPLE_EVENTS = ("sample_complete", "sample_success", "sample")
# ---- end of fixed values ----


def line_updates(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Adds ``has_set``, ``contrib`` (the line's value if it SETs, else its
    RAISE or NULL) and ``total`` (last total the line states). The payload is
    parsed once, in its own projection."""
    parsed = lines.withColumn("_pair", P.json_pair(line_col, PAYLOAD)).withColumn("_p", P.first_object("_pair")).drop("_pair")
    p = F.col("_p")
    staged = parsed.withColumn("_set", F.coalesce(p["progress"]["completed"], p["results"]["completed_samples"])) \
        .withColumn("_raise", F.greatest(p["sample"]["completed"], p["sample"]["index"] + 1,
                                         F.when(p["event"].isin(*SAMPLE_EVENTS), p["completed"]))) \
        .withColumn("total", F.coalesce(p["sample"]["total"], p["progress"]["total"], p["results"]["total_samples"]))
    set_v, raise_v = F.col("_set"), F.col("_raise")
    return (staged.withColumn("has_set", set_v.isNotNull())
            .withColumn("contrib", F.when(set_v.isNotNull(), F.greatest(set_v, raise_v)).otherwise(raise_v))
            .drop("_p", "_set", "_raise"))


def _segment_end(df: DataFrame, group: list[str], order: str, has_set: str, contrib: str,
                 extra: list[Column] = ()) -> DataFrame:
    """Per group: (any SET, value after the group as if entered with -inf),
    plus ``extra`` aggregates over the same rows. The unordered window gives
    every row its group's last SET position; the aggregate then keeps that
    SET's contribution and later ones. Window and aggregate share one
    partitioning, so the rows cross the network once."""
    w = Window.partitionBy(*group)
    last_set = F.max(F.when(F.col(has_set), F.col(order))).over(w)
    d = df.withColumn("_ls", last_set)
    after = F.when(F.col("_ls").isNull() | (F.col(order) > F.col("_ls")), F.col(contrib))
    return d.groupBy(*group).agg(
        F.max(F.col(has_set)).alias("any_set"),
        F.greatest(F.max_by(F.col(contrib), F.when(F.col(has_set), F.col(order))), F.max(after)).alias("end_value"),
        *extra)


def _pieces(lines: DataFrame, job_col: str, seq_col: str, ts_col: str, line_col: str, bucket: int) -> DataFrame:
    return line_updates(lines.select(job_col, seq_col, ts_col, line_col), line_col) \
        .withColumn("_b", F.floor(F.col(seq_col) / F.lit(bucket)).cast("bigint"))


def progress_summary(lines: DataFrame, job_col: str = "job_id", seq_col: str = "seq", ts_col: str = "ts",
                     line_col: str = "line", bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """One row per job summing up a run of its lines: ``any_set``,
    ``end_value`` (the count after the lines as if entered with -inf),
    ``total_samples`` (last stated total, NULL if none), ``last_update``
    (time of the last line), ``n_lines`` and the lines' ``first_seq`` and ``last_seq``. Summaries compose: see
    ``enter`` and ``continue_progress``."""
    u = _pieces(lines, job_col, seq_col, ts_col, line_col, bucket)
    tot_key = F.when(F.col("total").isNotNull(), F.col(seq_col))
    pieces = _segment_end(u, [job_col, "_b"], seq_col, "has_set", "contrib", [
        F.max_by(F.col("total"), tot_key).alias("_tot"), F.max(tot_key).alias("_tot_seq"),
        F.max_by(F.col(ts_col), F.col(seq_col)).alias("_last_ts"), F.max(seq_col).alias("_last_seq"), F.min(seq_col).alias("_first_seq"),
        F.count("*").alias("_n")])
    return _segment_end(pieces, [job_col], "_b", "any_set", "end_value", [
        F.max_by(F.col("_tot"), F.col("_tot_seq")).alias("total_samples"),
        F.max_by(F.col("_last_ts"), F.col("_last_seq")).alias("last_update"),
        F.sum("_n").alias("n_lines"), F.min("_first_seq").alias("first_seq"), F.max("_last_seq").alias("last_seq")])


def enter(c_in: Column) -> Column:
    """The count after a summarised run of lines entered with count ``c_in``."""
    return F.when(F.col("any_set"), F.col("end_value")).otherwise(F.greatest(c_in, F.col("end_value")))


def progress_fold(lines: DataFrame, job_col: str = "job_id", seq_col: str = "seq", ts_col: str = "ts",
                  line_col: str = "line", bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """Final ``samples_completed``, ``total_samples``, ``last_update`` and line
    count per job."""
    job = progress_summary(lines, job_col, seq_col, ts_col, line_col, bucket)
    return job.select(job_col, enter(F.lit(0).cast("bigint")).alias("samples_completed"),
                      "total_samples", "last_update", "n_lines")


def continue_progress(state: DataFrame, summary: DataFrame, job_col: str = "job_id") -> DataFrame:
    """Progress per job after further lines: ``state`` is the progress before
    them (``progress_fold``'s columns and ``last_seq``, one row per job), ``summary`` the
    ``progress_summary`` of the new lines. A job's lines arrive in order of ``seq``: a line that is not behind all lines
    counted in ``state`` fails the query, since the count at its place is no longer known (``streaming.state`` keeps
    what late lines need). Both sides hold one row per job."""
    if "last_seq" not in state.columns:  # a state from elsewhere: the order of its lines is the caller's word
        state = state.withColumn("last_seq", F.lit(None).cast("bigint"))
    b = summary.select(F.col(job_col).alias("_b_job"), "any_set", "end_value", F.col("total_samples").alias("_b_total"),
                       F.col("last_update").alias("_b_last"), F.col("n_lines").alias("_b_n"), "first_seq", F.col("last_seq").alias("_b_seq"))
    j = state.join(b, F.col(job_col).eqNullSafe(F.col("_b_job")), "full_outer").withColumn(job_col, F.coalesce(job_col, "_b_job"))
    late = F.raise_error(F.format_string("late line: seq %d of a job that is at %d", F.col("first_seq"), F.col("last_seq")))
    j = j.withColumn("_b_n", F.when(F.col("first_seq") <= F.col("last_seq"), late.cast("bigint")).otherwise(F.col("_b_n")))
    seen = F.col("_b_n").isNotNull()
    c_in = F.coalesce(F.col("samples_completed"), F.lit(0).cast("bigint"))
    return j.select(
        job_col,
        F.when(seen, enter(c_in)).otherwise(F.col("samples_completed")).alias("samples_completed"),
        F.coalesce(F.col("_b_total"), F.col("total_samples")).alias("total_samples"),
        F.when(seen, F.col("_b_last")).otherwise(F.col("last_update")).alias("last_update"),
        (F.coalesce(F.col("n_lines"), F.lit(0)) + F.coalesce(F.col("_b_n"), F.lit(0))).alias("n_lines"),
        F.coalesce(F.col("_b_seq"), F.col("last_seq")).alias("last_seq"))


def progress_history(lines: DataFrame, job_col: str = "job_id", seq_col: str = "seq", ts_col: str = "ts",
                     line_col: str = "line", bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """``samples_completed`` and ``total_samples`` after every line.

    Inside a piece: segment = running count of SET lines, local value =
    running max of contributions within the segment. Across pieces: the
    count entering a piece comes from an ordered window over the job's piece
    summaries (one row per piece), which are aggregated from the lines as in
    the fold, without the ordered windows."""
    pieces = _pieces(lines, job_col, seq_col, ts_col, line_col, bucket)
    wp = Window.partitionBy(job_col, "_b").orderBy(seq_col).rowsBetween(Window.unboundedPreceding, 0)
    u = pieces.withColumn("_seg", F.sum(F.col("has_set").cast("int")).over(wp)) \
              .withColumn("_tot_local", F.last("total", ignorenulls=True).over(wp))
    ws = Window.partitionBy(job_col, "_b", "_seg").orderBy(seq_col).rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_local", F.max("contrib").over(ws))

    # piece summaries straight from the lines (as in the fold): no ordered window
    tot_key = F.when(F.col("total").isNotNull(), F.col(seq_col))
    summary = _segment_end(pieces, [job_col, "_b"], seq_col, "has_set", "contrib",
                           [F.max_by(F.col("total"), tot_key).alias("_tot_b")])
    wj = Window.partitionBy(job_col).orderBy("_b")
    summary = summary.withColumn("_seg2", F.sum(F.col("any_set").cast("int")).over(
        wj.rowsBetween(Window.unboundedPreceding, 0)))
    w2 = Window.partitionBy(job_col, "_seg2").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("bigint")
    summary = summary.withColumn("_run", F.max("end_value").over(w2))
    summary = summary.withColumn(
        "_after", F.when(F.col("_seg2") == 0, F.greatest(zero, F.coalesce("_run", zero))).otherwise(F.col("_run")))
    carry = summary.select(
        job_col, "_b",
        F.coalesce(F.lag("_after").over(wj), zero).alias("_c_in"),
        F.last("_tot_b", ignorenulls=True).over(wj.rowsBetween(Window.unboundedPreceding, -1)).alias("_tot_in"))
    carry = carry.select(F.col(job_col).alias("_c_job"), F.col("_b").alias("_c_b"), "_c_in", "_tot_in")
    out = u.join(carry, F.col(job_col).eqNullSafe(F.col("_c_job")) & F.col("_b").eqNullSafe(F.col("_c_b")))
    value = F.when(F.col("_seg") > 0, F.col("_local")).otherwise(F.greatest(F.col("_c_in"), F.col("_local")))
    return out.select(job_col, seq_col, ts_col, value.alias("samples_completed"),
                      F.coalesce(F.col("_tot_local"), F.col("_tot_in")).alias("total_samples"))


def log_tail(lines: DataFrame, n: int = 200, job_col: str = "job_id", seq_col: str = "seq",
             line_col: str = "line") -> DataFrame:
    """Last ``n`` lines per job, trailing whitespace removed. The rank filter
    becomes a window group limit, applied map-side before the shuffle, so a
    job with a third of the lines ships at most n rows per map task."""
    w = Window.partitionBy(job_col).orderBy(F.col(seq_col).desc())
    return (lines.select(job_col, seq_col, line_col)
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            .select(job_col, seq_col, F.regexp_replace(F.col(line_col), r"(?U)\s+\z", "").alias(line_col)))
