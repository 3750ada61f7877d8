"""Plans for log files, streaming twins and the user-defined surface
(SURVEY 2.1 list/read_eval_logs, 2.12, 2.13)."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from evalframe.fixtures import fixture
from evalframe.functions import score as SC
from evalframe.operators.scoring import score_choice_table
from evalframe.functions.parse import py_strip
from evalframe.functions.prompt_texts import MATH_SYSTEM_TEMPLATE
from evalframe.operators import generate as G
from evalframe.operators import metrics as M
from evalframe.operators.prompts import render_system_prompt
from evalframe.operators.samples import filter_difficulty, join_targets
from evalframe import tasks as TK
from evalframe.plans.common import (CHOICE_FIXTURES, CHOICE_SCORES_CTE, choice_samples, choice_scores, round9)
from evalframe.plans.registry import plan
from evalframe.plans.status_plans import PROGRESS_CTE
from evalframe.session import work_dir
from evalframe.sources import lines as LN
from evalframe.sources import log_rows as LRW
from evalframe.sources import logs as LG
from evalframe.sources import raw_lines as RL
from evalframe.streaming import tables as STR
from evalframe.streaming.runner import write_in_order

# ---- log files ---------------------------------------------------------------------------------


#: name pattern -> folder, minutes before the newest, whether the body is whole
LOG_FILES = (("2024-05-29T12-38-43+00-00_m{i}.json", 0, 3, True), ("with space m{i}.json", 0, 1, True), ("pct%20m{i}.json", 0, 2, True),
             ("2024-05-29T12-38-43+00-00_m{i}.json", 1, 0, True), ("only b m{i}.json", 1, 5, True), ("broken_m{i}.json", 1, 4, False))


def _log_body(n: int, folder: int, whole: bool) -> str:
    return f'{{"n_samples": {n}, "folder": {folder}' + ("}" if whole else "")


def _write_logs(spark, sf):
    """Log folders derived from the scores (a log per model and LOG_FILES entry): names with plus signs, spaces and percent signs,
    one name in both folders, a nested log, a file that is no log, and a third folder that does not exist."""
    counts = choice_scores(spark, sf).groupBy("model").agg(F.countDistinct("sample_id").alias("n")).collect()
    root = work_dir(spark, "logs")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def put(path, text, minutes):
        p = jvm.org.apache.hadoop.fs.Path(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.setTimes(p, 1_700_000_000_000 - minutes * 60_000, -1)

    for r in counts:
        i = int(r.model.rsplit("-", 1)[1])
        for name, folder, minutes, whole in LOG_FILES:
            put(f"{root}/{'ab'[folder]}/{name.format(i=i)}", _log_body(r.n, folder, whole), minutes)
        put(f"{root}/a/inner/nested_m{i}.json", _log_body(r.n, 0, True), 0)
        put(f"{root}/b/notes_m{i}.txt", "no log", 0)
    return [f"{root}/a", f"{root}/b", f"{root}/absent"]


_LOG_ROWS = CHOICE_SCORES_CTE + """
, per_model as (select split_part(model, '-', -1) as i, count(distinct sample_id) as n from choice_scores group by model)
, log_rows as (select replace(pattern, '{i}', i) as name, folder as dir_rank, minutes, whole, n,
    length('{"n_samples": ' || n || ', "folder": ' || folder) + case when whole then 1 else 0 end as size
  from per_model cross join (values """ + ", ".join(f"('{n}', {f}, {m}, {str(w).lower()})" for n, f, m, w in LOG_FILES) + """) as x(pattern, folder, minutes, whole))
"""


@plan("list_eval_logs", _LOG_ROWS + """
select name, dir_rank, size, 'json' as type, cast(row_number() over (partition by dir_rank order by minutes, name) as int) as place from log_rows""",
      CHOICE_FIXTURES)
def q_list_eval_logs(spark, sf):
    logs = LG.list_eval_logs(spark, _write_logs(spark, sf))
    newest = Window.partitionBy("dir_rank").orderBy(F.desc("modified"), "name")
    return logs.select("name", "dir_rank", "size", "type", F.row_number().over(newest).alias("place"))


@plan("read_eval_logs", _LOG_ROWS + """
select name, dir_rank, whole as is_valid, case when whole then n end as n_samples, case when whole then dir_rank end as folder
from log_rows qualify row_number() over (partition by name order by dir_rank) = 1""",
      CHOICE_FIXTURES)
def q_read_eval_logs(spark, sf):
    logs = LG.read_eval_logs(spark, _write_logs(spark, sf))
    return logs.select("name", "dir_rank", "is_valid", F.try_variant_get("doc", "$.n_samples", "bigint").alias("n_samples"),
                       F.try_variant_get("doc", "$.folder", "int").alias("folder"))


#: Samples of a log, about: a log is one document in one task.
LOG_SAMPLES = 20_000


def _sample_logs(spark, sf):
    """Logs for each model and epoch, as many as keep them at about LOG_SAMPLES samples (one up to that), with the samples' scores; every third sample's
    grade is a letter, the others' a number."""
    scores = choice_scores(spark, sf)
    blocks = max(1, -(-choice_samples(spark, sf).count() // LOG_SAMPLES))
    block = [F.pmod(F.xxhash64("sample_id"), F.lit(blocks)).alias("block")] if blocks > 1 else []
    grade = F.when(F.col("sample_id") % 3 == 0, F.when(F.col("value") == 1, '"C"').otherwise('"I"')).otherwise(F.col("value").cast("int").cast("string"))
    sample = F.format_string('{"id":%d,"epoch":%d,"scores":{"choice":{"value":%s,"answer":"%s"},"answered":{"value":%s}}}', "sample_id", "epoch", grade, "answer",
                             (F.col("answer") != "").cast("string"))
    logs = scores.groupBy("model", "epoch", *block).agg(F.concat_ws(",", F.collect_list(sample)).alias("samples"), F.count("*").alias("n"))
    body = F.format_string('{"status":"success","eval":{"task":"telelogs","model":"%s"},"results":{"total_samples":%d},"samples":[%s]}', "model", "n", "samples")
    path = work_dir(spark, "sample-logs")
    logs.select(F.concat("model", F.lit("-"), F.col("epoch"), *[x for _ in block for x in (F.lit("-"), F.col("block"))]).alias("log"), body.alias("value")).write.partitionBy("log").text(path)
    return LG.read_eval_logs(spark, [path], glob="*.txt", nested=True)


@plan("read_log_samples", CHOICE_SCORES_CTE + """
select model, cast(sample_id as varchar) as sample_id, epoch, 'choice' as scorer, value, answer from choice_scores
union all select model, cast(sample_id as varchar), epoch, 'answered', case when answer <> '' then 1.0 else 0.0 end, null from choice_scores""", CHOICE_FIXTURES)
def q_read_log_samples(spark, sf):
    """Logs to sample rows, kept as shredded Parquet, and from there to score rows."""
    stored = LRW.write_log_samples(LRW.log_samples(_sample_logs(spark, sf)), work_dir(spark, "log-samples"))
    return LRW.log_scores(LRW.scan_log_samples(spark, stored)).select("model", "sample_id", "epoch", "scorer", "value", "answer")


# ---- streaming -------------------------------------------------------------------------------


def _files_per_trigger(spark):
    """Micro-batches of about one written range: each range is written as up to
    one file per core, so a batch stays bounded however large the stream."""
    return spark.sparkContext.defaultParallelism


def _line_stream(spark, sf, name):
    path = work_dir(spark, name)
    lines = fixture(spark, sf, "fx_progress").select("job_id", "seq", "ts", "line")
    write_in_order(lines, path, "seq", pieces=4, key_col="job_id")
    return LN.scan_progress_lines(spark, path, stream=True, max_files_per_trigger=_files_per_trigger(spark))


@plan("stream_progress", PROGRESS_CTE + "select job_id, samples_completed, total_samples, last_update, n_lines from pf",
      ("fx_progress",))
def q_stream_progress(spark, sf):
    stream = _line_stream(spark, sf, "stream-lines")
    return STR.stream_progress(spark, stream, work_dir(spark, "stream-progress"), work_dir(spark, "ckpt"),
                               state_partitions=spark.sparkContext.defaultParallelism)


@plan("stream_late_progress", PROGRESS_CTE + "select job_id, samples_completed, total_samples, last_update, n_lines from pf",
      ("fx_progress",))
def q_stream_late_progress(spark, sf):
    """The same stream with its lines dealt over the micro-batches by chance: most come late."""
    path = work_dir(spark, "late-lines")
    lines = fixture(spark, sf, "fx_progress").select("job_id", "seq", "ts", "line")
    write_in_order(lines.withColumn("turn", F.pmod(F.xxhash64("job_id", "seq"), F.lit(4))), path, "turn", pieces=4)
    stream = LN.scan_progress_lines(spark, path, stream=True, max_files_per_trigger=_files_per_trigger(spark))
    return STR.stream_progress(spark, stream, work_dir(spark, "stream-progress"), work_dir(spark, "ckpt"),
                               state_partitions=spark.sparkContext.defaultParallelism)


# ---- plain text logs ----------------------------------------------------------------------------

#: A line begins where the lines before it end, each with its line end.
_RAW_CTE = """
, raw as (select job_id, cast(coalesce(sum(strlen(line) + 1) over (partition by job_id order by seq rows between unbounded preceding and 1 preceding), 0) as bigint) as seq, line from fx_progress)
"""


def _raw_logs(spark, sf):
    """The fixture's lines as text logs, one file a job."""
    return RL.write_raw_logs(fixture(spark, sf, "fx_progress"), work_dir(spark, "raw-logs"))


@plan("scan_raw_lines", _RAW_CTE + "select job_id, seq, line from raw", ("fx_progress",))
def q_scan_raw_lines(spark, sf):
    """Text logs as a table, a job's log read by several tasks."""
    lines = RL.scan_raw_lines(spark, _raw_logs(spark, sf), range_bytes=1 << 16)
    return lines.select(F.col("job_id").cast("bigint").alias("job_id"), "seq", "line")


@plan("stream_raw_progress", PROGRESS_CTE + "select job_id, samples_completed, total_samples, n_lines from pf", ("fx_progress",))
def q_stream_raw_progress(spark, sf):
    """Text logs followed as a stream, folded to the progress of each job."""
    lines = RL.scan_raw_lines(spark, _raw_logs(spark, sf), stream=True, range_bytes=1 << 16)
    found = STR.stream_progress(spark, lines, work_dir(spark, "stream-progress"), work_dir(spark, "ckpt"),
                                state_partitions=spark.sparkContext.defaultParallelism)
    return found.select(F.col("job_id").cast("bigint").alias("job_id"), "samples_completed", "total_samples", "n_lines")


@plan("stream_log_tail", r"""
select job_id, seq, regexp_replace(line, '\s+$', '') as line
from (select *, row_number() over (partition by job_id order by seq desc) as rn from fx_progress) t where rn <= 200""",
      ("fx_progress",))
def q_stream_log_tail(spark, sf):
    stream = _line_stream(spark, sf, "stream-lines")
    return STR.stream_log_tail(spark, stream, work_dir(spark, "stream-tail"), work_dir(spark, "ckpt"))


JOB_UPDATE_SCHEMA = "run_id string, job_id long, model string, status string, last_update timestamp_ntz, update_seq int"


@plan("stream_run_status", """
select run_id, count(*) as total, count(*) filter (where status = 'complete') as complete,
  count(*) filter (where status = 'failed') as failed, count(*) filter (where status = 'cancelled') as cancelled,
  count(*) filter (where status = 'running') as running, count(*) filter (where status = 'queued') as queued
from fx_jobs group by run_id""", ("fx_jobs",))
def q_stream_run_status(spark, sf):
    jobs = fixture(spark, sf, "fx_jobs")
    path = work_dir(spark, "job-updates")
    # every job is first seen queued, then its final row arrives
    queued = jobs.select("run_id", "job_id", "model", F.lit("queued").alias("status"),
                         F.col("started_at").alias("last_update"), F.lit(0).alias("update_seq"))
    final = jobs.select("run_id", "job_id", "model", "status", "last_update", F.lit(1).alias("update_seq"))
    queued.repartition("job_id").write.mode("append").parquet(path)
    write_in_order(final, path, "job_id", pieces=3, key_col="job_id")
    stream = (spark.readStream.schema(JOB_UPDATE_SCHEMA).option("maxFilesPerTrigger", _files_per_trigger(spark))
              .parquet(path))
    _, counts = STR.stream_run_status(spark, stream, work_dir(spark, "stream-status"), work_dir(spark, "ckpt"),
                                      JOB_UPDATE_SCHEMA)
    return counts


COMPLETION_SCHEMA = "sample_id long, model string, epoch int, completion string"


@plan("stream_score", CHOICE_SCORES_CTE + "select model, sample_id, epoch, answer, value from choice_scores",
      CHOICE_FIXTURES)
def q_stream_score(spark, sf):
    path = work_dir(spark, "completion-files")
    write_in_order(fixture(spark, sf, "fx_completions"), path, "sample_id", pieces=3)
    stream = (spark.readStream.schema(COMPLETION_SCHEMA).option("maxFilesPerTrigger", _files_per_trigger(spark))
              .parquet(path))
    samples = choice_samples(spark, sf)

    def score(df):
        return score_choice_table(join_targets(df, samples, ("choices", "target"), merge=True), ["model", "sample_id", "epoch"])

    return STR.stream_score(spark, stream, score, work_dir(spark, "stream-scores"), work_dir(spark, "ckpt"))


@plan("stream_eval_results", CHOICE_SCORES_CTE + "select 'telelogs' as task, model, sample_id, epoch, answer, value from choice_scores",
      CHOICE_FIXTURES)
def q_stream_eval_results(spark, sf):
    """Scores appended to a result table by task and model as completions land."""
    path = work_dir(spark, "completion-files")
    write_in_order(fixture(spark, sf, "fx_completions"), path, "sample_id", pieces=3)
    stream = spark.readStream.schema(COMPLETION_SCHEMA).option("maxFilesPerTrigger", _files_per_trigger(spark)).parquet(path)
    paired = join_targets(stream, choice_samples(spark, sf), ("choices", "target"), merge=True)
    scores = score_choice_table(paired, ["model", "sample_id", "epoch"]).withColumn("task", F.lit("telelogs"))
    return STR.stream_eval_results(spark, scores, work_dir(spark, "stream-results"), work_dir(spark, "ckpt"))


# ---- user-defined surface -----------------------------------------------------------------------

@TK.scorer("exact_group", metrics=("accuracy", "stderr"))
def exact_group(completion, target):
    """User scorer: whole reply equals the target up to case and outer spaces."""
    ans = F.lower(py_strip(F.coalesce(completion, F.lit(""))))
    return {"answer": ans, "value": (ans == F.lower(target)).cast("double")}


@TK.batch_scorer("strict_group", batch_bytes=1 << 16)
def strict_group(rows):
    """User scorer over batches; a reply that names two groups is none that it can score."""
    answers = []
    for reply in rows["completion"]:
        if "," in (reply or ""):
            raise ValueError("two groups")
        answers.append((reply or "").lower())
    return {"value": [float(a == t.lower()) for a, t in zip(answers, rows["target"])], "answer": answers}


@plan("custom_batch_scorer", """
select sample_id, case when two then null when lower(coalesce(completion, '')) = lower(target) then 1.0 else 0.0 end as value,
  case when not two then lower(coalesce(completion, '')) end as answer, case when two then 'ValueError: two groups' end as error
from (select *, strpos(coalesce(completion, ''), ',') > 0 as two from fx_working_group) t""", ("fx_working_group",))
def q_custom_batch_scorer(spark, sf):
    w = fixture(spark, sf, "fx_working_group")
    return TK.apply_scorer(w, "strict_group", ["sample_id"], completion=F.col("completion"), target=F.col("target")).drop("explanation")


@TK.metric("any_correct")
def any_correct(scores, keys):
    """User metric: share of samples with at least one correct epoch."""
    per = scores.groupBy(*keys, "sample_id").agg(F.max("value").alias("best"))
    return per.groupBy(*keys).agg(F.avg("best").alias("any_correct"))


@plan("custom_scorer", r"""
select sample_id, lower(regexp_replace(completion, '^\s+|\s+$', '', 'g')) as answer,
  case when lower(regexp_replace(completion, '^\s+|\s+$', '', 'g')) = lower(target) then 1.0 else 0.0 end as value
from fx_working_group""", ("fx_working_group",))
def q_custom_scorer(spark, sf):
    w = fixture(spark, sf, "fx_working_group")
    return TK.apply_scorer(w, "exact_group", ["sample_id"], completion=F.col("completion"), target=F.col("target"))


@plan("custom_metric", CHOICE_SCORES_CTE + """
select model, round(avg(best), 9) as any_correct from (select model, sample_id, max(value) as best from choice_scores
group by model, sample_id) t group by model""", CHOICE_FIXTURES)
def q_custom_metric(spark, sf):
    return round9(TK.METRICS["any_correct"](choice_scores(spark, sf), ["model"]), "any_correct")


def _entropy(counts):
    n = sum(counts.values())
    return 0.0 - sum(c / n * math.log(c / n) for c in sorted(counts.values())) if n else None


@TK.aggregate_metric("answer_entropy", ["answer"], init=Counter, merge=lambda a, b: a + b, finish=_entropy)
def answer_entropy(counts, rows):
    """User metric by a mergeable aggregate: entropy of the answers given."""
    counts.update(a for a in rows["answer"].to_pylist() if a)
    return counts


@plan("custom_aggregate_metric", CHOICE_SCORES_CTE + """
select model, epoch, round(cast(0 as double) - sum(n / total * ln(n / total)) filter (n > 0), 9) as answer_entropy from (select model, epoch,
  cast(count(*) filter (answer <> '') as double) as n, sum(count(*) filter (answer <> '')) over (partition by model, epoch) as total
  from choice_scores group by model, epoch, answer) t group by model, epoch""", CHOICE_FIXTURES)
def q_custom_aggregate_metric(spark, sf):
    return round9(TK.METRICS["answer_entropy"](choice_scores(spark, sf), ["model", "epoch"]), "answer_entropy")


@TK.scorer("boxed_number", metrics=("accuracy", "stderr"))
def boxed_number(completion, target):
    return SC.score_boxed(completion, target)


def _math_dataset(spark, sf, difficulty="full"):
    math = filter_difficulty(fixture(spark, sf, "fx_math"), difficulty)
    return math.select("sample_id", "ord" if "ord" in math.columns else F.col("sample_id").alias("ord"), F.col("question").alias("input"),
                       F.col("answer").alias("target"), "difficulty")


def _math_replies(pdf):
    """Stand-in for a model client: boxes the sample's number plus the epoch, but for basic parity; shows the system prompt's length."""
    return [f"{len(s)} \\boxed{{{i % 50 if e == 1 else i % 7}}}" for i, e, s in zip(pdf["sample_id"], pdf["epoch"], pdf["system_prompt"])]


def _math_completions(spark, sf):
    """The work of the task as it is defined, generated and written."""
    work = MATH_TASK.work(spark, sf, ["lab/model-0", "lab/model-1"], epochs=2)
    return G.persist_completions(G.generate_completions(work, _math_replies), work_dir(spark, "task-completions"))


MATH_TASK = TK.Task("telemath", _math_dataset, _math_completions, "boxed_number", {"completion": "completion", "target": "target"},
                    system_prompt=lambda samples: render_system_prompt(MATH_SYSTEM_TEMPLATE, {}))
BASIC_MATH = MATH_TASK.with_params(difficulty="basic")


@plan("task_definition", """
, per as (select difficulty, m.model, sample_id, (cast(answer = cast(sample_id % 50 as varchar) as int) + cast(answer = cast(sample_id % 7 as varchar) as int)) / 2 as v
  from fx_math cross join (values ('lab/model-0'), ('lab/model-1')) m(model))
select 'telemath' as task, part, model, round(avg(v), 9) as accuracy, round(coalesce(sqrt(var_samp(v) / count(v)), 0.0), 9) as stderr
from (select 'full' as part, * from per union all select 'basic', * from per where difficulty = 'basic') x group by part, model""",
      ("fx_math",))
def q_task_definition(spark, sf):
    """The task over its whole dataset and, by its parameter, over one difficulty."""
    out = [t.run(spark, sf).select("task", F.lit(part).alias("part"), "model", "accuracy", "stderr") for part, t in (("full", MATH_TASK), ("basic", BASIC_MATH))]
    return round9(out[0].unionByName(out[1]), "accuracy", "stderr")
