"""Plans for job logs, progress, run status and the scalar helpers
(SURVEY 2.1 scan_progress_lines, 2.2, 2.3, 2.8 run_*, 2.10, 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalframe.fixtures import fixture
from evalframe.functions import scalars as S
from evalframe.operators import progress as PR
from evalframe.operators import samples as SM
from evalframe.operators import status as ST
from evalframe.plans.common import round9
from evalframe.plans.registry import plan
from evalframe.sources import lines as LN

NOW = "2024-02-01 00:00:00"

# DuckDB: per-line updates, then the fold with plain line-level windows.
PROGRESS_CTE = r"""
, pl as (select job_id, seq, ts, line,
    case when regexp_matches(line, '^[ \t\r\n]*\{') and json_valid(plain) then plain end as j
  from (select *, replace(replace(line, ':NaN', ':0'), '"completed":1,"completed":', '"completed":') as plain from fx_progress) x)
, pu as (select job_id, seq, ts, line,
    coalesce(try_cast(json_extract(j, '$.progress.completed') as bigint),
             try_cast(json_extract(j, '$.results.completed_samples') as bigint)) as sv,
    greatest(try_cast(json_extract(j, '$.sample.completed') as bigint),
             try_cast(json_extract(j, '$.sample.index') as bigint) + 1,
             case when json_extract_string(j, '$.event') in ('sample_complete', 'sample_success', 'sample')
                  then try_cast(json_extract(j, '$.completed') as bigint) end) as rv,
    coalesce(try_cast(json_extract(j, '$.sample.total') as bigint), try_cast(json_extract(j, '$.progress.total') as bigint),
             try_cast(json_extract(j, '$.results.total_samples') as bigint)) as tot
  from pl)
, ps as (select *, sum(case when sv is not null then 1 else 0 end) over (partition by job_id order by seq
           rows between unbounded preceding and current row) as seg,
         last_value(tot ignore nulls) over (partition by job_id order by seq
           rows between unbounded preceding and current row) as run_tot
  from pu)
, ph as (select job_id, seq, ts, run_tot,
    case when seg = 0 then greatest(0, coalesce(m, 0)) else m end as completed
  from (select *, max(case when sv is not null then greatest(sv, rv) else rv end)
          over (partition by job_id, seg order by seq rows between unbounded preceding and current row) as m from ps) x)
, pf as (select job_id, arg_max(completed, seq) as samples_completed, arg_max(run_tot, seq) as total_samples,
    arg_max(ts, seq) as last_update, count(*) as n_lines from ph group by job_id)
"""


def _lines(spark, sf):
    return fixture(spark, sf, "fx_progress").select("job_id", "seq", "ts", "line")


@plan("progress_fold", PROGRESS_CTE + "select job_id, samples_completed, total_samples, last_update, n_lines from pf",
      ("fx_progress",))
def q_progress_fold(spark, sf):
    return PR.progress_fold(_lines(spark, sf))


@plan("progress_history", PROGRESS_CTE +
      "select job_id, seq, ts, completed as samples_completed, run_tot as total_samples from ph", ("fx_progress",))
def q_progress_history(spark, sf):
    # a small piece size makes the cross-piece carry do real work on the fixture
    return PR.progress_history(_lines(spark, sf), bucket=512)


@plan("log_tail", r"""
select job_id, seq, regexp_replace(line, '\s+$', '') as line
from (select *, row_number() over (partition by job_id order by seq desc) as rn from fx_progress) t where rn <= 200""",
      ("fx_progress",))
def q_log_tail(spark, sf):
    return PR.log_tail(_lines(spark, sf), 200)


@plan("filter_json_objects", r"""
select job_id, seq, line from fx_progress where regexp_matches(line, '^[ \t\r\n]*\{') and json_valid(replace(line, ':NaN', ':0'))""",
      ("fx_progress",))
def q_filter_json_objects(spark, sf):
    return SM.filter_json_objects(_lines(spark, sf)).select("job_id", "seq", "line")


@plan("scan_progress_lines", "select job_id, seq, ts, line from fx_progress", ("fx_progress",))
def q_scan_progress_lines(spark, sf):
    path = LN.write_lines(spark, _lines(spark, sf), "progress-lines")
    return LN.scan_progress_lines(spark, path)


# ---- run status ----

@plan("run_status_counts", """
select run_id, count(*) as total, count(*) filter (where status = 'complete') as complete,
  count(*) filter (where status = 'failed') as failed, count(*) filter (where status = 'cancelled') as cancelled,
  count(*) filter (where status = 'running') as running, count(*) filter (where status = 'queued') as queued
from fx_jobs group by run_id""", ("fx_jobs",))
def q_run_status_counts(spark, sf):
    return ST.run_status_counts(fixture(spark, sf, "fx_jobs"))


@plan("run_overall_status", """
, c as (select r.run_id, count(j.job_id) as total,
    count(*) filter (where j.status = 'complete') as complete, count(*) filter (where j.status = 'failed') as failed,
    count(*) filter (where j.status = 'cancelled') as cancelled, count(*) filter (where j.status = 'running') as running,
    count(*) filter (where j.status = 'queued') as queued
  from fx_runs r left join fx_jobs j on j.run_id = r.run_id group by r.run_id)
select *, case
  when running = 0 and queued = total and total > 0 then 'queued'
  when complete = total and total > 0 then 'complete'
  when failed > 0 and failed + complete + cancelled = total then 'failed'
  when cancelled = total and total > 0 then 'cancelled'
  when total = 0 then 'empty' else 'running' end as status
from c""", ("fx_runs", "fx_jobs"))
def q_run_overall_status(spark, sf):
    return ST.run_overall_status(fixture(spark, sf, "fx_runs"), fixture(spark, sf, "fx_jobs"))


_ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S') || case when epoch_us({t}) % 1000000 <> 0 then '.' || strftime({t}, '%f') else '' end || '+00:00'"


def iso_sql(t: str) -> str:
    return f"case when {t} is null or epoch_us({t}) = 0 then null else {_ISO.format(t=t)} end"


_RUN_COUNTS = """
, c as (select r.run_id, count(j.job_id) as total,
    count(*) filter (where j.status = 'complete') as complete, count(*) filter (where j.status = 'failed') as failed,
    count(*) filter (where j.status = 'cancelled') as cancelled, count(*) filter (where j.status = 'running') as running,
    count(*) filter (where j.status = 'queued') as queued
  from fx_runs r left join fx_jobs j on j.run_id = r.run_id group by r.run_id)
"""


@plan("run_report", PROGRESS_CTE + _RUN_COUNTS + f"""
, models as (select j.run_id, string_agg(j.job_id || ':' || j.status || ':' || coalesce(j.provider, '-') || ':' || coalesce(pf.samples_completed, 0), ' ' order by j.job_id) as models,
    max(j.last_update) as last from fx_jobs j left join pf on pf.job_id = j.job_id group by j.run_id)
select r.run_id, r.task, {iso_sql('r.created_at')} as created_at, {iso_sql('greatest(r.created_at, last)')} as updated_at,
  total, complete, failed, cancelled, running, queued, case
  when running = 0 and queued = total and total > 0 then 'queued' when complete = total and total > 0 then 'complete'
  when failed > 0 and failed + complete + cancelled = total then 'failed' when cancelled = total and total > 0 then 'cancelled'
  when total = 0 then 'empty' else 'running' end as status, coalesce(models, '') as models
from fx_runs r join c using (run_id) left join models using (run_id)""", ("fx_progress", "fx_runs", "fx_jobs"))
def q_run_report(spark, sf):
    jobs = _job_state(spark, sf).join(PR.progress_fold(_lines(spark, sf)).select("job_id", "samples_completed", "total_samples"), "job_id", "left")
    out = ST.run_report(fixture(spark, sf, "fx_runs"), jobs, NOW)
    models = F.array_join(F.transform("models", lambda m: F.concat_ws(":", m["job_id"].cast("string"), m["status"], F.coalesce(m["provider"], F.lit("-")),
                                                                      m["samples_completed"].cast("string"))), " ")
    return out.select("run_id", "task", "created_at", "updated_at", "overall.*", models.alias("models"))


@plan("run_updated_at", f"""
select r.run_id, {iso_sql('greatest(r.created_at, max(j.last_update))')} as updated_at
from fx_runs r left join fx_jobs j on j.run_id = r.run_id group by r.run_id, r.created_at""", ("fx_runs", "fx_jobs"))
def q_run_updated_at(spark, sf):
    return ST.run_updated_at(fixture(spark, sf, "fx_runs"), fixture(spark, sf, "fx_jobs"))


# ---- job-level projections and scalars ----

_JOB_STATE_SQL = """
select j.*, case when j.status in ('complete', 'failed', 'cancelled') then j.last_update end as finished_at,
  case when j.status = 'failed' then 'Exited with code ' || cast(j.returncode as varchar) end as error
from fx_jobs j
"""


def _job_state(spark, sf):
    j = fixture(spark, sf, "fx_jobs")
    return j.select("*", F.when(F.col("status").isin("complete", "failed", "cancelled"), F.col("last_update"))
                    .alias("finished_at"),
                    F.when(F.col("status") == "failed", F.concat(F.lit("Exited with code "),
                                                                 F.col("returncode").cast("string"))).alias("error"))


def _fmt_sql(s: str) -> str:
    tot = f"cast(floor(greatest(0.0, {s})) as bigint)"
    h, m, sec = f"({tot} // 3600)", f"(({tot} % 3600) // 60)", f"({tot} % 60)"
    return (f"case when {s} is null then null else concat_ws(' ', "
            f"case when {h} > 0 then {h} || 'h' end, case when {m} > 0 then {m} || 'm' end, "
            f"case when ({h} = 0 and {m} = 0) or ({sec} > 0 and {h} < 2) then {sec} || 's' end) end")


_ELAPSED = f"case when s.started_at is null then null else (epoch_us(coalesce(s.finished_at, timestamp '{NOW}')) - epoch_us(s.started_at)) / 1e6 end"


@plan("job_snapshot", PROGRESS_CTE + f"""
, s as (select js.*, pf.samples_completed, pf.total_samples from ({_JOB_STATE_SQL}) js left join pf on pf.job_id = js.job_id)
, e as (select s.*, {_ELAPSED} as el from s)
, r as (select e.*, case when coalesce(samples_completed, 0) = 0 or total_samples is null or total_samples = 0
          or el is null or el <= 0 then null when total_samples - coalesce(samples_completed, 0) <= 0 then 0.0
          else (total_samples - coalesce(samples_completed, 0)) * (el / coalesce(samples_completed, 0)) end as eta from e)
select job_id, model, coalesce(nullif(label, ''), split_part(model, '/', -1)) as display_name, status,
  provider, coalesce(samples_completed, 0) as samples_completed, total_samples,
  round(case when total_samples is null or total_samples = 0 then null
    else greatest(0.0, least(1.0, coalesce(samples_completed, 0) / total_samples)) end * 100, 2) as progress_percent,
  round(el, 6) as elapsed_seconds, {_fmt_sql('el')} as elapsed, round(eta, 3) as eta_seconds, {_fmt_sql('eta')} as eta,
  error, {iso_sql('started_at')} as started_at, {iso_sql('finished_at')} as finished_at, returncode
from r""", ("fx_progress", "fx_jobs"))
def q_job_snapshot(spark, sf):
    state = _job_state(spark, sf).join(PR.progress_fold(_lines(spark, sf)).select(
        "job_id", "samples_completed", "total_samples"), "job_id", "left")
    snap = ST.job_snapshot(state, NOW)
    return snap.withColumn("elapsed_seconds", F.round("elapsed_seconds", 6)).withColumn("eta_seconds", F.round("eta_seconds", 3))


@plan("job_display_name", "select job_id, coalesce(nullif(label, ''), split_part(model, '/', -1)) as display_name "
      "from fx_jobs", ("fx_jobs",))
def q_job_display_name(spark, sf):
    return fixture(spark, sf, "fx_jobs").select("job_id", S.display_name("label", "model").alias("display_name"))


@plan("resolve_task_alias", """
select job_id, requested_task, case requested_task when 'teleqna_bench' then 'teleqna'
  when 'telelogs_bench' then 'telelogs' else requested_task end as task from fx_task_requests""",
      ("fx_task_requests",))
def q_resolve_task_alias(spark, sf):
    return SM.resolve_task_alias(fixture(spark, sf, "fx_task_requests"))


@plan("index_to_letter", "select sample_id, chr(cast(65 + answer as int)) as letter from fx_samples", ("fx_samples",))
def q_index_to_letter(spark, sf):
    return fixture(spark, sf, "fx_samples").select("sample_id", S.index_to_letter("answer").alias("letter"))


@plan("normalise_category", "select sample_id, replace(lower(category), ' ', '_') as category_key from fx_yaml_tasks",
      ("fx_yaml_tasks",))
def q_normalise_category(spark, sf):
    return fixture(spark, sf, "fx_yaml_tasks").select("sample_id",
                                                      S.normalise_category("category").alias("category_key"))


@plan("iso_timestamp", f"select job_id, {iso_sql('started_at')} as started_iso, {iso_sql('last_update')} as updated_iso "
      "from fx_jobs", ("fx_jobs",))
def q_iso_timestamp(spark, sf):
    return fixture(spark, sf, "fx_jobs").select("job_id", S.iso_timestamp("started_at").alias("started_iso"),
                                                S.iso_timestamp("last_update").alias("updated_iso"))


_DUR = "(epoch_us(last_update) - epoch_us(started_at)) / 1e6"


@plan("format_duration", f"""
select job_id, {_fmt_sql(_DUR)} as d_span, {_fmt_sql(_DUR + ' / 3600.0')} as d_short,
  {_fmt_sql(_DUR + ' / 200.0')} as d_mid, {_fmt_sql('-' + _DUR)} as d_negative from fx_jobs""", ("fx_jobs",))
def q_format_duration(spark, sf):
    j = fixture(spark, sf, "fx_jobs")
    d = (F.unix_micros(F.col("last_update").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / F.lit(1e6)
    return j.select("job_id", S.format_duration(d).alias("d_span"), S.format_duration(d / 3600.0).alias("d_short"),
                    S.format_duration(d / 200.0).alias("d_mid"), S.format_duration(-d).alias("d_negative"))


_RATIO_IN = """(select job_id, job_id % 120 - 5 as completed,
  case job_id % 4 when 0 then 0 when 1 then null else 100 end as total from fx_jobs)"""


def _ratio_input(spark, sf):
    j = fixture(spark, sf, "fx_jobs")
    return j.select("job_id", (F.col("job_id") % 120 - 5).alias("completed"),
                    F.when(F.col("job_id") % 4 == 0, F.lit(0)).when(F.col("job_id") % 4 == 1, F.lit(None))
                    .otherwise(F.lit(100)).alias("total"))


_RATIO_SQL = "case when total is null or total = 0 then null else greatest(0.0, least(1.0, completed / total)) end"


@plan("progress_ratio", f"select job_id, round({_RATIO_SQL}, 9) as ratio from {_RATIO_IN} t", ("fx_jobs",))
def q_progress_ratio(spark, sf):
    return round9(_ratio_input(spark, sf).select("job_id", S.progress_ratio("completed", "total").alias("ratio")),
                  "ratio")


@plan("progress_percent", f"select job_id, round({_RATIO_SQL} * 100, 2) as percent from {_RATIO_IN} t", ("fx_jobs",))
def q_progress_percent(spark, sf):
    return _ratio_input(spark, sf).select("job_id", S.progress_percent("completed", "total").alias("percent"))


@plan("elapsed_seconds", f"select job_id, round({_ELAPSED}, 9) as elapsed_seconds from ({_JOB_STATE_SQL}) s",
      ("fx_jobs",))
def q_elapsed_seconds(spark, sf):
    return round9(_job_state(spark, sf).select(
        "job_id", S.elapsed_seconds("started_at", "finished_at", F.lit(NOW)).alias("elapsed_seconds")),
        "elapsed_seconds")


@plan("estimate_remaining", f"""
select job_id, round(case when coalesce(c, 0) = 0 or t is null or t = 0 or el is null or el <= 0 then null
  when t - c <= 0 then 0.0 else (t - c) * (el / c) end, 3) as eta_seconds
from (select s.job_id, s.job_id % 120 - 5 as c, case s.job_id % 4 when 0 then 0 when 1 then null else 100 end as t,
        {_ELAPSED} as el from ({_JOB_STATE_SQL}) s) x""", ("fx_jobs",))
def q_estimate_remaining(spark, sf):
    s = _job_state(spark, sf)
    c = F.col("job_id") % 120 - 5
    t = F.when(F.col("job_id") % 4 == 0, F.lit(0)).when(F.col("job_id") % 4 == 1, F.lit(None)).otherwise(F.lit(100))
    eta = S.estimate_remaining(c, t, "started_at", "finished_at", F.lit(NOW))
    # seconds to the millisecond: values near 1e8 differ between engines in the 17th digit
    return s.select("job_id", F.round(eta, 3).alias("eta_seconds"))


@plan("job_outcome", """
select job_id, case when exc is not null then 'failed' when cancel_requested then 'cancelled'
    when returncode = 0 then 'complete' else 'failed' end as status,
  case when exc is not null then exc when cancel_requested or returncode = 0 then null
    else 'Exited with code ' || cast(returncode as varchar) end as error
from (select *, case when job_id % 11 = 0 then 'worker crashed on job ' || cast(job_id as varchar) end as exc
      from fx_jobs) t""", ("fx_jobs",))
def q_job_outcome(spark, sf):
    j = fixture(spark, sf, "fx_jobs")
    exc = F.when(F.col("job_id") % 11 == 0, F.concat(F.lit("worker crashed on job "), F.col("job_id").cast("string")))
    o = S.job_outcome("cancel_requested", "returncode", exc)
    return j.select("job_id", o["status"].alias("status"), o["error"].alias("error"))
