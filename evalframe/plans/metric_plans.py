"""Plans for metrics and ordered operators over scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalframe.fixtures import fixture
from evalframe.functions import parse as P
from evalframe.functions import score as SC
from evalframe.operators import metrics as M
from evalframe.operators import samples as SM
from evalframe.plans.common import CHOICE_FIXTURES, CHOICE_SCORES_CTE, choice_scores, round9
from evalframe.plans.registry import plan

# DuckDB pieces written with windows, independent of the Spark aggregation.
_PER_SAMPLE = """
, per_sample as (select model, sample_id, avg(value) as m, count(*) as n from choice_scores group by model, sample_id)
"""


def _vote_ctes(k: int | None) -> str:
    cond = f"epoch <= {k} and " if k else ""
    return f"""
, votes as (select model, sample_id, answer, count(*) as votes, min(epoch) as fe,
                   max(case when value = 1 then 1 else 0 end) as ok
            from choice_scores where {cond} answer <> '' group by model, sample_id, answer)
, ranked as (select *, row_number() over (partition by model, sample_id order by votes desc, fe) as rn from votes)
, maj as (select p.model, p.sample_id, coalesce(r.ok, 0) as ok from per_sample p
          left join ranked r on r.model = p.model and r.sample_id = p.sample_id and r.rn = 1)
"""


@plan("metric_accuracy", CHOICE_SCORES_CTE + _PER_SAMPLE +
      "select model, round(avg(m), 9) as accuracy from per_sample group by model", CHOICE_FIXTURES)
def q_metric_accuracy(spark, sf):
    return round9(M.accuracy(choice_scores(spark, sf)), "accuracy")


@plan("metric_stderr", CHOICE_SCORES_CTE + _PER_SAMPLE +
      "select model, round(coalesce(sqrt(var_samp(m) / count(m)), 0.0), 9) as stderr from per_sample group by model",
      CHOICE_FIXTURES)
def q_metric_stderr(spark, sf):
    return round9(M.stderr(choice_scores(spark, sf)), "stderr")


_GRADES = r"""
, grades as (select judge_model, coalesce(try_cast(nullif(regexp_extract(judge_output,
    '""" + P.FINAL_SCORE_PATTERN + r"""', 1), '') as double), 0.0) as value from fx_judge)
"""


@plan("metric_mean", _GRADES + """
select judge_model, round(avg(value), 9) as mean, round(coalesce(sqrt(var_samp(value) / count(value)), 0.0), 9) as stderr,
  count(value) as n from grades group by judge_model""", ("fx_judge",))
def q_metric_mean(spark, sf):
    j = fixture(spark, sf, "fx_judge")
    g = j.select("judge_model", SC.score_judge_grade("judge_output")["value"].alias("value"))
    return round9(M.mean(g, ("judge_model",)), "mean", "stderr")


@plan("metric_maj_at_k", CHOICE_SCORES_CTE + _PER_SAMPLE + _vote_ctes(None) +
      "select model, round(sum(ok) / count(*), 9) as maj_at_k from maj group by model", CHOICE_FIXTURES)
def q_metric_maj_at_k(spark, sf):
    return round9(M.maj_at_k(choice_scores(spark, sf)), "maj_at_k")


@plan("metric_const_at_16", CHOICE_SCORES_CTE + _PER_SAMPLE + _vote_ctes(16) +
      "select model, round(sum(ok) / count(*), 9) as const_at_16 from maj group by model", CHOICE_FIXTURES)
def q_metric_const_at_16(spark, sf):
    return round9(M.maj_at_k(choice_scores(spark, sf), k=16, name="const_at_16"), "const_at_16")


@plan("metric_pass_at_1", CHOICE_SCORES_CTE + _PER_SAMPLE + """
select model, round(avg(m), 9) as pass_at_1, round(coalesce(sqrt(var_samp(m) / count(m)), 0.0), 9) as stderr,
  count(*) as n_samples from per_sample group by model""", CHOICE_FIXTURES)
def q_metric_pass_at_1(spark, sf):
    return round9(M.pass_at_1(choice_scores(spark, sf)), "pass_at_1", "stderr")


@plan("eval_report", CHOICE_SCORES_CTE + _PER_SAMPLE + _vote_ctes(4) + """
select p.model, count(*) as n_samples, cast(sum(p.n) as bigint) as n_scores, round(avg(p.m), 9) as pass_at_1,
  round(coalesce(sqrt(var_samp(p.m) / count(p.m)), 0.0), 9) as stderr, round(sum(j.ok) / count(*), 9) as maj_at_4
from per_sample p join maj j on j.model = p.model and j.sample_id = p.sample_id group by p.model""",
      CHOICE_FIXTURES)
def q_eval_report(spark, sf):
    return round9(M.eval_report(choice_scores(spark, sf), k=4), "pass_at_1", "stderr", "maj_at_4")


@plan("metrics_by_slice", CHOICE_SCORES_CTE + _PER_SAMPLE + """
select model, subject, cast(grouping(subject) as bigint) as is_full, count(*) as n_samples,
  round(avg(m), 9) as accuracy, round(coalesce(sqrt(var_samp(m) / count(m)), 0.0), 9) as stderr
from per_sample p join fx_samples s on s.sample_id = p.sample_id
group by grouping sets ((model), (model, subject))""", CHOICE_FIXTURES)
def q_metrics_by_slice(spark, sf):
    slices = fixture(spark, sf, "fx_samples").select("sample_id", "subject")
    return round9(M.metrics_by_slice(choice_scores(spark, sf), slices, "subject"), "accuracy", "stderr")


@plan("majority_answer", CHOICE_SCORES_CTE + _PER_SAMPLE + _vote_ctes(None) + """
select model, sample_id, answer, votes, cast(fe as int) as first_epoch, ok = 1 as correct from ranked where rn = 1""",
      CHOICE_FIXTURES)
def q_majority_answer(spark, sf):
    return M.majority_answer(choice_scores(spark, sf))


@plan("filter_answered", CHOICE_SCORES_CTE +
      "select model, sample_id, epoch, answer, value from choice_scores where coalesce(answer, '') <> ''",
      CHOICE_FIXTURES)
def q_filter_answered(spark, sf):
    return SM.filter_answered(choice_scores(spark, sf))
