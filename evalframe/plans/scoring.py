"""Plans for answer parsing and per-row scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalframe.fixtures import fixture
from evalframe.functions import parse as P
from evalframe.functions import score as SC  # noqa: F401
from evalframe.operators import scoring as ST
from evalframe.plans.common import CHOICE_FIXTURES, CHOICE_SCORES_CTE, choice_samples, choice_scores
from evalframe.plans.registry import plan


@plan("parse_choice", CHOICE_SCORES_CTE + "select model, sample_id, epoch, answer from choice_scores",
      CHOICE_FIXTURES)
def q_parse_choice(spark, sf):
    return choice_scores(spark, sf).select("model", "sample_id", "epoch", "answer")


@plan("score_choice", CHOICE_SCORES_CTE + "select model, sample_id, epoch, answer, value from choice_scores",
      CHOICE_FIXTURES)
def q_score_choice(spark, sf):
    return choice_scores(spark, sf)


_BOXED_SQL = r"""
select sample_id, answer as target,
  coalesce(rtrim(ltrim(regexp_replace(regexp_replace(
    regexp_extract_all(completion, '\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}', 1)[-1],
    '^\s+|\s+$', '', 'g'), '\n\s*', '', 'g'), ':'), './'), '') as parsed
from fx_math
"""


@plan("parse_boxed", "select sample_id, parsed from (" + _BOXED_SQL + ") t", ("fx_math",))
def q_parse_boxed(spark, sf):
    m = fixture(spark, sf, "fx_math")
    return m.select("sample_id", P.parse_boxed("completion").alias("parsed"))


@plan("score_boxed",
      "select sample_id, parsed as answer, case when parsed = target then 1.0 else 0.0 end as value from ("
      + _BOXED_SQL + ") t", ("fx_math",))
def q_score_boxed(spark, sf):
    m = fixture(spark, sf, "fx_math")
    return ST.score_boxed_table(m, ["sample_id"], "completion", "answer")


def _wg_sql(c: str) -> str:
    hit = f"regexp_extract(upper({c}), '([A-Z]+[0-9]+(?:-[A-Z]+)?)', 1)"
    return (f"case when {c} is null or {c} = '' then '' when {hit} <> '' then {hit} "
            f"else regexp_replace({c}, '^\\s+|\\s+$', '', 'g') end")


_WG_SQL = f"""
select sample_id, {_wg_sql('completion')} as answer, {_wg_sql('target')} as truth from fx_working_group
"""


@plan("parse_working_group", "select sample_id, answer as parsed_completion, truth as parsed_target from ("
      + _WG_SQL + ") t", ("fx_working_group",))
def q_parse_working_group(spark, sf):
    w = fixture(spark, sf, "fx_working_group")
    return w.select("sample_id", P.parse_working_group("completion").alias("parsed_completion"),
                    P.parse_working_group("target").alias("parsed_target"))


@plan("score_working_group", """
select sample_id, answer, case when lower(answer) = lower(truth) then 1.0 else 0.0 end as value,
  'Predicted: ' || answer || ', Ground Truth: ' || truth || '. Match: ' ||
  case when lower(answer) = lower(truth) then 'True' else 'False' end as explanation
from (""" + _WG_SQL + ") t", ("fx_working_group",))
def q_score_working_group(spark, sf):
    return ST.score_working_group_table(fixture(spark, sf, "fx_working_group"), ["sample_id"])


_GRADE_SQL = r"""
select sample_id, judge_model,
  try_cast(nullif(regexp_extract(judge_output, '""" + P.FINAL_SCORE_PATTERN + r"""', 1), '') as double) as grade
from fx_judge
"""


@plan("parse_judge_grade", "select sample_id, judge_model, coalesce(grade, 0.0) as grade, grade is not null as parsed from ("
      + _GRADE_SQL + ") t", ("fx_judge",))
def q_parse_judge_grade(spark, sf):
    return ST.judge_grade_table(fixture(spark, sf, "fx_judge"), ["sample_id", "judge_model"])


@plan("score_multi_judge", "select sample_id, round(avg(coalesce(grade, 0.0)), 9) as value, count(*) as n_judges from ("
      + _GRADE_SQL + ") t group by sample_id", ("fx_judge",))
def q_score_multi_judge(spark, sf):
    from evalframe.operators.judging import multi_judge_mean
    graded = ST.judge_grade_table(fixture(spark, sf, "fx_judge"), ["sample_id", "judge_model"])
    out = multi_judge_mean(graded.withColumnRenamed("grade", "value"), ("sample_id",))
    return out.select("sample_id", F.round("value", 9).alias("value"), "n_judges")


_JSON_SQL = r"""
select sample_id, judge_output, b,
  case when b is not null then coalesce(try_cast(json_extract_string(b, '$.overall_score') as double), 0.0) else 0.0 end as value,
  json_extract_string(b, '$.reasoning') as reasoning,
  case when judge_output like '%NaN%' then cast('NaN' as double) else try_cast(json_extract(b, '$.confidence') as double) end as confidence,
  try_cast(json_extract(b, '$.is_safe') as boolean) as is_safe
from (select sample_id, judge_output,
        case when json_valid(body) and regexp_matches(body, '^[ \t\r\n]*\{') then body end as b
      from (select sample_id, judge_output,
              replace(replace(coalesce(nullif(regexp_extract(judge_output, '(?s)\{.*\}', 0), ''), judge_output), ': NaN', ': null'),
                '"overall_score": 3, "overall_score"', '"overall_score"') as body
            from fx_judge_json) x) y
"""


@plan("parse_judge_json", "select sample_id, b is not null as parsed, value as overall_score, reasoning from ("
      + _JSON_SQL + ") t", ("fx_judge_json",))
def q_parse_judge_json(spark, sf):
    d = ST.parse_judge_json_table(fixture(spark, sf, "fx_judge_json"), ["sample_id"])
    v = F.col("judge_doc")
    return d.select("sample_id", v.isNotNull().alias("parsed"), F.coalesce(P.judge_number(v, "overall_score"), F.lit(0.0)).alias("overall_score"),
                    v["reasoning"].alias("reasoning"))


@plan("score_judge_json", """
select sample_id, value, judge_output as answer,
  case when b is null then 'Failed to parse JSON: ' || judge_output else coalesce(reasoning, b) end as explanation,
  confidence, is_safe
from (""" + _JSON_SQL + ") t", ("fx_judge_json",))
def q_score_judge_json(spark, sf):
    s = ST.score_judge_json_table(fixture(spark, sf, "fx_judge_json"), ["sample_id"])
    return s.select("sample_id", "value", "answer", "explanation", "confidence", "is_safe")
