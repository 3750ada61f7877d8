"""Plans for the suite's seven tasks run end to end with their defaults
(``evalframe.suite``): records -> samples -> scores -> the task's report."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalframe import suite as SU
from evalframe.fixtures import fixture
from evalframe.plans.common import CHOICE_FIXTURES, CHOICE_SCORES_CTE, round9
from evalframe.plans.metric_plans import _vote_ctes
from evalframe.plans.registry import plan
from evalframe.functions import prompt_texts as T
from evalframe.operators import generate as G
from evalframe.operators import rubric as RB
from evalframe.plans.sample_plans import MODELS, _judge_prompt_sql, rubric_values_sql, sql_lit, stub_grader
from evalframe.plans.scoring import _BOXED_SQL, _WG_SQL
from evalframe.session import work_dir

MODEL = "lab/model-0"


def _report(name, scores):
    out = SU.report(name, scores)
    return round9(out, *[c for c in out.columns if c not in ("model", "task", "n_samples")])


def _one_epoch(df, model=MODEL):
    return df.withColumn("model", F.lit(model)).withColumn("epoch", F.lit(1))


def _summary_sql(task: str, per: str, value: str, metric: str = "accuracy") -> str:
    """Per-model count, mean and standard error of ``value`` over the
    per-sample relation ``per`` (which has a ``model`` column)."""
    return f"""
select model, '{task}' as task, count(*) as n_samples, round(avg({value}), 9) as {metric},
  round(coalesce(sqrt(var_samp({value}) / count({value})), 0.0), 9) as stderr
from {per} group by model"""


_PER_SAMPLE = """
, per_sample as (select model, sample_id, avg(value) as m from choice_scores group by model, sample_id)
"""


@plan("eval_teleqna", CHOICE_SCORES_CTE + _PER_SAMPLE + _summary_sql("teleqna", "per_sample", "m"), CHOICE_FIXTURES)
def q_eval_teleqna(spark, sf):
    samples = SU.load_samples("teleqna", fixture(spark, sf, "fx_samples"))
    return _report("teleqna", SU.score("teleqna", fixture(spark, sf, "fx_completions"), samples))


@plan("eval_telelogs", CHOICE_SCORES_CTE + _PER_SAMPLE + _vote_ctes(None) + """
, mk as (select model, avg(ok) as maj from maj group by model)
select s.*, round(mk.maj, 9) as maj_at_k from (""" + _summary_sql("telelogs", "per_sample", "m") + """) s
join mk on mk.model = s.model""", CHOICE_FIXTURES)
def q_eval_telelogs(spark, sf):
    samples = SU.load_samples("telelogs", fixture(spark, sf, "fx_samples"))
    return _report("telelogs", SU.score("telelogs", fixture(spark, sf, "fx_completions"), samples))


@plan("eval_three_gpp", CHOICE_SCORES_CTE + _PER_SAMPLE + _summary_sql("three_gpp", "per_sample", "m"),
      CHOICE_FIXTURES)
def q_eval_three_gpp(spark, sf):
    records = fixture(spark, sf, "fx_samples").select("sample_id", "ord", F.col("question").alias("input"),
                                                      "choices", F.col("index_str").alias("index"))
    samples = SU.load_samples("three_gpp", records)
    return _report("three_gpp", SU.score("three_gpp", fixture(spark, sf, "fx_completions"), samples))


@plan("eval_telemath", _summary_sql("telemath", f"""(select '{MODEL}' as model,
  case when parsed = target then 1.0 else 0.0 end as v from ({_BOXED_SQL}) b) t""", "v"), ("fx_math",))
def q_eval_telemath(spark, sf):
    m = fixture(spark, sf, "fx_math")
    samples = SU.load_samples("telemath", m)
    comp = _one_epoch(m.select("sample_id", "completion"))
    return _report("telemath", SU.score("telemath", comp, samples))


@plan("eval_old_three_gpp", _summary_sql("old_three_gpp", f"""(select '{MODEL}' as model,
  case when lower(answer) = lower(truth) then 1.0 else 0.0 end as v from ({_WG_SQL}) w) t""", "v"),
      ("fx_working_group",))
def q_eval_old_three_gpp(spark, sf):
    w = fixture(spark, sf, "fx_working_group")
    records = w.select("sample_id", F.concat(F.lit("Which working group wrote document "),
                                              F.col("sample_id").cast("string"), F.lit("?")).alias("question"),
                       F.col("target").alias("answer"))
    samples = SU.load_samples("old_three_gpp", records)
    comp = _one_epoch(w.select("sample_id", "completion"))
    return _report("old_three_gpp", SU.score("old_three_gpp", comp, samples))


# ---- graded tasks: samples -> work -> completions -> grader inputs -> replies -> report ----

JUDGES = ("judge-a", "judge-b")


def stub_config_model(pdf):
    """Stand-in for a model client; the reply shows which system prompt and question it was given."""
    return [f"kind: Reply # {m} {len(s)} {q}" for m, s, q in zip(pdf["model"], pdf["system_prompt"], pdf["prompt"])]


def stub_json_grader(pdf):
    """Stand-in for a JSON grader: a score from the length of the user message."""
    return [f'{{"overall_score": {len(m[1]["content"]) % 11}, "reasoning": "read"}}' for m in pdf["messages"]]


def _config_records(spark, sf):
    return fixture(spark, sf, "fx_yaml_tasks").select(
        "sample_id", "Question", F.concat(F.lit("expected config "), F.col("sample_id").cast("string")).alias("Answer"),
        F.col("main_category").alias("Main Category"), F.col("category").alias("Category"), F.col("context").alias("Context"))


def _graded_chain(spark, sf, name, judges, grader):
    """Grader replies of a graded task from its records on; what a model returned is written before it is used."""
    samples = SU.load_samples(name, _config_records(spark, sf))
    work = SU.work(name, samples, MODELS)
    completions = G.run_in_slices(work, lambda part: G.generate_completions(part, stub_config_model, max_connections=4),
                                  work_dir(spark, f"{name}-completions"), slices=2)
    asked = SU.grader_work(name, completions, samples, judges, RB.rubric_table(spark))
    return G.persist_completions(G.generate_judgements(asked, grader), work_dir(spark, f"{name}-replies"))


def _chain_sql(template: str) -> str:
    """The stub's completions: system prompt filled by successive replaces (no value holds a later placeholder that the template names)."""
    filled = sql_lit(template)
    for name, col in (("Main Category", "main_category"), ("Category", "category"), ("Context", "context")):
        filled = f"replace({filled}, '{{{name}}}', coalesce({col}, ''))"
    return f"""
, done as (select sample_id, Question as question, category, 'expected config ' || sample_id as target, m.model,
    'kind: Reply # ' || m.model || ' ' || length({filled}) || ' ' || Question as answer
  from fx_yaml_tasks cross join (values ('lab/model-0'), ('lab/model-1')) m(model))"""


_CHAIN_GRADED = _chain_sql(T.CONFIG_SYSTEM_TEMPLATE) + f"""
, graded as (select a.model, a.sample_id, avg((length({_judge_prompt_sql()}) + length(j.judge)) % 101) as m
  from done a join {rubric_values_sql()} on rb.category_key = replace(lower(a.category), ' ', '_')
  cross join (values ('judge-a'), ('judge-b')) j(judge) group by a.model, a.sample_id)"""


@plan("eval_teleyaml", _CHAIN_GRADED + _summary_sql("teleyaml", "graded", "m"), ("fx_yaml_tasks",))
def q_eval_teleyaml(spark, sf):
    return _report("teleyaml", SU.score_replies("teleyaml", _graded_chain(spark, sf, "teleyaml", JUDGES, stub_grader)))


@plan("eval_legacy_teleyaml", _chain_sql(T.LEGACY_CONFIG_SYSTEM_TEMPLATE) + """
, graded as (select model, sample_id, cast(length(chr(10) || '[Question]' || chr(10) || question || chr(10) || chr(10) || '[Ground Truth]'
    || chr(10) || target || chr(10) || chr(10) || '[Model Response]' || chr(10) || answer || chr(10)) % 11 as double) as m from done)
""" + _summary_sql("legacy_teleyaml", "graded", "m", "mean"), ("fx_yaml_tasks",))
def q_eval_legacy_teleyaml(spark, sf):
    replies = _graded_chain(spark, sf, "legacy_teleyaml", ["grader"], stub_json_grader)
    return _report("legacy_teleyaml", SU.score_replies("legacy_teleyaml", replies))


_SET_BOXED = f"""(select '{MODEL}' as model, case when parsed = target then 1.0 else 0.0 end as v
  from ({_BOXED_SQL}) b) t"""


@plan("eval_set", CHOICE_SCORES_CTE + _PER_SAMPLE + _vote_ctes(None) + _CHAIN_GRADED + """
, mk as (select model, avg(ok) as maj from maj group by model)
select *, cast(null as double) as maj_at_k from (""" + _summary_sql("teleqna", "per_sample", "m") + """) a
union all
select s.*, round(mk.maj, 9) as maj_at_k from (""" + _summary_sql("telelogs", "per_sample", "m") + """) s
join mk on mk.model = s.model
union all
select *, cast(null as double) as maj_at_k from (""" + _summary_sql("three_gpp", "per_sample", "m") + """) d
union all
select *, cast(null as double) as maj_at_k from (""" + _summary_sql("teleyaml", "graded", "m") + """) e
union all
select *, cast(null as double) as maj_at_k from (""" + _summary_sql("telemath", _SET_BOXED, "v") + ") c",
      CHOICE_FIXTURES + ("fx_math", "fx_yaml_tasks"))
def q_eval_set(spark, sf):
    """The five default tasks from one completions and one reply table."""
    math, choices = fixture(spark, sf, "fx_math"), fixture(spark, sf, "fx_samples")
    indexed = choices.select("sample_id", "ord", F.col("question").alias("input"), "choices", F.col("index_str").alias("index"))
    records = {"teleyaml": _config_records(spark, sf), "telelogs": choices, "telemath": math, "teleqna": choices, "three_gpp": indexed}
    choice = fixture(spark, sf, "fx_completions")
    completions = _one_epoch(math.select("sample_id", "completion")).withColumn("task", F.lit("telemath"))
    for name in ("teleqna", "telelogs", "three_gpp"):
        completions = completions.unionByName(choice.withColumn("task", F.lit(name)))
    replies = _graded_chain(spark, sf, "teleyaml", JUDGES, stub_grader).withColumn("task", F.lit("teleyaml"))
    out = SU.eval_set_report(records, completions, replies)
    return round9(out, "accuracy", "stderr", "maj_at_k")
