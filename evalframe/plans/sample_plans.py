"""Plans for sources, projections, filters, joins, prompts and generation
(SURVEY 2.1-2.6, 2.10 limit_samples)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from evalframe.fixtures import fixture, table
from evalframe.functions import prompt_texts as T
from evalframe.operators import generate as G
from evalframe.operators import prompts as PM
from evalframe.operators import samples as SM
from evalframe.plans.common import CHOICE_FIXTURES, CHOICE_SCORES_CTE, choice_samples, choice_scores
from evalframe.operators.selection import first_samples
from evalframe.plans.registry import plan
from evalframe.session import work_dir
from evalframe.sources import datasets as DS


def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- projections -------------------------------------------------------------------

@plan("map_choice_records", """
select sample_id, ord, question as input, array_to_string(choices, '|') as choices_text,
  chr(cast(65 + answer as int)) as target, subject from fx_samples""", ("fx_samples",))
def q_map_choice_records(spark, sf):
    s = choice_samples(spark, sf)
    return s.select("sample_id", "ord", "input", F.array_join("choices", "|").alias("choices_text"), "target",
                    F.col("metadata.subject").alias("subject"))


@plan("map_indexed_records", """
select sample_id, ord, question as input, chr(cast(65 + cast(index_str as int) as int)) as target from fx_samples""",
      ("fx_samples",))
def q_map_indexed_records(spark, sf):
    s = fixture(spark, sf, "fx_samples")
    return SM.map_indexed_records(s, input_col="question", index_col="index_str").select(
        "sample_id", "ord", "input", "target")


@plan("map_field_spec", """
select sample_id, question as input, answer as target, category, difficulty, array_to_string(tags, '|') as tags_text
from fx_math""", ("fx_math",))
def q_map_field_spec(spark, sf):
    m = SM.map_field_spec(fixture(spark, sf, "fx_math"), "question", "answer", ["category", "tags", "difficulty"])
    return m.select("sample_id", "input", "target", "metadata.category", "metadata.difficulty",
                    F.array_join("metadata.tags", "|").alias("tags_text"))


# ---- filters -------------------------------------------------------------------------

@plan("filter_subject", "select sample_id, subject from fx_samples where subject = 'Standards Overview'",
      ("fx_samples",))
def q_filter_subject(spark, sf):
    return SM.filter_subject(fixture(spark, sf, "fx_samples"), "Standards Overview").select("sample_id", "subject")


@plan("filter_difficulty", "select sample_id, difficulty from fx_math where difficulty = 'advanced'", ("fx_math",))
def q_filter_difficulty(spark, sf):
    return SM.filter_difficulty(fixture(spark, sf, "fx_math"), "advanced").select("sample_id", "difficulty")


# ---- sources ----------------------------------------------------------------------------

_SPLIT = "case when subject in ('Research Overview', 'Standards Overview') then 'test' else 'train' end"


@plan("scan_eval_dataset", f"""
select sample_id, ord, question, answer, subject from fx_samples where {_SPLIT} = 'test'""", ("fx_samples",))
def q_scan_eval_dataset(spark, sf):
    root = work_dir(spark, "datasets")
    s = fixture(spark, sf, "fx_samples").withColumn("split", F.expr(_SPLIT))
    DS.write_eval_dataset(s.select("sample_id", "ord", "question", "answer", "subject", "split"), root, "teleqna")
    schema = StructType([StructField("sample_id", LongType()), StructField("ord", IntegerType()),
                         StructField("question", StringType()), StructField("answer", IntegerType()),
                         StructField("subject", StringType())])
    return DS.scan_eval_dataset(spark, root, "teleqna", "test", schema=schema)


@plan("write_eval_results", CHOICE_SCORES_CTE +
      "select 'telelogs' as task, model, sample_id, epoch, answer, value from choice_scores", CHOICE_FIXTURES)
def q_write_eval_results(spark, sf):
    path = work_dir(spark, "results")
    DS.write_eval_results(choice_scores(spark, sf).withColumn("task", F.lit("telelogs")), path)
    back = DS.read_eval_results(spark, path)
    return back.select("task", "model", "sample_id", "epoch", "answer", "value")


# ---- joins and the work grid --------------------------------------------------------------

@plan("join_targets", """
select c.model, c.sample_id, c.epoch, c.completion, chr(cast(65 + s.answer as int)) as target
from fx_completions c join fx_samples s on s.sample_id = c.sample_id""", CHOICE_FIXTURES)
def q_join_targets(spark, sf):
    j = SM.join_targets(fixture(spark, sf, "fx_completions"), choice_samples(spark, sf))
    return j.select("model", "sample_id", "epoch", "completion", "target")


MODELS = ["lab/model-0", "lab/model-1", ""]


@plan("expand_work_grid", """
select s.sample_id, m.model, cast(e.range as int) as epoch
from fx_samples s cross join (values ('lab/model-0'), ('lab/model-1')) m(model) cross join range(1, 4) e""",
      ("fx_samples",))
def q_expand_work_grid(spark, sf):
    return SM.expand_work_grid(fixture(spark, sf, "fx_samples"), MODELS, epochs=3).select("sample_id", "model", "epoch")


@plan("limit_samples", """
select sample_id, subject, ord from (select *, row_number() over (partition by subject order by ord, sample_id) as rn
  from fx_samples) t where rn <= 50""", ("fx_samples",))
def q_limit_samples(spark, sf):
    return SM.limit_samples(fixture(spark, sf, "fx_samples"), 50, task_col="subject").select("sample_id", "subject",
                                                                                            "ord")


# ---- prompts ---------------------------------------------------------------------------------

def _choice_prompt_sql(cot: bool) -> str:
    letters = "array_to_string(list_transform(range(len(choices)), lambda i: chr(cast(65 + i as int))), ',')"
    lines = ("array_to_string(list_transform(range(len(choices)), lambda i: chr(cast(65 + i as int)) || ') ' "
             "|| choices[i + 1]), chr(10))")
    instr = T.CHOICE_INSTRUCTION + (T.CHOICE_COT_SUFFIX if cot else "")
    head, tail = instr.split("{letters}")
    return (f"question || chr(10) || chr(10) || {lines} || chr(10) || chr(10) || {sql_lit(head)} || {letters} "
            f"|| {sql_lit(tail)}")


@plan("render_choice_prompt", f"""
select sample_id, {_choice_prompt_sql(False)} as prompt, {_choice_prompt_sql(True)} as prompt_cot from fx_samples""",
      ("fx_samples",))
def q_render_choice_prompt(spark, sf):
    s = fixture(spark, sf, "fx_samples")
    return s.select("sample_id", PM.render_choice_prompt("question", "choices").alias("prompt"),
                    PM.render_choice_prompt("question", "choices", cot=True).alias("prompt_cot"))


@plan("render_system_prompt", f"""
select sample_id, replace(replace(replace({sql_lit(T.CONFIG_SYSTEM_TEMPLATE)}, '{{Main Category}}',
  coalesce(main_category, '')), '{{Category}}', coalesce(category, '')), '{{Context}}', coalesce(context, ''))
  as system_prompt, {sql_lit(T.WORKING_GROUP_SYSTEM_TEMPLATE)} as classifier_prompt,
  {sql_lit(T.MATH_SYSTEM_TEMPLATE.replace('{{', '{').replace('}}', '}'))} as math_prompt
from fx_yaml_tasks""", ("fx_yaml_tasks",))
def q_render_system_prompt(spark, sf):
    t = fixture(spark, sf, "fx_yaml_tasks")
    fields = {"Main Category": "main_category", "Category": "category", "Context": "context"}
    return t.select("sample_id", PM.render_system_prompt(T.CONFIG_SYSTEM_TEMPLATE, fields).alias("system_prompt"),
                    PM.render_system_prompt(T.WORKING_GROUP_SYSTEM_TEMPLATE, {}).alias("classifier_prompt"),
                    PM.render_system_prompt(T.MATH_SYSTEM_TEMPLATE, {}).alias("math_prompt"))


def rubric_values_sql() -> str:
    from evalframe.operators.rubric import RUBRICS, rubric_text
    rows = ", ".join(f"({sql_lit(k)}, {sql_lit(rubric_text(k))})" for k in RUBRICS)
    return f"(values {rows}) as rb(category_key, rubric)"


def _judge_prompt_sql() -> str:
    t = sql_lit(T.RUBRIC_JUDGE_TEMPLATE)
    return (f"replace(replace(replace(replace({t}, '{{question}}', coalesce(a.question, '')), '{{rubric}}', "
            f"coalesce(rb.rubric, '')), '{{answer}}', coalesce(a.answer, '')), '{{instructions}}', "
            f"{sql_lit(T.RUBRIC_JUDGE_INSTRUCTIONS)})")


_JUDGE_PROMPTS_CTE = f"""
, jp as (select a.sample_id, {_judge_prompt_sql()} as prompt
  from fx_yaml_answers a join {rubric_values_sql()} on rb.category_key = replace(lower(a.category), ' ', '_'))
"""


def _judge_prompts(spark, sf):
    from evalframe.operators.rubric import rubric_table
    a = fixture(spark, sf, "fx_yaml_answers")
    j = SM.join_rubrics(a, rubric_table(spark))
    return j.select("sample_id", PM.render_judge_prompt("question", "rubric", "answer").alias("prompt"))


@plan("render_judge_prompt", _JUDGE_PROMPTS_CTE + "select sample_id, prompt from jp", ("fx_yaml_answers",))
def q_render_judge_prompt(spark, sf):
    return _judge_prompts(spark, sf)


@plan("build_judge_messages", f"""
select sample_id, 0 as msg_index, 'system' as role, {sql_lit(T.JSON_JUDGE_SYSTEM_PROMPT)} as content from fx_yaml_answers
union all
select sample_id, 1, 'user', chr(10) || '[Question]' || chr(10) || question || chr(10) || chr(10) || '[Ground Truth]'
  || chr(10) || target || chr(10) || chr(10) || '[Model Response]' || chr(10) || answer || chr(10) from fx_yaml_answers""",
      ("fx_yaml_answers",))
def q_build_judge_messages(spark, sf):
    a = fixture(spark, sf, "fx_yaml_answers")
    m = a.select("sample_id", F.posexplode(PM.build_judge_messages("question", "target", "answer")))
    return m.select("sample_id", F.col("pos").alias("msg_index"), "col.role", "col.content")


@plan("assemble_transcript", """
select conv_id, count(*) as n_turns,
  string_agg(role || ': ' || coalesce(text, ''), chr(10) || chr(10) order by turn) as transcript
from conversations group by conv_id""")
def q_assemble_transcript(spark, sf):
    return PM.assemble_transcript(table(spark, sf, "conversations"))


@plan("last_completion", """
select conv_id, arg_max(text, turn) as completion, max(turn) as turn from conversations where role = 'assistant'
group by conv_id""")
def q_last_completion(spark, sf):
    return PM.last_completion(table(spark, sf, "conversations"))


# ---- generation (deterministic stand-ins for the caller's model) ---------------------------------

def stub_model(pdf: pd.DataFrame) -> list[str]:
    """Stand-in for a model client: a letter from (sample, epoch, model)."""
    letters = (pdf["sample_id"] * 7 + pdf["epoch"] * 3 + pdf["model"].str.len()) % 4
    return [f"Reasoning done.\nANSWER: {chr(65 + int(v))}" for v in letters]


def stub_grader(pdf: pd.DataFrame) -> list[str]:
    """Stand-in for a grader: a score from the prompt and grader name lengths."""
    vals = (pdf["prompt"].str.len() + pdf["judge_model"].str.len()) % 101
    return [f"Checked the rubric.\n$FINAL_SCORE: {int(v)}" for v in vals]


@plan("generate_completions", """
select s.sample_id, m.model, cast(e.range as int) as epoch,
  'Reasoning done.' || chr(10) || 'ANSWER: ' || chr(cast(65 + (s.sample_id * 7 + e.range * 3 + length(m.model)) % 4 as int))
  as completion
from fx_samples s cross join (values ('lab/model-0'), ('lab/model-1')) m(model) cross join range(1, 3) e""",
      ("fx_samples",))
def q_generate_completions(spark, sf):
    s = fixture(spark, sf, "fx_samples").withColumn(
        "prompt", PM.render_choice_prompt("question", "choices"))
    path = work_dir(spark, "completions")
    # first run: one epoch, persisted; resumed run: two epochs, finished keys skipped
    first = G.generate_completions(SM.expand_work_grid(s, MODELS, 1), stub_model, max_connections=4)
    done = G.persist_completions(first, path)
    more = G.generate_completions(SM.expand_work_grid(s, MODELS, 2), stub_model, max_connections=4, done=done)
    cols = ["sample_id", "model", "epoch", "completion"]
    return done.select(*cols).unionByName(more.select(*cols))


@plan("generate_judgements", _JUDGE_PROMPTS_CTE + """
select jp.sample_id, j.judge_model, 'Checked the rubric.' || chr(10) || '$FINAL_SCORE: ' ||
  cast((length(jp.prompt) + length(j.judge_model)) % 101 as varchar) as judge_output
from jp cross join (values ('judge-a'), ('judge-b')) j(judge_model)""", ("fx_yaml_answers",))
def q_generate_judgements(spark, sf):
    return G.generate_judgements(_judge_prompts(spark, sf), stub_grader, ["judge-a", "judge-b"])


@plan("limit_samples_many", """
select model, sample_id, epoch, turn from (select model, sample_id, epoch, sample_id % 50 as turn, row_number() over (partition by model order by sample_id % 50, sample_id * 100 + epoch) as rn from fx_completions) t
where rn <= (select count(*) // 5 from fx_completions)""", ("fx_completions",))
def q_limit_samples_many(spark, sf):
    """A fifth of all completions for each model, by a column of many ties."""
    rows = fixture(spark, sf, "fx_completions").select("model", "sample_id", "epoch", (F.col("sample_id") % 50).alias("turn"), (F.col("sample_id") * 100 + F.col("epoch")).alias("place"))
    return first_samples(rows, rows.count() // 5, "model", "turn", "place", bins=64, most=500).drop("place")
