"""The evaluation suite's seven tasks as DataFrame compositions.

A task names its record mapping, slice filter, prompts, scorer and metrics.
The caller supplies the records, the completions (or a generation callable,
see ``operators.generate``) and, for the graded tasks, the grader replies.
Every step is an operator of this package:

    records -> samples (project, filter, limit) -> work grid + prompts
    completions -> join targets -> parse/score -> per-sample -> per-model report
    graded tasks: completions -> grader prompts -> replies -> grades -> report

``report`` is one chain of hash aggregates over the scores (the vote step
only when the task has a vote metric), so a model with a third of all
scores only widens the partial aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalframe.functions import prompt_texts as T
from evalframe.functions.parse import FINAL_SCORE_PATTERN
from evalframe.functions.templates import render
from evalframe.operators import metrics as M
from evalframe.operators import prompts as PM
from evalframe.operators import samples as SM
from evalframe.operators import scoring as SC
from evalframe.operators.judging import multi_judge_mean

KEYS = ["model", "sample_id", "epoch"]


@dataclass(frozen=True)
class SuiteTask:
    """``to_samples`` maps raw records to samples (sample_id, input, target,
    [choices], metadata); ``slice_col`` is the metadata field the task's
    filter reads; ``prompt_fields`` maps system-template names to sample
    columns; ``choice_cot`` is None for free generation, else the
    multiple-choice prompt with or without reasoning."""
    name: str
    to_samples: Callable[[DataFrame], DataFrame]
    scorer: str   # choice | boxed | working_group | rubric_grader | json_grader
    metrics: tuple[str, ...] = ("accuracy", "stderr")
    slice_col: str | None = None
    system_template: str | None = None
    prompt_fields: tuple[tuple[str, str], ...] = ()
    choice_cot: bool | None = None
    epochs: int = 1


def _config_samples(records: DataFrame) -> DataFrame:
    return SM.map_field_spec(records, "Question", "Answer", ["Main Category", "Category", "Context"])


_CONFIG_FIELDS = (("Main Category", "metadata.main_category"), ("Category", "metadata.category"),
                  ("Context", "metadata.context"))

TASKS: dict[str, SuiteTask] = {t.name: t for t in [
    SuiteTask("teleqna", SM.map_choice_records, "choice", slice_col="subject", choice_cot=False),
    SuiteTask("telelogs", SM.map_choice_records, "choice", ("accuracy", "stderr", "maj_at_k"),
              choice_cot=False, epochs=4),
    SuiteTask("three_gpp", SM.map_indexed_records, "choice", system_template=T.WORKING_GROUP_SYSTEM_TEMPLATE,
              choice_cot=True),
    SuiteTask("telemath", lambda r: SM.map_field_spec(r, "question", "answer", ["category", "tags", "difficulty"]),
              "boxed", slice_col="difficulty", system_template=T.MATH_SYSTEM_TEMPLATE),
    SuiteTask("old_three_gpp", lambda r: SM.map_field_spec(r, "question", "answer"), "working_group"),
    SuiteTask("teleyaml", _config_samples, "rubric_grader", system_template=T.CONFIG_SYSTEM_TEMPLATE,
              prompt_fields=_CONFIG_FIELDS),
    SuiteTask("legacy_teleyaml", _config_samples, "json_grader", ("mean", "stderr"),
              system_template=T.LEGACY_CONFIG_SYSTEM_TEMPLATE),
]}


def task(name: str) -> SuiteTask:
    if name not in TASKS:
        raise ValueError(f"Unsupported task: {name}")
    return TASKS[name]


def load_samples(name: str, records: DataFrame, slice_value: str = "full", limit: int | None = None) -> DataFrame:
    """Records -> samples of the task, filtered to one slice (``full`` keeps
    all) and cut to the first ``limit`` samples by ``ord`` (``sample_id``
    when the records carry no order)."""
    t = task(name)
    s = t.to_samples(records)
    if "ord" not in s.columns:
        s = s.withColumn("ord", F.col("sample_id"))
    if t.slice_col:
        s = SM.filter_equal(s, f"metadata.{t.slice_col}", slice_value)
    return SM.limit_samples(s, limit)


def work(name: str, samples: DataFrame, models: Sequence[str], epochs: int | None = None) -> DataFrame:
    """(model, sample_id, epoch, system_prompt, prompt) rows to generate;
    models and epochs expand inside the scan's stage."""
    t = task(name)
    grid = SM.expand_work_grid(samples, models, epochs or t.epochs)
    system = (render(t.system_template, {k: F.col(c) for k, c in t.prompt_fields}) if t.system_template
              else F.lit(None).cast("string"))
    user = F.col("input") if t.choice_cot is None else PM.render_choice_prompt("input", "choices", t.choice_cot)
    return grid.select(*KEYS, system.alias("system_prompt"), user.alias("prompt"))


def score(name: str, completions: DataFrame, samples: DataFrame) -> DataFrame:
    """Per-epoch scores ``(model, sample_id, epoch, answer, value[, explanation])``
    of a task scored on the completion itself."""
    t = task(name)
    if t.scorer == "choice":
        return SC.score_choice_table(SM.join_targets(completions, samples, ("choices", "target")), KEYS)
    j = SM.join_targets(completions, samples, ("target",))
    if t.scorer == "boxed":
        return SC.score_boxed_table(j, KEYS)
    if t.scorer == "working_group":
        return SC.score_working_group_table(j, KEYS)
    raise ValueError(f"{name} is scored from grader replies: use grader_work and score_replies")


def with_history(completions: DataFrame, turns: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Completions with a ``history`` column: the transcript of the turns (``keys``, turn, role, text) that led to each; NULL without turns."""
    told = turns.withColumn("_conv", F.to_json(F.struct(*keys)))
    history = PM.assemble_transcript(told, conv_col="_conv").select("_conv", F.col("transcript").alias("history"))
    return completions.withColumn("_conv", F.to_json(F.struct(*keys))).join(history, "_conv", "left").drop("_conv")


def grader_work(name: str, completions: DataFrame, samples: DataFrame, judges: Sequence[str],
                rubrics: DataFrame | None = None, include_history: bool = False) -> DataFrame:
    """Grader inputs per (model, sample_id, epoch, judge_model): the rubric
    grader's prompt (rubric joined by category), or the JSON grader's
    message array. Graders are expanded here and nowhere else: pass the result to
    ``generate_judgements`` without judges. With ``include_history`` the rubric grader's question is the
    completion's ``history`` (see ``with_history``), the input where it has none."""
    t = task(name)
    cols = ["input", "target", "metadata"]
    j = SM.join_targets(completions, samples, cols)
    if include_history:
        j = j.withColumn("input", F.coalesce("history", "input"))
    names = [m for m in judges if m]
    if not names:
        raise ValueError("At least one grader model must be provided")
    if t.scorer == "rubric_grader":
        if rubrics is None:
            raise ValueError("the rubric grader needs the rubric table")
        j = SM.join_rubrics(j.withColumn("category", F.col("metadata.category")), rubrics)
        payload = PM.render_judge_prompt("input", "rubric", "completion").alias("prompt")
    elif t.scorer == "json_grader":
        payload = PM.build_judge_messages("input", "target", "completion").alias("messages")
    else:
        raise ValueError(f"{name} is not a graded task")
    return j.select(*KEYS, F.explode(F.array(*[F.lit(m) for m in names])).alias("judge_model"), payload)


def score_replies(name: str, replies: DataFrame, grade_pattern: str = FINAL_SCORE_PATTERN) -> DataFrame:
    """Per-epoch scores from grader replies ``(model, sample_id, epoch,
    judge_model, judge_output)``: the mean grade over graders (group 1 of ``grade_pattern``), or the JSON
    grader's ``overall_score`` with its reasoning."""
    t = task(name)
    if t.scorer == "rubric_grader":
        graded = SC.judge_grade_table(replies, KEYS + ["judge_model"], pattern=grade_pattern)
        return multi_judge_mean(graded.withColumnRenamed("grade", "value"), KEYS)
    if t.scorer == "json_grader":
        return SC.score_judge_json_table(replies, KEYS)
    raise ValueError(f"{name} is not a graded task")


def report(name: str, scores: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """The task's metrics per keys from one scan of the scores. Epochs are
    averaged per sample first; the vote metric sees every epoch's answer."""
    t = task(name)
    keys = list(keys)
    if "maj_at_k" in t.metrics:
        per = M.sample_level(M.answer_groups(scores, keys), keys)
    else:
        per = M.sample_means(scores, keys)
    out: list[Column] = [F.count("*").alias("n_samples")]
    for m in t.metrics:
        if m in ("accuracy", "mean"):
            out.append(F.avg("mean_value").alias(m))
        elif m == "stderr":
            out.append(M.stderr_of("mean_value").alias("stderr"))
        elif m == "maj_at_k":
            out.append((F.sum(F.coalesce(F.col("maj_ok"), F.lit(0))) / F.count("*")).cast("double").alias(m))
    return per.groupBy(*keys).agg(*out).withColumn("task", F.lit(t.name))


# ---- several tasks at once (the batch driver's eval set) ---------------------------------

def eval_set_work(records: dict[str, DataFrame], models: Sequence[str], limit: int | None = None,
                  epochs: int | None = None) -> DataFrame:
    """One work table for several tasks: per task its first ``limit`` samples
    x models x epochs (each task's default epochs unless given), with a
    ``task`` column. A union of the tasks' grids: no join, no shuffle."""
    parts = [work(n, load_samples(n, r, limit=limit), models, epochs).withColumn("task", F.lit(n))
             for n, r in records.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("task", *KEYS, "system_prompt", "prompt")


def eval_set_report(records: dict[str, DataFrame], completions: DataFrame, replies: DataFrame | None = None,
                    limit: int | None = None) -> DataFrame:
    """Every task's report from one completions table keyed by ``task`` (and
    one grader-reply table keyed the same way for graded tasks); a metric a
    task does not report is NULL. ``limit`` picks the samples that are scored, of graded tasks
    too (replies to others are left out). Each task filters on ``task``: with the
    results laid out by task (``write_eval_results``) that prunes to the
    task's own files, so the tables are read once in total."""
    outs = []
    for n, r in records.items():
        samples = load_samples(n, r, limit=limit)
        if task(n).scorer in ("rubric_grader", "json_grader"):
            if replies is None:
                raise ValueError(f"{n} is scored from grader replies: pass replies=")
            own = replies.filter(F.col("task") == n).drop("task")
            if limit:
                own = own.join(samples.select("sample_id"), "sample_id", "left_semi")
            scores = score_replies(n, own)
        else:
            scores = score(n, completions.filter(F.col("task") == n).drop("task"), samples)
        outs.append(report(n, scores))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outs)
