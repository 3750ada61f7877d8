"""Table-level scorers: parse once into a named column, then derive answer,
value and explanation from it.

A Column-level scorer used in several output columns repeats its regex or
JSON parse per use, and codegen does not reliably share work inside CASE
branches. Here each parse is its own projection; Catalyst keeps it
separate because the parsed column is referenced more than once, so every
row is parsed exactly once. Works on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalframe.functions import parse as P
from evalframe.functions.score import bool_value


def score_choice_table(df: DataFrame, keep: Sequence[str], completion: str = "completion",
                       choices: str = "choices", target: str = "target") -> DataFrame:
    keep = list(keep)
    s = df.select(*keep, F.col(choices).alias("_ch"), F.col(target).alias("_tg"),
                  F.upper(P.last_match(F.col(completion), P.CHOICE_PATTERN, 1)).alias("_l"))
    ok = F.col("_l").isNotNull() & ((F.ascii("_l") - F.lit(65)) < F.size("_ch"))
    s = s.select(*keep, "_tg", F.when(ok, F.col("_l")).otherwise(F.lit("")).alias("answer"))
    return s.select(*keep, "answer", bool_value(F.col("answer") == F.col("_tg")).alias("value"))


def score_boxed_table(df: DataFrame, keep: Sequence[str], completion: str = "completion",
                      target: str = "target") -> DataFrame:
    keep = list(keep)
    s = df.select(*keep, F.col(target).alias("_tg"), P.parse_boxed(completion).alias("answer"))
    return s.select(*keep, "answer", bool_value(F.col("answer") == F.col("_tg")).alias("value"))


def score_working_group_table(df: DataFrame, keep: Sequence[str], completion: str = "completion",
                              target: str = "target") -> DataFrame:
    keep = list(keep)
    s = df.select(*keep, P.parse_working_group(completion).alias("answer"),
                  P.parse_working_group(target).alias("_gt"))
    ok = F.lower("answer") == F.lower("_gt")
    s = s.select(*keep, "answer", "_gt", ok.alias("_ok"))
    expl = F.format_string("Predicted: %s, Ground Truth: %s. Match: %s", F.col("answer"), F.col("_gt"),
                           F.when(F.col("_ok"), F.lit("True")).otherwise(F.lit("False")))
    return s.select(*keep, "answer", F.col("_ok").cast("double").alias("value"), expl.alias("explanation"))


def parse_judge_json_table(df: DataFrame, keep: Sequence[str], output: str = "judge_output") -> DataFrame:
    """Adds ``judge_doc`` (the object's fields as texts, NULL when the reply holds no JSON object)."""
    return _judge_docs(df, keep, output).drop("_text")


def _judge_docs(df: DataFrame, keep: Sequence[str], output: str) -> DataFrame:
    """``judge_output``, the object's text ``_text`` and ``judge_doc``. Each step is used several times by the next, so each is a projection
    of its own: one regex and one JSON parse a reply."""
    said = df.select(*keep, F.col(output).alias("judge_output"), P.judge_json_text(output).alias("_text"))
    pairs = said.select("*", P.json_pair("_text", P.JUDGE_JSON_SCHEMA).alias("_pair"))
    return pairs.select(*keep, "judge_output", "_text", P.first_object("_pair").alias("judge_doc"))


def score_judge_json_table(df: DataFrame, keep: Sequence[str], output: str = "judge_output") -> DataFrame:
    """value = overall_score (0 when absent or unparsable), answer = the reply,
    explanation = reasoning (else the object's own text, or the failure text),
    plus the grader's eight fields. Two deviations from the suite, which prints a
    Python dict there: an object without reasoning explains itself as JSON, and a
    JSON null reasoning counts as none."""
    keep = list(keep)
    s = _judge_docs(df, keep, output)
    v, failed = F.col("judge_doc"), F.col("judge_doc").isNull()
    fields = [P.judge_number(v, k).alias(k) for k in P.JUDGE_JSON_FIELDS[:6]]
    fields += [v["is_safe"].try_cast("boolean").alias("is_safe"), v["reasoning"].alias("reasoning")]
    return s.select(
        *keep,
        F.coalesce(P.judge_number(v, "overall_score"), F.lit(0.0)).alias("value"),
        F.col("judge_output").alias("answer"),
        F.when(failed, F.concat(F.lit("Failed to parse JSON: "), F.col("judge_output")))
         .otherwise(F.coalesce(v["reasoning"], F.col("_text"))).alias("explanation"),
        (~failed).alias("parsed"),
        *fields)


def judge_grade_table(df: DataFrame, keep: Sequence[str], output: str = "judge_output",
                      pattern: str = P.FINAL_SCORE_PATTERN) -> DataFrame:
    keep = list(keep)
    s = df.select(*keep, P.parse_judge_grade(output, pattern).alias("_g"))
    return s.select(*keep, F.coalesce(F.col("_g"), F.lit(0.0)).alias("grade"), F.col("_g").isNotNull().alias("parsed"))
