"""Inputs shared by several plans, with the matching DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalframe.fixtures import fixture
from evalframe.functions.parse import CHOICE_PATTERN
from evalframe.operators.scoring import score_choice_table
from evalframe.operators import samples as SM


def choice_samples(spark: SparkSession, sf: str) -> DataFrame:
    return SM.map_choice_records(fixture(spark, sf, "fx_samples"))


def choice_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(model, sample_id, epoch, answer, value) of the multiple-choice task."""
    comp = fixture(spark, sf, "fx_completions")
    j = SM.join_targets(comp, choice_samples(spark, sf), ("choices", "target"))
    return score_choice_table(j, ["model", "sample_id", "epoch"])


# DuckDB: the same scores, written independently (RE2 regex, list indexing).
CHOICE_SCORES_CTE = r"""
, choice_scores as (
  select model, sample_id, epoch, answer, case when answer = target then 1.0 else 0.0 end as value
  from (select c.model, c.sample_id, c.epoch, chr(cast(65 + s.answer as int)) as target,
          case when c.m is not null and ascii(upper(c.m)) - 65 < len(s.choices) then upper(c.m) else '' end as answer
        from (select *, regexp_extract_all(completion, '""" + CHOICE_PATTERN + r"""', 1)[-1] as m
              from fx_completions) c
        join fx_samples s on s.sample_id = c.sample_id) x)
"""

CHOICE_FIXTURES = ("fx_samples", "fx_completions")


def round9(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), 9).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
