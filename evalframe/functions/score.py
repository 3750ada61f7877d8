"""Per-row scorers. Each returns Columns for ``value`` (double), ``answer`` and,
where the suite writes one, ``explanation``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalframe.functions import parse as P


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bool_value(cond: Column) -> Column:
    """Boolean outcome as the score value (1.0 / 0.0); NULL counts as wrong."""
    return F.coalesce(cond, F.lit(False)).cast("double")


def score_choice(completion, choices, target) -> dict[str, Column]:
    letter = P.parse_choice(completion, choices)
    return {"answer": letter, "value": bool_value(letter == _col(target))}


def score_boxed(completion, target) -> dict[str, Column]:
    parsed = P.parse_boxed(completion)
    return {"answer": parsed, "value": bool_value(parsed == _col(target))}


def score_working_group(completion, target) -> dict[str, Column]:
    ans = P.parse_working_group(completion)
    gt = P.parse_working_group(target)
    ok = F.lower(ans) == F.lower(gt)
    expl = F.format_string("Predicted: %s, Ground Truth: %s. Match: %s", ans, gt,
                           F.when(ok, F.lit("True")).otherwise(F.lit("False")))
    return {"answer": ans, "value": ok.cast("double"), "explanation": expl}


def score_judge_grade(judge_output) -> dict[str, Column]:
    g = P.parse_judge_grade(judge_output)
    return {"value": F.coalesce(g, F.lit(0.0)), "parsed": g.isNotNull()}
