"""Record -> sample projections, filters, joins and the work grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalframe.functions import parse as P
from evalframe.functions import scalars as S

def _opt(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _ord(df: DataFrame, ord_col: str, id_col: str) -> Column:
    """The record order; records without one are ordered by their id."""
    return F.col(ord_col) if ord_col in df.columns else F.col(id_col)


# ---- projections -----------------------------------------------------------

def map_choice_records(df: DataFrame, id_col: str = "sample_id", ord_col: str = "ord") -> DataFrame:
    """question, choices, 0-based ``answer`` -> sample with a letter target and
    optional ``subject`` metadata (absent column -> NULL); without an
    ``ord`` column the samples are ordered by id."""
    return df.select(F.col(id_col).alias("sample_id"), _ord(df, ord_col, id_col).alias("ord"),
                     F.col("question").alias("input"), F.col("choices"),
                     S.index_to_letter(F.col("answer")).alias("target"),
                     F.struct(_opt(df, "subject").alias("subject")).alias("metadata"))


def map_indexed_records(df: DataFrame, input_col: str = "input", index_col: str = "index",
                        id_col: str = "sample_id", ord_col: str = "ord") -> DataFrame:
    """Like ``map_choice_records`` but the index arrives as text; a value that
    is not an integer raises (ANSI cast), as the suite's ``int()`` does."""
    return df.select(F.col(id_col).alias("sample_id"), _ord(df, ord_col, id_col).alias("ord"),
                     F.col(input_col).alias("input"), F.col("choices"),
                     S.index_to_letter(F.col(index_col).cast("int")).alias("target"))


def map_field_spec(df: DataFrame, input: str, target: str, metadata: Sequence[str] = (),
                   id_col: str = "sample_id", rename: dict[str, str] | None = None) -> DataFrame:
    """Rename by declared field names and gather metadata into a struct.
    Metadata names may hold spaces; ``rename`` maps them to snake_case."""
    rename = rename or {}
    meta = [F.col(f"`{m}`").alias(rename.get(m, m.lower().replace(" ", "_"))) for m in metadata]
    return df.select(F.col(id_col).alias("sample_id"), F.col(f"`{input}`").alias("input"),
                     F.col(f"`{target}`").cast("string").alias("target"), F.struct(*meta).alias("metadata"))


# ---- filters -----------------------------------------------------------------

def filter_equal(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Keep rows whose ``column`` equals ``value``; ``full`` keeps all. NULL
    never matches. Decided on the driver, so ``full`` adds no predicate."""
    if value is None or value == "full":
        return df
    return df.filter(F.col(column) == F.lit(value))


def filter_subject(df: DataFrame, subject: str = "full", column: str = "subject") -> DataFrame:
    return filter_equal(df, column, subject)


def filter_difficulty(df: DataFrame, difficulty: str = "full", column: str = "difficulty") -> DataFrame:
    return filter_equal(df, column, difficulty)


def filter_answered(scores: DataFrame, column: str = "answer") -> DataFrame:
    return scores.filter(F.coalesce(F.col(column), F.lit("")) != "")


def filter_json_objects(lines: DataFrame, column: str = "line") -> DataFrame:
    return lines.filter(P.is_json_object(column))


# ---- joins -------------------------------------------------------------------

def join_rubrics(samples: DataFrame, rubrics: DataFrame, category_col: str = "category") -> DataFrame:
    """Attach the rubric of each sample's normalised category; a category
    without a rubric fails the query. The rubric side is a small dimension
    (one row per category): the planner broadcasts it by the size it sees, AQE by the size it measures."""
    r = rubrics.select("category_key", "rubric")
    joined = samples.withColumn("category_key", S.normalise_category(F.col(category_col))) \
        .join(r, "category_key", "left")
    check = F.when(F.col("rubric").isNull(),
                   F.raise_error(F.concat(F.lit("no rubric for category "), F.col(category_col))))
    return joined.withColumn("rubric", F.coalesce(F.col("rubric"), check.cast("string")))


def rubric_gaps(samples: DataFrame, rubrics: DataFrame, category_col: str = "category") -> DataFrame:
    """Categories that have no rubric (the error case as a report)."""
    keys = samples.select(F.col(category_col).alias("category"),
                          S.normalise_category(F.col(category_col)).alias("category_key")).distinct()
    return keys.join(rubrics.select("category_key"), "category_key", "left_anti")


def join_targets(completions: DataFrame, samples: DataFrame, cols: Sequence[str] = ("target",), merge: bool = False) -> DataFrame:
    """Pair each completion with its sample's target (equi-join on
    ``sample_id``; AQE picks broadcast when the sample side is small). With ``merge`` the two are sorted and
    nothing is broadcast: for streams, whose batches are sized by compressed files that hold far more in memory."""
    targets = samples.select("sample_id", *cols)
    return completions.join(targets.hint("merge") if merge else targets, "sample_id", "inner")


# ---- fixed values: task names and their benchmark aliases ----
TASK_NAMES = ("telemath", "teleqna", "telelogs")
TASK_ALIASES = {"teleqna_bench": "teleqna", "telelogs_bench": "telelogs"}
# ---- end of fixed values ----
# (a further alias, the evaluation package's own name, is left to the caller's ``aliases``)


def resolve_task_alias(df: DataFrame, column: str = "requested_task", out: str = "task",
                       aliases: dict[str, str] | None = None, known: Sequence[str] = TASK_NAMES) -> DataFrame:
    """Alias -> task name; a name that is neither fails the query. The alias
    map is driver-side configuration, so it becomes a CASE expression instead
    of a join."""
    aliases = TASK_ALIASES if aliases is None else aliases
    c = F.col(column)
    resolved = c
    if aliases:
        expr = None
        for a, t in aliases.items():
            expr = (F.when(c == a, F.lit(t)) if expr is None else expr.when(c == a, F.lit(t)))
        resolved = expr.otherwise(c)
    checked = F.when(resolved.isin(*known), resolved).otherwise(
        F.raise_error(F.concat(F.lit("Unsupported task: "), c)).cast("string"))
    return df.withColumn(out, checked)


def limit_samples(samples: DataFrame, n: int | None, task_col: str | None = None,
                  ord_col: str = "ord") -> DataFrame:
    """First ``n`` samples by ``ord`` (per task when ``task_col`` is given).
    One task: TakeOrderedAndProject; several: row_number with a window group
    limit, which keeps only n rows per task before the shuffle."""
    if not n:
        return samples
    if task_col is None:
        return samples.orderBy(F.col(ord_col), F.col("sample_id")).limit(n)
    w = Window.partitionBy(task_col).orderBy(F.col(ord_col), F.col("sample_id"))
    return samples.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def expand_work_grid(samples: DataFrame, models: Sequence[str], epochs: int = 1,
                     limit: int | None = None, task_col: str | None = None) -> DataFrame:
    """Every (sample x model x epoch) to run. The limit applies first; models
    without a name are dropped. Models and epochs are run configuration held
    on the driver, so they expand as generators inside the scan's stage:
    no join and no shuffle."""
    names = [m for m in models if m]
    if not names:
        raise ValueError("At least one model must be provided")
    s = limit_samples(samples, limit, task_col)
    return (s.withColumn("model", F.explode(F.array(*[F.lit(m) for m in names])))
             .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(int(epochs))))))
