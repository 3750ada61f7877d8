"""User-defined scorers, metrics and tasks.

A scorer is a Python function that returns Columns (``value``, ``answer``,
optionally ``explanation``) from the columns of a completions-with-targets
DataFrame; it stays in the JVM unless the function itself chooses a pandas
UDF. A metric is a function (scores DataFrame, keys) -> DataFrame, or a mergeable
aggregate of four small functions. A task
bundles dataset, prompt, scorer and metrics under a name; running it is a
composition of DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalframe.operators import metrics as M
from evalframe.operators.aggregates import Aggregate, aggregate
from evalframe.operators.batch_scorer import DEFAULT_BYTES, BatchScorerFn, score_batches
from evalframe.operators.generate import tasks_for
from evalframe.operators.samples import expand_work_grid

ScorerFn = Callable[..., dict[str, Column]]
MetricFn = Callable[[DataFrame, Sequence[str]], DataFrame]
#: Samples of a scoring task, about; each has the completions of all models and epochs.
SCORED_SAMPLES = 50_000


@dataclass(frozen=True)
class ScorerDef:
    name: str
    fn: ScorerFn | BatchScorerFn
    metrics: tuple[str, ...]
    batch_bytes: int | None = None      # of a scorer over batches


SCORERS: dict[str, ScorerDef] = {}
METRICS: dict[str, MetricFn] = {
    "accuracy": lambda s, k: M.accuracy(s, k),
    "stderr": lambda s, k: M.stderr(s, k),
    "mean": lambda s, k: M.mean(s, k).select(*k, "mean"),
    "pass_at_1": lambda s, k: M.pass_at_1(s, k).select(*k, "pass_at_1"),
    "maj_at_k": lambda s, k: M.maj_at_k(s, k),
}

# Built-in metrics over per-sample rows: computed together in one aggregate
# chain (while the name still maps to the built-in function).
_SAMPLE_LEVEL = {
    "accuracy": lambda: F.avg("mean_value"),
    "pass_at_1": lambda: F.avg("mean_value"),
    "stderr": lambda: M.stderr_of("mean_value"),
    "maj_at_k": lambda: (F.sum(F.coalesce(F.col("maj_ok"), F.lit(0))) / F.count("*")).cast("double"),
}
_BUILTIN = dict(METRICS)


def scorer(name: str | None = None, metrics: Sequence[str] = ("accuracy", "stderr")):
    """Register a per-row scorer with its default metrics."""
    def deco(fn: ScorerFn) -> ScorerFn:
        SCORERS[name or fn.__name__] = ScorerDef(name or fn.__name__, fn, tuple(metrics))
        return fn
    return deco


def batch_scorer(name: str | None = None, metrics: Sequence[str] = ("accuracy", "stderr"), batch_bytes: int = DEFAULT_BYTES):
    """Register a scorer over batches of rows (see ``operators.batch_scorer``) with its default metrics."""
    def deco(fn: BatchScorerFn) -> BatchScorerFn:
        SCORERS[name or fn.__name__] = ScorerDef(name or fn.__name__, fn, tuple(metrics), batch_bytes)
        return fn
    return deco


def metric(name: str | None = None):
    """Register an aggregate over (sample, epoch) scores."""
    def deco(fn: MetricFn) -> MetricFn:
        METRICS[name or fn.__name__] = fn
        return fn
    return deco


def aggregate_metric(name: str, columns: Sequence[str], init: Callable, merge: Callable, finish: Callable):
    """Register a metric by its mergeable aggregate (see ``operators.aggregates``); the decorated function is its ``update``."""
    def deco(update: Callable) -> Callable:
        made = Aggregate(name, tuple(columns), init, update, merge, finish)
        METRICS[name] = lambda scores, keys: aggregate(scores, made, keys)
        return update
    return deco


def apply_scorer(df: DataFrame, name: str, keep: Sequence[str], **cols) -> DataFrame:
    known = SCORERS[name]
    if known.batch_bytes:
        return score_batches(df, known.fn, keep, cols, known.batch_bytes)
    out = known.fn(**cols)
    return df.select(*keep, *[c.alias(k) for k, c in out.items()])


def compute_metrics(scores: DataFrame, names: Sequence[str], keys: Sequence[str] = ("model",)) -> DataFrame:
    """The named metrics per keys. Built-in sample-level metrics share one
    scan and one aggregate chain; every other metric (user-registered, or a
    built-in name the user re-registered) is its own aggregate, joined on the
    keys (a handful of rows each)."""
    keys = list(keys)
    fused = [n for n in names if n in _SAMPLE_LEVEL and METRICS.get(n) is _BUILTIN[n]]
    out = None
    if fused:
        per = M.sample_level(M.answer_groups(scores, keys), keys) if "maj_at_k" in fused else M.sample_means(scores, keys)
        out = per.groupBy(*keys).agg(*[_SAMPLE_LEVEL[n]().alias(n) for n in fused])
    for n in names:
        if n in fused:
            continue
        m = METRICS[n](scores, keys)
        out = m if out is None else out.join(m, keys, "outer")
    return out


@dataclass(frozen=True)
class Task:
    """dataset(spark, sf_dir, **params) -> samples; completions(spark, sf_dir) -> rows
    keyed (model, sample_id, epoch); scorer named in the registry with the
    column mapping it needs; metrics by name. ``system_prompt(samples)`` is the column that a model is shown
    first, ``prompt_col`` the sample's own question; ``params`` are the dataset's parameters (such as a difficulty), changed per run by
    ``with_params``."""
    name: str
    dataset: Callable[[SparkSession, str], DataFrame]
    completions: Callable[[SparkSession, str], DataFrame]
    scorer: str
    scorer_cols: dict[str, str]
    metrics: tuple[str, ...] = ()
    system_prompt: Callable[[DataFrame], Column] | None = None
    params: dict = field(default_factory=dict)
    prompt_col: str = "input"

    def with_params(self, **params) -> "Task":
        return replace(self, params={**self.params, **params})

    def work(self, spark: SparkSession, sf: str, models: Sequence[str], epochs: int = 1) -> DataFrame:
        """(task, model, sample_id, epoch, system_prompt, prompt) rows to generate."""
        samples = self.dataset(spark, sf, **self.params)
        system = F.lit(None).cast("string") if self.system_prompt is None else self.system_prompt(samples)
        grid = expand_work_grid(samples.withColumn("system_prompt", system), models, epochs)
        return grid.select(F.lit(self.name).alias("task"), "model", "sample_id", "epoch", "system_prompt", F.col(self.prompt_col).alias("prompt"))

    def scores(self, spark: SparkSession, sf: str) -> DataFrame:
        samples = self.dataset(spark, sf, **self.params)
        comp = self.completions(spark, sf)
        n = tasks_for(samples, SCORED_SAMPLES)
        if n:       # else a task sorts, and holds sums for, ever more rows
            comp, samples = comp.repartition(n, "sample_id"), samples.repartition(n, "sample_id").hint("merge")
        j = comp.join(samples, "sample_id")
        cols = {k: F.col(v) for k, v in self.scorer_cols.items()}
        return apply_scorer(j, self.scorer, ["model", "sample_id", "epoch"], **cols)

    def run(self, spark: SparkSession, sf: str) -> DataFrame:
        names = self.metrics or SCORERS[self.scorer].metrics
        return compute_metrics(self.scores(spark, sf), names).withColumn("task", F.lit(self.name))
