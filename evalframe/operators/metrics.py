"""Metrics over score tables ``(<keys>, sample_id, epoch, value, answer)``.

Everything is a chain of hash aggregates with map-side partial combine:

* per (keys, sample, answer): epochs seen, first epoch, whether any was
  scored 1, sum of values. Epochs collapse before the first shuffle.
* per (keys, sample): the per-sample mean over epochs and the majority
  answer's outcome (``max_by`` on ``(votes, -first_epoch)``; empty answers get a
  NULL ordering, so they never win but the sample stays in the denominator).
* per keys: means, standard error, vote share.

No metric collects a sample's answers into an array, so a sample with many
epochs or a model with a third of all rows only widens the partial
aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def stderr_of(v: Column | str) -> Column:
    """sqrt(var_samp / n); 0.0 when fewer than two values."""
    c = F.col(v) if isinstance(v, str) else v
    return F.coalesce(F.sqrt(F.var_samp(c) / F.count(c)), F.lit(0.0))


def answer_groups(scores: DataFrame, keys: Sequence[str] = ("model",), k: int | None = None) -> DataFrame:
    """One row per (keys, sample_id, answer) with ``votes``, ``first_epoch``,
    ``ok`` (some epoch with this answer scored 1), ``sum_value`` and ``n``
    (all epochs, for means) and the same restricted to ``epoch <= k``."""
    keys = _keys(keys)
    in_k = F.lit(True) if k is None else (F.col("epoch") <= F.lit(k))
    return (scores.groupBy(*keys, "sample_id", "answer")
            .agg(F.count("*").alias("n"),
                 F.sum("value").alias("sum_value"),
                 F.count_if(in_k).alias("votes"),
                 F.min(F.when(in_k, F.col("epoch"))).alias("first_epoch"),
                 F.max(F.when(in_k, (F.col("value") == 1).cast("int"))).alias("ok")))


def _vote_order() -> Column:
    """(votes, -first_epoch) packed into one bigint, so ``max_by`` keeps a
    fixed-width buffer and the aggregate stays a HashAggregate (a struct
    ordering would force a sort-based aggregate). Epochs are below 2^31."""
    return F.col("votes").cast("bigint") * F.lit(1 << 31) + (F.lit((1 << 31) - 1) - F.col("first_epoch"))


def _vote_key() -> Column:
    answered = (F.coalesce(F.col("answer"), F.lit("")) != "") & (F.col("votes") > 0)
    return F.when(answered, _vote_order())


def sample_level(groups: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Per (keys, sample_id): ``mean_value`` over epochs, ``n_epochs`` and the
    majority outcome ``maj_ok`` (NULL when nothing was answered)."""
    keys = _keys(keys)
    return (groups.groupBy(*keys, "sample_id")
            .agg((F.sum("sum_value") / F.sum("n")).alias("mean_value"),
                 F.sum("n").alias("n_epochs"),
                 F.max_by(F.col("ok"), _vote_key()).alias("maj_ok")))


def sample_means(scores: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Per (keys, sample_id): ``mean_value`` over epochs and ``n_epochs``. No answer text is shuffled: metrics
    without a vote start here."""
    return scores.groupBy(*_keys(keys), "sample_id").agg(F.avg("value").alias("mean_value"), F.count("*").alias("n_epochs"))


def accuracy(scores: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Mean score per keys; with epochs, the mean of per-sample means."""
    keys = _keys(keys)
    per = sample_means(scores, keys)
    return per.groupBy(*keys).agg(F.avg("mean_value").alias("accuracy"))


def stderr(scores: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    keys = _keys(keys)
    per = sample_means(scores, keys)
    return per.groupBy(*keys).agg(stderr_of("mean_value").alias("stderr"))


def mean(values: DataFrame, keys: Sequence[str] = ("model",), value: str = "value") -> DataFrame:
    """Plain mean and standard error of a graded value."""
    keys = _keys(keys)
    return values.groupBy(*keys).agg(F.avg(value).alias("mean"), stderr_of(value).alias("stderr"),
                                     F.count(value).alias("n"))


def pass_at_1(scores: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy averaged over epochs, with its standard error over samples."""
    keys = _keys(keys)
    per = sample_means(scores, keys)
    return per.groupBy(*keys).agg(F.avg("mean_value").alias("pass_at_1"),
                                  stderr_of("mean_value").alias("stderr"),
                                  F.count("*").alias("n_samples"))


def maj_at_k(scores: DataFrame, keys: Sequence[str] = ("model",), k: int | None = None,
             name: str = "maj_at_k") -> DataFrame:
    """Share of samples whose most frequent non-empty answer (ties: earliest
    epoch) was scored correct; samples with no answer count as misses."""
    keys = _keys(keys)
    per = sample_level(answer_groups(scores, keys, k), keys)
    return per.groupBy(*keys).agg(
        (F.sum(F.coalesce(F.col("maj_ok"), F.lit(0))) / F.count("*")).cast("double").alias(name))


def majority_answer(scores: DataFrame, keys: Sequence[str] = ("model",), k: int | None = None) -> DataFrame:
    """Per (keys, sample): the winning non-empty answer, its votes and first
    epoch; samples without any answer are absent."""
    keys = _keys(keys)
    g = answer_groups(scores, keys, k).filter((F.coalesce(F.col("answer"), F.lit("")) != "") & (F.col("votes") > 0))
    win = F.max_by(F.struct("answer", "votes", "first_epoch", "ok"), _vote_order())
    return (g.groupBy(*keys, "sample_id").agg(win.alias("w"))
            .select(*keys, "sample_id", F.col("w.answer").alias("answer"), F.col("w.votes").alias("votes"),
                    F.col("w.first_epoch").alias("first_epoch"), F.col("w.ok").cast("boolean").alias("correct")))


def eval_report(scores: DataFrame, keys: Sequence[str] = ("model",), k: int = 4) -> DataFrame:
    """Flagship report: pass@1 (= accuracy over per-sample means), its standard
    error and maj@k per keys, from one scan of the scores."""
    keys = _keys(keys)
    per = sample_level(answer_groups(scores, keys, k), keys)
    return per.groupBy(*keys).agg(
        F.count("*").alias("n_samples"),
        F.sum("n_epochs").alias("n_scores"),
        F.avg("mean_value").alias("pass_at_1"),
        stderr_of("mean_value").alias("stderr"),
        (F.sum(F.coalesce(F.col("maj_ok"), F.lit(0))) / F.count("*")).cast("double").alias(f"maj_at_{k}"))


def metrics_by_slice(scores: DataFrame, slices: DataFrame, slice_col: str,
                     keys: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy, stderr and n for the whole set and for each slice value in one
    pass. Per-sample means are reduced to (n, mean, sum of squared deviations) per slice
    before the grouping sets, so the expansion runs over a handful of rows; the whole set's
    deviations are the slices' own plus their means' distance from its mean, so nothing cancels.
    ``is_full`` is 1 on the whole-set row, telling it from a NULL slice."""
    keys = _keys(keys)
    per = sample_means(scores, keys).join(slices.select("sample_id", slice_col), "sample_id", "left")
    part = per.groupBy(*keys, slice_col).agg(F.count("*").alias("n"), F.avg("mean_value").alias("m"),
                                             (F.var_pop("mean_value") * F.count("*")).alias("m2"))
    n, m = F.col("n"), F.col("m")
    whole = Window.partitionBy(*keys)
    part = part.withColumn("_all", F.sum(n * m).over(whole) / F.sum(n).over(whole))
    rolled = (part.groupingSets([[F.col(c) for c in keys], [F.col(c) for c in keys + [slice_col]]],
                                *keys, slice_col)
              .agg(F.grouping(slice_col).cast("bigint").alias("is_full"), F.sum(n).alias("n_samples"),
                   (F.sum(n * m) / F.sum(n)).alias("accuracy"), F.sum("m2").alias("_own"),
                   F.sum(F.col("m2") + n * (m - F.col("_all")) * (m - F.col("_all"))).alias("_spread")))
    squares = F.when(F.col("is_full") == 1, F.col("_spread")).otherwise(F.col("_own"))
    return rolled.select(*keys, slice_col, "is_full", "n_samples", "accuracy",
                         F.when(F.col("n_samples") > 1, F.sqrt(squares / (F.col("n_samples") - 1) / F.col("n_samples")))
                         .otherwise(F.lit(0.0)).alias("stderr"))
