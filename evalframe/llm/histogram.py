"""Operator 9: token counts by an exact length histogram.

Documents are encoded and counted by length (map-side combined, so what is shuffled is
bounded by the number of distinct lengths in a task). From the histogram, suffix sums answer for every
context limit L that occurs as a length: documents and tokens in all, documents longer
than L, tokens kept when each document is cut at L, and the share of documents up to L (the quantile); ``at_limits`` and
``at_quantiles`` answer for any other limit and for wanted quantiles.

Lengths are grouped in blocks of ``BLOCK``; sums run within a block, and over the
blocks' totals, so no task holds the whole histogram in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalframe.llm.graph import stage_table
from evalframe.llm.tokens import token_lengths

BLOCK = 4096


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """``context_limit, n_docs`` of the lengths, nulls left out."""
    return (lengths.where(F.col(length_col).isNotNull()).groupBy(F.col(length_col).cast("long").alias("context_limit"))
            .agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_answers(histogram: DataFrame) -> DataFrame:
    """Per length L of a histogram: ``docs_longer`` (than L), ``tokens_longer`` (theirs), ``total_docs``,
    ``total_tokens``, ``truncated_tokens`` (kept when cut at L), ``quantile`` (share of documents of at most L tokens)."""
    rows = histogram.select("context_limit", "n_docs", (F.col("context_limit") * F.col("n_docs")).alias("n_tokens"),
                            F.floor(F.col("context_limit") / F.lit(BLOCK)).cast("long").alias("_block"))
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(F.col("_block"), *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("_docs", "_tokens")),
                           F.sum("_docs").over(every).alias("total_docs"), F.sum("_tokens").over(every).alias("total_tokens"))
    inside = Window.partitionBy("_block").orderBy(F.desc("context_limit")).rowsBetween(Window.unboundedPreceding, -1)
    got = rows.join(blocks, "_block").select(
        "context_limit", "n_docs", "n_tokens", "total_docs", "total_tokens",
        (F.col("_docs_later") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).alias("docs_longer"),
        (F.col("_tokens_later") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("tokens_longer"))
    return got.select("context_limit", "n_docs", "n_tokens", "docs_longer", "tokens_longer", "total_docs", "total_tokens",
                      (F.col("total_tokens") - F.col("tokens_longer") + F.col("context_limit") * F.col("docs_longer")).alias("truncated_tokens"),
                      ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("quantile"))


COUNTS = ["docs_longer", "tokens_longer", "total_docs", "total_tokens"]


def at_limits(answers: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``suffix_answers``'s columns for given context limits, whether a document has that length or not: what is longer than a limit is
    the next longer length and what is longer than that. One aggregate over the histogram; no rows if that is empty."""
    this = F.struct("n_docs", "n_tokens", *COUNTS)
    found = answers.agg(F.max("total_docs").alias("docs"), F.max("total_tokens").alias("tokens"),
                        *[F.max(F.when(F.col("context_limit") == n, F.col("n_docs"))).alias(f"own_{i}") for i, n in enumerate(limits)],
                        *[F.min_by(this, F.when(F.col("context_limit") > n, F.col("context_limit"))).alias(f"next_{i}") for i, n in enumerate(limits)])
    zero = F.lit(0).cast("long")
    rows = F.array(*[F.struct(F.lit(n).cast("long").alias("context_limit"), F.coalesce(f"own_{i}", zero).alias("n_docs"),
                              F.coalesce(F.col(f"next_{i}.n_docs") + F.col(f"next_{i}.docs_longer"), zero).alias("docs_longer"),
                              F.coalesce(F.col(f"next_{i}.n_tokens") + F.col(f"next_{i}.tokens_longer"), zero).alias("tokens_longer")) for i, n in enumerate(limits)])
    got = found.where("docs is not null").select("docs", "tokens", F.explode(rows).alias("r")).select("r.*", F.col("docs").alias("total_docs"), F.col("tokens").alias("total_tokens"))
    return got.select("context_limit", "n_docs", (F.col("context_limit") * F.col("n_docs")).alias("n_tokens"), *COUNTS,
                      (F.col("total_tokens") - F.col("tokens_longer") + F.col("context_limit") * F.col("docs_longer")).alias("truncated_tokens"),
                      ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("quantile"))


def at_quantiles(answers: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """``wanted, context_limit``: the smallest length that at least this share of all documents doesn't exceed."""
    found = answers.agg(*[F.min(F.when(F.col("quantile") >= q, F.col("context_limit"))).alias(f"q_{i}") for i, q in enumerate(quantiles)])
    rows = F.array(*[F.struct(F.lit(float(q)).alias("wanted"), F.col(f"q_{i}").alias("context_limit")) for i, q in enumerate(quantiles)])
    return found.select(F.explode(rows).alias("r")).select("r.*").where("context_limit is not null")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                 end_tokens: int = 1, limits: Sequence[int] = (), quantiles: Sequence[float] = ()) -> DataFrame:
    """The histogram of all documents' encoded lengths with its suffix sums: one row per distinct length, one for each of
    ``limits`` that is no length (``n_docs`` 0), and in ``quantiles`` those of the wanted ones that the row's length answers.

    A null or empty text has ``end_tokens`` tokens; repeated rows count each; an empty table gives no row. Texts are encoded
    once: the histogram is a written table before it is summed.
    """
    texts = docs.select(F.col(text_col).alias("text"), F.lit(0).alias("id"))
    answers = suffix_answers(stage_table(length_histogram(token_lengths(texts, "id", "text", vocabulary, end_tokens)), "histogram"))
    if limits:
        missing = at_limits(answers, limits).join(answers.select("context_limit"), "context_limit", "left_anti")
        answers = answers.unionByName(missing)
    if not quantiles:
        return answers.withColumn("quantiles", F.array().cast("array<double>"))
    named = at_quantiles(answers, quantiles).groupBy("context_limit").agg(F.sort_array(F.collect_list("wanted")).alias("quantiles"))
    return answers.join(named, "context_limit", "left").withColumn("quantiles", F.coalesce("quantiles", F.array().cast("array<double>")))
