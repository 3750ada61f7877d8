"""The insides of evaluation logs as tables: headers, samples, scores.

A log is one JSON document: ``status``, ``eval`` (task, model, created), ``results`` (counts) and ``samples``, each with an id, an epoch and
``scores`` by scorer. ``read_eval_logs`` gives the documents as VARIANT; here ``variant_explode`` makes them rows, so a log of thousands of samples is
scored, joined and filtered like any table. ``write_log_samples`` keeps the sample rows as shredded Parquet: the fields
that the samples share become typed columns of the file, and a query that asks for one of them reads that column only.

A document must fit one VARIANT value (a larger one reads as not valid). Unexpected kinds are no errors: a log without an array of
samples has no sample rows, a sample whose ``scores`` is no object has no score rows, and a field of another kind is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields a log's header row takes from the document: name -> (path, type).
HEADER = {"status": ("$.status", "string"), "task": ("$.eval.task", "string"), "model": ("$.eval.model", "string"), "created": ("$.eval.created", "string"),
          "total_samples": ("$.results.total_samples", "bigint"), "completed_samples": ("$.results.completed_samples", "bigint")}

# ---- fixed values: letter grades of a log and what they count ----
LETTER_VALUES = {"C": 1.0, "P": 0.5, "I": 0.0, "N": 0.0}
# ---- end of fixed values ----

_SHRED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


def _field(doc: str, path: str, kind: str) -> Column:
    return F.try_variant_get(doc, path, kind)


def _kind(doc: Column) -> Column:
    """The kind of a VARIANT value up to its parameters: ``OBJECT``, ``ARRAY``, ``STRING``, ``BIGINT``, ``DECIMAL``, ``BOOLEAN``..."""
    return F.regexp_extract(F.schema_of_variant(doc), r"^\w+", 0)


def log_headers(logs: DataFrame) -> DataFrame:
    """One row a log: ``name, dir_rank, is_valid``, the header fields and ``n_samples`` (length of the array of samples, null without one)."""
    one = logs.withColumn("_samples", F.try_variant_get("doc", "$.samples", "array<variant>"))
    return one.select("name", "dir_rank", "is_valid", *[_field("doc", *spec).alias(c) for c, spec in HEADER.items()], F.size("_samples").cast("bigint").alias("n_samples"))


def log_samples(logs: DataFrame) -> DataFrame:
    """One row a sample: ``name, task, model, pos`` (from 0), ``sample_id`` (text), ``epoch`` (1 if the sample states none) and ``sample`` (VARIANT)."""
    head = logs.where("is_valid").select("name", _field("doc", *HEADER["task"]).alias("task"), _field("doc", *HEADER["model"]).alias("model"),
                                         F.try_variant_get("doc", "$.samples", "variant").alias("_samples"))
    # what is exploded without a key was an array: told from the rows, for the kind of a whole document takes a walk through it
    rows = head.lateralJoin(head.sparkSession.tvf.variant_explode(F.col("_samples").outer())).where("key is null")
    return rows.select("name", "task", "model", F.col("pos").cast("bigint").alias("pos"), _field("value", "$.id", "string").alias("sample_id"),
                       F.coalesce(_field("value", "$.epoch", "int"), F.lit(1)).alias("epoch"), F.col("value").alias("sample"))


def log_scores(samples: DataFrame) -> DataFrame:
    """One row a sample and scorer: ``name, task, model, sample_id, epoch, scorer, value, value_text, answer, explanation``.

    ``value`` is a number as it is, true and false as 1 and 0, a letter grade as ``LETTER_VALUES`` has it, else null; ``value_text`` is what the log says, arrays and objects as JSON."""
    keys = ["name", "task", "model", "sample_id", "epoch"]
    own = samples.select(*keys, F.try_variant_get("sample", "$.scores", "variant").alias("_scores"))
    rows = own.lateralJoin(own.sparkSession.tvf.variant_explode(F.col("_scores").outer())).where("key is not null").select(*keys, F.col("key").alias("scorer"), F.col("value").alias("score"))
    said = rows.select("*", F.try_variant_get("score", "$.value", "variant").alias("_value")).select("*", _kind(F.col("_value")).alias("_kind"))
    text = F.try_variant_get("_value", "$", "string")
    letters = F.create_map(*[F.lit(x) for pair in LETTER_VALUES.items() for x in pair])
    value = (F.when(F.col("_kind") == "BOOLEAN", F.try_variant_get("_value", "$", "boolean").cast("int").cast("double"))
             .when(F.col("_kind") == "STRING", F.try_element_at(letters, text)).otherwise(F.try_variant_get("_value", "$", "double")))
    return said.select(*keys, "scorer", value.alias("value"), text.alias("value_text"), _field("score", "$.answer", "string").alias("answer"),
                       _field("score", "$.explanation", "string").alias("explanation"))


def write_log_samples(samples: DataFrame, path: str, partition_by: tuple[str, ...] = ("task", "model")) -> str:
    """Write sample rows with shredded ``sample`` columns; the partitions written replace what is there. The shared fields are found by Spark from each file's first rows."""
    conf = samples.sparkSession.conf
    old = {k: conf.get(k, None) for k in _SHRED}
    try:
        for k, v in _SHRED.items():
            conf.set(k, v)
        samples.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    finally:
        for k, v in old.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return path


def scan_log_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample rows as written; the paths that a query takes from ``sample`` are read from their own columns."""
    return spark.read.schema("name string, pos bigint, sample_id string, epoch int, sample variant, task string, model string").parquet(path)
