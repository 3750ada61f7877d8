"""Question tables and result tables on shared storage.

Layout: ``<root>/dataset=<name>/config=<config>/split=<split>/*.parquet``
(or JSON lines). Reading names a fixed schema and filters on the partition
columns, so only the chosen config and split are listed and scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_eval_dataset(df: DataFrame, root: str, dataset: str, config: str = "default",
                       split_col: str = "split", fmt: str = "parquet") -> str:
    """Write a question table under the dataset/config/split layout. The splits written replace what is there
    (dynamic mode), so a second run changes nothing; others stay."""
    (df.withColumn("dataset", F.lit(dataset)).withColumn("config", F.lit(config))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("dataset", "config", split_col).format(fmt).save(root))
    return root


def scan_eval_dataset(spark: SparkSession, root: str, dataset: str, split: str = "test", config: str = "default",
                      schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Load one (dataset, config, split); the partition filters prune
    directories before any file is opened."""
    r = spark.read.format(fmt).option("basePath", root)
    if schema is not None:
        full = T.StructType(list(schema.fields) + [T.StructField("dataset", T.StringType()),
                                                   T.StructField("config", T.StringType()),
                                                   T.StructField("split", T.StringType())])
        r = r.schema(full)
    df = r.load(root)
    return (df.filter((F.col("dataset") == dataset) & (F.col("config") == config) & (F.col("split") == split))
              .drop("dataset", "config", "split"))


def write_eval_results(df: DataFrame, path: str, partition_by: Sequence[str] = ("task", "model"),
                       fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Per-sample scores or run metrics, partitioned by task and model.
    ``overwrite`` replaces only the partitions written (dynamic mode), so
    re-running one model does not drop the others."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).format(fmt).save(path))
    return path


def read_eval_results(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
