"""Evaluation log files and rubric files as tables.

Listing uses the ``binaryFile`` source with ``content`` pruned, so only file
metadata is read. Bodies are read whole (one JSON document per file) and
parsed to VARIANT on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BROADCAST_FILES = 100_000


def log_name(path) -> "F.Column":
    """File name, prefixed by its ``key=value`` folder when the log table was
    written partitioned (file names repeat across such folders)."""
    parts = F.split(F.col(path) if isinstance(path, str) else path, "/")
    parent, fname = F.element_at(parts, -2), F.element_at(parts, -1)
    return F.when(parent.contains("="), F.concat(parent, F.lit("/"), fname)).otherwise(fname)


def _plain_path(path) -> "F.Column":
    """A file's path as both readers should see it: percent escapes undone, a plus sign kept (it is no space in a path)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _present(spark: SparkSession, dirs: Sequence[str]) -> list[tuple[int, str]]:
    """(rank, folder) of the folders that exist; an absent one has no logs."""
    sc, out = spark.sparkContext, []
    for rank, d in enumerate(dirs):
        p = sc._jvm.org.apache.hadoop.fs.Path(d)
        if p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p):
            out.append((rank, d))
    return out


def _listing(spark: SparkSession, dirs: Sequence[str], glob: str, nested: bool) -> DataFrame:
    parts = []
    for rank, d in _present(spark, dirs):
        df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(nested).lower())
        path = _plain_path(F.col("_metadata.file_path"))
        parts.append(df.load(d).select(log_name(path).alias("name"), path.alias("path"), F.col("length").alias("size"),
                                       (F.unix_micros("modificationTime") / F.lit(1e6)).alias("modified"),
                                       F.lit("json").alias("type"), F.lit(rank).alias("dir_rank")))
    if not parts:
        return spark.createDataFrame([], "name string, path string, size long, modified double, type string, dir_rank int")
    return reduce(lambda a, b: a.unionByName(b), parts)


def list_eval_logs(spark: SparkSession, dirs: Sequence[str], glob: str = "*.json", nested: bool = False) -> DataFrame:
    """name, path, size, modified (epoch seconds), type for the JSON logs of
    several folders; folders in the given order, newest first inside each. A folder that isn't there has none; folders inside
    are read only with ``nested``."""
    return _listing(spark, dirs, glob, nested).orderBy("dir_rank", F.desc("modified"), "name")


def read_eval_logs(spark: SparkSession, dirs: Sequence[str], glob: str = "*.json", nested: bool = False) -> DataFrame:
    """One row per log name: the body from the first folder that has it,
    parsed to VARIANT, with ``is_valid`` false for bodies that do not parse
    (the row is kept, as an error report).

    The folder each name comes from is decided on the file listing (metadata
    only, one row per file); bodies join it by their path, spelled by one rule on both sides. A file that is
    gone when it is read fails the query. Up to BROADCAST_FILES listed files (known to the driver
    without a job) the listing is broadcast, so no body crosses the network."""
    listed = _listing(spark, dirs, glob, nested)
    first = listed.groupBy("name").agg(F.min(F.struct("dir_rank", "path")).alias("f")).select("name", F.col("f.path").alias("path"), "f.dir_rank")
    if len(listed.inputFiles()) <= BROADCAST_FILES:
        first = F.broadcast(first)
    parts = []
    for _, d in _present(spark, dirs):
        df = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(nested).lower()).text(d, wholetext=True)
              .select(_plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("body")))
        parts.append(df)
    if not parts:
        return spark.createDataFrame([], "name string, path string, dir_rank int, doc variant, is_valid boolean")
    bodies = reduce(lambda a, b: a.unionByName(b), parts)
    doc = F.try_parse_json("body")
    return bodies.join(first, "path").select("name", "path", "dir_rank", doc.alias("doc"), doc.isNotNull().alias("is_valid"))


def scan_rubrics(spark: SparkSession, path: str) -> DataFrame:
    """(category_key, rubric) from a folder of rubric text files: the key is
    the ``category_key=`` folder when the files were written partitioned, else
    the file name without ``.txt``."""
    df = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1)
    key = F.col("category_key") if "category_key" in df.columns else stem
    return df.select(key.cast("string").alias("category_key"), F.col("value").alias("rubric"))


def write_rubrics(rubrics: DataFrame, path: str) -> str:
    """One text file per category key (``category_key=<key>/part-*.txt``)."""
    rubrics.select("category_key", "rubric").repartition("category_key") \
        .write.mode("overwrite").partitionBy("category_key").text(path)
    return path
