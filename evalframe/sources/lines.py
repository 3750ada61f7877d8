"""Job log lines as a table or a stream, with a fixed schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from evalframe.session import work_dir

def line_schema(job_type: T.DataType | None = None) -> T.StructType:
    """Columns of a line table; job ids are of any type (text for hex ids)."""
    return T.StructType([T.StructField("job_id", job_type or T.LongType()), T.StructField("seq", T.LongType()),
                         T.StructField("ts", T.TimestampNTZType()), T.StructField("line", T.StringType())])


LINE_SCHEMA = line_schema()


def write_lines(spark: SparkSession, lines: DataFrame, name: str, fmt: str = "parquet",
                path: str | None = None) -> str:
    """Persist lines in the shared work folder; returns the folder."""
    out = path or work_dir(spark, name)
    lines.select([f.name for f in LINE_SCHEMA.fields]).write.mode("overwrite").format(fmt).save(out)
    return out


def scan_progress_lines(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False,
                        schema: T.StructType = LINE_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Read lines written by a job (parquet or JSON lines) as a batch table or,
    with ``stream=True``, as a file stream in arrival (modification) order."""
    if stream:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.schema(schema).format(fmt).load(path)
