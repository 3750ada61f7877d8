"""Helpers to drive file streams: feed a folder in order, run a query with
``availableNow`` into ``foreachBatch``, keep what batches emit, read a query's state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a stateful query keeps its state: RocksDB on the executors, changes of each batch in the checkpoint. Avro rows let fields be
#: added to a state's schema between runs.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.encodingFormat": "avro",
}


def write_in_order(df: DataFrame, path: str, order_col: str, pieces: int, fmt: str = "parquet",
                   key_col: str | None = None) -> str:
    """Append ``df`` to ``path`` in ``pieces`` ascending ``order_col`` ranges,
    one write after another, so a file stream sees the ranges in that order.
    Each range is written by all tasks in parallel (never funnelled into one
    file); with ``key_col`` the rows of a range are clustered by key, so a
    key's rows of one range sit in one file. (For feeding fixtures; real producers append files as they go.)"""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return path
    width = (hi - lo) // pieces + 1
    piece = F.floor((F.col(order_col) - F.lit(lo)) / F.lit(width))
    for i in range(pieces):
        part = df.filter(piece == i)
        if key_col:
            part = part.repartition(key_col)
        part.write.mode("append").format(fmt).save(path)
    return path


def start_with(writer, spark: SparkSession, settings: dict[str, str]):
    """Start a query under ``settings``. A query copies the session's settings when it starts, and a checkpointed
    query keeps its state partitioning and store for life; the session's own settings are restored right after the start."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_available_now(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None],
                      output_mode: str = "append", shuffle_partitions: int | None = None, stateful: bool = False) -> None:
    """Process everything available now, batch by batch, then stop. The
    checkpoint makes a restarted query resume after the last committed batch."""
    w = (stream.writeStream.outputMode(output_mode).foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    settings = (STATE_STORE if stateful else {}) | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {})
    q = start_with(w, stream.sparkSession, settings)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """The state variable ``name`` of a stateful query as a table, as of its last batch: ``key``, and ``value`` or ``list_element``."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


class BatchTable:
    """What each micro-batch of a stream emits, as plain Parquet under ``batch_id=<id>``.

    A batch that runs again (after a failure) replaces its own folder and no other, so the table is the same however often a batch is repeated. ``partition_by``
    splits a batch's rows further, so that results of a task and model can be read alone."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.partition_by = spark, path, schema, tuple(partition_by)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        w = rows.write.mode("overwrite")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(f"{self.path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        """All batches' rows, with ``batch_id``."""
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], f"{self.schema}, batch_id bigint")
        return self.spark.read.schema(f"{self.schema}, batch_id bigint").parquet(self.path)

    def newest(self, *keys: str) -> DataFrame:
        """Of each key the row of its newest batch."""
        all_ = self.read()
        columns = [c for c in all_.columns if c not in keys and c != "batch_id"]
        best = all_.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch_id").alias("_row"))
        return best.select(*keys, *[F.col("_row")[c].alias(c) for c in columns])
