"""The first N rows of a table, or of each task, where N is large.

``limit_samples`` takes a few samples for a trial run: Spark keeps the N smallest in one task. Here N may be any share of the
table. The place where the N-th row falls is found from histograms: each pass counts the rows by ``bins`` equal ranges of the order
column (counts are what is shuffled, ``bins`` a task and group at most) and goes on inside the range that holds the N-th row, until ``most`` rows or one value are left.
Rows below that range stay and rows above it go, by a filter; only the rows of the range itself are ranked. Where one value
of the order column holds more than ``most`` rows, the search goes on over the ids of these rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalframe.session import work_dir

BINS = 1024
MOST = 200_000


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _narrow(rows: DataFrame, need: DataFrame, bins: int, most: int) -> DataFrame:
    """``_g, lo, hi, need, inside`` for each group of ``rows`` (``_g``, ``_p``): the rows below ``lo`` are among the first, those in ``[lo, hi]`` (``inside`` of
    them) hold the last ``need``. ``need`` (``_g, need``) is what each group may keep; a group of no more rows than that has ``lo > hi``."""
    ends = rows.groupBy("_g").agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"), F.count("*").alias("inside")).join(need, "_g")
    all_ = F.col("inside") <= F.col("need")
    now = _kept(ends.select("_g", F.when(all_, F.col("hi") + 1).otherwise(F.col("lo")).alias("lo"), "hi", "need", F.when(all_, F.lit(0)).otherwise(F.col("inside")).cast("bigint").alias("inside")), "cut")
    while now.where((F.col("inside") > most) & (F.col("lo") < F.col("hi"))).limit(1).count():
        wide = now.where((F.col("inside") > most) & (F.col("lo") < F.col("hi"))).withColumn("w", F.ceil((F.col("hi") - F.col("lo") + 1) / F.lit(bins)).cast("bigint"))
        met = rows.join(wide, "_g").where("_p between lo and hi")
        hist = met.groupBy("_g", "lo", "hi", "need", "w", F.floor((F.col("_p") - F.col("lo")) / F.col("w")).cast("bigint").alias("b")).agg(F.count("*").alias("c"))
        upto = hist.withColumn("below", F.sum("c").over(Window.partitionBy("_g").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c"))
        cut = upto.where("below < need and below + c >= need")
        next_ = cut.select("_g", (F.col("lo") + F.col("b") * F.col("w")).alias("lo"), F.least("hi", F.col("lo") + (F.col("b") + 1) * F.col("w") - 1).alias("hi"),
                           (F.col("need") - F.col("below")).alias("need"), F.col("c").alias("inside"))
        now = _kept(now.join(wide.select("_g"), "_g", "left_anti").unionByName(next_), "cut")
    return now


def first_samples(samples: DataFrame, n: int | None, task_col: str | None = None, ord_col: str = "ord", id_col: str = "sample_id", bins: int = BINS,
                  most: int = MOST) -> DataFrame:
    """The rows that ``limit_samples`` gives: the first ``n`` by ``ord_col`` (a whole number; null first), then ``id_col``, of the table or of each task (null is one).
    Rows that agree in order and id are taken as they come. The column order and all other columns are kept."""
    if not n:
        return samples
    task = F.col(task_col).cast("string") if task_col else F.lit("")
    least = samples.agg(F.min(F.col(ord_col).cast("bigint"))).first()[0]
    rows = samples.select("*", F.concat(F.when(task.isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(task, F.lit(""))).alias("_g"),
                          F.coalesce(F.col(ord_col).cast("bigint"), F.lit((least or 0) - 1)).alias("_p"))
    need = rows.select("_g").distinct().withColumn("need", F.lit(n).cast("bigint"))
    cut = _narrow(rows.select("_g", "_p"), need, bins, most)
    met = rows.join(cut, "_g")
    below, edge = met.where("_p < lo"), met.where("_p between lo and hi")
    kind = dict(samples.dtypes)[id_col]
    if kind in ("bigint", "int", "smallint", "tinyint") and cut.where(F.col("inside") > most).limit(1).count():
        ids = edge.drop("_p", "lo", "hi", "inside").withColumn("_p", F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2 ** 62))))
        second = _narrow(ids.select("_g", "_p"), cut.select("_g", "need"), bins, most)
        met = ids.drop("need").join(second, "_g")
        below, edge = below.select(*samples.columns).unionByName(met.where("_p < lo").select(*samples.columns)), met.where("_p between lo and hi")
    order = Window.partitionBy("_g").orderBy("_p", F.col(id_col))
    last = edge.withColumn("_rn", F.row_number().over(order)).where("_rn <= need")
    return below.select(*samples.columns).unionByName(last.select(*samples.columns))
