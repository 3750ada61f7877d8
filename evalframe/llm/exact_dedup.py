"""Exact deduplication against a persistent digest index.

The index is a Parquet table of one row for each distinct text ever kept: the SHA-256 of the text and the id of the row that
stays. It is bucketed and sorted by the digest, so new data meets it in a sort-merge anti join that moves the new digests only,
never the index. What the join leaves is appended.

Texts are equal when their UTF-8 bytes are; null counts as the empty text. Two texts of one SHA-256 would be taken for one.
Of equal texts of one call the row of the largest id stays (null ids are smaller than all others); of rows that agree in id and
text exactly one stays. A text that the index knows stays where it was first kept, whatever the ids of later rows. Adding the
same rows once more appends nothing and gives the same decisions, so a call that failed half way is repeated as it was.

Scale: texts are read once and never shuffled; a row of id and digest (about 50 bytes) is. Copies are counted in each
task before digests meet, so a text that holds a third of all rows is one row a task there. Only the join that hands
the decision back to the rows meets all copies of a text; it is a plain sort-merge join of two written tables, which AQE splits.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalframe.llm.graph import fresh, stage_table

#: Entries that a bucket should hold at the size that is expected (about 90 MB).
BUCKET_ROWS = 2_000_000


def buckets_for(rows: int) -> int:
    """Buckets for an index of so many texts: a power of two, 8 at least."""
    return max(8, 1 << (-(-rows // BUCKET_ROWS) - 1).bit_length())


def digest(text: str):
    """SHA-256 of the text's UTF-8 bytes as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


class DigestIndex:
    """The digests kept so far, under ``path`` on storage that driver and executors share.

    Whoever opens a path first fixes the number of buckets (see ``buckets_for``) and the type of the ids; later ones find both in the
    folder's name. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        found = next((n for n in names if n.startswith("buckets=")), f"buckets={buckets},id={id_type}")
        self.folder = f"{self.path}/{found}"
        fs.mkdirs(sc._jvm.org.apache.hadoop.fs.Path(self.folder))
        self.buckets, kind = int(found.split(",")[0][8:]), found.partition(",id=")[2]
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {kind}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'")

    def entries(self) -> DataFrame:
        """``digest, keep_id``, one row for each text kept."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, groups: DataFrame) -> None:
        """Append those of ``groups`` (``digest, keep_id``, one row a digest) whose digest the index doesn't hold."""
        known = self.entries().select("digest")
        new = groups.repartition(self.buckets, "digest").join(known.hint("merge"), "digest", "left_anti")
        new.select("digest", "keep_id").write.insertInto(self.table)


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", deliveries: int = 1) -> DataFrame:
    """One row for each row of ``docs``: its id, ``keep_id`` (id of the row that stays for its text), ``group_size`` (rows of
    this text in ``docs``), ``kept`` and ``digest``.

    With ``deliveries`` above 1 (numeric ids only) the rows reach the index in as many parts, larger ids first, each joined against what the
    parts before it left there; the decisions are the same. Columns other than id and text are not read.
    An empty table gives no rows."""
    rows = stage_table(docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    cuts = rows.agg(F.percentile_approx("id", [i / deliveries for i in range(1, deliveries)])).first()[0] if deliveries > 1 else None
    cuts = sorted(set(cuts or []), reverse=True)
    last = F.lit(len(cuts))
    part = F.coalesce(*[F.when(F.col("id") > F.lit(c), F.lit(i)) for i, c in enumerate(cuts)], last)
    for no in range(len(cuts) + 1):
        now = rows.where(part == no)
        index.add(now.groupBy("digest").agg(F.max("id").alias("keep_id")))
    best = rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
    groups = stage_table(best.join(index.entries().hint("merge"), "digest")
                         .select("digest", "keep_id", "group_size", F.when(F.col("best.id").eqNullSafe(F.col("keep_id")), F.col("best.row")).alias("stays")), "digest-groups")
    out = rows.join(groups, "digest")
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.coalesce(F.col("row") == F.col("stays"), F.lit(False)).alias("kept"), "digest")


def drop_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    id_, key, one = (fresh(docs.columns, n) for n in ("kept_id", "digest", "row"))
    kept = deduplicate(docs, index, id_col, text_col).where("kept").select(F.col(id_col).alias(id_), F.col("digest").alias(key))
    same = docs.withColumn(one, digest(text_col))
    found = same.join(kept, (same[one] == kept[key]) & same[id_col].eqNullSafe(kept[id_]), "left_semi")
    return found.dropDuplicates([id_col, one]).select(*docs.columns)
