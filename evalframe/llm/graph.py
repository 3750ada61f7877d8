"""Connected components and shared intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalframe.session import work_dir


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it (names are compared without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the lineage ends
    there, and a lost executor costs a read of the files."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(rows: DataFrame, hash_col: str, n: int) -> DataFrame:
    """The ``n`` rows of the smallest hashes (and rows that repeat the last of them): the same sample in every run. Only the
    hashes are sorted and sent; the rows themselves stay where they are."""
    last = rows.select(hash_col).orderBy(hash_col).limit(n).agg(F.max(hash_col)).first()[0]
    return rows.where(F.col(hash_col) <= F.lit(last)) if last is not None else rows.limit(0)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node with an edge.

    Alternating large-star and small-star rounds over an edge table: each round aggregates a minimum per
    node and joins it back, so a node with many edges is split like any skewed join key;
    nothing is collected but two numbers a round. Loops, repeated edges and both directions may occur; edges with a null end are left out.
    """
    kind = edges.schema[a].dataType
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u != v").distinct()
    own = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct()
    now, before = stage_table(now, "edges"), None
    for _ in range(max_rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # each node keeps its larger neighbours at m; small-star then hangs the smaller neighbours and itself there
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = stage_table(small, "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node").cast(kind))
    alone = own.join(stars.select("node").unionByName(roots.select("node")), "node", "left_anti")
    return stars.unionByName(roots).unionByName(alone.withColumn("component", F.col("node")))
