"""Operator 4: approximate nearest neighbours by cross-polytope hashing.

Vectors are scaled to unit length, turned by fast Hadamard pseudo-rotations (three rounds of random signs and a Hadamard
transform) and hashed to the nearest signed axis. Each of ``tables`` rotations gives one table; a vector is entered once in each, and a query
probes the ``probes`` axes nearest to it (multiprobe). Candidates of a bucket are compared exactly, in double precision and blocks, and the best
``k`` of each block (ties to the smaller id) go on to the final ranking.

For the largest inner product, vectors of unequal norms get one more component that evens out the norms; the product with a query is unchanged up to scale.
What uneven norms and padded widths cost in recall is made up by probes: unless they are given, their number is measured on a sample of the queries.

Identical vectors: of each group only the ``k + 1`` smallest ids can ever be among a query's ``k`` nearest (ties go to the smaller id), so the
others aren't entered; every one can still be a query. Buckets are dealt into blocks of at most ``BLOCK`` vectors and ``BLOCK`` queries, so a hot
bucket is many tasks' work. The hashed search decides at every size of the table. Only a query that meets fewer than ``k`` vectors in its buckets probes every
bucket of the first table, that is all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.graph import fresh, smallest_hashes, stage_table

TABLES, PROBES, BLOCK, PAIRS = 28, 2, 512, 16384
SAMPLE, AIM = 128, 0.92
ENTRY = "id long, part int, axis int, vector array<double>"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def rotate(x: np.ndarray, table: int, size: int, seed: int = 0) -> np.ndarray:
    """The table's pseudo-rotation of unit rows padded to ``size`` (a power of two)."""
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, size))
    out = np.zeros((len(x), size))
    out[:, :x.shape[1]] = x
    for s in signs:
        out = hadamard(out * s)
    return out


def axes(rotated: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first; axis i and its opposite are 2i and 2i + 1."""
    signed = np.stack([rotated, -rotated], axis=2).reshape(len(rotated), -1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (double) of rows whose id and vector are there and whose components are finite numbers, not all zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where("id is not null and vector is not null and size(vector) > 0")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(fine).where(F.exists("vector", lambda x: x != 0))


def padded(width: int) -> int:
    """The power of two that holds the width."""
    return 1 << max(width - 1, 1).bit_length()


def unit_rows(raw: np.ndarray, top: float | None) -> np.ndarray:
    """Rows at unit length; with ``top``, the largest norm, by one more component that evens out the norms."""
    norm = np.linalg.norm(raw, axis=1, keepdims=True)
    return raw / norm if top is None else np.concatenate([raw / top, np.sqrt(np.maximum(1 - (norm / top) ** 2, 0))], axis=1)


def _entries(rows: DataFrame, tables: list[int], probes: int, top: float | None) -> DataFrame:
    """Rows of ENTRY. ``top``: the largest norm, if vectors are to be evened out; None for queries and for vectors of one norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, width = b.column(0).to_numpy(), len(b.column(1)[0])
            raw = b.column(1).flatten().to_numpy().reshape(-1, width)
            unit = unit_rows(raw, top)
            size = padded(unit.shape[1])
            for t in tables:
                found = axes(rotate(unit, t, size), min(probes, 2 * size))
                n = found.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.full(len(ids) * n, t, np.int32)), pa.array(found.ravel().astype(np.int32)),
                                                  b.column(1).take(pa.array(np.repeat(np.arange(len(ids)), n)))], names=["id", "part", "axis", "vector"])

    return rows.mapInArrow(run, ENTRY)


def _blocks(entries: DataFrame, name: str, others: DataFrame, other: str) -> DataFrame:
    """Entries with their own block number (by bucket size) and one row for each block of the other side."""
    sizes = entries.groupBy("part", "axis").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("own"))
    other_sizes = others.groupBy("part", "axis").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("theirs"))
    both = F.broadcast(sizes.join(other_sizes, ["part", "axis"]))  # a row per bucket: tables times axes
    return (entries.join(both, ["part", "axis"]).withColumn(name, F.pmod(F.xxhash64("id"), F.col("own")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("theirs") - 1))).drop("own", "theirs"))


def products(q: np.ndarray, v: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Inner products of the pairs: equal vectors give equal products wherever they lie, which a matrix product doesn't promise."""
    parts = [(q[row[i:i + PAIRS]] * v[col[i:i + PAIRS]]).sum(axis=1) for i in range(0, len(row), PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def best_of(q: np.ndarray, asked: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and product of each query's ``k`` best vectors, ties to the smaller id; a query is none of its own. The matrix product only
    leaves out what lies below the k-th value by more than its rounding; what is left is chosen by the products that are reported."""
    near = q @ v.T
    near[asked[:, None] == ids[None, :]] = -np.inf
    n = min(k, near.shape[1])
    last = np.partition(near, near.shape[1] - n, axis=1)[:, near.shape[1] - n]
    slack = 1e-13 * q.shape[1] * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
    row, col = np.nonzero((near >= (last - slack)[:, None]) & (near > -np.inf))
    score = products(q, v, row, col)
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], col[keep], score[keep]


def _search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best ``k`` of each bucket a query probes."""
    keys = ["part", "axis", "vblock", "qblock"]
    left = _blocks(queries, "qblock", vectors, "vblock")
    right = _blocks(vectors, "vblock", queries, "qblock")
    schema = "query_id long, vec_id long, score double"

    def run(qs: pa.Table, vs: pa.Table) -> pa.Table:
        ids = vs.column("id").to_numpy()
        v = vs.column("vector").combine_chunks()
        q = qs.column("vector").combine_chunks()
        if not len(v) or not len(q):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=["query_id", "vec_id", "score"])
        v, q = (x.flatten().to_numpy().reshape(len(x), -1) for x in (v, q))
        asked = qs.column("id").to_numpy()
        row, col, score = best_of(q, asked, v, ids, k)
        return pa.table([pa.array(asked[row]), pa.array(ids[col]), pa.array(score)], names=["query_id", "vec_id", "score"])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def needed_probes(rows: DataFrame, queries: DataFrame, tables: int, top: float | None, k: int) -> int:
    """The fewest probes, ``PROBES`` at least, by which the tables hold ``AIM`` of the ``k`` true neighbours of ``SAMPLE`` queries (the smallest hashes of
    their ids): those are found exactly, and each is held by a table if its axis is among the query's nearest ``probes``. Every axis probed is every vector."""
    got = smallest_hashes(queries.withColumn("_h", F.xxhash64("id")), "_h", SAMPLE).select("id", "vector").toArrow()
    if not got.num_rows:
        return PROBES
    asked, q = got.column("id").to_numpy(), _matrix(got.column("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column(0).to_numpy()
            r, c, s = best_of(q, asked, _matrix(b.column(1)), own, k)
            row, ids, score = np.concatenate([row, r]), np.concatenate([ids, own[c]]), np.concatenate([score, s])
            order = np.lexsort((ids, -score, row))
            row, ids, score = row[order], ids[order], score[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, ids, score = row[keep], ids[keep], score[keep]
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(ids), pa.array(score)], names=["query", "id", "score"])

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    near = (rows.select("id", "vector").mapInArrow(run, "query long, id long, score double").withColumn("_n", F.row_number().over(best))
            .where(F.col("_n") <= k).select("query", "id"))
    pairs = rows.join(F.broadcast(near), "id").select("query", "vector").toArrow()
    if not pairs.num_rows:
        return PROBES
    row, v = pairs.column("query").to_numpy(), unit_rows(_matrix(pairs.column("vector")), top)
    u = unit_rows(q, None)
    size = padded(v.shape[1])
    need = np.full(len(row), 2 * size)
    for t in range(tables):
        place = np.argsort(axes(rotate(u, t, size), 2 * size), axis=1)  # of each axis in the query's order
        need = np.minimum(need, place[row, axes(rotate(v, t, size), 1)[:, 0]] + 1)
    return max(PROBES, int(np.sort(need)[int(np.ceil(AIM * len(need))) - 1]))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as rows."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy().reshape(len(whole), -1)


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, tables: int = TABLES,
            probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where the column ``is_query`` holds its ``k`` nearest found (all candidates, if fewer).

    Score is the inner product of the original vectors in double precision; ranks run from 1, ties go to the smaller id, and a row is no candidate
    of its own. Without ``probes`` a sample of the queries says how many are needed. Rows without a usable vector, or of another width than most, take no part. Ids are unique; an id that occurs twice counts once (the first by
    vector). An empty table gives no row.
    """
    ask = fresh(vectors.columns, "_ask")
    flagged = vectors.withColumn(ask, is_query)
    rows = usable(flagged, id_col, vector_col)
    widths = rows.groupBy(F.size("vector").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("w")).limit(1).collect()
    if not widths:
        return vectors.sparkSession.createDataFrame([], T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
                                                                      T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]))
    rows = rows.where(F.size("vector") == widths[0].w).groupBy("id").agg(F.min("vector").alias("vector"))
    rows = stage_table(rows, "vectors")
    same = Window.partitionBy("h", "vector").orderBy("id")
    entered = (rows.withColumn("h", F.xxhash64("vector")).withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).select("id", "vector"))
    asked = flagged.where(F.col(ask)).select(F.col(id_col).cast("long").alias("id")).distinct()
    queries = stage_table(rows.join(asked, "id", "left_semi"), "queries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    least, most = rows.agg(F.min(norm), F.max(norm)).first()
    top = None if most - least <= 1e-3 * most else float(most)
    index = stage_table(_entries(entered, list(range(tables)), 1, top), "index")
    width = widths[0].w + (top is not None)
    every = 2 * padded(width)
    if probes is None:
        probes = needed_probes(rows, queries, tables, top, k)
    probing = _probing(queries, list(range(tables)), probes, top)
    found = stage_table(_ranked(_search(index, probing, k), k), "found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    rest = _search(index.where("part = 0"), _probing(queries.join(full, "id", "left_anti"), [0], every, top), k)
    return _ranked(found.drop("rank").unionByName(rest), k)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` best of pairs that may repeat, ranked."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _probing(queries: DataFrame, tables: list[int], probes: int, top: float | None) -> DataFrame:
    """Entries of queries: unit vectors, with a zero for the component that evens out norms. Their own vector goes along unchanged."""
    if top is None:
        return _entries(queries, tables, probes, None)
    padded = queries.select("id", F.concat("vector", F.array(F.lit(0.0))).alias("vector"))
    got = _entries(padded, tables, probes, None)
    return got.withColumn("vector", F.slice("vector", 1, F.size("vector") - 1))
