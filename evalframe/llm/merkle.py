"""Merkle manifest of a dataset: a root over all rows, and for each row the proof that it belongs to that root.

Rows hash to leaves. Within a group the leaves stand in order of their ids; every three consecutive nodes (the last run of a
level may be shorter, even one) become their hash until one node, the subroot, remains. The subroots, in order of the group
(null first, then bytewise), become the root in the same way. Hashes are SHA-256 in lowercase hex, over the
concatenated hex text of the run.

Time-forward processing. A node's label is (level, number). Messages wait in a priority queue ordered by the label of
the node they are for: a leaf sends its digest to its parent; the smallest label is taken off with all its messages, hashed, and
the digest sent on. A second sweep runs from the root down: a node that is taken off sends each child its proof suffix, which
is the child's siblings followed by the node's own suffix. The queue is external: between blocks (subtrees of ``3 ** height`` consecutive
nodes) it is a written table that Spark deals by (group, block) and sorts by label, spilling where it must; within a block it is a heap.
So a task holds one block at a time, whatever the size of a group, and a group of a third of all rows is as many blocks as its rows need.

The number of a leaf is its rank in its group. Rows are dealt into sorted ranges of (group, id, leaf, row); a range numbers its own rows,
and each range's first rank follows from one row per range on the driver (as many as there are partitions, whatever the data).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.graph import stage_table

FANOUT = 3
DEFAULT_HEIGHT = 7
#: Rows of one Arrow batch that leaves a task.
ROWS = 4096

PROOF = "array<struct<before: string, after: string>>"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


# ---- columns -------------------------------------------------------------------------------------

def leaf_hash(*fields: Column) -> Column:
    """Hash of a row's fields: each is ``-`` if null, else its length in UTF-8 bytes, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``proof`` leads to from ``leaf``."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


# ---- one block: the two sweeps over its queue ------------------------------------------------------

def climb(digests: Sequence[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """Root of a block after ``levels`` levels, and the run of digests that reached each label."""
    runs: dict[tuple[int, int], list[str]] = {}
    if not levels:
        return digests[0], runs
    queue = [((1, i // FANOUT), i, d) for i, d in enumerate(digests)]  # sorted, and so a heap
    while True:
        label, run = queue[0][0], []
        while queue and queue[0][0] == label:
            run.append(heappop(queue)[2])
        runs[label] = run
        digest = hashlib.sha256("".join(run).encode()).hexdigest()
        if label[0] == levels:
            return digest, runs
        heappush(queue, ((label[0] + 1, label[1] // FANOUT), label[1], digest))


def descend(n: int, levels: int, runs: dict[tuple[int, int], list[str]], above: tuple) -> list[tuple]:
    """Proof of each of the block's ``n`` nodes; ``above`` is the proof of its root."""
    if not levels:
        return [above]
    out: list[tuple] = [()] * n
    queue = [((-levels, 0), above)]
    while queue:
        (level, number), suffix = heappop(queue)
        run = runs[(-level, number)]
        for place in range(len(run)):
            below = (("".join(run[:place]), "".join(run[place + 1:])), *suffix)
            child = number * FANOUT + place
            if level == -1:
                out[child] = below
            else:
                heappush(queue, ((level + 1, child), below))
    return out


def levels_of(n: int, block: int, height: int) -> int:
    """Levels that a block of ``n`` nodes rises: the whole height, or until one node remains if it is all of its group."""
    if block or n == FANOUT ** height:
        return height
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


# ---- ranks ----------------------------------------------------------------------------------------

def _numbered(group: int):
    """Adds ``part`` (the task) and ``nth`` (place among the task's rows of its group) to sorted rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, began = TaskContext.get().partitionId(), None, 0, False
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(group)
            one, two = g.slice(1), g.slice(0, len(g) - 1)
            same = pc.or_(pc.fill_null(pc.equal(one, two), False), pc.and_(one.is_null(), two.is_null()))
            at = np.arange(len(g))
            new = np.concatenate([[True], ~same.to_numpy(zero_copy_only=False)])
            nth = at - np.maximum.accumulate(np.where(new, at, 0))
            if began and g[0].as_py() == last:
                head = int(np.flatnonzero(new)[1]) if new.sum() > 1 else len(g)
                nth[:head] += count
            last, count, began = g[-1].as_py(), int(nth[-1]) + 1, True
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(g), part, np.int32)), pa.array(nth)], [*b.schema.names, "part", "nth"])
    return run


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``rank`` (long, from 0): the row's place in its group by ``order`` (nulls first, texts bytewise)."""
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())])
    numbered = stage_table(dealt.mapInArrow(_numbered(rows.columns.index(group)), schema), "ranks")
    each = numbered.groupBy("part", group).agg(F.count("*").alias("n"))
    ends = each.groupBy("part").agg(F.min(F.struct(group, "n")).alias("first"), F.max(F.struct(group, "n")).alias("last"), F.count("*").alias("groups"))
    starts, before, group_before, seen = [], 0, None, False
    for r in sorted(ends.collect(), key=lambda r: r["part"]):  # one row a partition
        start = before if seen and r["first"][0] == group_before else 0
        starts.append((r["part"], r["first"][0], start))
        before, group_before, seen = (start if r["groups"] == 1 else 0) + r["last"][1], r["last"][0], True
    kinds = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("first_group", rows.schema[group].dataType), T.StructField("start", T.LongType())])
    first = F.broadcast(rows.sparkSession.createDataFrame(starts, kinds))
    rank = F.col("nth") + F.when(F.col(group).eqNullSafe(F.col("first_group")), F.col("start")).otherwise(F.lit(0))
    return numbered.join(first, "part").select(*rows.columns, rank.alias("rank"))


# ---- the sweeps over all blocks --------------------------------------------------------------------

def _up(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (grp, block, place, digest), sorted; a block begins at its place 0."""
        key, held, out = None, [], []

        def done():
            out.append((*key, climb(held, levels_of(len(held), key[1], height))[0]))

        def send():
            groups, blocks, digests = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(blocks, pa.int64()), pa.array(digests, pa.string())], ["grp", "rank", "digest"])

        for b in batches:
            groups, blocks, digests = b.column(0), b.column(1), b.column(3).to_pylist()
            cuts = np.flatnonzero(b.column(2).to_numpy() == 0).tolist()
            held.extend(digests[:cuts[0]] if cuts else digests)
            for at, to in zip(cuts, [*cuts[1:], len(digests)]):
                if key is not None:
                    done()
                key, held = (groups[at].as_py(), blocks[at].as_py()), digests[at:to]
            if len(out) >= ROWS:
                yield send()
        if key is not None:
            done()
        if out:
            yield send()
    return run


def _proofs(proofs: list[tuple]) -> pa.Array:
    steps = [s for p in proofs for s in p]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in proofs])]).astype(np.int32)
    parts = [pa.array([s[i] for s in steps], pa.string()) for i in (0, 1)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, fields=list(_STEP)))


def _down(height: int, keep: list[int], names: list[str]):
    """Rows (grp, block, place, digest, proof, subroot, payload...), sorted; a block begins with its message, at place -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[pa.RecordBatch] = []     # node rows, in order, that haven't left yet
        proofs: list[tuple] = []              # of the first of these rows
        roots: list[str] = []
        message, held = None, []

        def done():
            above, root, block = message
            levels = levels_of(len(held), block, height)
            _, runs = climb(held, levels)
            proofs.extend(descend(len(held), levels, runs, above))
            roots.extend([root] * len(held))

        def send():
            nonlocal pieces
            table = pa.Table.from_batches(pieces)
            left, n = table.slice(len(proofs)), len(proofs)
            for at in range(0, n, ROWS):
                to = min(at + ROWS, n)
                rows = table.slice(at, to - at).combine_chunks()
                columns = [rows.column(i).chunk(0) for i in keep]
                yield pa.RecordBatch.from_arrays([*columns, _proofs(proofs[at:to]), pa.array(roots[at:to], pa.string())], names)
            proofs.clear()
            roots.clear()
            pieces = left.combine_chunks().to_batches() if left.num_rows else []

        for b in batches:
            places = b.column(2).to_numpy()
            digests = b.column(3).to_pylist()
            cuts = np.flatnonzero(places == -1).tolist()
            if not cuts or cuts[0] > 0:
                to = cuts[0] if cuts else len(digests)
                held.extend(digests[:to])
                pieces.append(b.slice(0, to))
            for at, to in zip(cuts, [*cuts[1:], len(digests)]):
                if message is not None:
                    done()
                steps = b.column(4)[at].as_py()
                message = tuple((s["before"], s["after"]) for s in steps), b.column(5)[at].as_py(), b.column(1)[at].as_py()
                held = digests[at + 1:to]
                if to > at + 1:
                    pieces.append(b.slice(at + 1, to - at - 1))
            if len(proofs) >= ROWS:
                yield from send()
        if message is not None:
            done()
            yield from send()
    return run


def _dealt(rows: DataFrame) -> DataFrame:
    """The external queue: messages and nodes of a block in one task, in order of their label."""
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def _place(height: int) -> list[Column]:
    width = F.lit(FANOUT ** height).cast("bigint")
    return [F.floor(F.col("rank") / width).cast("bigint").alias("block"), (F.col("rank") % width).alias("place")]


def build(nodes: DataFrame, height: int = DEFAULT_HEIGHT) -> list[DataFrame]:
    """First sweep: ``grp, rank, digest`` of the leaves, of the roots of their blocks, and so on up to one root a group."""
    out = [nodes]
    while True:
        rows = _dealt(out[-1].select("grp", *_place(height), "digest"))
        out.append(stage_table(rows.mapInArrow(_up(height), "grp string, rank bigint, digest string"), "nodes"))
        if not out[-1].agg(F.max("rank")).first()[0]:
            return out


def deliver(levels: list[DataFrame], messages: DataFrame, payload: Sequence[str] = (), height: int = DEFAULT_HEIGHT) -> DataFrame:
    """Second sweep: from ``messages`` (``grp, rank, proof, subroot`` of the topmost nodes) to the leaves: ``digest``, ``payload``
    columns, ``proof`` and ``subroot``."""
    for no in range(len(levels) - 2, -1, -1):
        nodes = levels[no]
        extra = list(payload) if no == 0 else ["rank"]
        kinds = {f.name: f.dataType for f in nodes.schema.fields}
        told = messages.select("grp", F.col("rank").alias("block"), F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("string").alias("digest"), "proof", "subroot",
                               *[F.lit(None).cast(kinds[c]).alias(f"p_{i}") for i, c in enumerate(extra)])
        rows = nodes.select("grp", *_place(height), "digest", F.lit(None).cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"),
                            *[F.col(c).alias(f"p_{i}") for i, c in enumerate(extra)])
        schema = T.StructType([T.StructField("grp", T.StringType()), T.StructField("digest", T.StringType()), *[T.StructField(f"p_{i}", kinds[c]) for i, c in enumerate(extra)],
                               *T._parse_datatype_string(f"proof {PROOF}, subroot string").fields])
        keep = [0, 3, *range(6, 6 + len(extra))]
        out = _dealt(rows.unionByName(told)).mapInArrow(_down(height, keep, schema.names), schema)
        if no:
            messages = stage_table(out.select("grp", F.col("p_0").alias("rank"), "proof", "subroot"), "proofs")
    return out.select("digest", *[F.col(f"p_{i}").alias(c) for i, c in enumerate(payload)], "proof", "subroot")


def manifest(rows: DataFrame, id_col: str, group_col: str, leaf_col: str, payload: Sequence[str] = (), height: int = DEFAULT_HEIGHT) -> DataFrame:
    """The manifest of ``rows``: id, group, ``leaf``, ``subroot``, ``root``, ``proof`` (a step for each level: the digests before and
    after the node in its run) and the ``payload`` columns.

    ``leaf_col`` holds each row's leaf hash. Rows of one id in a group stand in order of their leaf; rows that agree in that too are as
    many leaves, each with a proof of its own. Null ids come first, rows of a null group make a group. No rows give no rows.
    Other columns of ``rows`` are not read."""
    spark = rows.sparkSession
    extra = [f"x_{i}" for i in range(len(payload))]
    leaves = stage_table(rows.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).alias("id"), F.col(leaf_col).alias("digest"),
                                     *[F.col(c).alias(x) for c, x in zip(payload, extra)], F.monotonically_increasing_id().alias("row")), "leaves")
    trees = build(ranked(leaves, "grp", ["id", "digest", "row"]), height)
    tops = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    top = build(ranked(tops, "grp", ["of"]), height)
    root = top[-1].first()
    start = spark.createDataFrame([("", 0, [], "")] if root else [], f"grp string, rank bigint, proof {PROOF}, subroot string")
    messages = stage_table(deliver(top, start, ["of"], height).select(F.col("of").alias("grp"), F.lit(0).cast("bigint").alias("rank"), "proof", F.col("digest").alias("subroot")), "proofs")
    out = deliver(trees, messages, ["id", "grp", *extra], height)
    return out.select(F.col("id").alias(id_col), F.col("grp").alias(group_col), F.col("digest").alias("leaf"), "subroot",
                      F.lit(root["digest"] if root else None).cast("string").alias("root"), "proof", *[F.col(x).alias(c) for c, x in zip(payload, extra)])
