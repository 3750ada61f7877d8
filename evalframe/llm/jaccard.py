"""Operator 1: n-gram Jaccard join, size-aware with light and heavy sets.

A document's set holds its distinct ``k``-word shingles. Two sets are linked when
``|A & B| >= t * |A | B|``; the result is the linked documents' components.

Sets are split by size at a boundary chosen by cost (``light_limit``):

* **Light** sets enumerate fixed-size subsets. A linked partner shares at least ``ceil(t * n)`` of the ``n`` shingles, so all subsets
  with up to ``n - ceil(t * n)`` shingles left out are keys; linked light sets share one, exactly.
* **Heavy** sets (and light ones that a heavy one can still reach) are entered in inverted lists. A list's key is a run of ``run`` shingles
  that follow each other in hash order, taken from the ``reach`` smallest shingles. Where two sets
  differ in a share of at most ``1 - t`` of their union, the pigeonhole principle forces a common run in the whole sets; in sets of more
  than ``reach`` shingles a common run is missing from the sampled part with a probability below ``MISS`` for a pair
  right at the threshold. Unlike single shingles, runs are not shared by documents that only have a line or passage in common,
  so a frequent passage makes no long list.

Scanning a list links every member to the list's smallest member only (candidates, linear in the list);
components of these candidates are verified exactly: each distinct set goes once to its component's
task, where sets that share one of their rarest shingles are compared until all that can be connected is (see ``link_sets``). Components of
more than ``block`` shingles are first cut to the sets that share rare shingles (see ``_refined``); what is still larger, groups of near
copies, is split into blocks (see ``_large``), so no task's memory follows a hot group. Equal sets are one node all along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.graph import connected_components, fresh, stage_table
from evalframe.llm.words import SPACES, mix, text_groups, text_shingles

MISS = 1e-10
RUN = 3
LIST_COST = 2
BLOCK = 4_000_000
SEEN = 100_000
#: Sets that one step of a hub's comparison takes.
TOGETHER = 4096


def run_length(t: float) -> int:
    """Longest run (at most RUN) that two sets linked at ``t`` must share: t/(1-t) common shingles per difference."""
    return RUN if t >= 1 else max(1, min(RUN, math.ceil(t / (1 - t) - 1e-9)))


def reach(t: float) -> int:
    """Number of runs to enter so that none is common with a probability of at most MISS."""
    if t >= 1:
        return 1
    w, p, lost = run_length(t), [1.0], 0
    state = np.zeros(run_length(t))
    state[0] = 1
    while state.sum() > MISS and lost < 4096:  # chains of common shingles, a run of w ends it
        state, lost = np.append((1 - t) * state.sum(), t * state[:-1]), lost + 1
    return max(lost - w + 1, 1)


def missing(n: int, t: float) -> int:
    """Shingles of an n-set that a linked set may lack."""
    return n - math.ceil(round(t * n, 9))


def subsets(n: int, t: float) -> int:
    return sum(math.comb(n, j) for j in range(missing(n, t) + 1))


def light_limit(t: float) -> int:
    """Largest size up to which enumerating subsets costs at most as much as entering and scanning lists."""
    n = 1
    while n < 64 and subsets(n + 1, t) <= LIST_COST * max(2, min(n + 2 - run_length(t), reach(t))):
        n += 1
    return n


def signatures(s: np.ndarray, t: float, light: int, runs: int, w: int) -> np.ndarray:
    """Keys of one sorted set: subsets if it is light, runs if it is heavy or in reach of a heavy one."""
    n, out = len(s), []
    if n <= light:
        m = mix(s, 11)
        whole = m.sum(dtype=np.uint64)
        for j in range(missing(n, t) + 1):
            left = np.array([m[list(c)].sum(dtype=np.uint64) for c in combinations(range(n), j)], np.uint64) if j else np.zeros(1, np.uint64)
            out.append(mix(whole - left, 100 + n - j))
    if n >= max(w, math.ceil(round(t * (light + 1), 9))):
        part = mix(s[:runs + w - 1], 13)
        key = np.zeros(max(len(part) - w + 1, 0), np.uint64)
        for j in range(w):
            key = mix(key + part[j:j + len(key)], 17 + j)
        out.append(key)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def node_of(s: np.ndarray) -> int:
    """64-bit identity of a set."""
    return int(mix(mix(s, 7).sum(dtype=np.uint64, keepdims=True), len(s))[0].astype(np.int64))


def _prepared(docs: DataFrame, text_col: str, k: int, t: float, sep, fold, exact: bool) -> DataFrame:
    """Row-wise: ``_id, _key, n, node, keys``; a task gives the keys of equal sets once (its map-side combine)."""
    light, runs, w = light_limit(t), 1 << 40 if exact else reach(t), run_length(t)
    schema = T.StructType([*docs.select("_id", "_key").schema, T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            n, nodes, keys = [], [], []
            for _, texts in text_groups(b.column(2)):
                for s in text_shingles(texts, k, sep, fold):
                    n.append(len(s))
                    nodes.append(node_of(s) if len(s) else None)
                    if not len(s) or nodes[-1] in seen:
                        keys.append(None)
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(nodes[-1])
                    keys.append(signatures(s, t, light, runs, w).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["_id", "_key", "n", "node", "keys"])

    return docs.select("_id", "_key", F.col(text_col).alias("_text")).mapInArrow(run, schema)


class _Union:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def roots(self) -> np.ndarray:
        up = self.up
        while not np.array_equal(up, up[up]):
            up = up[up]
        self.up = up
        return up


def link_sets(sets: list[np.ndarray], t: float, hubs: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(root, links tested so far) of each set, connected exactly as the links among the sets connect them.

    Shingles are ordered by the number of sets that hold them, rare ones first. Linked sets share one of the first ``missing + 1`` shingles of
    both, so a passage that many sets have in common brings no two of them together as long as they have enough rarer shingles.
    A *hub* is compared with all sets that share one of these with it. Once every set outside the largest component has been a
    hub, no untested pair can connect anything. With ``hubs`` given, just these are compared.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    token = rank[token]
    token = token[np.lexsort((token, owner))]
    start = np.concatenate([[0], np.cumsum(size)])
    head = 1 + size - -(-size * round(t * 10_000) // 10_000)
    early = np.arange(len(token)) - start[owner] < head[owner]
    by = np.argsort(token[early], kind="stable")
    posting, held = owner[early][by], token[early][by]
    first = np.searchsorted(held, np.arange(len(df) + 1))
    met = np.diff(first)
    weight = np.add.reduceat(met[token] * early, start[:-1])
    union, degree = _Union(n), np.zeros(n, np.int64)
    done, mark = weight <= head, np.zeros(len(df), bool)  # nobody else holds their first shingles

    def compare(h: int) -> None:
        done[h] = True
        own = token[start[h]:start[h] + head[h]]
        others = np.unique(np.concatenate([posting[first[x]:first[x + 1]] for x in own]))
        others = others[_linked(np.minimum(size[others], size[h]), np.maximum(size[others], size[h]), t)]
        whole = token[start[h]:start[h + 1]]
        mark[whole] = True
        for at in range(0, len(others), TOGETHER):
            some = others[at:at + TOGETHER]
            lengths = size[some]
            ends = np.cumsum(lengths)
            place = np.repeat(start[some] - ends + lengths, lengths) + np.arange(ends[-1])
            shared = np.add.reduceat(mark[token[place]].astype(np.int64), ends - lengths)
            hit = some[_linked(shared, lengths + size[h] - shared, t)]
            degree[h] += len(hit)
            root = union.find(h)
            for i in hit.tolist():
                other = union.find(i)
                if other != root:
                    root, other = min(root, other), max(root, other)
                    union.up[other] = root
        mark[whole] = False

    if hubs is not None:
        for h in hubs:
            if not done[h]:
                compare(h)
        return union.roots(), degree
    compare(int(np.argmax(weight)))
    while True:
        roots = union.roots()
        count = np.bincount(roots, minlength=n)
        outside = np.flatnonzero(~done & (roots != np.argmax(count)))
        if not len(outside):
            return union.roots(), degree
        order = outside[np.argsort(-weight[outside], kind="stable")]
        largest = int(np.argmax(count))
        for h in order[:max(1, len(order) // 8)].tolist():
            if union.find(h) != union.find(largest):
                compare(h)


def _linked(shared: np.ndarray, union: np.ndarray, t: float) -> np.ndarray:
    """shared >= t * union in whole numbers (t as hundredths of a percent)."""
    return (shared * 10_000 >= union * round(t * 10_000)) & (shared > 0)


def _roots(sets: DataFrame, by: list[str], t: float) -> DataFrame:
    """``by, node, root, degree`` of the sets in each group (a group is one block)."""
    schema = T.StructType([*(sets.schema[c] for c in by), *(T.StructField(c, T.LongType()) for c in ("node", "root", "degree"))])

    def run(group: pa.Table) -> pa.Table:
        nodes, index = np.unique(group.column("node").to_numpy(), return_index=True)
        raw = group.column("shingles")
        roots, degree = link_sets([np.frombuffer(raw[int(i)].as_py(), np.uint64) for i in index], t)
        keys = [pa.array([group.column(c)[0].as_py()] * len(nodes), pa.int64()) for c in by]
        return pa.table([*keys, pa.array(nodes), pa.array(nodes[roots]), pa.array(degree)], names=[*by, "node", "root", "degree"])

    return sets.groupBy(*by).applyInArrow(run, schema)


def _large(sets: DataFrame, t: float) -> DataFrame:
    """Edges that connect components of several blocks exactly.

    Blocks are linked on their own; each block's largest group names its best connected set as pivot, and pivots are compared with each
    other. Sets of the groups whose pivots are connected (the core) need no test among
    themselves; every other set is compared with all sets of its component, block by block.
    """
    inner = stage_table(_roots(sets, ["label", "block"], t), "blocks")
    groups = inner.groupBy("label", "block", "root").agg(F.count("*").alias("size"), F.max(F.struct("degree", "node")).node.alias("pivot"))
    largest = groups.groupBy("label", "block").agg(F.max(F.struct("size", "root", "pivot")).alias("g")).select("label", "block", "g.size", "g.root", "g.pivot")
    pivots = sets.join(largest.select(F.col("pivot").alias("node"), "label", "size"), ["label", "node"], "left_semi")
    among = stage_table(_roots(pivots, ["label"], t).select("label", F.col("node").alias("pivot"), F.col("root").alias("core")), "pivots")
    weights = largest.join(among, ["label", "pivot"]).groupBy("label", "core").agg(F.sum("size").alias("size"))
    chosen = weights.groupBy("label").agg(F.max(F.struct("size", "core")).core.alias("core"))
    core = largest.join(among, ["label", "pivot"]).join(chosen, ["label", "core"]).select("label", "block", "root", "core")
    outside = inner.join(core, ["label", "block", "root"], "left_anti").select("label", "node")
    rest = sets.join(outside, ["label", "node"], "left_semi").withColumnRenamed("block", "outer")
    blocks = sets.select("label", "block").distinct()
    outer = rest.select("label", "outer").distinct()
    probes = rest.join(blocks, "label").select("label", "outer", "block", "node", "shingles", F.lit(True).alias("probe"))
    against = sets.join(outer, "label").select("label", "outer", "block", "node", "shingles", F.lit(False).alias("probe"))

    def run(group: pa.Table) -> pa.Table:
        nodes, probe = group.column("node").to_numpy(), group.column("probe").to_numpy(zero_copy_only=False)
        order = np.lexsort([~probe, nodes])
        order = order[np.append(True, nodes[order][1:] != nodes[order][:-1])]
        raw = group.column("shingles")
        roots, _ = link_sets([np.frombuffer(raw[int(i)].as_py(), np.uint64) for i in order], t, np.flatnonzero(probe[order]).tolist())
        mine = nodes[order]
        return pa.table([pa.array(mine), pa.array(mine[roots])], names=["a", "b"])

    crossing = probes.unionByName(against).groupBy("label", "outer", "block").applyInArrow(run, "a long, b long")
    return (inner.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(among.select(F.col("pivot").alias("a"), F.col("core").alias("b")))
            .unionByName(crossing))


def _refined(sets: DataFrame, t: float, block: int) -> DataFrame:
    """``sets`` of components above one block, with the labels and blocks of smaller ones: of the sets that share one of their first
    ``missing + 1`` shingles, rare ones in the component first. Linked sets share one, so no link is lost; sets without a partner are left out.

    Shingles are counted and ranked as rows (plain joins and windows), so nothing of a component meets in one task."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, raw in enumerate(b.column(2)):
                token = np.frombuffer(raw.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([*(pa.array(np.full(len(token), b.column(c)[i].as_py(), np.int64)) for c in (0, 1)), pa.array(token)], ["label", "node", "token"])

    tokens = stage_table(sets.select("label", "node", "shingles").mapInArrow(cut, "label long, node long, token long"), "tokens")
    df = tokens.groupBy("label", "token").agg(F.count("*").alias("df"))
    ranked = tokens.join(df, ["label", "token"]).withColumn("at", F.row_number().over(Window.partitionBy("label", "node").orderBy("df", "token")))
    sizes = tokens.groupBy("label", "node").agg(F.count("*").alias("n"))
    head = F.expr(f"n - (n * {round(t * 10_000)} + 9999) div 10000 + 1")
    early = stage_table(ranked.where("df > 1").join(sizes, ["label", "node"]).where(F.col("at") <= head).select("label", "token", "node"), "early")
    heads = early.groupBy("label", "token").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").select("label", "token", "head")
    stars = early.join(heads, ["label", "token"]).where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    labels = connected_components(stars).select("node", F.col("component").alias("label"))
    labelled = stage_table(labels.join(sizes.drop("label"), "node"), "refined")
    blocks = labelled.groupBy("label").agg(F.ceil(F.sum("n") / F.lit(block)).alias("blocks"))
    again = labelled.join(blocks, "label").select("node", "label", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    return sets.select("node", "shingles").join(again, "node").select(sets.columns)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _key, _text``: the key tells rows apart that differ in id or text."""
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"))


def _components(rows: DataFrame, k: int, threshold: float, sep: np.ndarray, fold: bool, block: int, exact: bool) -> tuple[DataFrame, DataFrame]:
    """All rows' ``_id, _key, n, node``, and ``node, root, first`` of the distinct sets: root names the component, first is the
    smallest (id missing, id, key) with that set."""
    table = stage_table(_prepared(rows, "_text", k, threshold, sep, fold, exact), "sets")
    entries = table.where("keys is not null").select(F.explode("keys").alias("key"), "node")
    heads = entries.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").select("key", "head")
    scanned = entries.join(heads, "key").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    labels = connected_components(scanned)
    first = F.min(F.struct(F.col("_id").isNull().alias("missing"), F.col("_id").alias("id"), F.col("_key").alias("key")))
    sizes = table.where("n > 0").groupBy("node").agg(F.min("n").alias("n"), first.alias("first"))
    nodes = stage_table(sizes.join(labels, "node", "left").select("node", "n", F.col("component").alias("label"), "first"), "nodes")
    linked = nodes.where("label is not null")
    blocks = linked.groupBy("label").agg(F.ceil(F.sum("n") / F.lit(block)).alias("blocks"))
    wanted = linked.join(blocks, "label").select("node", "label", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), F.col("first.key").alias("_key"))
    sets = _shingles(rows, wanted, k, sep, fold)
    several = wanted.where("blocks > 1").limit(1).count() > 0
    if several:
        sets = stage_table(sets, "shingles")
        parts = stage_table(_refined(sets.where("blocks > 1"), threshold, block), "parts")
        small = sets.where("blocks = 1").unionByName(parts.where("blocks = 1"))
        found = _roots(small, ["label"], threshold).select(F.col("node").alias("a"), F.col("root").alias("b"))
        if parts.where("blocks > 1").limit(1).count():
            found = found.unionByName(_large(parts.where("blocks > 1"), threshold))
        found = connected_components(found)
    else:
        found = _roots(sets, ["label"], threshold).select("node", F.col("root").alias("component"))
    named = nodes.select("node", "first").join(found, "node", "left").select("node", "first", F.coalesce("component", "node").alias("root"))
    return table.select("_id", "_key", "n", "node"), stage_table(named, "named")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, threshold: float = 0.9,
                       sep: np.ndarray = SPACES, fold: bool = True, block: int = BLOCK, exact: bool = False) -> DataFrame:
    """``id_col, n_shingles, component_id`` per document row.

    Words are runs of non-separators, A-Z folded if ``fold``. ``component_id`` is the smallest id reachable over links, the row's own included.
    A text with fewer than ``k`` words has its whole sequence as the only shingle; a null or empty one, or one
    without words, has no shingle and is linked with nothing. Repeated rows and rows with equal sets are linked. Null ids are kept, and never the smallest. Other columns
    aren't read; an empty table gives no row. With ``exact`` every run of a heavy set is entered, so that no chance is involved (about eight times the entries for texts of 300 words).
    """
    table, named = _components(_keyed(docs, id_col, text_col), k, threshold, sep, fold, block, exact)
    smallest = named.groupBy("root").agg(F.min("first").id.alias("smallest"))
    ids = named.join(smallest, "root").select("node", "smallest")
    return (table.join(ids, "node", "left")
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("smallest")).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8,
             sep: np.ndarray = SPACES, fold: bool = True, block: int = BLOCK, exact: bool = False) -> DataFrame:
    """One row of each component (the smallest id, then key), all columns unchanged. Rows without shingles are linked with nothing and stay."""
    table, named = _components(_keyed(docs, id_col, text_col), k, threshold, sep, fold, block, exact)
    chosen = named.groupBy("root").agg(F.min("first").key.alias("_key")).select("_key", F.lit(False).alias("_every"))
    kept = chosen.unionByName(table.where("node is null").select("_key", F.lit(True).alias("_every")).distinct())
    key, every, number = (fresh(docs.columns, c) for c in ("_key", "_every", "_number"))
    rows = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col))).join(kept.toDF(key, every), key)
    order = F.row_number().over(Window.partitionBy(key).orderBy(every))
    return rows.withColumn(number, order).where(F.col(every) | (F.col(number) == 1)).select(*docs.columns)


def _shingles(rows: DataFrame, wanted: DataFrame, k: int, sep, fold) -> DataFrame:
    """The wanted nodes' sets, made again from one document of each."""
    joined = rows.join(wanted, "_key").select("_text", "node", "label", "blocks", "block")
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("node", "label", "blocks", "block")), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in text_groups(b.column(0)):
                sets = text_shingles(texts, k, sep, fold)
                keep = [i for i, s in zip(at, sets, strict=True) if len(s) and node_of(s) == b.column(1)[i].as_py()]
                part = b.take(pa.array(keep, pa.int64()))
                raw = {i: s.tobytes() for i, s in zip(at, sets, strict=True)}
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(1, 5)), pa.array([raw[i] for i in keep], pa.binary())],
                                                 names=["node", "label", "blocks", "block", "shingles"])

    return joined.mapInArrow(run, schema)
