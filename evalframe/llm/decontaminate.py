"""Operator 6: benchmark decontamination by size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length. An item is the set of its
distinct ``k``-word shingles (case-folded words of letters and digits; an item of fewer words is one shingle of all
its words). An item of ``n`` shingles counts as contained when a document has at least
``need = ceil(threshold * n)`` of them.

Items are partitioned by ``n`` into classes of powers of two. Within a class each item's MinHash sketch is
its bottom ``s`` shingle hashes. A document that holds ``need`` of the item's ``n`` shingles holds at
least ``s - (n - need)`` of any ``s`` of them, so a candidate must hit that many sketch values; with ``s = n - need + extra``
for the class's ``extra`` hits no contained item is missed. Candidates are verified by the exact shingle
intersection. Unlike the Jaccard form, nothing depends on the document's length.

The items are the query set: they are dealt into blocks of at most ``block_chars`` characters
(one broadcast each, bounded), and all documents are scanned against each block. Documents are
never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.words import PUNCTUATION, gram_hashes, split_words, text_groups

K, THRESHOLD = 5, 0.8
FILTER_BITS = 18


def extra_hits(n: int) -> int:
    """Sketch hits asked for beyond the guaranteed minimum, by the size class of ``n`` shingles."""
    return min(8, max(1, n.bit_length() - 2))


class ItemIndex:
    """Sketches and exact sets of one block of items, by shingle length."""

    def __init__(self, items: list[tuple], k: int = K, threshold: float = THRESHOLD):
        self.ids, self.sets, self.need, self.hits, self.k = [], [], [], [], []
        entries: dict[int, list[tuple[int, int]]] = {}
        hashes, _, _, offsets = split_words([(t or "").encode() for _, t in items], PUNCTUATION, fold=True)
        for (item, _), a, b in zip(items, offsets[:-1], offsets[1:], strict=True):
            if b == a:
                continue
            own_k = int(min(k, b - a))
            shingles = np.unique(gram_hashes(hashes[a:b], own_k))
            n = len(shingles)
            need = math.ceil(round(threshold * n, 9))
            extra = min(extra_hits(n), need)
            at = len(self.ids)
            for to, v in ((self.ids, item), (self.sets, shingles), (self.need, need), (self.hits, extra), (self.k, own_k)):
                to.append(v)
            entries.setdefault(own_k, []).extend((int(h), at) for h in shingles[:n - need + extra])
        self.by_k = {}
        for own_k, found in entries.items():
            values = np.array([h for h, _ in found], np.uint64)
            order = np.argsort(values, kind="stable")
            sketch, first = np.unique(values[order], return_index=True)
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[(sketch >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.by_k[own_k] = sketch, np.append(first, len(order)), np.array([i for _, i in found])[order], bits

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(text index, item index, shared shingles) of every contained item."""
        hashes, _, _, offsets = split_words(texts, PUNCTUATION, fold=True)
        for own_k, (sketch, first, owner, bits) in self.by_k.items():
            grams = gram_hashes(hashes, own_k)
            at = np.flatnonzero(bits[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            where = np.searchsorted(sketch, grams[at])
            where[where == len(sketch)] = 0
            real = sketch[where] == grams[at]
            at, where = at[real], where[real]
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + own_k <= offsets[doc + 1]
            hits = np.unique(np.stack([doc[inside], where[inside]]), axis=1)
            pairs: dict[tuple[int, int], int] = {}
            for d, w in hits.T.tolist():
                for i in owner[first[w]:first[w + 1]].tolist():
                    pairs[d, i] = pairs.get((d, i), 0) + 1
            own, last = None, -1
            for (d, i), n in sorted(pairs.items()):
                if n < self.hits[i]:
                    continue
                if d != last:
                    own, last = np.unique(grams[offsets[d]:offsets[d + 1] - own_k + 1]), d
                shared = int(np.isin(self.sets[i], own, assume_unique=True).sum())
                if shared >= self.need[i]:
                    yield d, i, shared


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """Distinct items in blocks whose text is about ``block_chars`` characters; each is collected on its own. All texts of one id are in one block,
    where the best of them counts."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").distinct()
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b)
        yield [(r.i, r.t) for r in part.sort("i", "t").collect()]


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", k: int = K, threshold: float = THRESHOLD, block_chars: int = 16_000_000) -> DataFrame:
    """One row per document row and benchmark item it contains: ``id_col, item_col, n_shared, n_item, containment``.

    Null or empty texts and items match nothing. Items with the same id but other texts are searched one by one and the best
    counts; repeated document rows give repeated results; empty tables give no rows; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), T.StructField(item_col, benchmark.schema[item_col].dataType),
                           T.StructField("n_shared", T.LongType()), T.StructField("n_item", T.LongType())])
    out = None
    for items in item_blocks(benchmark, item_col, item_text_col, block_chars):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, k, threshold))
        found = rows.mapInArrow(_searcher(index, schema, id_col), schema)
        out = found if out is None else out.unionByName(found)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def _searcher(index, schema: T.StructType, id_col: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        for b in batches:
            for rows, texts in text_groups(b.column(1)):
                best: dict[tuple, tuple[int, int]] = {}
                for d, i, shared in items.search(texts):
                    key, got = (rows[d], items.ids[i]), (shared, len(items.sets[i]))
                    if key not in best or got[0] * best[key][1] > best[key][0] * got[1]:
                        best[key] = got
                if best:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([r for r, _ in best])), pa.array([i for _, i in best], arrow.field(1).type),
                                                      pa.array([v[0] for v in best.values()], pa.int64()), pa.array([v[1] for v in best.values()], pa.int64())],
                                                     schema=arrow)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                      k: int = K, threshold: float = THRESHOLD, block_chars: int = 16_000_000) -> DataFrame:
    """The document rows that contain no benchmark item, all columns unchanged. Row-wise: no join, no shuffle."""
    at = docs.columns.index(text_col)
    for items in item_blocks(benchmark, item_col, item_text_col, block_chars):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, k, threshold))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for rows, texts in text_groups(b.column(at)):
                    for d, _, _ in index.value.search(texts):
                        clean[rows[d]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
