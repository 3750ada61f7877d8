"""Operator 3: substring deduplication by an index of word windows, in the form of a relative Lempel-Ziv parse.

Every document is held against a reference: all documents with smaller ids. A *factor* is a stretch of words
copied from one place of one reference document; factors of at least ``window`` words are duplicate spans. They are found window
by window and merged afterwards; no longest match is extended, so a factor ends where the smallest holder of its windows changes.

The reference is indexed in blocks, each a range of hash values, and documents visit every
block that could hold a match for them:

1. *Anchors.* Each ``window`` of words has an anchor, the smallest-hashed of its ``gram``-word grams; equal windows have equal
   anchors, and neighbouring windows mostly share one. An anchor block finds anchors that occur in two documents; windows with
   any other anchor cannot match and go no further.
2. *Index.* The remaining windows are entered by hash, together with their neighbours of the same anchor. A block
   names for each window the smallest document that holds it, and gives larger ones the pieces (start, windows, source, source start) they copy.
3. *Merge.* A document's pieces are joined, left to right, into factors as long as source and position run on. Every window, also one that straddles a factor
   boundary, has been looked up on its own, so what one factor ends another goes on with, and no window is lost.

Texts of a task are indexed together before anything is shuffled: an anchor or window that several of them share
travels once, and the other holders' results are known at once. So a passage in a third of all documents
makes one entry per task and not one per document. What is shuffled is packed by block and task as byte arrays in document order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.words import SPACES, gram_hashes, mix, split_words, text_groups

WINDOW, GRAM = 13, 7
BLOCK_CHARS = 24_000_000
GROUP_BYTES = 8 << 20
PACKED = "slice int, known boolean, ids binary, keys binary, counts binary, hashes binary, starts binary, lengths binary"
PIECES = "key long, start long, windows long, source_id long, source_start long"


def _windows(texts: list[bytes], window: int, gram: int, sep: np.ndarray):
    """(text index, start, window hash, anchor hash) of every window, in order; starts count from the text's first word."""
    hashes, _, _, offsets = split_words(texts, sep)
    whole = gram_hashes(hashes, window)
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), whole, whole
    grams = gram_hashes(hashes, gram, 5)
    at = np.flatnonzero(np.arange(len(whole)) + window <= np.repeat(offsets[1:], np.diff(offsets))[:len(whole)])
    anchor = sliding_window_view(grams, window - gram + 1)[at].argmin(1) + at
    text = np.searchsorted(offsets, at, side="right") - 1
    return text, at - offsets[text], whole[at], grams[anchor]


def _firsts(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)


def _own_smallest(values: np.ndarray, ids: np.ndarray, starts: np.ndarray):
    """For each entry the smallest id with its value, that id's first start, and whether another id has the value."""
    order = np.lexsort([starts, ids, values])
    first = _firsts(values[order])
    group = np.cumsum(first) - 1
    head = order[first]
    last = order[np.append(np.flatnonzero(first)[1:], len(order)) - 1] if len(order) else head
    where = np.empty(len(order), np.int64)
    where[order] = group
    return ids[head][where], starts[head][where], (ids[head] != ids[last])[where]


def _packed(part: np.ndarray, text: np.ndarray, ids: np.ndarray, keys: np.ndarray, hashes: np.ndarray, starts: np.ndarray | None) -> Iterator[tuple]:
    """Rows of PACKED, one per block: entries in document order, ids and starts run-length coded."""
    order = np.argsort(part, kind="stable")
    cuts = np.append(np.flatnonzero(_firsts(part[order])), len(order))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        fresh = _firsts(text[own])
        if starts is None:
            heads, lengths, begun = np.flatnonzero(fresh), b"", b""
            counts = np.diff(np.append(heads, len(own)))
        else:
            run = fresh | np.append(True, np.diff(starts[own]) != 1)
            runs = np.flatnonzero(run)
            heads = np.flatnonzero(fresh)
            counts = np.diff(np.append(np.searchsorted(runs, heads), len(runs)))
            begun, lengths = starts[own][runs].astype("<u4").tobytes(), np.diff(np.append(runs, len(own))).astype("<u4").tobytes()
        which = text[own][heads]
        yield (int(part[own[0]]), False, ids[which].tobytes(), keys[which].tobytes(), counts.astype("<u4").tobytes(), hashes[own].tobytes(), begun, lengths)


def _known(columns: list[np.ndarray], at: int) -> tuple:
    """Results that need no block, carried along as one row: int64 columns one after the other."""
    return at, True, b"", b"", b"", np.stack(columns).astype("<i8").tobytes(), b"", b""


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]
    names = [f.split(" ")[0] for f in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _pieces(row: np.ndarray, starts: np.ndarray, source: np.ndarray, source_start: np.ndarray):
    """Starts and window counts of runs that go on in their row and in their source."""
    go_on = (np.diff(row) == 0) & (np.diff(starts) == 1) & (np.diff(source) == 0) & (np.diff(source_start) == 1)
    heads = np.flatnonzero(np.append(True, ~go_on)) if len(row) else np.zeros(0, np.int64)
    return heads, np.diff(np.append(heads, len(row)))


def _grouped(batches: Iterator[pa.RecordBatch]):
    """(ids, keys, batch rows, texts) of bounded groups of rows ``key, id, text, ...``."""
    for b in batches:
        b = b.filter(b.column(1).is_valid())
        keys, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
        for rows, texts in text_groups(b.column(2), GROUP_BYTES):
            yield ids[rows].astype(np.int64), keys[rows], b, rows, texts


def _anchor_rows(slices: int, window: int, gram: int, sep: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, _, _, texts in _grouped(batches):
            text, _, _, anchors = _windows(texts, window, gram, sep)
            if not len(text):
                continue
            order = np.lexsort([anchors, text])
            order = order[_firsts(text[order]) | _firsts(anchors[order])]  # each anchor once a document
            text, anchors = text[order], anchors[order]
            smallest, _, shared = _own_smallest(anchors, ids[text], text)
            rows = []
            if shared.any():
                rows.append(_known([keys[text[shared]], anchors[shared].view(np.int64)], int(keys[0] % slices)))
            sent = ids[text] == smallest
            part = ((anchors[sent] >> np.uint64(20)) % np.uint64(slices)).astype(np.int64)
            rows.extend(_packed(part, text[sent], ids, keys, anchors[sent], None))
            yield _batch(rows)

    return run


def _unpacked(table: pa.Table):
    """Known results and the entries of one block: ``known rows, (ids, keys, row number, hashes, starts)``."""
    known, found, n = [], [], 0
    cols = [table.column(c) for c in range(1, 8)]
    for i in range(table.num_rows):
        is_known, ids, keys, counts, hashes, begun, lengths = (c[i].as_py() for c in cols)
        if is_known:
            known.append(np.frombuffer(hashes, "<i8"))
            continue
        ids, keys, counts = np.frombuffer(ids, np.int64), np.frombuffer(keys, np.int64), np.frombuffer(counts, "<u4").astype(np.int64)
        hashes = np.frombuffer(hashes, np.uint64)
        if len(begun):
            lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
            row = np.repeat(np.repeat(np.arange(len(ids)), counts), lengths)
            starts = np.repeat(np.frombuffer(begun, "<u4").astype(np.int64) - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(len(hashes))
        else:
            row, starts = np.repeat(np.arange(len(ids)), counts), np.zeros(len(hashes), np.int64)
        found.append((ids[row], keys[row], row + n, hashes, starts))
        n += len(ids)
    return known, tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else None


def _shared_anchors(table: pa.Table) -> pa.Table:
    known, entries = _unpacked(table)
    keys, anchors = [k.reshape(2, -1)[0] for k in known], [k.reshape(2, -1)[1] for k in known]
    if entries:
        ids, own, _, hashes, starts = entries
        _, _, shared = _own_smallest(hashes, ids, starts)
        keys.append(own[shared])
        anchors.append(hashes[shared].view(np.int64))
    return pa.table([pa.array(np.concatenate(keys)), pa.array(np.concatenate(anchors))], names=["key", "anchor"])


def _window_rows(slices: int, window: int, gram: int, sep: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, b, rows, texts in _grouped(batches):
            text, start, hashes, anchors = _windows(texts, window, gram, sep)
            lists = b.column(3).take(pa.array(rows))
            wanted = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy())
            tag = mix(wanted, 3) + mix(owner.astype(np.uint64), 4)
            keep = np.isin(mix(anchors, 3) + mix(text.astype(np.uint64), 4), tag)
            text, start, hashes, anchors = text[keep], start[keep], hashes[keep], anchors[keep]
            if not len(text):
                continue
            smallest, at, _ = _own_smallest(hashes, ids[text], start)
            copied = ids[text] > smallest
            out = []
            if copied.any():
                t, s, src, src_at = text[copied], start[copied], smallest[copied], at[copied]
                heads, n = _pieces(t, s, src, src_at)
                out.append(_known([keys[t[heads]], s[heads], n, src[heads], src_at[heads]], int(keys[0] % slices)))
            sent = ~copied
            part = ((anchors[sent] >> np.uint64(20)) % np.uint64(slices)).astype(np.int64)
            out.extend(_packed(part, text[sent], ids, keys, hashes[sent], start[sent]))
            yield _batch(out)

    return run


def _copied_pieces(table: pa.Table) -> pa.Table:
    known, entries = _unpacked(table)
    found = [k.reshape(5, -1) for k in known]
    if entries:
        ids, keys, row, hashes, starts = entries
        smallest, at, _ = _own_smallest(hashes, ids, starts)
        copied = ids > smallest
        row, starts, smallest, at, keys = row[copied], starts[copied], smallest[copied], at[copied], keys[copied]
        heads, n = _pieces(row, starts, smallest, at)
        found.append(np.stack([keys[heads], starts[heads], n, smallest[heads], at[heads]]))
    columns = np.concatenate(found, axis=1)
    return pa.table([pa.array(np.ascontiguousarray(c)) for c in columns], names=["key", "start", "windows", "source_id", "source_start"])


def with_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, sep: np.ndarray = SPACES,
                slices: int | None = None) -> DataFrame:
    """The documents as ``_key, _id, _text, pieces``: what each copies from documents with smaller ids.

    ``pieces`` is an array of (start, windows, source_id, source_start) in no order, null without any. Rows with a null id are no reference and copy
    nothing. Only ``id_col`` (integer) and ``text_col`` are read. ``slices`` is the number of index blocks; by default one for each
    shuffle partition and for each BLOCK_CHARS characters at least.
    """
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    spark = docs.sparkSession
    if slices is None:
        chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / BLOCK_CHARS))
    usable = rows.where("_id is not null and _text is not null")
    shared = (usable.mapInArrow(_anchor_rows(slices, window, gram, sep), PACKED).groupBy("slice").applyInArrow(_shared_anchors, "key long, anchor long")
              .groupBy("key").agg(F.collect_set("anchor").alias("anchors")))
    # no filter here: both joins read the very same exchange of the texts, so Spark shuffles them once
    candidates = rows.join(shared, rows["_key"] == shared["key"]).select("_key", "_id", "_text", "anchors")
    pieces = (candidates.mapInArrow(_window_rows(slices, window, gram, sep), PACKED).groupBy("slice").applyInArrow(_copied_pieces, PIECES)
              .groupBy("key").agg(F.collect_list(F.struct("start", "windows", "source_id", "source_start")).alias("pieces")))
    return rows.join(pieces, rows["_key"] == pieces["key"], "left").select("_key", "_id", "_text", "pieces")


def factors(pieces: list[dict], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """Factors of one document: (start, words, source_id, source_start) from left to right, pieces joined while source and position run on."""
    out: list[list[int]] = []
    for start, windows, source, at in sorted({(p["start"], p["windows"], p["source_id"], p["source_start"]) for p in pieces}):
        if out and out[-1][2] == source and start - out[-1][0] == at - out[-1][3] and start <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], start - out[-1][0] + windows)
        else:
            out.append([start, windows, source, at])
    return [(start, windows + window - 1, source, at) for start, windows, source, at in out]


def parse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, sep: np.ndarray = SPACES,
          slices: int | None = None) -> DataFrame:
    """Per document row ``id_col, n_words, n_removed, kept_text, factors``.

    ``factors`` holds the duplicate spans (start, words, source_id, source_start; words count from 0); ``kept_text`` is what no factor
    covers, words joined by one space. Null or empty texts have no words and an empty ``kept_text``; repeated rows copy nothing
    from each other (their ids are equal), and an empty table gives no row.
    """
    factor = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "words", "source_id", "source_start")]))
    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType()), T.StructField("factors", factor)])
    arrow = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "words", "source_id", "source_start")]))
    spaces = bytes(np.flatnonzero(sep).astype(np.uint8))
    table = bytes.maketrans(spaces, b" " * len(spaces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, texts in text_groups(b.column(1), GROUP_BYTES):
                n, gone, kept, spans = [], [], [], []
                for row, raw in zip(rows, texts, strict=True):
                    found = factors(b.column(2)[row].as_py() or [], window)
                    words = raw.translate(table).split()
                    n.append(len(words))
                    if found:
                        cover = np.zeros(len(words) + 1, np.int64)
                        for start, length, _, _ in found:
                            cover[start] += 1
                            cover[start + length] -= 1
                        left = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
                        words = [words[i] for i in left.tolist()]
                    gone.append(n[-1] - len(words))
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                    spans.append([dict(zip(("start", "words", "source_id", "source_start"), f, strict=True)) for f in found])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                                                  pa.array(spans, arrow)], names=schema.names)

    whole = with_pieces(docs, id_col, text_col, window, gram, sep, slices)
    out = whole.select("_id", "_text", "pieces").mapInArrow(run, schema)
    return out.select(F.col("_id").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "n_removed", "kept_text", "factors")
