"""Operator 10: packing by power-of-two decomposition.

A document's ids (its tokens and an end id) are split into pieces whose lengths are powers
of two: as many pieces of ``max_tokens`` as fit, then one piece for each binary digit of what is left, the
longest first. Each piece is a sequence of its own, so no sequence crosses documents and
none needs padding; ``bucket`` (log2 of the length) says which sequences share a length and can
form a batch. The work is row-wise: no shuffle, and memory holds one document's ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.tokens import default_vocabulary, encoder

FIELDS = [("start", T.LongType(), pa.int64()), ("length", T.LongType(), pa.int64()), ("bucket", T.IntegerType(), pa.int32()),
          ("ids_crc32", T.LongType(), pa.int64()), ("doc_tokens", T.LongType(), pa.int64())]
IDS = ("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))


def binary_pieces(n: int, longest: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; ``longest`` is a power of two."""
    at = 0
    while n - at >= longest:
        yield at, longest
        at += longest
    size = longest >> 1
    while size:
        if (n - at) & size:
            yield at, size
            at += size
        size >>= 1


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         max_tokens: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: ``id_col, start, length, bucket, ids_crc32, doc_tokens, sequence_id, offset``
    and, ``with_ids``, the ids themselves (what a trainer reads).

    A null or empty text is the end id alone. Rows with equal ids are documents of their own. ``sequence_id`` is unique
    and follows the input's partitions; other columns of the input aren't read.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    fields = FIELDS + [IDS] * with_ids
    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), *(T.StructField(n, t) for n, t, _ in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), int(end_id).to_bytes(4, "little")
        for b in batches:
            owner, out, held = [], [[] for _ in fields], 0
            for row, value in enumerate(b.column(1)):
                text = value.as_py()
                ids = np.frombuffer((enc.ids(text) if text else b"") + end, "<u4")
                for start, length in binary_pieces(len(ids), max_tokens):
                    piece = ids[start:start + length]
                    owner.append(row)
                    for to, v in zip(out, (start, length, length.bit_length() - 1, zlib.crc32(piece.tobytes()), len(ids), piece.astype(np.int32)), strict=False):
                        to.append(v)
                    held += length if with_ids else 1
                    if held >= 1 << 20:
                        yield _batch(b.column(0), owner, out, fields, id_col)
                        owner, out, held = [], [[] for _ in fields], 0
            if owner:
                yield _batch(b.column(0), owner, out, fields, id_col)

    pieces = rows.mapInArrow(run, schema)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def _batch(ids: pa.Array, owner: list[int], out: list[list], fields: list, id_col: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), *(pa.array(v, t) for v, (_, _, t) in zip(out, fields, strict=True))],
                                      names=[id_col, *(n for n, _, _ in fields)])
