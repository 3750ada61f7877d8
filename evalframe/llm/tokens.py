"""Token ids of texts with a word-level BPE vocabulary.

The vocabulary drops white space and never joins characters across it, so a text's ids
are the ids of its space- or line-separated chunks put together; chunks recur, and
each is encoded once per worker (the memory of the cache is bounded, not its hits' exactness).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHE_CHUNKS = 150_000
CACHED_LENGTH = 48
TRAILING = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


_encoders: dict[str, "ChunkEncoder"] = {}


def encoder(path: str) -> "ChunkEncoder":
    """The worker's encoder for a vocabulary file (loaded once per Python process)."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _plain(word: str) -> bool:
    """Letters that the vocabulary's normaliser only puts in lower case, one by one."""
    low = word.lower()
    return word.isalpha() and low.isalpha() and len(low) == len(word) and "\u03a3" not in word and is_normalized("NFC", word) and is_normalized("NFC", low)


class ChunkEncoder:
    """Ids as little-endian unsigned 32-bit bytes. Two generations of cached chunks bound its memory."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        #: The vocabulary's character for each byte that occurs in UTF-8.
        self.shown = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(0x21, 0x7F)}
        for c in (*range(0x80, 0x800, 0x40), *range(0x800, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x40000), *range(0x80, 0xC0)):
            if not 0xD800 <= c < 0xE000:
                self.shown |= dict(zip(chr(c).encode(), level.pre_tokenize_str(chr(c))[0][0], strict=True))

    def _word(self, word: str) -> bytes:
        """Ids of a run of letters: one unit of the vocabulary's own splitting rule."""
        low = word.lower() if word.isascii() else word
        got = self.cache.get(low) or self.older.get(low)
        if got is None:
            if low.isascii():
                got = np.array([t.id for t in self.tokenizer.model.tokenize(low)], "<u4").tobytes()
            else:
                raw = low.lower().encode()
                mapped = "".join([self.shown.get(b, "") for b in raw])
                got = np.array([t.id for t in self.tokenizer.model.tokenize(mapped)], "<u4").tobytes() if len(mapped) == len(raw) else self._whole(low)
            if len(low) <= CACHED_LENGTH:
                self.cache[low] = got
        return got

    def _whole(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        got = self.older.get(chunk)
        if got is None:
            core = chunk.rstrip(TRAILING)
            if core.isascii() and core.isalpha() or _plain(core):  # letters, then signs: the splitting rule always cuts there
                got = self._word(core)
                if len(core) < len(chunk):
                    tail = chunk[len(core):]
                    got += self.cache[tail] if tail in self.cache else self._chunk(tail)
            else:
                got = self._whole(chunk)
        if len(chunk) <= CACHED_LENGTH:
            self.cache[chunk] = got
        return got

    def ids(self, text: str) -> bytes:
        """Ids of a whole text."""
        chunks = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.cache.__getitem__, chunks))
        except KeyError:
            if len(self.cache) > CACHE_CHUNKS:
                self.older, self.cache = self.cache, {}
            cache, chunk = self.cache, self._chunk
            return b"".join([cache[c] if c in cache else chunk(c) for c in chunks])

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


def token_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                  end_tokens: int = 0) -> DataFrame:
    """``id_col, n_tokens`` of every row's whole text (null: empty), ``end_tokens`` added; row-wise, no shuffle."""
    import pyarrow as pa
    path = vocabulary or default_vocabulary()
    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [enc.count(t) + end_tokens if (t := x.as_py()) else end_tokens for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    return rows.mapInArrow(run, schema)
