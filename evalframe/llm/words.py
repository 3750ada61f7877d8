"""Words, word hashes and n-gram hashes of many texts at once (numpy helpers
that run inside Spark tasks).

A *word* is a maximal run of bytes that are no separators. Words are hashed
to 64 bits by a polynomial over their bytes and a final mix; an n-gram by a
polynomial over its words' hashes. Nothing depends on the process, the
position in the text or the batch, so hashes from different tasks agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
PIECE = 1 << 20
_BASE, _GRAM = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1

#: Separators: the ASCII space and the bytes 0x09-0x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators: every ASCII byte that is no letter or digit (bytes of other characters belong to words).
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
#: A-Z to a-z, all other bytes unchanged.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h + U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n bytes at least."""
    size = max(PIECE * 2, 1 << max(n - 1, 1).bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = pow(_BASE, -1, 2**64)
        ones = np.ones(size, U64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = U64(_BASE), U64(inverse)
        _powers[size] = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
    return _powers[size]


def _pieces(buf: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer behind separators, about PIECE bytes each (one longer word stays whole)."""
    at, n = 0, len(buf)
    while at < n:
        to = min(at + PIECE, n)
        while to < n and not sep[buf[to - 1]]:
            step = np.flatnonzero(sep[buf[to:to + PIECE]])
            to = to + int(step[0]) + 1 if len(step) else min(to + PIECE, n)
        yield at, to
        at = to


def split_words(texts: list[bytes], sep: np.ndarray = SPACES, fold: bool = False):
    """Words of all texts in order.

    Returns ``(hashes, starts, ends, offsets)``: 64-bit word hashes, the
    words' byte ranges in ``b" ".join(texts)``, and the index of the first word of each text
    (one entry more than texts). A text is never cut short.
    """
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    if fold:
        buf = FOLD[buf]
    found = []
    for at, to in _pieces(buf, sep):
        part = buf[at:to]
        gap = np.concatenate([[True], sep[part], [True]])
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        s, e = edges[0::2], edges[1::2]
        if not len(s):
            continue
        up, down = _power_tables(len(part) + 1)
        total = np.concatenate([np.zeros(1, U64), np.cumsum((part.astype(U64) + U64(1)) * up[:len(part)], dtype=U64)])
        h = (total[e] - total[s]) * down[s]
        found.append((mix(h + (e - s).astype(U64) * U64(_GRAM)), s + at, e + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none, none, np.zeros(len(texts) + 1, np.int64)
    hashes, starts, ends = (np.concatenate([f[i] for f in found]) for i in range(3))
    return hashes, starts, ends, np.searchsorted(starts, firsts)


def gram_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``k`` words from each position on (``len - k + 1`` of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, power = np.zeros(n, U64), 1
    for j in range(k):
        out += hashes[j:j + n] * U64(power)
        power = power * _GRAM % 2**64
    return mix(out, seed + k)


def text_shingles(texts: list[bytes], k: int, sep: np.ndarray = SPACES, fold: bool = True) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each text; a text with fewer
    words has its whole sequence as the only one; one without words has none."""
    hashes, _, _, offsets = split_words(texts, sep, fold)
    grams = gram_hashes(hashes, k)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            out.append(gram_hashes(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def text_groups(texts, size: int = 4 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """Positions and texts of an Arrow column (or list) in groups of about ``size`` bytes, read one by one, so that memory
    doesn't follow the batch; null texts are empty."""
    got_ids, got, n = [], [], 0
    for i, t in enumerate(texts):
        t = t.as_py() if hasattr(t, "as_py") else t
        raw = t.encode("utf-8", "surrogatepass") if t is not None else b""
        got_ids.append(i)
        got.append(raw)
        n += len(raw) + 64
        if n >= size:
            yield got_ids, got
            got_ids, got, n = [], [], 0
    if got:
        yield got_ids, got
