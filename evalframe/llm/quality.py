"""Operator 7: quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words, the shapes of its chunks (letter case, digits and signs with runs collapsed) and how often chunks recur;
each term falls in one of ``TERMS`` hashed dimensions. Terms are weighted by inverse document frequency and projected to ``rank``
latent dimensions (a truncated singular value decomposition). The labelled sample's latent vectors are broadcast; every
document's cosine products with all of them are computed exactly, in blocks, and the ``neighbours`` largest
vote with their similarity as weight. Equally near labelled rows count in the sample's order (hash of the id, then label), and the products are
summed in one order, so a score depends on its text alone, not on the rows of its block.

The model is fitted on at most ``max_rows`` labelled ids of each label (the smallest hashes: the same ones in every run), so what is
broadcast is bounded by parameters. Scoring covers whole texts of all rows, row by row, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalframe.llm.graph import smallest_hashes
from evalframe.llm.neighbours import best_of

WORDS, SHAPES, REPEATS = 4096, 512, 32
TERMS = WORDS + SHAPES + REPEATS
WEIGHTS = (0.4, 1.0, 1.0)
CACHE = 200_000
_RUNS = re.compile(r"(.)\1+")
_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_]"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")

_cache: dict[str, tuple[int, tuple[int, ...]]] = {}


def shape(chunk: str) -> str:
    """``Hello,`` is ``Aa,``; runs are collapsed."""
    out = _UPPER.sub("\x01", chunk)
    out = _DIGIT.sub("0", _LOWER.sub("a", out)).replace("\x01", "A")
    return _RUNS.sub(r"\1", out)


def _dimensions(chunk: str) -> tuple[int, tuple[int, ...]]:
    """A chunk's word term, and a shape term for each twelve signs of its whole shape."""
    got = _cache.get(chunk)
    if got is None:
        core = chunk.lower().strip(".,;:!?()\"'*$%&#|")
        form = shape(chunk)
        pieces = [form[i:i + 12] for i in range(0, len(form), 12)]
        got = (zlib.crc32(core.encode("utf-8", "replace")) % WORDS, tuple(zlib.crc32(p.encode("utf-8", "replace")) % SHAPES for p in pieces))
        if len(_cache) >= CACHE:
            _cache.clear()
        if len(chunk) <= 64:
            _cache[chunk] = got
    return got


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and weights of a whole text; each family of terms has a fixed length (WEIGHTS). Empty without chunks."""
    chunks = (text or "").split()
    if not chunks:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts = Counter(chunks)
    n = np.fromiter(counts.values(), np.float64, len(counts))
    dims = [_dimensions(c) for c in counts]
    words = np.bincount([w for w, _ in dims], np.log1p(n), WORDS)
    pieces = np.fromiter((p for _, ps in dims for p in ps), np.int64)
    shapes = np.sqrt(np.bincount(pieces, np.repeat(n, [len(ps) for _, ps in dims]), SHAPES) / len(chunks))
    repeats = np.zeros(REPEATS)
    np.add.at(repeats, np.minimum(np.log2(n).astype(int), 15), n / len(chunks))
    same = sum(map(str.__eq__, chunks, chunks[1:])) / len(chunks)
    repeats[16 + min(int(same * 15), 15)] += 1
    out = []
    for family, weight in zip((words, shapes, repeats), WEIGHTS, strict=True):
        norm = np.sqrt((family * family).sum())
        out.append(family * (weight / norm) if norm else family)
    whole = np.concatenate(out)
    at = np.flatnonzero(whole)
    return at.astype(np.int32), whole[at].astype(np.float32)


class QualityModel:
    """``projection`` (term weights times latent axes), labelled unit vectors and labels, and the score of texts without terms."""

    def __init__(self, projection: np.ndarray, vectors: np.ndarray, labels: np.ndarray, prior: float, neighbours: int):
        self.projection, self.vectors, self.labels, self.prior, self.neighbours = projection, vectors, labels, prior, neighbours

    def latent(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(rows), self.projection.shape[1]), np.float32)
        for i, (at, w) in enumerate(rows):
            if len(at):
                out[i] = w @ self.projection[at]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)

    def score(self, texts: list[str | None], block: int = 512) -> np.ndarray:
        got = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return got
        labelled, order = self.vectors.astype(np.float64), np.arange(len(self.vectors))
        for a in range(0, len(texts), block):
            rows = self.latent([terms(t) for t in texts[a:a + block]]).astype(np.float64)
            some = np.flatnonzero(rows.any(axis=1))
            if not len(some):
                continue
            row, near, cosine = best_of(rows[some], np.full(len(some), -1), labelled, order, self.neighbours)
            weight = np.maximum(cosine, 0) ** 4
            total = np.bincount(row, weight, len(some))
            voted = np.bincount(row, weight * self.labels[near], len(some))
            got[a + some] = np.where(total > 0, voted / np.where(total > 0, total, 1), self.prior)
        return np.clip(got, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 2000,
        rank: int = 48, neighbours: int = 15) -> QualityModel:
    """Fit on the texts of documents whose label is 0 or 1. The sample is chosen from the labels alone and, bounded as it is, broadcast to the documents, so no text is shuffled."""
    marked = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"), F.xxhash64(F.col(id_col)).alias("h")))
    share = marked.agg(F.avg("label")).first()[0]
    prior = 0.5 if share is None else float(share)
    chosen = None
    for label in (0, 1):
        part = smallest_hashes(marked.where(F.col("label") == label), "h", max_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen.dropDuplicates(["id", "label"])), "id").select("label", "h", "text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [terms(t) for t in b["text"]]
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "at": [a.tolist() for a, _ in found], "w": [w.tolist() for _, w in found]})

    got = sample.mapInPandas(read, "label double, h long, at array<int>, w array<float>").collect()
    got = sorted((r for r in got if len(r["at"])), key=lambda r: (r["h"], r["label"]))
    n = len(got)
    if not n:
        return QualityModel(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), prior, neighbours)
    x = np.zeros((n, TERMS), np.float32)
    for i, r in enumerate(got):
        x[i, r["at"]] = r["w"]
    idf = np.log((1 + n) / (1 + (x > 0).sum(axis=0))).astype(np.float32)
    idf[WORDS:] = np.maximum(idf[WORDS:], 0.5)
    x *= idf
    rank = min(rank, n)
    basis = np.random.default_rng(0).standard_normal((TERMS, rank + 16)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, vt = np.linalg.svd(x @ basis, full_matrices=False)
    projection = (idf[:, None] * (basis @ vt.T[:, :rank])).astype(np.float32)
    model = QualityModel(projection, np.zeros((0, rank), np.float32), np.zeros(0), prior, neighbours)
    model.vectors = model.latent([(np.array(r["at"]), np.array(r["w"], np.float32)) for r in got])
    model.labels = np.array([r["label"] for r in got])
    return model


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every row's whole text. Null, empty and blank texts get the labelled rows' mean label; repeated rows give repeated
    results; an empty table gives none; other columns aren't read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            yield pd.Series(m.score(texts.tolist()))

    return docs.select(F.col(id_col), vote(F.col(text_col)).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
