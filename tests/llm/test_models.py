"""Scores of the fitted models against plain reimplementations, text by text."""

import math
import random
import re

import numpy as np
from helpers import DOCS, documents

from evalframe.llm import language, quality

VOWELS = {"aa": "aeiou", "bb": "äöüßy", "cc": "éàèçw", "dd": "åøæzk"}


def texts(rng, n=120):
    """(id, text, lang): words of four made-up languages that share letters, and awkward rows."""
    rows = []
    for i in range(n):
        lang = list(VOWELS)[i % 4]
        words = ["".join(rng.choice("bdfglmnrst") + rng.choice(VOWELS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 60))]
        rows.append((i, " ".join(w.capitalize() if rng.random() < 0.1 else w for w in words) + rng.choice([".", "", "!"]), lang))
    return rows + [(1000 + i, t, None) for i, (_, t) in enumerate(documents()[-15:])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", None, "k", "l", 1) for i, t, g in rows], DOCS).repartition(3)


def plain_language(model, text):
    """Word by word: the log frequency of a known word, else the mean over the longest character n-grams that are known."""
    total, letters = [0.0] * len(model.langs), False
    for chunk in (text or "").lower().split():
        for w in language.WORD.findall(chunk):
            letters = letters or any(c.isalpha() for c in w)
            value = model.words.get(w)
            for n in language.ORDERS if value is None else ():
                padded = f" {w} " if n > 1 else w
                known = [model.grams[n][padded[i:i + n]] for i in range(len(padded) - n + 1) if padded[i:i + n] in model.grams.get(n, {})]
                if known:
                    value = [sum(k[j] for k in known) / len(known) for j in range(len(model.langs))]
                    break
            total = [a + b for a, b in zip(total, value or [0.0] * len(model.langs))]
    if not letters:
        return "und", 0.0
    best = max(range(len(total)), key=lambda j: (total[j], -j))
    return model.langs[best], 1 / sum(math.exp(t - total[best]) for t in total)


def test_language_equals_plain_backoff(spark):
    rows = texts(random.Random(3))
    docs = frame(spark, rows)
    model = language.fit(docs.where("doc_id % 3 != 0"))            # a third of the words is unseen or rare
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language.identify(docs, model).join(docs.select("doc_id", "text").distinct(), "doc_id").collect() if r.doc_id is not None}
    checked = 0
    for i, t, _ in rows:
        if (i, t) in got and sum(1 for j, _, _ in rows if j == i) == 1:
            lang, score = plain_language(model, t)
            assert got[i, t][0] == lang and abs(got[i, t][1] - score) < 1e-9, (i, t)
            checked += 1
    assert checked > 110 and any(re.search("[a-z]", k[1] or "") and v[1] < 0.999 for k, v in got.items())


def plain_quality(model, text):
    """All cosines, the nearest labelled rows, votes weighted by the fourth power; None where the last neighbour ties with the next (the library has no
    rule for which of them votes)."""
    at, w = quality.terms(text)
    v = (w.astype(float) @ model.projection[at].astype(float)) if len(at) else np.zeros(model.projection.shape[1])
    if not np.linalg.norm(v):
        return model.prior
    near = model.vectors.astype(float) @ (v / np.linalg.norm(v))
    order = sorted(range(len(near)), key=lambda j: -near[j])
    top = order[:model.neighbours]
    if len(order) > len(top) and near[top[-1]] - near[order[len(top)]] < 1e-6:
        return None
    weight = [max(near[j], 0) ** 4 for j in top]
    return sum(a * model.labels[j] for a, j in zip(weight, top)) / sum(weight) if sum(weight) else model.prior


def test_quality_equals_plain_neighbours(spark):
    rows = texts(random.Random(5))
    docs = frame(spark, [(i, t, g) for i, t, g in rows])
    labels = spark.createDataFrame([(i, int(len(t or "") % 3 == 0 or i % 4 == 1)) for i, t, _ in rows if i % 2 and i < 1000], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert len(model.vectors) == labels.count() and 0 < model.prior < 1
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(rows)
    by_id = {}
    for i, t, _ in rows:
        by_id.setdefault(i, []).append(plain_quality(model, t))
    tied = sum(v is None for vs in by_id.values() for v in vs)
    for r in scored:
        assert any(v is None or abs(r.score - v) < 1e-4 for v in by_id[r.doc_id]) and r.predicted == int(r.score >= 0.5)
    assert tied < 10
    assert len({round(r.score, 3) for r in scored}) > 50


def test_quality_of_tied_neighbours_does_not_depend_on_the_block():
    """Forty labelled rows in four groups of ten equal vectors and 13 neighbours: of the group at the cut the first rows in order vote, in blocks of any size."""
    rng = np.random.default_rng(4)
    vectors = np.repeat(rng.standard_normal((4, 8)), 10, axis=0)[rng.permutation(40)].astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 40).astype(float)
    model = quality.QualityModel(rng.standard_normal((quality.TERMS, 8)).astype(np.float32), vectors, labels, 0.25, 13)
    words = [t for _, t, _ in texts(random.Random(6), 200)] + ["", " ", None]
    whole = model.score(words)
    for block in (1, 7, 64):
        assert (model.score(words, block) == whole).all()
    assert (model.score(words[::-1]) == whole[::-1]).all() and (whole[-3:] == 0.25).all()
    seen = set()
    for t, score in zip(words, whole, strict=True):
        v = model.latent([quality.terms(t)])[0].astype(float)
        near = [float((v * x).sum()) for x in vectors.astype(float)]
        top = sorted(range(40), key=lambda j: (-near[j], j))[:13]
        weight = [max(near[j], 0) ** 4 for j in top]
        want = sum(w * labels[j] for w, j in zip(weight, top, strict=True)) / sum(weight) if sum(weight) else 0.25
        assert abs(score - want) < 1e-12
        seen.add(round(want, 6))
    assert len(seen) > 4
