import hashlib
import random

import pytest
from helpers import documents, empty, frame, words

from evalframe.llm import substrings


def brute(rows, window):
    first = {}
    split = [words(t, lower=False) for _, t in rows]
    for (i, _), w in zip(rows, split, strict=True):
        for p in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[p:p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for p, x in enumerate(w) if p not in gone).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "gram", "slices"), [(13, 7, None), (5, 2, 3), (4, 4, 1)])
def test_parse_equals_brute_force(spark, window, gram, slices):
    rows = documents(seed=window, n=80)
    rng = random.Random(3)
    line = [f"l{i}" for i in range(16)]
    rows += [(100 + i, " ".join([f"z{rng.randrange(9)}" for _ in range(30)] + line + [f"y{rng.randrange(3)}" for _ in range(40)])) for i in range(25)]
    got = substrings.parse(frame(spark, rows), window=window, gram=gram, slices=slices).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=str) == brute(rows, window)


def test_factors_are_copies_of_their_sources(spark):
    rows = [r for r in documents(seed=8, n=80) if r[0] is not None and r[0] < 900]
    text = {i: words(t, lower=False) for i, t in rows}
    found = 0
    for r in substrings.parse(frame(spark, rows), window=6, gram=3).collect():
        for f in r.factors:
            found += 1
            assert f.words >= 6 and f.source_id < r.doc_id
            assert text[r.doc_id][f.start:f.start + f.words] == text[f.source_id][f.source_start:f.source_start + f.words]
    assert found


def test_factors_join_while_the_source_runs_on():
    pieces = [dict(start=7, windows=2, source_id=1, source_start=17), dict(start=3, windows=4, source_id=1, source_start=13), dict(start=9, windows=1, source_id=2, source_start=0)]
    assert substrings.factors(pieces, 5) == [(3, 10, 1, 13), (9, 5, 2, 0)]


def test_empty_table(spark):
    assert substrings.parse(empty(spark)).collect() == []
