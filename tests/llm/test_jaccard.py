import random
import time

import numpy as np
import pytest
from helpers import documents, empty, frame, words

from evalframe.llm import jaccard
from evalframe.llm.graph import connected_components


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, hundredths):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= hundredths * len(a | sets[j]):
                up[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=str), groups


@pytest.mark.parametrize(("k", "t", "block"), [(3, 0.9, jaccard.BLOCK), (5, 0.8, jaccard.BLOCK), (3, 0.8, 60)])
def test_components_equal_brute_force(spark, k, t, block):
    rows = documents(seed=k, n=90)
    got = jaccard.jaccard_components(frame(spark, rows), k=k, threshold=t, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, k, round(100 * t))[0]


def test_keep_one_keeps_one_row_of_each_group_and_all_columns(spark):
    rows = documents(seed=4)
    docs = frame(spark, rows)
    got = jaccard.keep_one(docs)
    assert got.schema == docs.schema
    _, groups = brute(rows, 5, 80)
    want = []
    for members in groups.values():
        ids = sorted((rows[i][0] is None, rows[i][0] or 0) for i in members)
        want.append(None if ids[0][0] else ids[0][1])
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(want, key=str)


def test_near_copies_of_one_document_are_one_component(spark):
    """A hot group: no pair need be linked directly; blocks of a few sets must not lose one."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(140)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        copy = list(base)
        for _ in range(rng.choice([1, 1, 2])):
            copy[rng.randrange(len(copy))] = f"c{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    for block in (jaccard.BLOCK, 3000):
        got = jaccard.jaccard_components(frame(spark, rows), block=block).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 90)[0]


def passage_documents(n, own, rng):
    """Unlinked documents with a passage of 27 words in common."""
    passage = " ".join(f"p{i}" for i in range(27))
    return [(i, passage + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(own))) for i in range(n)]


def test_a_shared_passage_brings_no_sets_together():
    """Sets of 40 shingles that share 25, none linked: only the links are tested, so four times the sets take far less than sixteen times."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 2**63, 25, dtype=np.uint64)
    took = []
    for n in (4000, 16000):
        sets = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, 15, dtype=np.uint64)])) for _ in range(n)]
        sets[7] = np.unique(np.append(sets[3][1:], sets[3][0]))  # a copy
        at = time.process_time()
        roots, _ = jaccard.link_sets(sets, 0.9)
        took.append(time.process_time() - at)
        assert roots[7] == roots[3] and len(np.unique(roots)) == n - 1
    assert took[1] < 8 * max(took[0], 0.5)


def test_links_equal_all_pairs():
    rng = np.random.default_rng(3)
    for t in (0.8, 0.9):
        base = [rng.integers(0, 2**63, int(rng.integers(1, 60)), dtype=np.uint64) for _ in range(6)]
        sets = []
        for _ in range(150):
            s = base[rng.integers(6)]
            s = np.append(s[rng.random(len(s)) > 0.06], rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64))
            sets.append(np.unique(s if len(s) else base[0]))
        want = jaccard._Union(len(sets))
        for i in range(len(sets)):
            for j in range(i):
                shared = len(np.intersect1d(sets[i], sets[j]))
                if jaccard._linked(np.array(shared), np.array(len(sets[i]) + len(sets[j]) - shared), t):
                    a, b = sorted((want.find(i), want.find(j)))
                    want.up[b] = a
        assert jaccard.link_sets(sets, t)[0].tolist() == want.roots().tolist()


def test_a_component_of_many_blocks_is_cut_by_rare_shingles(spark):
    rng = random.Random(8)
    rows = passage_documents(150, 15, rng)
    rows += [(1000 + i, t + (" more" if i % 2 else "")) for i, (_, t) in enumerate(rows[:20])]
    got = jaccard.jaccard_components(frame(spark, rows), block=600).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 90)[0]


def test_every_run_is_entered_if_exact(spark):
    rows = documents(seed=6, n=40)
    got = jaccard.jaccard_components(frame(spark, rows), exact=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 90)[0]
    s = np.arange(1, 1001, dtype=np.uint64)
    assert len(jaccard.signatures(s, 0.9, 5, 1 << 40, jaccard.RUN)) == 998


def test_empty_table(spark):
    assert jaccard.jaccard_components(empty(spark)).collect() == []
    assert jaccard.keep_one(empty(spark)).collect() == []


@pytest.mark.parametrize("t", [0.8, 0.9])
def test_linked_sets_share_a_key(t):
    """Of pairs right at the threshold none may go without a common key."""
    rng = np.random.default_rng(0)
    light, runs, w = jaccard.light_limit(t), jaccard.reach(t), jaccard.run_length(t)
    for n in [*range(1, 45), 100, 600]:
        for _ in range(30 if n < 45 else 60):
            lost = int(rng.integers(0, jaccard.missing(n, t) + 1))
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            common = rng.permutation(a)[lost:]
            more = 0
            while len(common) >= t * (n + more + 1) - 1e-9:
                more += 1
            b = np.unique(np.concatenate([common, rng.integers(0, 2**63, int(rng.integers(0, more + 1)), dtype=np.uint64)]))
            if not len(common) or len(common) < t * len(np.union1d(a, b)) - 1e-9:
                continue
            keys = [set(jaccard.signatures(s, t, light, runs, w).tolist()) for s in (a, b)]
            assert keys[0] & keys[1], (n, lost, more)


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500), (None, 3), (4, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if None not in e}
    up = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            if a is not None and b is not None:
                up[a] = up[b] = min(up[a], up[b])
    assert got == up
