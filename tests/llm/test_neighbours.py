import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm import neighbours

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                       T.StructField("axis", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "a") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k, every):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and len(v) and None not in list(v) and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            out[i] = sorted(((-float((q * v).sum()), j) for j, v in good if j != i))[:k]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def check(spark, rows, k=5, recall=1.0, **options):
    got = answers(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 4 == 0, k=k, **options))
    want = brute(rows, k, 4)
    assert set(got) == {q for q, near in want.items() if near}
    hit = total = 0
    for q, near in got.items():
        assert [r for r, _, _ in near] == list(range(1, len(near) + 1)) and len(near) == len(want[q])
        assert near == sorted(near, key=lambda x: (-x[2], x[1]))
        hit += len({v for _, v, _ in near} & {j for _, j in want[q]})
        total += len(near)
    assert hit >= recall * total
    return got, want


def test_exact_on_small_tables_with_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6)) for i in range(40)]
    rows += [(100 + i, rows[4][1]) for i in range(12)] + [(200, None), (201, [0.0] * 6), (202, [1, None, 0, 0, 0, 0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (208, [])]
    got, want = check(spark, rows)
    for q in got:
        assert [v for _, v, _ in got[q]] == [j for _, j in want[q]]
        assert np.allclose([s for _, _, s in got[q]], [-s for s, _ in want[q]], rtol=1e-12)


def test_recall_of_the_hashed_search(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((3000, 32))
    check(spark, [(i, x) for i, x in enumerate(v / np.linalg.norm(v, axis=1, keepdims=True))], k=10, recall=0.9)
    check(spark, [(i, x * rng.uniform(0.2, 3)) for i, x in enumerate(v[:1500])], k=10, recall=0.9, probes=4)  # one more component: twice as many axes


def test_few_rows_and_empty_table(spark):
    check(spark, [(0, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [3.0, 0.5])], k=20)
    assert neighbours.nearest(frame(spark, []), F.lit(True)).collect() == []
    assert neighbours.nearest(frame(spark, [(0, None)]), F.lit(True)).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(np.linalg.norm(neighbours.rotate(x, 3, 16), axis=1), np.linalg.norm(x, axis=1))


def test_ties_at_rank_k_go_to_the_smaller_ids(spark):
    """Sixteen equal queries, 300 vectors that tie behind them and that only the exact search meets, and others; production parameters."""
    rng = np.random.default_rng(5)

    def at(cosine, n):
        noise = rng.standard_normal((n, 4)) * [0, 1, 1, 1]
        return np.sqrt(1 - cosine ** 2) * noise / np.linalg.norm(noise, axis=1, keepdims=True) + cosine * np.eye(4)[0]

    v = np.concatenate([at(1, 16), at(-0.9, 300), at(-0.97, 100)])
    ids = rng.permutation(len(v))
    got, want = check(spark, [(int(i), x) for i, x in zip(ids, v, strict=True)], k=20)
    straddling = [int(i) for i in ids[:16] if i % 4 == 0]
    assert straddling and all([v for _, v, _ in got[q]] == [j for _, j in want[q]] for q in straddling)


def test_a_block_keeps_the_smallest_of_tied_ids():
    rng = np.random.default_rng(6)
    q, tied = rng.standard_normal((1, 64)), rng.standard_normal(64)
    tied *= 5 / (q[0] @ tied)
    v = np.concatenate([q * np.linspace(0.5, 1, 15)[:, None], np.tile(tied, (21, 1)), -q * rng.uniform(0.1, 1, (400, 1))])
    for _ in range(20):
        at = rng.permutation(len(v))
        row, col, score = neighbours.best_of(q, np.array([-1]), v[at], at, 20)
        assert (row == 0).all() and sorted(at[col]) == [*range(15), *range(15, 20)] and (np.diff(score) <= 0).all()


def test_production_defaults_on_uneven_norms(spark):
    rng = np.random.default_rng(3)
    check(spark, [(i, x * rng.uniform(0.2, 3)) for i, x in enumerate(rng.standard_normal((3000, 64)))], k=10, recall=0.9)


def test_small_tables_are_searched_by_hashing(spark):
    """One table and one probe: what a query is given lies on its axis, however small the table; a query of too few vectors there is given all there are."""
    rng = np.random.default_rng(8)
    v = rng.standard_normal((400, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    on = neighbours.axes(neighbours.rotate(v, 0, 8), 1)[:, 0]
    met = np.bincount(on, minlength=16)
    rows = list(enumerate(v))
    got, want = answers(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 4 == 0, k=20, tables=1, probes=1)), brute(rows, 20, 4)
    few = [q for q in got if met[on[q]] <= 20]
    assert 0 < len(few) < len(got) == 100
    for q, near in got.items():
        found = [i for _, i, _ in near]
        own = sorted(((-(v[q] * v[i]).sum(), i) for i in np.flatnonzero(on == on[q]) if i != q))[:20]
        assert found == ([j for _, j in want[q]] if q in few else [i for _, i in own])


def test_recall_of_small_tables(spark):
    rng = np.random.default_rng(9)
    v = rng.standard_normal((500, 64))
    check(spark, [(i, x) for i, x in enumerate(v / np.linalg.norm(v, axis=1, keepdims=True))], k=20, recall=0.9)
