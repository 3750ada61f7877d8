"""The Merkle manifest against a plain build of every tree."""

import hashlib
from collections import defaultdict

import pytest
from helpers import documents, empty, frame
from pyspark.sql import functions as F

from evalframe.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root and, for each node, its proof as (before, after) steps."""
    proofs, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at:at + 3]
            for k in range(len(run)):
                for i in spans[at + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(H(*run))
            over.append([i for s in spans[at:at + 3] for i in s])
        nodes, spans = up, over
    return nodes[0], proofs


def plain(rows):
    """(id, group, leaf) rows -> sorted (group, id, leaf, subroot, root, proof)."""
    groups = defaultdict(list)
    for i, g, leaf in rows:
        groups[g].append((i is not None, i or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: tree([leaf for *_, leaf in sorted(groups[g])]) for g in order}
    root, tops = tree([built[g][0] for g in order])
    out = []
    for g, above in zip(order, tops):
        for (some, i, leaf), proof in zip(sorted(groups[g]), built[g][1]):
            out.append((str(g), some, i, leaf, built[g][0], root, tuple(proof + above)))
    return sorted(out)


def got(df):
    return sorted((str(r.source), r.doc_id is not None, r.doc_id or 0, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in df.collect())


def leaves(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    return docs.withColumn("leaf", M.leaf_hash(F.col("doc_id"), F.col("source"), F.col("text")))


def rows_of(n, groups, seed=0):
    return [(i * 7 % n if i % 11 else None, [None, "", "é", "z", "a\U0001f600", "a"][i % groups] if i % 3 else "hot", f"t{i % 13}" if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("n,groups,height", [(1, 1, 7), (3, 1, 1), (4, 1, 1), (40, 6, 1), (300, 6, 2), (300, 1, 1), (700, 3, 3)])
def test_equals_plain_trees(spark, n, groups, height):
    rows = rows_of(n, groups)
    want = plain([(i, s, H(field(i), field(s), field(t))) for i, s, t in rows])
    assert got(M.manifest(leaves(spark, rows), "doc_id", "source", "leaf", height=height)) == want


def test_many_small_groups_and_one_hot_key(spark):
    rows = [(i, f"g{i:04}", "x") for i in range(400)] + [(7, "hot", "same")] * 500     # 500 rows that agree in everything
    want = plain([(i, s, H(field(i), field(s), field(t))) for i, s, t in rows])
    assert got(M.manifest(leaves(spark, rows), "doc_id", "source", "leaf", height=2)) == want


def test_proofs_fold_to_the_root_and_show_changes(spark):
    rows = rows_of(200, 6)
    out = M.manifest(leaves(spark, rows).withColumn("other", F.when(F.col("doc_id") % 2 == 0, F.sha2("leaf", 256)).otherwise(F.col("leaf"))),
                     "doc_id", "source", "leaf", ["other"], height=2)
    out = out.select("doc_id", "root", M.fold(F.col("leaf"), F.col("proof")).alias("same"), M.fold(F.col("other"), F.col("proof")).alias("changed"),
                     M.siblings(F.col("proof")).alias("s"), "proof").collect()
    assert all(r.same == r.root for r in out)
    assert all((r.changed == r.root) == (r.doc_id is None or r.doc_id % 2 == 1) for r in out)
    assert all(r.s == "".join(p.before + p.after for p in r.proof) for r in out)


def test_awkward_documents_and_clashing_columns(spark):
    docs = frame(spark, documents())
    for name in ("grp", "rank", "digest", "proof", "part", "nth", "block", "place", "row", "p_0"):
        docs = docs.withColumn(name, F.lit("x"))
    docs = docs.withColumn("leaf", M.leaf_hash(F.col("doc_id"), F.col("text")))
    want = plain([(i, "s", H(field(i), field(t))) for i, t in documents()])
    assert got(M.manifest(docs, "doc_id", "source", "leaf", ["text"], height=2)) == want


def test_no_rows(spark):
    out = M.manifest(empty(spark).withColumn("leaf", F.lit("x")), "doc_id", "source", "leaf")
    assert out.count() == 0 and out.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"]


def test_ranks_cross_partitions(spark):
    rows = spark.range(5000).selectExpr("case when id < 4000 then 'hot' else cast(id as string) end as g", "id * 7 % 5000 as id")
    out = M.ranked(rows.repartition(7), "g", ["id"]).toPandas()
    for g, part in out.groupby("g"):
        assert part.sort_values("id")["rank"].tolist() == list(range(len(part)))
