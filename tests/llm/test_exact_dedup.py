"""Exact deduplication against a persistent index."""

import hashlib
from collections import defaultdict

import pytest
from helpers import documents, empty, frame

from evalframe.llm import exact_dedup as X


def plain(rows):
    """Text -> (id that stays, rows); null ids are smallest."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def collected(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.digest.hex(), r.keep_id, r.group_size, r.kept) for r in df.collect())


@pytest.mark.parametrize("deliveries", [1, 3])
def test_equals_plain_groups(spark, tmp_path, deliveries):
    rows = documents() + [(i, "a hot text") for i in range(2000, 2400)]
    got = X.deduplicate(frame(spark, rows), X.DigestIndex(spark, str(tmp_path / "i"), buckets=4), deliveries=deliveries).collect()
    want, texts = plain(rows), {hashlib.sha256((t or "").encode()).hexdigest(): t or "" for _, t in rows}
    assert len(got) == len(rows)
    for r in got:
        keep, n = want[texts[r.digest.hex()]]
        assert (r.keep_id, r.group_size) == (keep, n) and (not r.kept or r.doc_id == keep)
    kept = [r.digest.hex() for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(want)     # of rows that agree in id and text, too, exactly one stays


def test_new_data_meets_the_index(spark, tmp_path):
    index = X.DigestIndex(spark, str(tmp_path / "i"), buckets=4)
    first = frame(spark, [(5, "one"), (6, "two"), (7, "two")])
    a = collected(X.deduplicate(first, index))
    again = X.DigestIndex(spark, str(tmp_path / "i"), "string", 99)          # opened anew: buckets and type come from the folder
    assert again.buckets == 4 and index.entries().count() == 2
    assert collected(X.deduplicate(first, again)) == a and again.entries().count() == 2   # a repeated call changes nothing
    got = {(r.doc_id, r.keep_id, r.kept) for r in X.deduplicate(frame(spark, [(90, "two"), (91, "three"), (None, "four")]), again).collect()}
    assert got == {(90, 7, False), (91, 91, True), (None, None, True)} and again.entries().count() == 4


def test_index_is_bucketed_and_not_shuffled(spark, tmp_path):
    index = X.DigestIndex(spark, str(tmp_path / "i"), buckets=4)
    X.deduplicate(frame(spark, documents()), index)
    groups = frame(spark, documents(2)).select(X.digest("text").alias("digest")).distinct().repartition(4, "digest")
    plan = groups.join(index.entries().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "SortMergeJoin" in physical and "Bucketed: true" in physical
    right = physical[physical.index("Bucketed: true") - 2000 if physical.index("Bucketed: true") > 2000 else 0:physical.index("Bucketed: true")]
    assert right.rindex("Exchange hashpartitioning(digest") < right.rindex("Scan parquet") and physical.count("Exchange hashpartitioning(digest") <= 3
    files = list((tmp_path / "i").rglob("*.parquet"))
    assert 0 < len({f.name.split("_")[1].split(".")[0] for f in files}) <= 4


def test_drop_copies_keeps_columns_and_empty(spark, tmp_path):
    rows = documents()
    docs = frame(spark, rows).withColumn("digest", docs_digest()).withColumn("kept_id", docs_digest())
    got = X.drop_copies(docs, X.DigestIndex(spark, str(tmp_path / "i"), buckets=4))
    assert got.columns == docs.columns
    want = plain(rows)
    assert sorted((t or "", r is not None, r or 0) for r, t in ((r.doc_id, r.text) for r in got.collect())) == sorted((t, k is not None, k or 0) for t, (k, _) in want.items())
    assert X.deduplicate(empty(spark), X.DigestIndex(spark, str(tmp_path / "j"), buckets=4), deliveries=3).count() == 0


def docs_digest():
    from pyspark.sql import functions as F
    return F.lit("mine")


def test_buckets_follow_the_size():
    assert [X.buckets_for(n) for n in (0, 10, 16_000_001, 10 ** 10)] == [8, 8, 16, 8192]
