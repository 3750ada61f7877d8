"""Registered queries against DuckDB, and the pipeline against its stages' plain versions."""

import os

import duckdb
import numpy as np
import pytest
from helpers import words

import __spark_entry__ as entry
from conftest import SF_SMALL
from evalframe.fixtures import TABLES
from evalframe.llm import queries
from test_oracle import rows as compared

NAMES = {"op1_jaccard_join", "op2_secret_scan", "op3_substring_dedup", "op4_nearest_neighbours", "op5_language", "op6_decontamination", "op7_quality", "op8_url_filter",
         "op9_token_histogram", "op10_packing", "op11_embedding_whitening", "op12_exact_dedup", "op13_merkle_manifest", "pipeline"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_all_are_registered():
    assert set(queries.QUERIES) == NAMES and NAMES <= set(entry.queries()) and set(queries.ORACLES) <= NAMES


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, con, name):
    got = queries.QUERIES[name](spark, SF_SMALL).toPandas()
    assert compared(got) == compared(con.execute(queries.ORACLES[name]).df())


def documents(spark, name="documents"):
    return spark.read.parquet(os.path.join(SF_SMALL, f"{name}.parquet")).collect()


def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in documents(spark)}
    got = queries.QUERIES["op5_language"](spark, SF_SMALL).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and held and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95


def test_quality_of_held_out_documents(spark):
    label = {r.doc_id: r.quality for r in documents(spark, "labels")}
    got = [r for r in queries.QUERIES["op7_quality"](spark, SF_SMALL).collect() if r.held_out and r.doc_id in label]
    assert got and np.mean([r.predicted == label[r.doc_id] for r in got]) >= 0.85


def test_neighbours_recall(spark):
    v = {r.vec_id: np.array(r.embedding, float) for r in documents(spark, "embeddings")}
    ids = np.array(sorted(v))
    x = np.array([v[i] for i in ids])
    hit = total = 0
    found = {}
    for r in queries.QUERIES["op4_nearest_neighbours"](spark, SF_SMALL).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
        assert abs(r.score - v[r.query_id] @ v[r.vec_id]) < 1e-12
    for i in ids[ids % 20 == 0]:
        near = x @ v[i]
        near[ids == i] = -9
        best = set(ids[np.argsort(-near)[:20]].tolist())
        hit, total = hit + len(best & found[i]), total + 20
    assert hit / total >= 0.9


def test_packing_and_histogram_cover_all_tokens(spark):
    pieces = queries.QUERIES["op10_packing"](spark, SF_SMALL).collect()
    counts = queries.QUERIES["op9_token_histogram"](spark, SF_SMALL).collect()
    per = {}
    for p in pieces:
        per.setdefault(p.doc_id, [0, p.doc_tokens])[0] += p.length
    assert all(a == b for a, b in per.values()) and len(per) == len(documents(spark))
    assert {c.total_tokens for c in counts} == {sum(a for a, _ in per.values())} and sum(c.n_docs for c in counts) == len(per)


def test_pipeline_equals_plain_stages(spark):
    import corpus_pipeline
    from evalframe.llm import packing, secrets
    from evalframe.llm.tokens import default_vocabulary, encoder
    from test_jaccard import brute
    from test_secrets import BASE
    from test_text_operators import contained

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"] and corpus_pipeline.ORACLE_SQL is None
    docs = [(r.doc_id, r.text) for r in documents(spark) if any(c.isalpha() for c in r.text or "")]
    _, groups = brute(docs, 5, 80)
    docs = [docs[min(g, key=lambda i: docs[i][0])] for g in groups.values()]
    items = [(r.item_id, r.text) for r in documents(spark, "benchmark")]
    hit = {k[0] for k in contained(docs, items)}
    assert hit
    want, enc = {}, encoder(default_vocabulary())
    for i, t in docs:
        if i in hit:
            continue
        spans = sorted((m.start(), m.end()) for p, group, n in BASE.values() for m in p.finditer(t) if len(m.group(group)) >= n)
        out, at = "", 0
        for s, e in spans:
            out += (t[at:s] + secrets.MASK) if s >= at else ""
            at = max(at, e)
        want[i] = enc.count(out + t[at:]) + 1
    got = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert {i: p[0][2] for i, p in got.items()} == want
    assert all(sorted((a, b) for a, b, _ in p) == list(packing.binary_pieces(want[i], 4096)) for i, p in got.items())
    assert words("A b") == ["a", "b"]
