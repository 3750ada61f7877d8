"""Language, decontamination, quality, URL filter, token counts, packing, the helpers and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents, empty, fold, frame, prose, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalframe.llm import decontaminate, histogram, language, packing, quality, url_filter
from evalframe.llm.tokens import default_vocabulary, encoder
from evalframe.llm.words import FOLD, PUNCTUATION, SPACES, split_words, text_shingles


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB z\u00e9\t\n\x0b\x1c\u4e2d-0"), max_size=30), max_size=6))
def test_word_hashes_follow_the_words(texts):
    raw = [t.encode() for t in texts]
    hashes, starts, ends, offsets = split_words(raw, SPACES, fold=True)
    joined = b" ".join(raw) + b" "
    own = [words(t) for t in texts]
    assert [joined[s:e].decode() for s, e in zip(starts, ends, strict=True)] == [w for t in texts for w in words(t, lower=False)]
    assert np.diff(offsets).tolist() == [len(w) for w in own]
    flat = [w for ws in own for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat)) == len(set(zip(flat, hashes.tolist(), strict=True)))


def test_words_do_not_depend_on_cuts(monkeypatch):
    from evalframe.llm import words as module
    texts = [" ".join(prose(random.Random(i), 400)).encode() for i in range(5)] + [b"x" * 500, b""]
    whole = split_words(texts)
    monkeypatch.setattr(module, "PIECE", 37)
    for a, b in zip(whole, split_words(texts), strict=True):
        assert np.array_equal(a, b)
    assert [len(s) for s in text_shingles([b"", b"a b", b"a b a b a"], 3)] == [0, 1, 2] and FOLD[ord("Q")] == ord("q") and not PUNCTUATION[ord("7")]


def test_language_learns_and_handles_awkward_rows(spark):
    rng = random.Random(1)
    syllables = {"aa": ["bo", "ka", "zu"], "bb": ["tri", "men", "qua"], "cc": ["sch", "ung", "lich"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 30))), lang) for i, lang in enumerate(list(syllables) * 30)]
    train = spark.createDataFrame([*rows[:60], (None, None, "aa"), (5, "x", None)], "doc_id long, text string, lang string")
    model = language.fit(train)
    held = spark.createDataFrame(rows[60:], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(held, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows[60:]]) > 0.95 and all(0 <= r.score <= 1 for r in got.values())
    awkward = language.identify(frame(spark, documents(n=12) + [(990, "12 345 --"), (991, "\u00b2\u00b3")]), model).collect()
    assert {r.lang_pred for r in awkward if r.doc_id in (900, 901, 902, 990, 991)} == {"und"} and len(awkward) == len(documents(n=12)) + 2
    docs = frame(spark, documents(n=12))
    kept = language.drop_undetermined(docs, model)
    assert kept.schema == docs.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in documents(n=12) if any(c.isalpha() for c in t or ""))
    assert language.identify(empty(spark), model).collect() == []


def test_language_of_an_empty_training_table(spark):
    model = language.fit(empty(spark))
    assert model.predict("some words") == ("und", 0.0)


def test_language_stage_keeps_a_corpus_without_labels(spark):
    from corpus_pipeline import identify_language
    texts = ["some words", None, "", "12 345 --", "\u00b2\u00b3", "7 x", "word_1"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    kept = identify_language(spark, docs, "")
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [0, 5, 6]
    model = language.LanguageModel({}, {}, ["a"])
    assert all((model.predict(t)[0] == "a") == language.has_letter(t) for t in texts)


def test_language_stage_rejects_texts_that_no_language_explains(spark):
    """Three languages that share one word: it is as likely in each, and so is a script that none has."""
    from corpus_pipeline import identify_language
    own = {"aa": "bo ka zu", "bb": "tri men qua", "cc": "sch ung lich"}
    rows = [(i, f"{own[g]} kx", g) for i, g in enumerate(list(own) * 4)]
    rows += [(100, "kx", None), (101, "\u4e2d\u6587 \u5b57", None), (102, "kx bo", None), (103, "bo ka tri", "bb"), (104, None, "aa"), (104, "men", "aa"), (104, "men", "aa"), (105, "7 8", "aa")]
    docs = frame(spark, []).select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = docs.withColumn("score", F.lit(1)).withColumn("_language", F.lit("x"))
    kept = identify_language(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), 102, 103, 104, 104]


def test_language_backs_off_to_shorter_grams():
    model = language.LanguageModel({"known": [0.0, -9.0]}, {4: {" abc": [-1.0, -2.0]}, 3: {"xyz": [-5.0, -1.0]}, 2: {}, 1: {"q": [-3.0, -2.0]}}, ["a", "b"])
    assert [list(model.word(w)) for w in ("known", "abcxyz", "xyz", "qq", "--")] == [[0, -9], [-1, -2], [-5, -1], [-3, -2], [0, 0]]


def contained(rows, items, k=5, t=0.8):
    def grams(text, n):
        w = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in fold(text or "")).split(" ")
        w = [x for x in w if x]
        return w, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}

    out = Counter()
    for i, text in rows:
        best = {}
        for item, body in set(items):
            w, _ = grams(body, k)
            if w:
                n = min(k, len(w))
                own = grams(body, n)[1]
                shared = len(own & grams(text, n)[1])
                if shared * 100 >= round(t * 100) * len(own):
                    best[item] = max(best.get(item, (0, 0, 0)), (shared / len(own), shared, len(own)))
        for item, (_, shared, n) in best.items():
            out[i, item, shared, n] += 1
    return out


@pytest.mark.parametrize("block_chars", [16_000_000, 300, 40])
def test_decontamination_equals_brute_force(spark, block_chars):
    rng = random.Random(4)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([3, 5, 6, 9, 20, 40, 60, 5, 1])] + [(3, " ".join(prose(rng, 12))), (20, None), (21, ""), (22, "..."), (23, "W1, w2")]
    rows = documents(seed=6, n=30)
    for i, (_, body) in enumerate(items):
        if body:
            w = body.split()
            for change in (0, 1, 3, 9):
                copy = list(w)
                for _ in range(min(change, len(w))):
                    copy[rng.randrange(len(w))] = "changed"
                rows.append((2000 + 10 * i + change, " ".join(prose(rng, 50)) + ". " + " ".join(copy).upper() + "! " + " ".join(prose(rng, 300))))
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained_items(docs, bench, block_chars=block_chars).collect()
    want = contained(rows, items)
    assert len(want) > 20
    assert Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got) == want
    clean = decontaminate.drop_contaminated(docs, bench, block_chars=block_chars)
    hit = {str(i) for i, _, _, _ in want}
    assert clean.schema == docs.schema
    assert Counter(str(r.doc_id) for r in clean.collect() if str(r.doc_id) not in hit) == Counter(str(i) for i, _ in rows if str(i) not in hit)
    assert not {str(r.doc_id) for r in clean.collect()} & {str(i) for i, _, _, _ in want if i is not None and i >= 2000}


@pytest.mark.parametrize("block_chars", [16_000_000, 40])
def test_texts_of_one_item_give_one_row(spark, block_chars):
    body = prose(random.Random(9), 40)
    bench = spark.createDataFrame([(1, " ".join(body[i:i + 20])) for i in range(8)], "item_id long, text string")
    got = decontaminate.contained_items(frame(spark, [(5, " ".join(body))]), bench, block_chars=block_chars).collect()
    assert [(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got] == [(5, 1, 16, 16)]


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = frame(spark, documents(n=6))
    assert decontaminate.contained_items(docs, none).collect() == [] and decontaminate.contained_items(empty(spark), some).collect() == []
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()


def test_quality_votes(spark):
    rng = random.Random(2)
    rows = []
    for i in range(160):
        good = i % 3 > 0
        body = [w.capitalize() if j == 0 else w for j, w in enumerate(prose(rng, rng.randint(5, 60)))]
        rows.append((i, " ".join(body if good else rng.choice([[w.upper() + "!!" for w in body], [w + "$$$" for w in body], [body[0]] * 30])), int(good)))
    labelled = spark.createDataFrame([*rows[:100], (1000, None, 1), (1001, "x", None)], "doc_id long, text string, quality int")
    model = quality.fit(labelled.select("doc_id", "text"), labelled.select("doc_id", "quality"))
    got = {r.doc_id: r for r in quality.score(spark.createDataFrame(rows[100:], "doc_id long, text string, quality int"), model).collect()}
    assert np.mean([got[i].predicted == q for i, _, q in rows[100:]]) > 0.9
    out = quality.score(frame(spark, documents(n=12)), model).collect()
    assert len(out) == len(documents(n=12)) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert {r.score for r in out if r.doc_id in (900, 901, 902)} == {model.prior}
    assert quality.score(empty(spark), model).collect() == []
    none = spark.createDataFrame([], "doc_id long, text string, quality int")
    lone = quality.fit(none, none)
    assert lone.score(["a b", None]).tolist() == [0.5, 0.5]


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "a.b", "/x"), ("allow", "b", "/x/y/z"),
         ("allow", "same", "/"), ("block", "same", "/")]


def test_url_filter_equals_brute_force(spark):
    urls = [f"{p}{h}{path}" for p in ("http://", "x://y://", "") for h in ("example.net", "A.Example.NET", "net", "internet", "example.com", "x.org", "org.", "a.b", "q.a.b", "u@net:80", "same", "")
            for path in ("", "/", "/en", "/en/", "/en/x?y#z", "/de/1", "/fr/?", "?q=/en/", "#/en/", "/x", "/xx/y", "/x/y/z", "/EN/")]
    rows = [(i, u) for i, u in enumerate(urls)] + [(5000, None), (5001, ""), (5001, "http://net/\n/en/"), (None, "http://net/")]
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in rows], "page_id long, url string, host string, path string, rule string")
    got = Counter(tuple(r) for r in url_filter.filter_urls(pages, RULES).collect())
    want = Counter()
    for i, u in rows:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, tail = fold(rest[:end]), rest[end:]
            end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
            path = tail[:end]
        fits = [(h.count("."), len(p), v == "block", h + p, v) for v, h, p in RULES if ("." + host).endswith("." + h) and path.startswith(p)]
        best = max(fits) if fits else (0, 0, 0, None, "allow")
        want[i, host, path, best[3], best[4]] += 1
    assert got == want


def test_url_rules_are_bounded():
    with pytest.raises(ValueError, match="max_rules"):
        url_filter.UrlTrie(RULES, max_rules=3)


def token_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_vocabulary()).encode(text or "", add_special_tokens=False).ids


def test_chunked_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer
    plain, own = Tokenizer.from_file(default_vocabulary()), encoder(default_vocabulary())
    rng = random.Random(3)
    texts = [t or "" for _, t in documents(n=30)]
    letters = "aZ \u00e9\u00c9\u03a3\u03c3 \u0130\u0131'\t\n.,!?*<|>endoftext5\u00b2\u2167\u4e2d\u6587 \u0301\u00df \u65e5\u03a9 \x1c\x85s'll'd"
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 25))) + rng.choice(["", "<|endoftext|>", "a" * 60]) for _ in range(800)]
    for t in texts:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 50_000), st.sampled_from([1, 2, 64, 4096]))
def test_binary_pieces_cover_in_order(n, longest):
    pieces = list(packing.binary_pieces(n, longest))
    assert [a for a, _ in pieces] == [sum(b for _, b in pieces[:i]) for i in range(len(pieces))] and sum(b for _, b in pieces) == n
    assert all(b <= longest and b & (b - 1) == 0 for _, b in pieces) and len(pieces) == n // longest + (n % longest).bit_count()


def test_packing_is_whole(spark):
    rows = documents(n=24)
    got = packing.pack(frame(spark, rows), max_tokens=64, with_ids=True).collect()
    by = {}
    for r in got:
        ids = np.array(r.ids, np.uint32)
        assert r.length == len(ids) == 1 << r.bucket and r.offset == 0 and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        by.setdefault(r.doc_id, []).append((r.start, r.doc_tokens, r.ids))
    assert len({r.sequence_id for r in got}) == len(got)
    want = Counter(str(token_ids(t) + [2]) for _, t in rows)
    have = Counter()
    for r in sorted(got, key=lambda r: r.sequence_id):
        pass
    for parts in by.values():
        parts = sorted(parts, key=lambda x: x[0])
        for n in {p[1] for p in parts}:
            ids = [p for p in parts if p[1] == n]
            copies = sum(p[0] == 0 for p in ids)
            if copies == 1:
                have[str([x for p in ids for x in p[2]])] += 1
    assert all(want[k] for k in have) and sum(r.length for r in got) == sum(len(token_ids(t)) + 1 for _, t in rows)
    assert packing.pack(empty(spark)).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(empty(spark), max_tokens=100)


def test_histogram_answers(spark, monkeypatch):
    monkeypatch.setattr(histogram, "BLOCK", 16)
    rows = documents(n=40)
    n = [len(token_ids(t)) + 1 for _, t in rows]
    got = {r.context_limit: r for r in histogram.token_counts(frame(spark, rows)).collect()}
    assert set(got) == set(n)
    for limit, r in got.items():
        longer = [x for x in n if x > limit]
        assert (r.n_docs, r.docs_longer, r.tokens_longer, r.total_docs, r.total_tokens) == (n.count(limit), len(longer), sum(longer), len(n), sum(n))
        assert r.truncated_tokens == sum(min(x, limit) for x in n) and abs(r.quantile - sum(x <= limit for x in n) / len(n)) < 1e-12
    assert histogram.token_counts(empty(spark)).collect() == []


def test_histogram_answers_any_limit_and_quantile(spark):
    lengths = [1, 1, 2, 5, 5, 5, 9, 40, 5000, 9000]
    table = histogram.suffix_answers(histogram.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long")))
    limits, qs = [0, 1, 3, 5, 41, 4096, 8192, 9000, 10 ** 6], [0.0, 0.1, 0.2, 0.5, 0.51, 0.9, 0.99, 1.0]
    got = {r.context_limit: r for r in histogram.at_limits(table, limits).collect()}
    assert set(got) == set(limits)
    for limit, r in got.items():
        longer = [n for n in lengths if n > limit]
        assert (r.n_docs, r.docs_longer, r.tokens_longer, r.total_docs, r.total_tokens) == (lengths.count(limit), len(longer), sum(longer), 10, sum(lengths))
        assert r.truncated_tokens == sum(min(n, limit) for n in lengths) and abs(r.quantile - (10 - len(longer)) / 10) < 1e-12
    found = {r.wanted: r.context_limit for r in histogram.at_quantiles(table, qs).collect()}
    assert found == {q: next(n for n in sorted(lengths) if sum(x <= n for x in lengths) / 10 >= q) for q in qs}
    none = table.limit(0)
    assert histogram.at_limits(none, limits).count() == 0 and histogram.at_quantiles(none, qs).count() == 0


def test_histogram_encodes_once_and_takes_clashing_names(spark):
    rows = documents(seed=3, n=12)
    docs = frame(spark, rows).withColumnRenamed("doc_id", "n_tokens")
    out = histogram.token_counts(docs, "n_tokens", limits=(3, 2048), quantiles=(0.5,))
    assert str(out._jdf.queryExecution().executedPlan()).count("MapInArrow") == 0     # the histogram is a written table by now
    got = out.collect()
    assert sum(r.n_docs for r in got) == len(rows) and len({r.context_limit for r in got}) == len(got) and {3, 2048} <= {r.context_limit for r in got}
    assert [r.quantiles for r in got if r.quantiles] == [[0.5]]


def test_shapes_cover_whole_chunks():
    from evalframe.llm import quality
    base = "aB3-" * 40
    assert quality._dimensions(base + "!!x?")[1] != quality._dimensions(base + "Zz9")[1]
    assert quality.shape("Hello,") == "Aa," and len(quality._dimensions("aB" * 500)[1]) == 84
    assert np.array_equal(quality.terms("short words only")[0], quality.terms("short words only")[0]) and quality._dimensions("word")[1] == quality._dimensions("word")[1][:1]
