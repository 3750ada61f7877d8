"""Registered plans of this package: ``opN_<name>`` applies operator N, with its
production parameters, to its whole table; ``pipeline`` runs the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalframe.llm import (decontaminate, exact_dedup, histogram, jaccard, language, merkle, neighbours, packing, quality, secrets, substrings, url_filter,
                           whitening)
from evalframe.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out("doc_id")))
    return language.identify(docs, model).select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLES["op6_decontamination"] = r"""
with docs as (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') as w from documents where text is not null),
items as (select distinct item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') as w from benchmark where text is not null),
item_sh as (select item_id, w as item, least(len(w), 5) as k, unnest(list_distinct([list_slice(w, i, i + least(len(w), 5) - 1) for i in range(1, len(w) - least(len(w), 5) + 2)])) as g
  from items where len(w) > 0),
sizes as (select item_id, item, k, count(*) as n_item from item_sh group by all),
doc_sh as (select r, doc_id, k, unnest(list_distinct([list_slice(w, i, i + k - 1) for i in range(1, len(w) - k + 2)])) as g
  from docs, (select distinct k from item_sh) where len(w) >= k),
pairs as (select r, doc_id, item_id, item, count(*) as n_shared from doc_sh join item_sh using (k, g) group by all)
select doc_id, item_id, n_shared, n_item, n_shared / n_item as containment
from pairs join sizes using (item_id, item) where n_shared >= ceil(0.8 * n_item)
qualify row_number() over (partition by r, item_id order by n_shared / n_item desc, n_item) = 1
"""

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query
def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf, "pages"), URL_RULES)


ORACLES["op8_url_filter"] = r"""
with u as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 2) as path from pages),
f as (select *, case when starts_with(path, '/en/') and ends_with('.' || host, '.example.net') then 'example.net/en/'
  when starts_with(path, '/de/') and ends_with('.' || host, '.example.com') then 'example.com/de/'
  when starts_with(path, '/fr/') and ends_with('.' || host, '.org') then 'org/fr/'
  when starts_with(path, '/') and ends_with('.' || host, '.net') then 'net/' end as rule from u)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from f
"""


@query
def op9_token_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return histogram.token_counts(table(spark, sf, "documents"), limits=(512, 1024, 2048, 4096, 8192), quantiles=(0.5, 0.9, 0.99))


@query
def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query
def op1_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf, "documents"))


ORACLES["op1_jaccard_join"] = r"""
with recursive docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [hash(w)]
    else list_distinct([hash(list_slice(w, i, i + 2)) for i in range(1, len(w) - 1)]) end as s from docs),
sh as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id and 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) group by all),
links as materialized (select x, y from pairs where 100 * c >= 90 * (nx + ny - c) union all select y, x from pairs where 100 * c >= 90 * (nx + ny - c)),
reached as (select doc_id as a, doc_id as b from sets union select r.a, l.y from reached r join links l on r.b = l.x)
select doc_id, cast(len(s) as bigint) as n_shingles, c as component_id from sets join (select a, min(b) as c from reached group by a) on a = doc_id
"""


@query
def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.parse(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op3_substring_dedup"] = r"""
with docs as materialized (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as materialized (select r, doc_id, i, hash(list_slice(w, i, i + 12)) as h from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from docs where len(w) >= 13)),
small as (select h, min(doc_id) as m from win group by h),
hit as (select r, list(i) as starts from win join small using (h) where doc_id > m group by r),
cover as (select r, list_distinct(flatten(list_transform(starts, lambda s: range(s, s + 13)))) as gone from hit),
kept as (select doc_id, w, case when gone is null then w else list_select(w, list_filter(range(1, len(w) + 1), lambda i: not list_contains(gone, i))) end as k from docs left join cover using (r))
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - len(k) as bigint) as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""


@query
def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind_no"] < len(secrets.BASE_RULES))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in secrets.BASE_RULES]
    return secrets.scan(table(spark, sf, "documents")).select("doc_id", *counts, F.sha2(secrets.written(base), 256).alias("base_sha256"),
                                                              secrets.written(spans).alias("spans"))


def _secret_oracle() -> str:
    """Positions from the pieces between matches, rule by rule, in DuckDB."""
    def quoted(s: str) -> str:
        return s.replace("'", "''")

    parts = []
    for no, r in enumerate(secrets.RULES):
        p = quoted(r.pattern)
        parts.append(f"""select r, {no} as no, '{r.kind}' as kind, unnest(range(1, len(m) + 1)) as i, m, g, s from (select r, regexp_extract_all(t, '{p}') as m,
            regexp_extract_all(t, '{p}', {r.group}) as g, regexp_split_to_array(t, '{p}') as s from docs where regexp_matches(t, '{p}'))""")
    return f"""
with docs as materialized (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
found as ({' union all '.join(parts)}),
spans as (select r, no, kind, length(m[i]) as n, length(g[i]) as gn,
    list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as pos, i from found),
kept as (select r, no, kind, kind || ':' || cast(pos as bigint) || ':' || cast(pos + n as bigint) as w, pos from spans where no <> 0 or gn >= 6),
per as (select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(w, ',' order by pos, no) filter (no < 3) as base, string_agg(w, ',' order by pos, no) as spans from kept group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join per using (r)"""


ORACLES["op2_secret_scan"] = _secret_oracle()


@query
def op4_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


@query
def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = language.held_out("doc_id", 3, 1)
    model = quality.fit(docs, table(spark, sf, "labels").select("doc_id", "quality").where(~kept))
    return quality.score(docs, model).select("doc_id", kept.alias("held_out"), "score", "predicted")


@query
def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return whitening.transform(vectors, whitening.fit(vectors))


@query
def op12_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    index = exact_dedup.DigestIndex(spark, work_dir(spark, "digest-index"), buckets=exact_dedup.buckets_for(docs.count()))
    found = exact_dedup.deduplicate(docs, index, deliveries=4)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op12_exact_dedup"] = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  row_number() over (partition by coalesce(text, '') order by doc_id desc) = 1 as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs, text = table(spark, sf, "documents"), F.col("text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & text.contains("\n")
    tampered = F.when(changed, merkle.leaf_hash(*fields, F.replace(text, F.lit("\n"), F.lit(""))))
    rows = docs.select("doc_id", "source", merkle.leaf_hash(*fields, text).alias("leaf"), tampered.alias("tampered"))
    found = merkle.manifest(rows, "doc_id", "source", "leaf", ["tampered"])
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLES["op13_merkle_manifest"] = """
with recursive d as materialized (select row_number() over () as r, *, case when list_reduce([4294967295] || list_transform(range(1, length(cast(doc_id as varchar)) + 1),
    lambda i: cast(ascii(cast(doc_id as varchar)[i]) as bigint)), lambda c, b: list_reduce([xor(c, b)] || [cast(0 as bigint) for _ in range(8)], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1
    then replace(text, chr(10), '') else text end as other from documents),
f as (select r, doc_id, source, other is distinct from text as changed, concat_ws('', coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-')) as head, text, other from d),
h as materialized (select r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf, sha256(head || coalesce(strlen(other) || ':' || other, '-')) as tampered from f),
placed as materialized (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from h),
up as (select source, 0 as lvl, list(leaf order by place) as l from placed group by source
  union all select source, lvl + 1, list_transform(range(0, (len(l) + 2) // 3), lambda i: sha256(array_to_string(l[3 * i + 1:3 * i + 3], ''))) from up where len(l) > 1),
sub as materialized (select source, max(lvl) as height, arg_max(l, lvl)[1] as subroot, row_number() over (order by source nulls first) - 1 as place from up group by source),
top as (select 0 as lvl, list(subroot order by place) as l from sub
  union all select lvl + 1, list_transform(range(0, (len(l) + 2) // 3), lambda i: sha256(array_to_string(l[3 * i + 1:3 * i + 3], ''))) from top where len(l) > 1),
paths as (select r, u.lvl, p.place // cast(3 ** u.lvl as bigint) as pos, u.l from placed p join up u on p.source is not distinct from u.source where len(u.l) > 1
  union all select p.r, s.height + t.lvl, s.place // cast(3 ** t.lvl as bigint), t.l from placed p join sub s on p.source is not distinct from s.source, top t where len(t.l) > 1),
steps as materialized (select r, lvl, coalesce(array_to_string(l[pos // 3 * 3 + 1:pos], ''), '') as before, coalesce(array_to_string(l[pos + 2:pos // 3 * 3 + 3], ''), '') as after from paths),
folds as (select r, 0 as lvl, tampered as acc from placed
  union all select f.r, f.lvl + 1, sha256(before || acc || after) from folds f join steps s on f.r = s.r and f.lvl = s.lvl),
proof as (select r, sha256(string_agg(before || after, '' order by lvl)) as proof_sha256 from steps group by r),
last as (select r, arg_max(acc, lvl) as folded_root from folds group by r),
root as (select arg_max(l, lvl)[1] as root from top)
select doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
from placed left join proof using (r) join last using (r) join sub s on placed.source is not distinct from s.source, root
"""


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)
