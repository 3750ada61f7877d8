"""Operator 2: secret scan with a trigram inverted index (DataFrame functions only).

Each rule's regular expression yields a Boolean query over trigrams that every match must contain
(``trigram_query``). An inverted index, trigram to documents, is built for the trigrams that some query names;
its postings are intersected and united as the queries say, and only the candidates of a rule are verified with
its expression. A rule whose expression has no mandatory trigram (such as a run of hex digits) scans all texts.

Trigrams are of the text with A-Z in lower case, so a query never misses a match. Positions count
code points. Texts are scanned whole; null texts are empty.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalframe.llm.graph import fresh

MASK = "[SECRET]"
#: Elements of one chunk of a running sum, and code points of one piece of a text.
PIECE, SIGNS = 64, 4096
SPAN = "array<struct<start:bigint,kind_no:int,stop:bigint,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` (Java syntax within what Python's re reads too); a match counts if ``group`` has ``shortest`` characters at least."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1


#: The base kinds of the contract, in its order. For ``access`` and ``hex`` the shortest length is part of the expression: a
#: run of the class is matched from its first possible start to its end either way.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds: private key headers, hosting and chat tokens, signed web tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

Query = frozenset  # of alternatives, each a frozenset of trigrams that must all occur
_STRINGS = 64


def trigram_query(pattern: str) -> Query | None:
    """Alternatives (a set of sets of trigrams) of which one must hold in any text with a match; None if there is no such condition."""
    from re import _parser as parser

    def small(node) -> list[str] | None:
        """All strings a node can match, if they are few."""
        kind, arg = str(node[0]), node[1]
        if kind == "LITERAL":
            return [chr(arg)]
        if kind == "IN":
            chars = []
            for k, v in arg:
                if str(k) == "LITERAL":
                    chars.append(chr(v))
                elif str(k) == "RANGE" and v[1] - v[0] < 8:
                    chars += map(chr, range(v[0], v[1] + 1))
                else:
                    return None
            return chars if len(chars) <= 8 else None
        if kind == "SUBPATTERN":
            return joined(arg[3])
        if kind == "BRANCH":
            parts = [joined(b) for b in arg[1]]
            return sum(parts, []) if all(p is not None for p in parts) and sum(map(len, parts)) <= _STRINGS else None
        if kind == "MAX_REPEAT" and arg[1] <= 8:
            one = joined(arg[2])
            if one is not None:
                out = ["".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)] if len(one) ** arg[1] <= _STRINGS else None
                return out
        return None

    def joined(nodes) -> list[str] | None:
        out = [""]
        for node in nodes:
            part = small(node)
            if part is None or len(out) * len(part) > _STRINGS:
                return None
            out = [a + b for a in out for b in part]
        return out

    def need(strings: list[str]) -> Query | None:
        """One of the strings occurs."""
        sets = [frozenset(s[i:i + 3].lower() for i in range(len(s) - 2)) for s in strings]
        return None if any(not s for s in sets) else frozenset(s for s in sets if not any(o < s for o in sets))

    def both(a: Query | None, b: Query | None) -> Query | None:
        if a is None or b is None:
            return a if b is None else b
        return frozenset(x | y for x in a for y in b) if len(a) * len(b) <= _STRINGS else min(a, b, key=len)

    def of(nodes) -> Query | None:
        query, now = None, [""]
        for node in [*nodes, None]:
            part = small(node) if node is not None else None
            if part is not None and len(now) * len(part) <= _STRINGS:
                now = [a + b for a in now for b in part]
                continue
            query, now = both(query, need(now)), [""] if part is None else part
            if node is None or part is not None:
                continue
            kind, arg = str(node[0]), node[1]
            if kind == "SUBPATTERN":
                query = both(query, of(arg[3]))
            elif kind == "BRANCH":
                parts = [of(b) for b in arg[1]]
                query = both(query, None if any(p is None for p in parts) else frozenset().union(*parts))
            elif kind == "MAX_REPEAT" and arg[0] > 0:
                query = both(query, of(arg[2]))
        return query

    return of(parser.parse(pattern))


def postings(docs: DataFrame, vocabulary: list[str], key: str = "_key", text_col: str = "_text") -> DataFrame:
    """The inverted index ``trigram, key`` of the vocabulary's trigrams."""
    low = F.lower(F.col(text_col))
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in vocabulary]))
    return docs.select(key, F.explode(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query], key: str = "_key") -> DataFrame:
    """``key, rules``: for each document the rules whose query holds; documents without any are left out."""
    had = index.groupBy(key).agg(F.collect_set("trigram").alias("_had"))

    def holds(query: Query) -> Column:
        every = [reduce(lambda a, b: a & b, [F.array_contains("_had", t) for t in sorted(s)]) for s in sorted(query, key=sorted)]
        return reduce(lambda a, b: a | b, every)

    rules = F.array_compact(F.array(*[F.when(holds(q), F.lit(kind)) for kind, q in queries.items()]))
    return had.select(key, rules.alias("_rules")).where(F.size("_rules") > 0)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(values: Column, fold) -> Column:
    """For each element of an array of longs, ``fold`` (sum or largest, from 0) over the elements before it. In chunks of ``PIECE`` elements, and
    of ``PIECE`` chunks' folds, so that the work for an element doesn't grow with the array."""
    zero = F.lit(0).cast("bigint")

    def over(part: Column) -> Column:
        return F.aggregate(part, zero, fold)

    def chunked(array: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / PIECE).cast("int")), lambda c: F.slice(array, c * PIECE + 1, F.lit(PIECE)))

    def within(chunks: Column, bases: Column) -> Column:
        return F.flatten(F.transform(chunks, lambda chunk, c: F.transform(
            chunk, lambda _, i: fold(F.get(bases, c), over(F.slice(chunk, F.lit(1), i))))))

    def plain(array: Column) -> Column:
        return F.transform(array, lambda _, i: over(F.slice(array, F.lit(1), i)))

    def scan(array: Column, levels: int) -> Column:
        if not levels:
            return plain(array)
        return _let(chunked(array), lambda chunks: _let(scan_of(F.transform(chunks, over), levels - 1), lambda bases: within(chunks, bases)))

    def scan_of(array: Column, levels: int) -> Column:
        return _let(array, lambda x: scan(x, levels))

    return F.when(F.size(values) == 0, F.expr("cast(array() as array<bigint>)")).otherwise(scan_of(values, 2))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Matches of one rule with their code point positions: the text's pieces between matches tell where each match starts."""
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g).cast("bigint"))

    def lengths(group: int) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), lambda m: F.length(m).cast("bigint"))

    def placed(found: Column, kept: Column, gap: Column) -> Column:
        widths = F.zip_with(F.slice(gap, F.lit(1), F.size(found)), found, lambda g, m: g + m)
        return _let(_before(widths, lambda x, y: x + y), lambda start: F.transform(found, lambda m, i: F.struct(
            (F.get(start, i) + F.get(gap, i)).alias("start"), F.lit(number).alias("kind_no"), (F.get(start, i) + F.get(gap, i) + m).alias("stop"),
            F.lit(rule.kind).alias("kind"), F.get(kept, i).alias("size"))))

    sized = _let(gaps, lambda gap: _let(lengths(0), lambda found: placed(found, found, gap) if not rule.group
                                        else _let(lengths(rule.group), lambda kept: placed(found, kept, gap))))
    fits = F.filter(sized, lambda x: x["size"] >= rule.shortest)
    return F.transform(fits, lambda x: F.struct(x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["stop"].alias("stop"), x["kind"].alias("kind"))).cast(SPAN)


def with_spans(docs: DataFrame, text_col: str, out: str, id_cols: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column of all rules' spans (start, kind_no, stop, kind), sorted by start, then by the rules' order."""
    none = F.expr(f"cast(array() as {SPAN})")
    key, body, possible = (fresh(docs.columns, c) for c in ("_key", "_text", "_rules"))
    keyed = docs.withColumn(key, F.xxhash64(*[F.col(c) for c in [*id_cols, text_col]])).withColumn(body, F.coalesce(F.col(text_col), F.lit("")))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    if queries:
        vocabulary = sorted({t for q in queries.values() for s in q for t in s})
        wanted = candidates(postings(keyed, vocabulary, key, body), queries, key).withColumnRenamed("_rules", possible)
        keyed = keyed.join(wanted, key, "left")
    parts = []
    for i, rule in enumerate(rules):
        text = F.col(body)
        asked = F.coalesce(F.array_contains(possible, rule.kind), F.lit(False)) if rule.kind in queries else F.lit(True)
        parts.append(F.when(asked & text.rlike(rule.pattern), _spans(text, rule, i)).otherwise(none))
    return keyed.withColumn(out, F.array_sort(F.concat(*parts))).drop(key, body, possible)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id_col, spans`` of every row: an array of (start, kind_no, stop, kind), empty without a finding.

    Repeated rows give repeated results, an empty table gives none; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_body"))
    return with_spans(rows, "_body", "spans", [id_col], rules).select(id_col, "spans")


def written(spans: Column) -> Column:
    """Spans as text: kind:start:stop, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, mask: str = MASK,
           length_col: str | None = None) -> DataFrame:
    """The documents with each span (overlapping ones together) replaced by ``mask``; other rows and columns are unchanged, null texts stay null.

    ``length_col`` names a column that holds the text's length and follows a changed text.
    """
    name = fresh(docs.columns, "_spans")
    text = F.col(text_col)
    none = F.lit("")

    def part(pieces: Column, i: Column, a: Column, n: Column) -> Column:
        return F.substring(F.coalesce(F.get(pieces, i.cast("int")), none), (a + 1).cast("int"), n.cast("int"))

    def cut(pieces: Column, a: Column, b: Column) -> Column:
        """The text from ``a`` to ``b``, from pieces of SIGNS code points each: nothing before the first of them is read."""
        i, j = F.floor(a / SIGNS), F.floor(b / SIGNS)
        middle = F.array_join(F.slice(pieces, (i + 2).cast("int"), F.greatest(j - i - 1, F.lit(0)).cast("int")), "")
        several = F.concat(part(pieces, i, a % SIGNS, F.lit(SIGNS)), middle, part(pieces, j, F.lit(0), b % SIGNS))
        return F.when(b <= a, none).when(i == j, part(pieces, i, a % SIGNS, b - a)).otherwise(several)

    def cleaned(spans: Column, pieces: Column) -> Column:
        stops = F.transform(spans, lambda s: s["stop"])
        kept = _let(_before(stops, lambda x, y: F.greatest(x, y)), lambda ends: F.transform(spans, lambda s, i: F.when(
            s["start"] >= F.get(ends, i), F.concat(cut(pieces, F.get(ends, i), s["start"]), F.lit(mask))).otherwise(none)))
        return F.concat(F.array_join(kept, ""), cut(pieces, F.array_max(stops), F.length(text).cast("bigint")))

    clean = _let(F.col(name), lambda spans: _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SIGNS}}}"), F.lit(0)), lambda pieces: cleaned(spans, pieces)))
    found, out = with_spans(docs, text_col, name, [id_col], rules), fresh(docs.columns, "_clean")
    hit = F.size(name) > 0
    changed = {text_col: F.col(out)}
    if length_col is not None:
        changed[length_col] = F.when(hit, F.length(out).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return found.withColumn(out, F.when(hit, clean).otherwise(text)).select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])
