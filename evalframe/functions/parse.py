"""Answer parsers: Column -> Column, all JVM-side (no Python in the plan).

Regexes go through the Python API (Java regex). Patterns that a user-facing
contract fixes are listed together below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (patterns whose matches must agree with the evaluation suite) ----
# Last `\boxed{...}` with one nested brace level. Possessive quantifiers keep
# Java's backtracking flat, so 20,000-character answers do not overflow the stack.
BOXED_PATTERN = r"\\boxed\{((?:[^{}]++|\{[^{}]*+\})*+)\}"
# Working-group names such as SA1, RAN2, SA3-LI (searched in upper-cased text).
WORKING_GROUP_PATTERN = r"([A-Z]+\d+(?:-[A-Z]+)?)"
# White space as Python's ``\s`` reads it in text: Java's ``\s`` is ASCII only. The
# class is valid in Java and in RE2.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Chosen letter of a multiple-choice reply; the last match wins.
CHOICE_PATTERN = rf"(?i)ANSWER{SPACE}*:{SPACE}*\(?([A-Z])\b"
# Grader score line.
FINAL_SCORE_PATTERN = rf"(?i)\$FINAL_SCORE{SPACE}*:{SPACE}*([0-9]+(?:\.[0-9]+)?)"
# Outermost JSON object of a grader reply (greedy, across lines).
JSON_OBJECT_PATTERN = r"(?s)\{.*\}"
# ---- end of fixed values ----

# Python's str.strip() removes Unicode whitespace; Spark's trim only spaces.
_EDGE_SPACE = r"(?U)^\s+|\s+\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: Unicode whitespace off both ends."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def last_match(text, pattern: str, group: int = 1) -> Column:
    """Group of the last regex match, NULL when there is none."""
    return F.try_element_at(F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(group)), F.lit(-1))


def parse_boxed(text) -> Column:
    """Content of the last ``\\boxed{...}``: stripped, newline+indent removed,
    leading ``:`` and trailing ``.``/``/`` dropped; ``''`` when absent."""
    inner = last_match(_col(text), BOXED_PATTERN, 1)
    s = py_strip(inner)
    s = F.regexp_replace(s, r"(?U)\n\s*", "")
    s = F.regexp_replace(s, r"^:+", "")
    s = F.regexp_replace(s, r"[./]+\z", "")
    return F.coalesce(s, F.lit(""))


def parse_working_group(text) -> Column:
    """First working-group token of the upper-cased text, else the stripped
    original text; NULL or empty gives ``''``."""
    t = _col(text)
    hit = F.regexp_extract(F.upper(t), WORKING_GROUP_PATTERN, 1)
    return (F.when(t.isNull() | (t == ""), F.lit(""))
            .when(hit != "", hit)
            .otherwise(py_strip(t)))


def parse_choice(text, choices) -> Column:
    """Letter after the last ``ANSWER:``, upper-cased, only when it names an
    existing choice; else ``''``."""
    letter = F.upper(last_match(_col(text), CHOICE_PATTERN, 1))
    idx = F.ascii(letter) - F.lit(65)
    return F.when(letter.isNotNull() & (idx < F.size(_col(choices))), letter).otherwise(F.lit(""))


def parse_judge_grade(text, pattern: str = FINAL_SCORE_PATTERN) -> Column:
    """The first match's group 1 as a number; NULL when there is none."""
    hit = F.regexp_extract(_col(text), pattern, 1)
    return F.nullif(hit, F.lit("")).try_cast("double")


_END = "__end_of_text__"
_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def json_pair(text, fields: str) -> Column:
    """The text read as the first of two array elements, for ``first_object``. Where speed matters, give it a projection of its own: the
    object and its test use it three times, and would parse the text as often."""
    return F.from_json(F.concat(F.lit("["), _col(text), F.lit(f',{{"{_END}":7}}]')), f"array<struct<{fields}, `{_END}`: int>>", _JSON_OPTIONS)


def first_object(pair) -> Column:
    """The object of a ``json_pair``; NULL unless the whole text is one object."""
    p = _col(pair)
    whole = (F.size(p) == 2) & (F.try_element_at(p, F.lit(2))[_END] == 7)
    return F.when(whole, F.try_element_at(p, F.lit(1)))


def json_object(text, fields: str) -> Column:
    """The text's JSON object as a struct of ``fields`` (DDL), NULL unless the whole text is one object.

    The rule is that of a strict reader that takes NaN and infinities and keeps the last of repeated keys; a field whose
    value has another type is NULL, its siblings stay. The text is read as the first of two array elements, so
    text behind the object, or a second object, is noticed."""
    return first_object(json_pair(text, fields))


def is_json_object(text) -> Column:
    """The whole text is one JSON object (see ``json_object``)."""
    return F.coalesce(json_object(text, "`__any__`: int").isNotNull(), F.lit(False))


def judge_json_text(text) -> Column:
    """The outermost ``{...}`` of a reply, or the whole reply when there is none."""
    t = _col(text)
    return F.coalesce(F.nullif(F.regexp_extract(t, JSON_OBJECT_PATTERN, 0), F.lit("")), t)


# Fields of the JSON grader's object, in the order it is asked for them.
JUDGE_JSON_FIELDS = ("overall_score", "confidence", "factual_correctness", "relevance",
                     "completeness", "conciseness", "is_safe", "reasoning")


JUDGE_JSON_SCHEMA = ", ".join(f"{k}: string" for k in JUDGE_JSON_FIELDS)


def parse_judge_json(text) -> Column:
    """The grader's JSON object as a struct of its fields' texts; NULL when the reply holds no JSON object."""
    return json_object(judge_json_text(text), JUDGE_JSON_SCHEMA)


def judge_number(doc: Column, name: str) -> Column:
    """A number of the grader's object (NaN and infinities are written in quotes by the reader)."""
    return F.trim(doc[name], F.lit('"')).try_cast("double")
