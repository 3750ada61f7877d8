"""Operator 5: language identification, words first with backoff to character n-grams.

The model holds, per language, the log frequency of the most frequent words and of character n-grams
(of words with their boundaries marked). A word of the model scores by its log frequencies; a word that it lacks scores
by its known n-grams of the longest order that has any, down to single letters. A text's score
per language is the sum over its words; the prediction is the largest (ties: the first name in order) and its score
the posterior under equal priors.

Fitting reads a sample of labelled rows of at most ``max_rows`` (the smallest hashes of id and text: the same
rows in every run) and keeps ``max_words`` words and ``max_grams`` n-grams of each order, so the broadcast model is
bounded by parameters. Prediction covers whole texts of all rows, row by row, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalframe.llm.graph import fresh, smallest_hashes

WORD = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
UNDETERMINED = "und"
CACHE = 100_000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single characters without the marks."""
    if n == 1:
        return list(word)
    marked = f" {word} "
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class LanguageModel:
    """``words`` and ``grams`` (by order): log frequencies per language of ``langs``."""

    def __init__(self, words: dict[str, tuple[float, ...]], grams_: dict[int, dict[str, tuple[float, ...]]], langs: list[str]):
        self.langs, self.words, self.grams = langs, words, grams_
        self._forget()

    def _forget(self) -> None:
        """Start the cache of chunks: their row in a table of summed log frequencies, and whether they hold a letter."""
        self._row: dict[str, int] = {}
        self._known: dict[str, tuple[float, ...]] = {}
        self._table = np.zeros((1024, max(len(self.langs), 1)))
        self._letters = np.zeros(1024, bool)

    def __getstate__(self):
        return {"langs": self.langs, "words": self.words, "grams": self.grams}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def word(self, w: str) -> tuple[float, ...]:
        """Log frequency of a word per language, with backoff."""
        got = self.words.get(w)
        if got is None:
            marked = f" {w} "
            for n in ORDERS:
                find, source = self.grams.get(n, {}).get, marked if n > 1 else w
                known = [v for i in range(len(source) - n + 1) if (v := find(source[i:i + n])) is not None]
                if known:
                    return tuple([sum(c) / len(known) for c in zip(*known, strict=True)])
            return (0.0,) * len(self.langs)
        return got

    def _learn(self, chunk: str) -> int:
        row = len(self._row)
        if row == len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            self._letters = np.concatenate([self._letters, np.zeros_like(self._letters)])
        self._row[chunk] = row
        scores, letters = (0.0,) * len(self.langs), False
        for w in WORD.findall(chunk):
            got = self._known.get(w)
            if got is None:
                got = self._known[w] = self.word(w)
            scores = got if not letters else tuple([a + b for a, b in zip(scores, got, strict=True)])
            letters = True
        self._table[row] = scores
        self._letters[row] = letters and any(map(str.isalpha, chunk))
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); a text without a letter, or null, is undetermined with score 0."""
        found = Counter(text.lower().split()) if text else None  # words never cross white space
        if not found or not self.langs:
            return UNDETERMINED, 0.0
        if len(self._row) >= CACHE:
            self._forget()
        known = self._row
        rows = [known[c] if c in known else self._learn(c) for c in found]
        if not self._letters[rows].any():
            return UNDETERMINED, 0.0
        total = np.fromiter(found.values(), np.float64, len(found)) @ self._table[rows]
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 20_000,
        max_words: int = 20_000, max_grams: int = 10_000) -> LanguageModel:
    """Fit on the labelled rows (text and language not null); see the module's text for the bounds."""
    rows = (labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h"))
            .where("lang is not null and text is not null"))
    rows = smallest_hashes(rows, "_h", max_rows).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            by: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(b["lang"], b["text"], strict=True):
                by[lang].update(words_of(text))
            yield pd.DataFrame([(lang, w, n) for lang, c in by.items() for w, n in c.items()], columns=["lang", "word", "n"])

    counts = rows.mapInPandas(count, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            by: Counter = Counter()
            for lang, w, n in zip(b["lang"], b["word"], b["n"], strict=True):
                for order in ORDERS:
                    for g in grams(w, order):
                        by[lang, order, g] += n
            yield pd.DataFrame([(order, g, lang, n) for (lang, order, g), n in by.items()], columns=["n_chars", "gram", "lang", "n"])

    per_word = counts.withColumn("n_chars", F.lit(0)).withColumnRenamed("word", "gram").select("n_chars", "gram", "lang", "n")
    per_gram = counts.mapInPandas(split, "n_chars int, gram string, lang string, n long").groupBy("n_chars", "gram", "lang").agg(F.sum("n").alias("n"))
    entries = (per_word.unionByName(per_gram).groupBy("n_chars", "gram").agg(F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("by")).persist())
    orders = [(0, max_words), *((n, max_grams) for n in ORDERS)]
    # coalesce: the last cut is made in a task, so that the driver gets the kept entries only and not as many of each partition
    kept = {n: entries.where(F.col("n_chars") == n).orderBy(F.desc("n"), "gram").limit(most).select("gram", "by").coalesce(1) for n, most in orders}
    tables = {n: {r.gram: {x.lang: x.n for x in r.by} for r in df.collect()} for n, df in kept.items()}
    entries.unpersist()
    langs = sorted({lang for t in tables.values() for by in t.values() for lang in by})

    def logs(table: dict) -> dict[str, tuple[float, ...]]:
        totals = {lang: sum(by.get(lang, 0) for by in table.values()) + 0.5 * len(table) for lang in langs}
        return {g: tuple([math.log((by.get(lang, 0) + 0.5) / totals[lang]) for lang in langs]) for g, by in table.items()}

    return LanguageModel(logs(tables[0]), {n: logs(tables[n]) for n in ORDERS}, langs)


def predictor(spark, model: LanguageModel):
    """Column function text -> struct(lang_pred, score) over the broadcast model."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            yield pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def held_out(id_col: str, mod: int = 5, rest: int = 0) -> Column:
    """Rows set aside: crc32 of the id as text, modulo ``mod``, is ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` per row; repeated rows give repeated results, other columns aren't read."""
    predict = predictor(docs.sparkSession, model)
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).withColumn("_p", predict("_text")).select(id_col, "_p.lang_pred", "_p.score")


def has_letter(text: str | None) -> bool:
    """Whether a text holds a letter, by the rule of ``predict``."""
    return any(WORD.search(c) and any(map(str.isalpha, c)) for c in text.lower().split()) if text else False


def drop_undetermined(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows whose language is determined with ``min_score`` at least; columns unchanged, no shuffle.

    With ``min_score`` 0 those are the texts with a letter; with 0.5 also those are rejected for which no language is as likely as all others
    together (texts in a script or a language that the model has never seen, single words that several languages share). A model without languages (nothing was labelled) can't tell a language or a score:
    all texts with a letter are kept then, whatever ``min_score``.
    """
    name = fresh(docs.columns, "_language")
    if not model.langs:
        lettered = F.pandas_udf(lambda texts: texts.map(has_letter).astype(bool), "boolean")
        return docs.withColumn(name, lettered(F.col(text_col))).where(F.col(name)).drop(name)
    predict = predictor(docs.sparkSession, model)
    return (docs.withColumn(name, predict(F.col(text_col)))
            .where((F.col(f"{name}.lang_pred") != UNDETERMINED) & (F.col(f"{name}.score") >= min_score)).drop(name))
