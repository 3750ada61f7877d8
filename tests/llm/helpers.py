"""Small documents with every awkward case, and plain reference versions."""

import random
import re

from pyspark.sql import types as T

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
#: The columns of documents, and some that operators use as names of their own.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("_key", T.StringType()),
                     T.StructField("length", T.StringType()), T.StructField("rule", T.LongType())])


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text, lower=True):
    text = text or ""
    return SPACE.findall(fold(text) if lower else text)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(seed=1, n=60):
    """Prose, exact and near copies, a shared passage and awkward rows: (doc_id, text)."""
    rng = random.Random(seed)
    passage = prose(rng, 25)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind < 3 or i < 6:
            body = prose(rng, rng.choice([1, 2, 4, 9, 12, 15, 30, 80]))
        else:
            body = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                body[rng.randrange(len(body))] = rng.choice(["new", "other", "x"])
        if kind == 1:
            at = rng.randrange(len(body) + 1)
            body = body[:at] + passage + body[at:]
        rows.append((i, " ".join(body)))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one"), (905, "Two Words"), (905, "two words"), (906, "a b c"), (906, "a b c"),
             (907, "\u00c9t\u00e9 \U0001f600 \u4e2d\u6587 caf\u00e9 na\u00efve"), (None, "a b c"), (None, None), (908, " ".join(prose(rng, 6000, 50))), (-5, "a  b\n\nc")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None, "k", "l", 7) for i, t in rows], DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
