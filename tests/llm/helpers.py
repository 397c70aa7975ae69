"""Small tables with the awkward rows, and brute-force helpers."""

import re

from pyspark.sql import types as T

#: ``documents`` with columns whose names clash with those the operators use inside.
DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("size", T.StringType()), ("key", T.StringType()), ("id", T.StringType()),
    ("digest", T.StringType()), ("k_id", T.StringType()), ("run", T.StringType()), ("row", T.StringType()),
    ("part", T.StringType()), ("score", T.StringType()), ("class", T.StringType()), ("node", T.StringType()),
    ("token", T.StringType()), ("train", T.StringType()), ("body", T.StringType()), ("copies", T.StringType()))])


def docs(spark, rows, parts=2):
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", None) + ("x",) * 15 for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts, "n_chars") if not rows else \
        spark.createDataFrame(spark.sparkContext.parallelize(full, parts), DOCS)


def split_words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def long_text(n, seed=0):
    return " ".join(f"w{(k * 7919 + seed * 104729) % 5003}" for k in range(n))


AWKWARD = [(1, None, "a"), (2, "", "b"), (3, " \t\n ", None), (4, "one", "a"), (5, "one", "a"), (5, "one", "a"),
           (None, "null id", None, None), (None, "one", "b"), (7, long_text(30_000), "c"), (8, long_text(30_000), "c"),
           (9, "a b c d e f g", "a"), (10, "a b c d e f g", "a", None), (11, "É x\x1cy z", "b")]
