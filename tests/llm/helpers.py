"""Small tables with every kind of awkward row."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use for columns of their own.
    T.StructField("id", T.StringType()), T.StructField("score", T.StringType()), T.StructField("x", T.StringType()),
    T.StructField("n", T.StringType()), T.StructField("_gone", T.StringType()), T.StructField("features", T.StringType()),
    T.StructField("prediction", T.StringType()), T.StructField("key", T.StringType()), T.StructField("c0", T.StringType()),
])
EXTRA = ("i", "s", "x", "n", "g", "f", "p", "k", "c")


def documents(spark, rows):
    """`rows`: (doc_id, text) or (doc_id, text, lang)."""
    full = [(*r, *(("en",) if len(r) < 3 else ()), "src0", None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(16))}" for _ in range(n))


def awkward(seed=1):
    """Nulls, empty and blank texts, a long one, copies, repeated rows, non-ASCII text."""
    long = prose(seed + 100, 60_000)
    rows = [(i, prose(seed + i, 30 + i)) for i in range(20)]
    rows += [(20, None), (21, ""), (22, "  \t\n "), (23, long), (24, long), (None, prose(seed, 30)), (None, None)]
    rows += [(25, rows[3][1]), (26, rows[3][1]), (27, "Übergröße ÀÉ　日本語 emoji 😀 é"), (28, rows[4][1] + " end"), (28, rows[4][1] + " end")]
    return rows
