"""Compressed-size quality scores."""

import random

import numpy as np
import zstandard
from pyspark.sql import functions as F

from covaria.llm import quality

from .helpers import awkward, documents, prose


def marked(n=800):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        words = prose(i, rng.randrange(15, 120)).split()
        bad = i % 4 == 0
        if bad:
            words = [w + rng.choice(["%%%", "&&&"]) for w in words] if i % 8 else [words[0]] * len(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    return docs, labels


def test_quality_of_held_out_rows(spark):
    rows, labels = marked()
    odd = [(2000, None), (2001, ""), (2002, "%%% &&& " * 30_000), (None, rows[1][1]), (None, rows[4][1]), (1, rows[1][1])]
    docs = documents(spark, rows + odd)
    marks = spark.createDataFrame(
        [(i, q, "t") for i, q in labels] + [(3000, 1, "x"), (None, 1, None), (5, None, None), (7, 0, "both labels")],
        "doc_id long, quality int, text string",
    )
    some, shares = quality.labelled(docs, marks)
    learnt = {i for i, _ in labels if i != 7} | {3000}
    crc = {r[0] for r in docs.filter(quality.fold("doc_id", 4) != 2).select("doc_id").distinct().collect()}
    assert sum(shares.values()) in (len(learnt & crc), len(learnt & crc) + 1)
    model = quality.train(some, shares)
    scored = quality.score(docs, model)
    # `score` was among the columns: it is replaced, all others stay.
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"]
    got = {(r.doc_id, r.text): r.score for r in scored.collect()}
    assert scored.count() == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    held = [(i, q) for i, q in labels if i not in crc]
    assert len(held) > 100 and np.mean([(got[i, rows[i][1]] >= 0.7) == bool(q) for i, q in held]) > 0.97
    assert got[2000, None] == got[2001, ""] and got[2002, odd[2][1]] < 0.7 <= got[None, rows[1][1]]
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == scored.filter("score >= 0.7").count()


def test_quality_scores_are_those_of_whole_texts(spark):
    rows, labels = marked(300)
    docs = documents(spark, rows + awkward())
    model = quality.train(*quality.labelled(docs, spark.createDataFrame(labels, "doc_id long, quality int")))
    pair = [
        zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False
        ) for d in model.dictionaries
    ]
    for r in quality.score(docs, model).collect():
        raw = (r.text or "").encode()
        parts = [raw[i : i + 512] for i in range(0, len(raw), 512)]
        bad, good = (sum(len(c.compress(p)) for p in parts) for c in pair)
        want = model.probability(np.array([[bad, good, len(raw)]]))[0]
        assert abs(r.score - want) < 1e-9


def test_labels_of_one_kind_give_their_share(spark):
    docs = documents(spark, awkward())
    for marks, want in (([], 0.0), ([(0, 1), (2, 1), (3, 1)], 1.0), ([(0, 0), (2, 0), (3, 0)], 0.0)):
        model = quality.train(*quality.labelled(docs, spark.createDataFrame(marks, "doc_id long, quality int")))
        assert {r.score for r in quality.score(docs, model).collect()} == {want}
    assert quality.score(documents(spark, []), model).count() == 0
    # Too few lines to train a dictionary on: they are the dictionary.
    few = quality.learn_dictionaries(
        spark.createDataFrame([(0, b"x%%% y%%%\nsame"), (1, b"some words\nsame"), (1, None)], "label int, raw binary")
    )
    assert few == {0: b"x%%% y%%%", 1: b"some words"}


def test_logistic_is_a_minimum():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.standard_normal(500) > 0.3).astype(float)
    weight = rng.uniform(0.5, 2, 500)
    best = quality.logistic(x, y, weight)

    def loss(w):
        z = w[0] + x @ w[1:]
        return np.average(np.log1p(np.exp(z)) - y * z, weights=weight) + 0.0005 * (w[1:] ** 2).sum()

    for i in range(4):
        for step in (-1e-3, 1e-3):
            assert loss(best) <= loss(best + step * np.eye(4)[i])


def test_units_keep_every_byte_of_the_lines():
    raw = (prose(1, 300) + "\n\n" + "é" * 600 + "\nend").encode()
    assert b"".join(quality.units(raw)) == raw.replace(b"\n", b"") and max(map(len, quality.units(raw))) <= 512
