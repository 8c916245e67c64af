"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.llm import phrases

from .helpers import awkward, documents, prose


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts(rows):
    """f of every phrase by (group, phrase), and all words by group."""
    f, n = Counter(), Counter()
    for group, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[group] += len(words)
            for k in range(1, 5):
                f.update((group, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, least=30, top=2000):
    f, n = counts(rows)
    cand = {p: a for p, a in f.items() if a >= least and " " in p[1]}
    out = []
    for group in n:
        scored = []
        for (g, p), a in cand.items():
            if g != group:
                continue
            w = p.split(" ")
            inside = lambda q: any(q[i : i + len(w)] == w for i in range(len(q) - len(w) + 1))
            if any(h == g and len(q.split(" ")) > len(w) and 100 * b >= 80 * a and inside(q.split(" ")) for (h, q), b in cand.items()):
                continue
            cuts = [(2000000 * a // (f[g, " ".join(w[:k])] + f[g, " ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, p.encode(), p, a, f[g, " ".join(w[:k])], f[g, " ".join(w[k:])], score))
        for rank, (_, _, _, p, a, l, r, score) in enumerate(sorted(scored)[:top], 1):
            out.append((group, rank, p, a, l, r, n[group], score))
    return sorted(out)


def corpus(seed=1, n=900):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{i // 26}" for i in range(60)] + ["É", "ß", "日本", "it's", " x"]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(len(vocabulary))], k=rng.randrange(60))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(["New York City", "in spite of", "red   herring", "a\tb c d e"]).split(" ")
        seps = rng.choices([" ", "  ", "\t", ". ", ", ", "\n", " ?! ", "\x0b"], weights=[20, 1, 1, 2, 2, 1, 1, 1], k=len(words))
        rows.append((rng.choice(["en", "de", None]), " ".join(w + s for w, s in zip(words, seps))))
    return rows


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", i) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, k long")


def mined(spark, rows, **settings):
    return sorted(tuple(r) for r in phrases.mine(table_of(spark, rows), **settings).collect())


def named(rows):
    return [(g or "und", t) for g, t in rows]


@pytest.mark.parametrize("settings", [{}, {"sample": 50, "least_sampled": 3}, {"bits": 6}])
def test_collocations_match_plain_counting(spark, settings):
    rows = corpus() + [("en", None), ("fr", ""), (None, " \t\n"), ("de", "word " * 2000), ("en", "x" * 5000)]
    want = brute(named(rows))
    assert len(want) > 50 and mined(spark, rows, **settings) == want


def test_top_and_ties(spark):
    rows = [("en", "b a. a b. c d! d c; é f? f é")] * 31 + [("de", "x y")] * 30
    want = brute(rows, top=3)
    assert mined(spark, rows, top=3) == want and [r[2] for r in want if r[0] == "en"] == ["a b", "b a", "c d"]


def test_border_failures_are_expanded(spark):
    # Phrases that the sample never shows: their words, pairs and triples each fail in turn.
    rows = [("en", "alpha beta gamma delta. filler words here")] * 40 + [("en", "filler words here and there")] * 400
    texts = table_of(spark, rows).select(F.col("lang").alias("group"), F.col("text").cast("binary").alias("text"), "doc_id")
    found, added = phrases.frequent(texts, F.when(F.col("doc_id") < 40, 1).otherwise(0))
    assert added == [5, 7, 4]
    f, n = counts(rows)
    got = {(r.group, r.phrase): r.f for r in found.filter("k > 0").collect()}
    assert got == {p: a for p, a in f.items() if a >= 30}
    assert found.filter("k > 0").count() == len(got)  # each phrase is counted in one pass only


def test_portions_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PORTION", 40)
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(["a", "bb ", " ", "c. ", "\n", "Dd\t", "é ", "long" * 20 + " "]) for _ in range(rng.randrange(1, 120)))
        words, longer = Counter(), [Counter() for _ in range(3)]
        hashes, n = phrases.Hashes(), 0
        for part, seen in phrases.portions(text.encode()):
            n += phrases.count_portion(part, seen, "g", words, longer, hashes, None, None)
        f, total = counts([("g", text)])
        got = {("g", p.decode()): c for c_ in (words, *longer) for p, c in c_.items()}
        assert got == dict(f) and n == total["g"]


def test_hashes_do_not_depend_on_the_place():
    hashes, rng = phrases.Hashes(), np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    data[4000:4100] = data[100:200]
    sums = hashes.sums(data)
    h = hashes.of(sums, np.array([100, 4000, 101]), np.array([200, 4100, 201]), 7)
    assert h[0] == h[1] != h[2]
    alone = hashes.of(hashes.sums(data[100:200]), np.array([0]), np.array([100]), 7)
    assert alone[0] == h[0] != hashes.of(sums, np.array([100]), np.array([200]), 8)[0]


def test_large_counts_are_exact(spark):
    big = 9 * 10**18
    found = spark.createDataFrame(
        [("g", "a b", 2, big), ("g", "a", 1, big + 1), ("g", "b", 1, big + 3), ("g", "", 0, 2 * 10**18), ("g", "a b c", 3, big * 8 // 10 - 1), ("g", "c", 1, big), ("g", "b c", 2, big)],
        "group string, phrase string, k int, f long",
    )
    got = {r.phrase: (r.score, r.l, r.r) for r in phrases.collocations(found).collect()}
    assert got["a b"] == (2000000 * big // (2 * big + 4), big + 1, big + 3)
    assert got["a b c"] == (2000000 * (big * 8 // 10 - 1) // (2 * big + 1), big + 1, big)


def test_awkward_and_empty_tables(spark):
    rows = [(None, t) for _, t in awkward()]
    docs = documents(spark, [(i, t) for i, t in awkward()])
    got = sorted(tuple(r) for r in phrases.mine(docs).collect())
    assert got == brute([("en", t) for _, t in rows])
    assert phrases.mine(documents(spark, [])).count() == 0
    assert phrases.mine(documents(spark, [(1, None), (2, "")])).count() == 0


def test_only_frequent_phrases_are_held_as_text():
    hashes = phrases.Hashes()
    known = phrases.Words(phrases.normal(b"alpha. beta. alpha beta"), "g", hashes)
    now = np.zeros(1 << 13, np.uint8)
    pairs = next(known.admitted(None, None))[1]
    for at in phrases.places(np.concatenate([known.h, pairs]), 16):
        np.bitwise_or.at(now, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    words, longer = Counter(), [Counter() for _ in range(3)]
    # Nothing is new: the pass before counted all that its full filter let in.
    full = np.full(1 << 13, 255, np.uint8)
    n = phrases.count_portion(phrases.normal(b"alpha beta rare alpha beta alpha"), 0, "g", words, longer, hashes, now, full)
    assert n == 6 and words == {b"alpha": 3, b"beta": 2} and longer == [{b"alpha beta": 2}, {}, {}]


def test_phrases_that_share_a_hash_are_counted_apart(monkeypatch):
    first = phrases.Hashes.of
    monkeypatch.setattr(phrases.Hashes, "of", lambda self, *a: first(self, *a) % np.uint64(1009))
    rows = [("g", text) for _, text in corpus(seed=5, n=120)]
    part, hashes, total = phrases.normal(".".join(t for _, t in rows).encode()), phrases.Hashes(), Counter()
    for _, h in phrases.portion_hashes(part, 0, "g", hashes, None, None):
        total.update(h.tolist())
    now, full = np.zeros(1 << 13, np.uint8), np.full(1 << 13, 255, np.uint8)
    for at in phrases.places(np.array([h for h, f in total.items() if f >= 30], np.uint64), 16):
        np.bitwise_or.at(now, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    words, longer = Counter(), [Counter() for _ in range(3)]
    phrases.count_portion(part, 0, "g", words, longer, hashes, now, full)
    f, _ = counts(rows)
    got = {("g", p.decode()): c for c_ in (words, *longer) for p, c in c_.items() if c >= 30}
    assert len(f) > 1009 and got == {p: c for p, c in f.items() if c >= 30}
