"""Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from covaria.llm import manifest

from .helpers import awkward, documents, prose


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(leaves):
    """Root of a list of digests, and for each the siblings (left, right) level by level."""
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, way in enumerate(ways):
            lo = at[i] // 16 * 16
            way.append(("".join(nodes[lo : at[i]]), "".join(nodes[at[i] + 1 : lo + 16])))
            at[i] //= 16
        nodes = [digest(nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], ways


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """`rows`: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        low = None if r[4] is None else lower(r[4])
        groups[r[1]].append((r[0], coded(r), coded((*r[:4], low))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = climb([x[1] for x in groups[s]])
    root, over = climb([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, over):
        for (i, leaf, forged), way in zip(groups[s], trees[s][1]):
            way = way + above
            at = forged if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else leaf
            for a, b in way:
                at = digest([a, at, b])
            out.append((i, leaf, trees[s][0], root, digest(x for e in way for x in e), at, at == root))
    return Counter(out)


def manifest_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    forged = F.when(
        manifest.fold("doc_id", 5) == 0, manifest.leaf_digest([*first, F.translate("text", manifest.UPPER, manifest.LOWER)])
    )
    found = manifest.verified(manifest.manifest(docs, "doc_id", "source", manifest.leaf_digest([*first, F.col("text")]), forged))
    return Counter(tuple(r) for r in found.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_sizes_of_groups(spark):
    rng = random.Random(5)
    rows = []
    for source, n in (("a", 1), ("b", 2), ("", 16), (None, 17), ("é", 256), ("Z", 257), ("z\0", 15), ("z", 33)):
        ids = rng.sample(range(-3000, 3000), n)
        rows += [(i, source, None if i % 3 else "en", None if i % 5 else i, f"Text {i}" if i % 7 else None) for i in ids]
    rng.shuffle(rows)
    got = manifest_of(spark, rows)
    assert got == brute(rows) and not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_ties_nulls_copies_and_far_ids(spark):
    rng = random.Random(6)
    same = [(7, "s", "en", 3, "Abc")] * 70
    null_ids = [(None, "s", "en", i % 9, f"t{i % 40}") for i in range(120)]
    tied = [(8, s, "en", i, prose(i, 5)) for i in range(90) for s in ("s", "t", None)]
    far = [(i, "far", None, None, "X") for i in (-(2**63), 2**63 - 1, 0, -1, 2**40, 2**52 + 1, -(2**52), 63, 64, 4095, 4096)]
    odd = [(i, "s", "en", None, text) for i, text in awkward()] + [(9, None, None, None, None)]
    rows = same + null_ids + tied + far + odd
    rng.shuffle(rows)
    assert manifest_of(spark, rows) == brute(rows)


def test_one_row_many_times_is_spread(spark, monkeypatch):
    monkeypatch.setattr(manifest, "PORTION", 8)
    rows = [(1, "s", None, 1, "A")] * 100 + [(2, "s", None, 1, "B")]
    assert manifest_of(spark, rows) == brute(rows)


def test_single_row_and_empty_table(spark):
    rows = [(5, None, None, None, None)]
    got = manifest_of(spark, rows)
    assert got == brute(rows)
    (r,) = got
    assert r[1] == r[2] == r[3] and r[4] == digest([])
    assert not manifest_of(spark, [])


def test_clashing_columns(spark):
    docs = documents(spark, [(i, f"t{i}", "en") for i in range(40)]).withColumnsRenamed({"n": "g", "x": "_before", "key": "pos", "_gone": "leaf"})
    found = manifest.verified(manifest.manifest(docs, "doc_id", "source", manifest.leaf_digest([F.col("doc_id"), F.col("leaf")])))
    assert found.count() == 40 and found.filter("verified").count() == 40


def test_ranks_hold_bounded_groups(spark):
    # Far apart ids: one word and one container each, and directories of at most 2**13 entries.
    ids = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7_919_000_123).alias("_i"), (F.col("id") % 3 + 1).alias("_n"))
    got = manifest.ranks(ids, ids, ["g"]).orderBy("_i").collect()
    before = 0
    for r in got:
        assert r["_before"] == before
        before += r["_n"]
