"""Text operators against brute force, on awkward rows."""

import base64
import gzip
import hashlib
import io
import re
import uuid

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from covaria.llm import common, decontaminate, packing, simhash, templates, token_cache, warc

from .helpers import awkward, documents, prose


def shared(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def components_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_on_paths_stars_and_loops(spark):
    rng = np.random.default_rng(3)
    order = rng.permutation(60).tolist()
    edges = [(order[i], order[i + 1]) for i in range(59)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == components_of({x for e in real for x in e}, real)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spread_join_keeps_hot_and_null_keys(spark):
    left = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(3000)] + [(9000, None)], "i long, k long")
    right = left.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("low"))
    got = common.spread_join(left, right, ["k"], "n", 3000, ["i"])
    assert got.count() == 3001 and got.filter("low IS NULL").count() == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = common.spread_join(left, right, ["k"], "n", 3000, ["i"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The place is part of the shuffle's key, so rows of a hot key do not meet.
    assert "SortMergeJoin [_place#" in plan and "hashpartitioning(_place#" in plan and "hashpartitioning(_c_place#" in plan
    assert got.filter("k = 1").select("low", "n").distinct().collect() == [(1, left.filter("k = 1").count())]


# --- SimHash


def fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    value = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints_match_the_definition(spark, monkeypatch):
    rows = awkward()
    got = [tuple(r) for r in simhash.with_fingerprints(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(i, fingerprint(t)) for i, t in rows], key=str)
    monkeypatch.setattr(simhash, "PORTION", 50)
    for _, t in rows[:24]:
        assert simhash.fingerprint(None if t is None else t[:5000].encode()) == fingerprint(t and t[:5000])


@pytest.mark.parametrize("short, cell", [(2, 50_000), (32, 50_000), (32, 7)])
def test_links_connect_what_is_within_the_distance(spark, monkeypatch, short, cell):
    monkeypatch.setattr(simhash, "CELL_SIZE", cell)
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 30)
    fps = {int(b) for b in base}
    for b in base[:6]:
        at = int(b)
        for _ in range(60):  # a dense cluster and a chain away from it
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            value = at
            for f in flips:
                value ^= 1 << int(f)
            value = ((value + 2**63) % 2**64) - 2**63
            fps.add(value)
            if rng.random() < 0.3:
                at = value
    fps = sorted(fps)
    ids = list(range(len(fps)))
    u = np.array(fps, np.int64).view(np.uint64)
    pairs = [(i, j) for i in ids for j in ids if j < i and np.bitwise_count(u[i] ^ u[j]) <= 4]
    table = spark.createDataFrame(list(zip(fps, ids)), "fp long, id long")
    seen = simhash.cells(np.array(fps, np.int64), 4)
    c = np.concatenate([seen[:, [k]] for k in range(seen.shape[1])])
    rows = sorted((int(k), f, i) for r, f, i in zip(seen.tolist(), fps, ids) for k in r if k != 1 << 40)
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[s : s + 97])], ["cell", "fp", "id"]) for s in range(0, len(rows), 97)]
    found = [tuple(p) for b in simhash.linker(4, short)(iter(batches)) for p in zip(*(x.to_pylist() for x in b.columns))]
    assert c.size and set(found) <= set(pairs)
    assert components_of(ids, found) == components_of(ids, pairs)
    if short == 32:
        got = [tuple(r) for r in simhash.links(table).distinct().collect()]
        assert components_of(ids, got) == components_of(ids, pairs)


def test_simhash_groups_and_stage(spark):
    rows = awkward()
    near = prose(77, 400)
    rows += [(60, near), (61, near + " tail"), (62, near + " other tail")]
    docs = documents(spark, rows)
    got = [(r.id, r.fp, r.component) for r in simhash.groups(docs).collect()]
    fps = [(i, fingerprint(t)) for i, t in rows]
    ids = sorted({i for i, _ in fps if i is not None})
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    real = [(i, f) for i, f in fps if i is not None]
    want = components_of(ids, [(i, j) for i, f in real for j, g in real if j < i and bits(f, g) <= 4])
    assert sorted(got, key=str) == sorted([(i, f, want.get(i)) for i, f in fps], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i, _ in rows if i is not None and want[i] == i)
    assert kept.filter("doc_id IS NULL").count() == 2
    empty = documents(spark, [])
    assert simhash.groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# --- token counts


def test_counts_are_the_librarys(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = awkward() + [
        (40, "don't STOP. <|endoftext|>x<|startoftext|> , ... a. A, '. 's. we'LL ... É. İ. ΑΣ Σ"), (41, "<|ENDOFTEXT|>. <|endoftext|>."),
        (42, "x" * 5000 + " y"), (43, "a\x85b\x1cc　d​e"), (44, "don't  STOP.\n\n"), (45, "don't STOP."),
    ]
    library = Tokenizer.from_file(token_cache.public_tokenizer())
    want = sorted([(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows], key=str)
    cache = shared(tmp_path)
    for _ in range(2):  # cold and warm
        got = [tuple(r) for r in token_cache.count_tokens(documents(spark, rows), cache).collect()]
        assert sorted(got, key=str) == want
    assert token_cache.count_tokens(documents(spark, []), shared(tmp_path)).count() == 0


def test_cache_is_used_and_grows_by_misses_only(spark, tmp_path):
    cache = shared(tmp_path)
    first = documents(spark, [(1, "one two"), (2, "one  two"), (3, "three")])
    token_cache.count_tokens(first, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    # A stored count is taken as it stands.
    row = spark.read.parquet(cache).limit(1).collect()[0]
    digest = first.filter("doc_id = 3").select(token_cache.content_digest(F.col("text"))).first()[0]
    other = shared(tmp_path)
    spark.createDataFrame([(digest, row.tokenizer, 77), (digest, "another", 5)], token_cache.CACHE_SCHEMA).write.parquet(other)
    got = {r.id: r.n_tokens for r in token_cache.count_tokens(first, other).collect()}
    assert got[3] == 77 and got[1] == got[2] == 2
    assert spark.read.parquet(other).count() == 3


# --- decontamination


def brute_scan(text, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, spans, hit_items = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(len(b), window)
        for i in range(len(b) - n + 1) if n else ():
            for p in range(len(w) - n + 1):
                if w[p : p + n] == b[i : i + n]:
                    spans.add((p + 1, n))
                    hit_items.add(str(item))
    return len(w), sorted(spans), sorted(hit_items)


def test_scan_matches_brute_force(spark):
    items = [(1, prose(500, 30)), (2, prose(500, 30)), (10, "Short, item!"), (11, None), (12, "..."), (13, prose(501, 10)), (14, "é日本語")]
    item_words = items[0][1].split()
    rows = awkward() + [
        (50, prose(1, 40) + " " + " ".join(item_words[3:16]) + " " + prose(2, 20)), (51, " ".join(w.upper() for w in item_words) + "!"),
        (52, "a SHORT--item here, short item"), (53, " ".join(item_words[:9])), (54, items[5][1] + " é日本語 x"), (55, "ÉÉ é日本語."), (50, "again"),
    ]
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items + [(1, "more words of item one that are ten in all here")], "item_id long, text string").withColumn("h", F.lit(1))
    items.append((1, "more words of item one that are ten in all here"))
    got = [(r.id, r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in decontaminate.scan(docs, bench).collect()]

    assert sorted(got, key=str) == sorted([(i, *brute_scan(t, items)) for i, t in rows], key=str)
    hit = {i for i, t in rows if brute_scan(t, items)[1]}
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(i) for i, _ in rows if i not in hit)
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs.filter("doc_id != 50"), bench).collect()}
    assert cut[52] == "a here" and cut[51] == "!" and cut[1] == rows[1][1]
    none = decontaminate.scan(documents(spark, []), bench)
    assert none.count() == 0
    assert decontaminate.scan(docs, bench.limit(0)).filter("size(spans) > 0").count() == 0


def test_covered_words(spark):
    df = spark.createDataFrame([([(1, 3), (2, 3), (9, 1)],), ([],), ([(1, 10), (4, 2)],)], "spans array<struct<at:int,len:int>>")
    assert [r[0] for r in df.select(decontaminate.covered(F.col("spans"))).collect()] == [5, 0, 10]


# --- packing


def test_best_fit_places_everything_once():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 4097, 700).tolist() + [4096, 1, 512, 512]
    placed = packing.best_fit(sizes)
    bins = {}
    for size, (b, length, offset) in zip(sizes, placed):
        bins.setdefault((b, length), []).append((offset, size))
    for (_, length), items in bins.items():
        items.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(items, items[1:])) and items[0][0] == 0
        used = sum(n for _, n in items)
        assert used <= length and length == min(c for c in packing.LENGTHS if c >= used)
    # No bin's contents fit into the room of a bin that was open before: best fit leaves few half-empty bins.
    assert sum(length for _, length in bins) < 1.1 * sum(sizes)
    assert packing.best_fit([]) == [] and packing.best_fit([100]) == [(0, 512, 0)]


def test_pack_keeps_all_tokens(spark):
    rows = [(i, i * 37 % 5000) for i in range(300)] + [(1000, None), (1001, 0), (None, 9), (None, 9), (1002, 20_001)]
    sized = spark.createDataFrame(rows, "id long, n_tokens long")
    got = packing.pack(sized, shard=64).collect()
    total = {}
    for r in got:
        total[r.id] = total.get(r.id, 0) + r.n_tokens
        assert (r.bin_id is None) == (r.n_tokens == 0)
        assert r.start_token == r.piece * 4096 and r.n_tokens <= 4096
    want = {}
    for i, n in rows:
        want[i] = want.get(i, 0) + (n or 0)
    assert total == want
    used, length = {}, {}
    for r in got:
        if r.bin_id is not None:
            used.setdefault(r.bin_id, []).append((r.bin_offset, r.n_tokens))
            length[r.bin_id] = r.bin_length
    for b, items in used.items():
        items.sort()
        assert all(x + n == y for (x, n), (y, _) in zip(items, items[1:])) and sum(n for _, n in items) <= length[b]
    again = packing.pack(sized.repartition(7), shard=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert packing.pack(spark.createDataFrame([], "id long, n_tokens long")).count() == 0


# --- line templates


def brute_dropped(rows, min_docs=2):
    leaves = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            for key in templates.template_keys(line):
                leaves.setdefault(key, []).append((i, k))
    gone = {}
    counts = {}
    for i, text in rows:
        for key in {key for line in (text or "").split("\n") for key in templates.template_keys(line)}:
            counts[key] = counts.get(key, 0) + 1
    for key, members in leaves.items():
        known = [i for i, _ in members if i is not None]
        for i, k in members:
            if counts[key] >= min_docs and known and i is not None and min(known) < i:
                gone.setdefault(i, set()).add(k)
    return gone


def test_template_drop_matches_brute_force(spark):
    passage = prose(900, 60)
    rows = awkward() + [
        (70, "own line of seventy stays here\n" + passage), (71, passage + "\n" + prose(901, 9)), (72, passage.replace(" ", "  ") + "\nx"),
        (73, "error 17 at 10:22 in part 5 of host a.example\nfine"), (74, "error 18 at 11:09 in part 6 of host a.example"),
        (75, "one two three four five six seven eight nine TEN"), (76, "one two three four five six seven eight nine ELEVEN"),
        (77, "too short line\nsame line twice in here\nsame line twice in here"), (78, "too short line"), (None, passage), (None, "z " * 20),
    ]
    docs = documents(spark, rows)
    gone = brute_dropped(rows)
    assert {70, 71, 72, 73, 74} & set(gone) == {71, 72, 74} and 76 in gone and 77 not in gone and 78 not in gone
    out = templates.drop_templates(docs)
    assert out.columns == docs.columns
    want = [(i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ()))) for i, t in rows]
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=str) == sorted(want, key=str)
    assert templates.drop_templates(documents(spark, [])).count() == 0


# --- archives


def test_archives_round_trip(spark, tmp_path):
    same = "<p>same</p>"
    rows = [
        (5, "http://a.example/x y\r\nEvil: 1", same), (2, "http://a.example/2", same), (9, None, same), (3, "u3", None), (4, "u4", ""), (7, "u7", "ü" * 3000),
        (8, "u8", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"), (None, "u9", same), (2, "http://a.example/2", same),
    ]
    pages = spark.createDataFrame(rows, "page_id long, target_uri string, html string").select(
        "page_id", "target_uri", F.lit("2024-01-01T00:00:00Z").alias("warc_date"), F.col("html").cast("binary").alias("payload"), F.lit(1).alias("record_id")
    )
    path = shared(tmp_path)
    resolved = warc.resolve(pages, "page_id")
    warc.write_archives(resolved, "page_id", path)
    back = warc.read_archives(spark, path)
    got = sorted((str(r.record_id), r.record_type, r.payload_digest, r.payload_bytes, r.refers_to, bytes(r.payload) if r.payload is not None else None) for r in back.collect())
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        first = min((j for j, _, o in rows if j is not None and (o or "").encode() == b), default=None)
        again = i is not None and first is not None and first < i
        want.append((f"<urn:record:{i}>" if i is not None else "None", "revisit" if again else "response", sha(b), len(b),
                     f"<urn:record:{first}>" if again else None, None if again else b))
    assert got == sorted(want)
    # Payloads under the limit are never revisits.
    assert warc.resolve(pages, "page_id", min_bytes=1).filter("page_id IN (3, 4) AND record_type = 'revisit'").count() == 0
    assert warc.resolve(pages.limit(0), "page_id").count() == 0


def test_parser_takes_plain_and_damaged_archives():
    good = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r[5] for r in warc.parse(io.BytesIO(good * 2), "f")] == [3, 3]
    assert [r[7] for r in warc.parse(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(good) * 2)), "f")] == [b"abc", b"abc"]
    for bad in (good[:-9], b"junk" + good):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(bad), "f"))
    wrong = good.replace(b"Content-Length", b"WARC-Payload-Digest: sha1:AAAA\r\nContent-Length")
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(wrong), "f"))
