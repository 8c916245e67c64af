"""Collocations: phrases of two to four words that occur together more than their parts apart.

Frequent phrases are mined by Toivonen's method.  A sample of the documents
proposes phrases.  One pass over all documents counts every word, and every
longer phrase whose two parts of one word less are proposed: these are the
proposals and their negative border.  Most of them are rare, so this pass counts
hashes of 64 bits only; phrases that share a hash can make it seem frequent,
never rare.  A second pass counts the phrases themselves, those of the frequent
hashes.  A border phrase that turned out frequent was missed by the sample, so
that pass also counts whatever can be built from it; it takes every phrase that
the first did not count for frequent when it looks for longer ones, so it closes
the search.  All counts are exact, whatever the sample held.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import cut_lineage
from .common import spread_join, table
from .registry import query

LONGEST = 4
LEAST = 30
TOP = 2000
# Share of the documents that proposes phrases, and the occurrences there that make a proposal.
SAMPLE = 8
LEAST_SAMPLED = 3
# Proposals are kept as two bits each in a filter of this many bits: its size does not grow with the data.  A phrase
# that the filter holds by chance is counted without need, which costs time and changes nothing.
FILTER_BITS = 26
# Bytes of text that are looked at in one piece; different phrases, and hashes, that a task holds before it hands them on;
# rows in one batch.
PORTION = 1 << 20
HELD = 750_000
HELD_HASHES = 4_000_000
BATCH = 250_000
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + _BREAKS, bytes(range(97, 123)) + b" " + b"\n" * len(_BREAKS)
)
_BLANKS = re.compile(rb"  +")
_EDGES = re.compile(rb" ?\n[ \n]*")
_CUT = re.compile(rb"[ \t.,;:!?\x0a-\x0d]")
_BASE = 0x9E3779B97F4A7C15


def normal(raw: bytes) -> bytes:
    """Lower case, one blank between words, one line end between pieces, a line end on either side."""
    out = raw.translate(_PLAIN)
    if b"  " in out:
        out = _BLANKS.sub(b" ", out)
    return b"\n" + _EDGES.sub(b"\n", b"\n" + out + b"\n").strip(b"\n") + b"\n"


def portions(raw: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text in (normal bytes, words already seen).

    Portions end between words.  One that goes on within a piece starts with
    the last words of the one before, which complete the phrases across.
    """
    start, before = 0, b""
    while start < len(raw):
        cut = _CUT.search(raw, min(len(raw), start + PORTION))
        end = cut.end() if cut else len(raw)
        part = normal(before + b" " + raw[start:end])
        seen = len(before.split())
        yield part, seen
        closed = raw[start:end].rstrip(b" \t").endswith(tuple(bytes([c]) for c in _BREAKS))
        before = b"" if closed else b" ".join(part.strip(b"\n").rsplit(b"\n", 1)[-1].split()[1 - LONGEST :])
        start = end


class Hashes:
    """Hashes of slices of a portion in constant time each, from sums of its bytes times powers of an odd number."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) >= n:
            return
        factors = np.full(max(n, 2 * PORTION), _BASE, np.uint64)
        factors[0] = 1
        self.up = factors.cumprod(dtype=np.uint64)
        factors[1:] = pow(_BASE, -1, 1 << 64)
        self.down = factors.cumprod(dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
        h = (sums[ends] - sums[starts]) * self.down[starts] ^ np.asarray(seed, np.uint64)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def seed_of(group: str) -> int:
    return xxhash.xxh64_intdigest(group.encode())


def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return (h & low).astype(np.int64), ((h >> np.uint64(64 - bits)) & low).astype(np.int64)


def held(h: np.ndarray, bitmap: np.ndarray | None) -> np.ndarray:
    """Which hashes the filter holds; without a filter, all."""
    if bitmap is None:
        return np.ones(len(h), bool)
    out = np.ones(len(h), bool)
    for at in places(h, (len(bitmap) * 8).bit_length() - 1):
        out &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


def admitted(sums, starts, ends, joined, hashes: Hashes, h: np.ndarray, seed: int, now, past) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For k = 2, 3, ...: the words at which a phrase of k words with good parts starts, the hashes of these phrases, and
    which of them are to be counted.

    `h` has the hashes of the words.  Without `past`, a part is good if it is
    counted and held by `now`, and all phrases with two good parts of k - 1
    words count.  With `past`, those count that `past` did not let in, and a
    part is good if `now` holds it or if it counts in this very pass: a part
    whose count is not known yet is taken for frequent, so nothing is missed.
    """
    good = held(h, now)
    old = held(h, past) if past is not None else None
    for k in range(2, LONGEST + 1):
        at = np.flatnonzero(good[:-1] & good[1:] & joined[: max(0, len(good) - 1)])
        new = np.ones(len(at), bool) if past is None else ~(old[at] & old[at + 1])
        h = hashes.of(sums, starts[at], ends[at + k - 1], seed)
        yield at, h, new
        if k == LONGEST:
            return
        good = np.zeros(max(0, len(good) - 1), bool)
        good[at] = held(h, now)
        if past is not None:
            good[at[new]] = True
            old = np.zeros(len(good), bool)
            old[at] = ~new & held(h, past)


class Words:
    """The words of a portion: where they start and end, which have another behind them in their piece, and their hashes."""

    def __init__(self, part: bytes, group: str, hashes: Hashes):
        data = np.frombuffer(part, np.uint8)
        gap = (data == 32) | (data == 10)
        self.starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        self.ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        self.joined = data[self.ends] == 32
        self.hashes, self.seed, self.sums = hashes, seed_of(group), hashes.sums(data)
        self.h = hashes.of(self.sums, self.starts, self.ends, self.seed)

    def __len__(self) -> int:
        return len(self.starts)

    def admitted(self, now, past) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return admitted(self.sums, self.starts, self.ends, self.joined, self.hashes, self.h, self.seed, now, past)


def count_portion(
    part: bytes, seen: int, group: str, words: Counter, longer: list[Counter], hashes: Hashes, now, past
) -> int:
    """Count the words and phrases of a portion that `now` holds or that `admitted` lets in anew; the number of its words."""
    found = Words(part, group, hashes)
    if len(found) <= seen:
        return 0
    words.update(compress(part.split()[seen:], held(found.h, now)[seen:].tolist()))
    for k, (at, h, new) in enumerate(found.admitted(now, past), 2):
        at = at[(new | held(h, now)) & (at + k > seen)]
        longer[k - 2].update([part[a:b] for a, b in zip(found.starts[at].tolist(), found.ends[at + k - 1].tolist())])
    return len(found) - seen


def portion_hashes(part: bytes, seen: int, group: str, hashes: Hashes, now, past, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray]]:
    """(k, hashes) of the phrases of a portion that `admitted` lets in, and without `past` of all its words."""
    found = Words(part, group, hashes)
    if past is None:
        yield 1, found.h[seen:]
    if longest > 1:
        for k, (at, h, new) in enumerate(found.admitted(now, past), 2):
            yield k, h[new & (at + k > seen)]


def packed(context: SparkContext, *bitmaps: np.ndarray | None) -> Broadcast:
    """Filters for the tasks, compressed: a filter with few phrases is small."""
    small = zstandard.ZstdCompressor(level=1)
    return context.broadcast([None if b is None else small.compress(b.tobytes()) for b in bitmaps])


def unpacked(shared: Broadcast) -> list[np.ndarray | None]:
    large = zstandard.ZstdDecompressor()
    return [None if b is None else np.frombuffer(large.decompress(b), np.uint8) for b in shared.value]


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, str]]:
    """(normal bytes, words already seen, group) of the texts of (group, text) batches; short texts of a group go together."""
    for b in batches:
        waiting: dict[str, list[bytes]] = {}
        sizes = Counter()
        for group, text in zip(b.column(0).to_pylist(), b.column(1)):
            raw = text.as_py()
            if not raw:
                continue
            if len(raw) > PORTION:
                for part, seen in portions(raw):
                    yield part, seen, group
                continue
            waiting.setdefault(group, []).append(raw)
            sizes[group] += len(raw)
            if sizes[group] > PORTION:
                yield normal(b"\n".join(waiting.pop(group))), 0, group
                sizes[group] = 0
        for group, raws in waiting.items():
            yield normal(b"\n".join(raws)), 0, group


def counted_hashes(texts: DataFrame, shared: Broadcast, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(h, k, f) with f >= `least`: hashes of phrases from `texts` (group, text in bytes), never rarer than any of their phrases.

    `shared` holds the filters `now` and `past` of `admitted`.  With `past` the
    words are left out.  Hashes are merged in the tasks before they are shuffled.
    With `longest` = 1 only words are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, past = unpacked(shared)
        hashes, waiting, n = Hashes(), {}, 0

        def out() -> Iterator[pa.RecordBatch]:
            for k in list(waiting):
                h = np.concatenate(waiting.pop(k))
                h.sort()
                first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                f = np.diff(np.r_[first, len(h)])
                h = h[first].view(np.int64)
                for i in range(0, len(h), BATCH):
                    some = slice(i, i + BATCH)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[some]), pa.array(np.full(len(h[some]), k, np.int32)), pa.array(f[some])], ["h", "k", "f"]
                    )

        for part, seen, group in pieces_of(batches):
            for k, h in portion_hashes(part, seen, group, hashes, now, past, longest):
                if len(h):
                    waiting.setdefault(k, []).append(h)
                    n += len(h)
            if n > HELD_HASHES:
                yield from out()
                n = 0
        yield from out()

    found = texts.mapInArrow(run, "h long, k int, f long")
    # Few hashes come twice from a task, so they are dealt out before they are merged further.
    return found.repartition("h").groupBy("h", "k").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def counted(texts: DataFrame, shared: Broadcast, least: int = LEAST) -> DataFrame:
    """(group, phrase, k, f) with f >= `least` from `texts` (group, text in bytes); k = 0 is the number of all words.

    `shared` holds the filters `now` and `past` of `count_portion`.  Counts are
    merged in the tasks before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, past = unpacked(shared)
        hashes, counters, totals = Hashes(), {}, Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for group, n in totals.items():
                yield made(group, [b""], 0, [n])
            for group, each in counters.items():
                for k, c in enumerate(each, 1):
                    rows = iter(c.items())
                    while some := list(islice(rows, BATCH)):
                        yield made(group, [p for p, _ in some], k, [f for _, f in some])
            counters.clear()
            totals.clear()

        def made(group: str, phrases: list[bytes], k: int, f: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([group] * len(f), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(np.full(len(f), k, np.int32)), pa.array(f, pa.int64()),
            ], ["group", "phrase", "k", "f"])

        for part, seen, group in pieces_of(batches):
            words, *longer = counters.setdefault(group, [Counter() for _ in range(LONGEST)])
            totals[group] += count_portion(part, seen, group, words, longer, hashes, now, past)
            if sum(len(c) for each in counters.values() for c in each) > HELD:
                yield from out()
        yield from out()

    found = texts.mapInArrow(run, "group string, phrase string, k int, f long")
    return found.groupBy("group", "phrase", "k").agg(F.sum("f").alias("f")).filter((F.col("f") >= least) | (F.col("k") == 0))


def missing(found: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The rows of `found` (h, k, f) whose hash the filter does not hold."""
    shared = packed(found.sparkSession.sparkContext, bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bitmap,) = unpacked(shared)
        for b in batches:
            yield b.filter(pa.array(~held(b.column(0).to_numpy().view(np.uint64), bitmap)))

    return found.mapInArrow(run, found.schema)


def with_hashes(bitmap: np.ndarray, found: DataFrame) -> np.ndarray:
    """The filter with the hashes of `found` (h, k, f).  What comes to the driver are words of the filter, so never more than it."""
    bits = (len(bitmap) * 8).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.concatenate(places(b.column(0).to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((at & 63).astype(np.int32))], ["word", "bit"])

    rows = found.mapInArrow(run, "word long, bit int").groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = bitmap.copy()
    out.view(np.uint64)[rows["word"].to_numpy()] |= rows["bits"].to_numpy().view(np.uint64)
    return out


def frequent(
    texts: DataFrame, draw: Column, least: int = LEAST, sample: int = SAMPLE, least_sampled: int = LEAST_SAMPLED,
    bits: int = FILTER_BITS,
) -> tuple[DataFrame, list[int]]:
    """All phrases of 1 to LONGEST words that occur `least` times in their group, with exact counts.

    `texts` has the columns group and text (bytes); `draw`, a number made from
    the row, picks the sample (`draw` % `sample` == 0).  Returns (group,
    phrase, k, f), with the number of all words of a group as k = 0, and how
    many words and longer phrases the sample proposed and how many it missed.
    """
    context = texts.sparkSession.sparkContext
    empty = np.zeros(1 << (bits - 3), np.uint8)

    def passed(rows: DataFrame, how, least: int, *filters: np.ndarray | None, **settings) -> DataFrame:
        shared = packed(context, *filters)
        out = cut_lineage(how(rows, shared, least, **settings))
        shared.destroy()
        return out

    drawn = texts.filter(F.pmod(draw, F.lit(sample)) == 0)
    part = F.col("k") < LONGEST
    words = passed(drawn, counted_hashes, least_sampled, None, None, longest=1)
    proposed = with_hashes(empty, words)
    # Longer proposals consist of proposed words; the empty filter lets all of them in as new.
    longer = passed(drawn, counted_hashes, least_sampled, proposed, empty).filter(part)
    added = [words.count(), missing(longer, proposed).count()]
    proposed = with_hashes(proposed, longer)
    known = passed(texts, counted_hashes, least, proposed, None)
    added.append(missing(known.filter(part), proposed).count())
    # Closed after this pass: what the one before did not count is taken for frequent, so its extensions are counted.
    return passed(texts, counted, least, with_hashes(empty, known), proposed), added


def collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): the best phrases of each group from the counts of `frequent`.

    A phrase scores floor(2000000 a / (l + r)) at its worst cut, l and r being
    the counts of its parts; at equal scores the first cut counts.  A phrase
    inside a longer one that has at least 80 % of its occurrences is left out.
    Groups without a phrase of two words have no row.
    """
    words = F.split("phrase", " ")
    phrases = found.filter("k > 1").select("group", "phrase", "k", F.col("f").alias("a"))
    cuts = phrases.withColumn("w", words).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "group", "phrase", "a", "cut",
        F.expr("array_join(slice(w, 1, cut), ' ')").alias("left"), F.expr("array_join(slice(w, cut + 1, k), ' ')").alias("right"),
    )
    cuts = cut_lineage(cuts)
    total = cuts.count()
    for side, name in (("left", "l"), ("right", "r")):
        uses = cuts.groupBy("group", side).agg(F.count(F.lit(1)).alias("_uses"))
        parts = found.filter("k > 0").select("group", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = spread_join(cuts, uses.join(parts, ["group", side]), ["group", side], "_uses", total, ["phrase", "cut"]).drop("_uses")
    big = "CAST({} AS DECIMAL(20, 0))"
    exact = F.expr(f"CAST((2000000BD * {big.format('a')}) div ({big.format('l')} + {big.format('r')}) AS LONG)")
    scored = cuts.withColumn("score", exact).groupBy("group", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("m")
    ).select("group", "phrase", "a", "m.l", "m.r", "m.score")
    inner = phrases.filter("k > 2").withColumn("w", words).select("group", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )).alias("phrase")).groupBy("group", "phrase").agg(F.max("a").alias("_longer"))
    covered = F.expr(f"100BD * {big.format('_longer')} >= 80BD * {big.format('a')}")
    kept = scored.join(inner, ["group", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("_longer")
    # Ranked in parts first, so that no task sorts all phrases of a group.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("group", part).orderBy(*order))).filter(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = found.filter("k = 0").select("group", F.col("f").alias("n"))
    return kept.join(sizes, "group").select("group", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(df: DataFrame, text_col: str = "text", group_col: str = "lang", top: int = TOP, least: int = LEAST, **settings) -> DataFrame:
    """Collocations of each group of `df`.

    Null texts are empty, a null group is `und`.  Empty tables and texts
    without a frequent phrase give no rows.  Repeated rows count as often as
    they stand there; other columns are not read, but for the draw of the sample.
    """
    texts = df.select(
        F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("group"), F.col(text_col).cast("binary").alias("text"),
        F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("draw"),
    )
    # The sample is drawn on the row without its text, so copies under other ids are drawn on their own.
    found, _ = frequent(texts, F.col("draw"), least, **settings)
    return collocations(found, top)


OP13_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
numbered AS (
  SELECT lang, row_number() OVER () AS id, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM numbered WHERE len(w) > 0),
runs AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY id ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {LEAST}),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[: c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1 :], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, {LONGEST}) t(m) WHERE m < k) GROUP BY ALL),
kept AS (
  SELECT x.* FROM worst x LEFT JOIN inside i ON i.lang = x.lang AND i.phrase = x.phrase
  WHERE NOT coalesce(100 * i.longer::HUGEINT >= 80 * x.a::HUGEINT, false))
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank,
  k.phrase, k.a, k.l, k.r, s.n, k.score::BIGINT AS score
FROM kept k JOIN sizes s ON s.lang = k.lang QUALIFY rank <= {TOP}
"""


@query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return mine(table(spark, sf, "documents").select("doc_id", "source", "lang", "text")).withColumnRenamed("group", "lang")
