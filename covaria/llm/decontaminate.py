"""Benchmark decontamination: a broadcast hash set of benchmark word windows, scanned over every document.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, in_few
from .common import plain_names, spread_join, table
from .registry import query

WINDOW = 10
# The window set is broadcast with its words up to this many rows (about 100 bytes each).  A larger one is broadcast as
# hashes (about 50 bytes each), in parts of at most HASHES, and the words of the hits are compared afterwards.
BROADCAST_WINDOWS = 500_000
HASHES = 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# All but \x00-\x2F, \x3A-\x60 and \x7B-\x7F, said in the positive: negated unions of ranges match many times slower.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]++"
# A word with what stands before it, or what stands after the last word; upper case counts.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+$"


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _windows(w: Column, length: Column | int) -> Column:
    """(at, len, h) for each window of `length` words."""
    length = F.lit(length) if isinstance(length, int) else length
    starts = F.when(F.size(w) >= length, F.sequence(F.lit(1), F.size(w) - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), length.alias("len"), F.xxhash64(F.slice(w, i, length)).alias("h")))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(h, window_words, items): each distinct window once, with the sorted ids of its items as strings.

    An item of fewer words than a window, but not none, is one window.  Items
    without an id have windows, but add nothing to `items`; items that share
    an id count as one.
    """
    w = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    w = w.filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    each = w.select("item", "w", F.explode(_windows(F.col("w"), length)).alias("x"))
    each = each.select("item", F.col("x.h").alias("h"), F.slice("w", F.col("x.at"), F.col("x.len")).alias("window_words"))
    return each.groupBy("h", "window_words").agg(F.collect_set("item").alias("items"))


def _looked_up(each: DataFrame, known: DataFrame, parts: int) -> DataFrame:
    """(id, _same, span, items) of the windows in `each` (id, _same, w, at, len, h) that are in `known`.

    Hashes alone are broadcast, so the words of a document stay where they are
    read; only hits take theirs along.  The items come to the hits by hash, safe
    against windows that very many documents hold.
    """
    known = known.groupBy("_h").agg(F.collect_list(F.struct("window_words", "items")).alias("choices"))
    known = cut_lineage(known)
    found = None
    for part in range(parts):
        hashes = known.select("_h") if parts == 1 else known.filter(F.pmod("_h", F.lit(parts)) == part).select("_h")
        hit = each.join(F.broadcast(hashes), F.col("h") == F.col("_h"), "left_semi")
        hit = hit.select("id", "_same", "at", "len", "h", F.slice("w", "at", "len").alias("words"))
        found = hit if found is None else found.unionByName(hit)
    found = cut_lineage(found)
    counts = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    total = found.agg(F.count(F.lit(1))).first()[0]
    wanted = counts.join(known, F.col("h") == F.col("_h")).select("h", "n", "choices")
    met = spread_join(found, wanted, ["h"], "n", total, ["id", "at"])
    # Windows of one hash are told apart by their words.
    same = F.get(F.filter("choices", lambda c: c["window_words"] == F.col("words")), F.lit(0))
    return met.withColumn("_w", same).filter("_w IS NOT NULL").select("id", "_same", F.struct("at", "len").alias("span"), F.col("_w.items").alias("items"))


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, same, n_words, spans, items) for each row of `docs`.

    same: xxhash64 of the text, which tells rows that share or lack an id apart;
    spans: (at, len) of each verified occurrence, `at` counted from 1, sorted;
    items: sorted ids of the items with an occurring window.  A window is
    looked up by hash and then compared word by word.  Null and empty texts
    have no words.  Rows may repeat or lack an id: each is counted by itself.

    Windows are looked up in a broadcast set in the stage that reads the
    documents, whatever the size of the benchmark: only hits and one row for
    each document go on, and come together by a row key made of the document
    itself.  Documents are read once for every HASHES windows.  Few documents
    come in few partitions, however many the shuffle has: on a local folder
    each file written starts child processes of the executor, and a sample of
    its memory taken then counts it twice.
    """
    known = benchmark_windows(benchmark, window, item_col, item_text_col)
    lengths = sorted(
        {r[0] for r in known.select(F.size("window_words")).distinct().collect()}  # at most `window` numbers
    )
    n_windows = known.groupBy().count().first()[0]
    known = known.withColumnRenamed("h", "_h")
    read = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("_same"), words(F.col(text_col)).alias("w")
    )
    own = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("len"), F.lit(None).cast("long").alias("h")))
    every = F.concat(own, *[_windows(F.col("w"), n) for n in lengths])
    each = read.select("id", "_same", "w", F.explode(every).alias("x"))
    each = each.select("id", "_same", "w", F.col("x.at").alias("at"), F.col("x.len").alias("len"), F.col("x.h").alias("h"))
    if n_windows <= BROADCAST_WINDOWS:
        met = each.join(F.broadcast(known), F.col("h") == F.col("_h"), "left")
        met = met.filter("_h IS NOT NULL OR at = 0").select(
            "id", "_same", F.when(F.col("at") == 0, F.size("w")).alias("n"),
            F.when(F.slice("w", F.greatest("at", F.lit(1)), "len") == F.col("window_words"), F.struct("at", "len")).alias("span"),
            F.when(F.slice("w", F.greatest("at", F.lit(1)), "len") == F.col("window_words"), F.col("items")).alias("items"),
        )
    else:
        hits = _looked_up(each.filter("at > 0"), known, -(-n_windows // HASHES))
        met = read.select(
            "id", "_same", F.size("w").alias("n"), F.lit(None).cast(hits.schema["span"].dataType).alias("span"),
            F.lit(None).cast("array<string>").alias("items"),
        ).unionByName(hits.withColumn("n", F.lit(None).cast("int")))
    found = met.groupBy("id", "_same").agg(
        F.max("n").cast("long").alias("n_words"), F.count("n").alias("_copies"),
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    out = found.select("id", F.col("_same").alias("same"), "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_"))
    return in_few(out.drop("_"), docs.count())


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = s["at"] + s["len"] - 1
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], s["at"] - 1))
        return F.struct((acc["n"] + fresh.cast("long")).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", by_id: bool = True
) -> DataFrame:
    """The rows of `docs` without any benchmark window.

    With `by_id` a window in one row takes all rows that share its id; else a
    row goes only if its own text holds a window.  Rows without an id are
    always judged by their own text.
    """
    hit = scan(docs, benchmark, window, id_col, text_col).filter(F.size("spans") > 0)
    plain, names = plain_names(docs)
    key, own = plain[f"c{names.index(id_col)}"], F.xxhash64(plain[f"c{names.index(text_col)}"])
    same = F.col("same")
    if by_id:
        own, same = F.when(key.isNull(), own), F.when(F.col("id").isNull(), same)
    gone = hit.select(F.col("id").alias("_id"), same.alias("_own")).distinct()
    return plain.join(gone, key.eqNullSafe(gone["_id"]) & own.eqNullSafe(gone["_own"]), "left_anti").toDF(*names)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the words of hit spans taken out of the text; other texts stay as they are.

    A removed word goes with what stands between it and the word before.
    Rows that share or lack an id are told apart by their text: each loses the
    spans of its own.
    """
    hits = scan(docs, benchmark, window, id_col, text_col).filter(F.size("spans") > 0)
    hits = hits.groupBy("id", "same").agg(F.first("spans").alias("spans"))
    plain, names = plain_names(docs)
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    joined = plain.join(hits, plain[key].eqNullSafe(hits["id"]) & (F.xxhash64(plain[text]) == hits["same"]), "left")
    pieces = F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0))

    def kept(_: Column, i: Column) -> Column:
        return ~F.exists("spans", lambda s: (s["at"] <= i + 1) & (i + 1 < s["at"] + s["len"]))

    left = F.array_join(F.filter(pieces, kept), "")
    return joined.withColumn(text, F.when(F.col("spans").isNull(), F.col(text)).otherwise(left)).select(*plain.columns).toDF(*names)


OP7_SQL = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
       FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
lens AS (SELECT DISTINCT n FROM win),
cand AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n),
occ AS (SELECT c.doc_id, c.i, c.n, win.item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM cand) c
        JOIN win ON win.n = c.n AND win.s = c.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
       sha256(array_to_string(list_sort(list_distinct(list(item_id::varchar))), ',')) AS items_sha256 FROM occ GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op7_benchmark_decontamination", OP7_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    found = scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
