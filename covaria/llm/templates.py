"""Line deduplication with a log-template tree: lines of recurring templates are dropped from all documents but the first."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage
from .common import plain_names, spread_join, table
from .registry import query

# Lines under MIN_WORDS words are left alone, or with `short` filed by their exact words; under FIELD_WORDS only masked fields may differ.
MIN_WORDS = 5
FIELD_WORDS = 8
# Leading words that are constant in a template, and the parts of the rest of which one may vary.
LEAD = 2
PARTS = 4
MIN_DOCS = 2
# A leaf is a template if at least one in CONSTANT of all words of the line are constant in it.
CONSTANT = 2
# A word or, in scripts that set no blanks between words, two characters.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
HAS_UNSPACED = regex.compile(f"[{UNSPACED}]")
SHORT_WORD = regex.compile(rf"(?:[{UNSPACED}]\p{{M}}*+){{1,2}}|[^\s{UNSPACED}]+")
VARIABLE = regex.compile(r"\d|@|://")
FIELD = "<*>"


def template_keys(
    line: str, min_words: int = MIN_WORDS, field_words: int = FIELD_WORDS, lead: int = LEAD, parts: int = PARTS, short: bool = False
) -> list[bytes]:
    """Leaves of the tree in which a line is filed.

    The path is the number of words, then the leading words, then the other
    words.  Words with digits, mail addresses and links are fields in every
    leaf.  In a line of `field_words` or more the words after the leading ones
    make `parts` runs of equal length, and each leaf makes a field of one run:
    lines that differ in one run of words meet there.  A leaf needs half of
    the line's words as constants; a line without such a leaf, like a row of
    numbers, is filed by its exact words.

    With `short`, lines under `min_words` words are filed by their exact words
    too, and two characters of a script without blanks count as a word.
    """
    words = SHORT_WORD.findall(line) if short and not line.isascii() and HAS_UNSPACED.search(line) else line.split()
    n = len(words)
    if n < min_words:
        return [exact_key(words)] if short and n else []
    exact = words
    fields = [False] * n
    if VARIABLE.search(line):
        fields = [bool(VARIABLE.search(w)) for w in words]
        words = [FIELD if f else w for w, f in zip(words, fields)]
    constant = n - sum(fields)
    if n < field_words:
        if CONSTANT * constant >= n:
            return [xxhash.xxh3_128_digest(f"{n} {' '.join(words)}")]
        return [exact_key(exact)]
    cuts = [lead + (n - lead) * k // parts for k in range(parts + 1)]
    keys = [
        xxhash.xxh3_128_digest(f"{n} {k} {' '.join(words[: cuts[k]])}\0{' '.join(words[cuts[k + 1]:])}") for k in range(parts)
        if CONSTANT * (constant - (cuts[k + 1] - cuts[k]) + sum(fields[cuts[k] : cuts[k + 1]])) >= n
    ]
    return keys or [exact_key(exact)]


def exact_key(words: list[str]) -> bytes:
    """The leaf of lines with exactly these words."""
    return xxhash.xxh3_128_digest(f"exact {' '.join(words)}")


def filed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **tree: int) -> DataFrame:
    """(id, same, line, key, again): the leaves of every line, `line` counted from 0.

    `same` is a hash of the text, which tells rows that share or lack an id
    apart; `again` marks a leaf that a line before it in the document has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, lines, keys, again = [], [], [], []

            def out():
                at = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(lines, pa.int32()), pa.array(keys, pa.binary()), pa.array(again, pa.bool_())],
                    ["id", "same", "line", "key", "again"],
                )

            for r, text in enumerate(b.column(2)):
                seen: set[bytes] = set()
                for i, line in enumerate((text.as_py() or "").split("\n")):
                    for key in template_keys(line, **tree):
                        rows.append(r)
                        lines.append(i)
                        keys.append(key)
                        again.append(key in seen)
                        seen.add(key)
                if len(rows) > 100_000:
                    yield out()
                    rows, lines, keys, again = [], [], [], []
            if rows:
                yield out()

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("same", T.LongType()), T.StructField("line", T.IntegerType()),
        T.StructField("key", T.BinaryType()), T.StructField("again", T.BooleanType()),
    ])
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("same"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def dropped_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", by_row: bool = False, **tree: int
) -> DataFrame:
    """(id, same, lines): numbers of the lines to drop, one row per document that loses any.

    A leaf recurs if at least `min_docs` documents have a line in it.  The
    document with the smallest id keeps its lines there, so one copy of every
    passage stays.  Documents without an id count but lose nothing, and those
    that share the smallest id all keep their lines.  With `by_row` rows that
    share or lack an id are told apart by their text: one text keeps the
    lines, that of the smallest id, those without an id last.
    """
    filed = cut_lineage(filed_lines(docs, id_col, text_col, **tree))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("same").alias("same")) if by_row else F.col("id")
    leaves = filed.groupBy("key").agg(
        F.sum(F.when(F.col("again"), 0).otherwise(1)).alias("docs"), F.min(order).alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    leaves = cut_lineage(leaves.filter(F.col("docs") >= min_docs).select("key", "keeper", "n"), filed.count())
    total = leaves.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    asked = filed if by_row else filed.filter(F.col("id").isNotNull())
    met = spread_join(asked.select("id", "same", "line", "key"), leaves, ["key"], "n", total, ["id", "same", "line"])
    return met.filter(F.col("keeper") < order).groupBy("id", "same").agg(F.collect_set("line").alias("lines"))


def without_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` under the names c0, c1, ... with a text that has lost its lines, `n_lines` and `n_dropped`; and the real names."""
    plain, names = plain_names(docs)
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    gone = dropped.select(F.col("id").alias("_id"), F.col("same").alias("_same"), F.col("lines").alias("_gone"))
    joined = plain.join(gone, plain[key].eqNullSafe(gone["_id"]) & (F.xxhash64(plain[text]) == gone["_same"]), "left")
    lines = F.split(F.col(text), "\n", -1)
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("_gone", i)), "\n")
    return joined.select(
        *[F.when(F.col("_gone").isNull(), F.col(c)).otherwise(left).alias(c) if c == text else c for c in plain.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_dropped"),
    ), names


def drop_templates(
    docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", by_row: bool = False, **tree: int
) -> DataFrame:
    """`docs`, its columns and rows as they are, without the lines of recurring templates in the text.

    A document may lose all its lines and then has an empty text.  Null texts
    stay null.  Lines repeated within one document only are kept.  A row loses
    lines of its own text only; rows with equal id and text share what they
    lose.  `by_row` is that of `dropped_lines`; `short=True` covers lines under
    `min_words` words and scripts without blanks.
    """
    kept, names = without_lines(docs, dropped_lines(docs, min_docs, id_col, text_col, by_row, **tree), id_col, text_col)
    return kept.drop("n_lines", "n_dropped").toDF(*names)


OP10_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
w AS (SELECT doc_id, line_no, list_filter(string_split_regex(line, '\s+'), lambda x: x <> '') AS ws FROM l),
m AS (SELECT doc_id, line_no, len(ws) AS n, list_transform(ws, lambda x: CASE WHEN regexp_matches(x, '[0-9]|@|://') THEN '{FIELD}' ELSE x END) AS ws
  FROM w WHERE len(ws) >= {MIN_WORDS}),
k AS (SELECT doc_id, line_no, n || ' ' || array_to_string(ws, ' ') AS key FROM m WHERE n < {FIELD_WORDS} UNION ALL
  SELECT doc_id, line_no, n || ' ' || p || ' ' || array_to_string(ws[1:{LEAD} + (n - {LEAD}) * p // {PARTS}], ' ') || chr(9) ||
    array_to_string(ws[{LEAD} + (n - {LEAD}) * (p + 1) // {PARTS} + 1:], ' ') FROM m, range({PARTS}) r(p) WHERE n >= {FIELD_WORDS}),
g AS (SELECT key, min(doc_id) AS keeper FROM k GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
gone AS (SELECT DISTINCT doc_id, line_no FROM k JOIN g USING (key) WHERE keeper < doc_id),
c AS (SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.line_no) FILTER (gone.doc_id IS NULL), '') AS text, count(*) AS n_lines,
    count(gone.doc_id) AS n_dropped
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.line_no = l.line_no GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(c.text, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines,
  coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN c USING (doc_id)
"""


@query("op10_line_templates", OP10_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """Each document with its remaining text, its number of lines, and how many of them were dropped."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept, names = without_lines(docs, dropped_lines(docs))
    return kept.toDF(*names, "n_lines", "n_dropped")
