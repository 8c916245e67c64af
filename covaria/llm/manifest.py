"""Merkle manifest of a table: a digest for every row, every group and the whole, with a proof for each row.

The place of a leaf in its group is a rank query on a compressed bitmap of the
group's ids, so leaves are never sorted: words of 64 ids merge by bitwise or, a
container keeps the words that are not zero, and directories of row counts above
them give the rows before each container.  Levels of the tree are reduced by
slot arrays keyed by (group, run).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.ranks import sorted_rank
from ..session import cut_lineage
from .common import spread_join, table
from .language import fold
from .registry import query

# Children of a node.
WIDTH = 16
# Ids of a word and words of a container, in bits; a directory has 2**FAN entries at most.
WORD, CONTAINER, FAN = 6, 6, 13
# A row that stands for many equal ones is multiplied in portions of this many.
PORTION = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 in hex of the values in a row: each as `bytes:value`, null as `-`."""
    parts = []
    for value in columns:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def bitmaps(ids: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Containers (groups, `_c`, `_rows`, `_present`, `_words`) from `ids` (groups, `_i`, `_n`).

    `ids` has one row per group and id, with the rows `_n` that the id has.  A
    container covers 4096 ids: `_present` marks its words that are not zero,
    `_words` holds these in order as (bits, rows before it in the container,
    ids with more than one row).  At most 64 words, of 64 ids, meet in one.
    """
    extra = F.when(F.col("_n") > 1, F.expr("struct(CAST(_i & 63 AS INT) AS k, _n - 1 AS more)"))
    words = ids.groupBy(*groups, F.shiftright("_i", WORD).alias("_w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_i & 63 AS INT)))").alias("bits"), F.sum("_n").alias("rows"), F.collect_list(extra).alias("extra")
    )
    entry = F.expr("struct(CAST(_w & 63 AS INT) AS j, bits, rows, extra)")
    held = words.groupBy(*groups, F.shiftright("_w", CONTAINER).alias("_c")).agg(
        F.array_sort(F.collect_list(entry)).alias("w"), F.sum("rows").alias("_rows")
    )
    return held.select(
        *groups, "_c", "_rows",
        F.expr("aggregate(w, 0L, (a, e) -> a | shiftleft(1L, e.j))").alias("_present"),
        F.expr(
            "transform(w, (e, i) -> struct(e.bits, aggregate(slice(w, 1, i), 0L, (a, x) -> a + x.rows) AS before, e.extra))"
        ).alias("_words"),
    )


def directories(held: DataFrame, groups: Sequence[str], start: DataFrame | None = None) -> DataFrame:
    """(groups, `_c`, `_base`): the rows of a group in the containers before each.

    Counts are summed upwards in four levels of at most 2**13 entries each,
    whatever the range of the ids, and the rows before an entry are summed
    downwards again.  `start` (groups, `_start`) counts rows before all others.
    """
    levels, bits = [held.select(*groups, F.col("_c").alias("_k0"), "_rows")], 64 - WORD - CONTAINER
    parents = []
    while bits > 0:
        i = len(levels)
        parents.append(F.shiftright(f"_k{i - 1}", FAN) if bits > FAN else F.lit(0).cast("long"))
        levels.append(levels[-1].groupBy(*groups, parents[-1].alias(f"_k{i}")).agg(F.sum("_rows").alias("_rows")))
        bits -= FAN
    base = levels.pop().select(*groups, f"_k{len(levels)}", F.lit(0).cast("long").alias("_base"))
    if start is not None:
        base = base.join(start, list(groups), "left").select(*groups, f"_k{len(levels)}", F.coalesce("_start", "_base").alias("_base"))
    for i in reversed(range(len(levels))):
        upto = Window.partitionBy(*groups, f"_k{i + 1}").orderBy(f"_k{i}").rowsBetween(Window.unboundedPreceding, -1)
        here = levels[i].withColumn(f"_k{i + 1}", parents[i]).withColumn("_in", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
        base = here.join(base, [*groups, f"_k{i + 1}"]).select(*groups, f"_k{i}", (F.col("_base") + F.col("_in")).alias("_base"))
    return base.withColumnRenamed("_k0", "_c")


def ranks(rows: DataFrame, ids: DataFrame, groups: Sequence[str], start: DataFrame | None = None) -> DataFrame:
    """`rows` with `_before`: how many rows of their group have a smaller id.

    `rows` has the groups and `_i`, a long, none of them null; it may repeat
    ids.  `ids` counts the rows `_n` of each (groups, `_i`).
    """
    held = cut_lineage(bitmaps(ids, groups))
    held = held.join(directories(held, groups, start), [*groups, "_c"])
    asked = rows.withColumn("_c", F.shiftright("_i", WORD + CONTAINER))
    total = held.agg(F.sum("_rows")).first()[0] or 0
    found = spread_join(asked, held, [*groups, "_c"], "_rows", total, ["_i"])

    def below(n: str) -> str:
        # The lowest n bits, n from 0 to 63.
        return f"shiftrightunsigned(9223372036854775807L, 63 - CAST({n} & 63 AS INT))"

    word = f"element_at(_words, 1 + CAST(bit_count(_present & {below(f'shiftright(_i, {WORD})')}) AS INT))"
    found = found.withColumn("_word", F.expr(word))
    inside = f"bit_count(_word.bits & {below('_i')}) + aggregate(_word.extra, 0L, (a, e) -> a + if(e.k < (_i & 63), e.more, 0L))"
    return found.select(*rows.columns, F.expr(f"_base + _word.before + {inside}").alias("_before"))


def _subranks(tied: DataFrame) -> DataFrame:
    """Rows (`g`, `z`, `_i`, `leaf`, `n`, ...) that share their id with others, with `_sub`, the rows of smaller leaves.

    A leaf's first 60 bits serve as its id in the group of the tied rows, so
    these are ranked by bitmaps too; only leaves that agree in all 60 bits meet
    in a window.
    """
    groups = ["g", "z", "_t"]
    coded = tied.withColumnRenamed("_i", "_t").withColumn("_i", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long"))
    ids = coded.groupBy(*groups, "_i").agg(F.sum("n").alias("_n"))
    same = Window.partitionBy(*groups, "_i").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    found = ranks(coded, ids, groups).withColumn("_sub", F.col("_before") + F.coalesce(F.sum("n").over(same), F.lit(0)))
    return found.drop("_i", "_before").withColumnRenamed("_t", "_i")


def placed_leaves(df: DataFrame, id_col: str, group_col: str, leaf: Column, forged: Column | None = None) -> DataFrame:
    """(`g`, `pos`, `digest`, `id`, `forged`): the leaf of each row and its place among those of its group.

    Leaves ascend by id, null first, and by digest where ids are equal; `g` is
    the group as text, coded so that null comes first.  Equal rows are counted
    before they are shuffled, so copies of one row meet as a number.
    """
    group = F.col(group_col).cast("string")
    rows = df.select(
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("g"), group)).alias("g"), F.col(id_col).isNull().alias("z"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("_i"), leaf.alias("leaf"),
        (F.lit(None).cast("string") if forged is None else forged).alias("forged"),
    )
    rows = cut_lineage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")))
    ids = cut_lineage(rows.groupBy("g", "z", "_i").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_d")))
    start = ids.filter("z").select("g", F.col("_n").alias("_start"))
    known = ranks(rows.filter("not z"), ids.filter("not z"), ["g"], start)
    placed = known.unionByName(rows.filter("z").withColumn("_before", F.lit(0).cast("long")))
    shared = ids.filter("_d > 1").select("g", "z", "_i", "_d")
    if not shared.isEmpty():
        placed = placed.withColumnRenamed("_before", "_first")
        placed = cut_lineage(spread_join(placed, shared, ["g", "z", "_i"], "_d", rows.count(), ["leaf"]))
        alone = placed.filter(F.col("_d").isNull()).drop("_d").withColumn("_sub", F.lit(0).cast("long"))
        tied = _subranks(placed.filter(F.col("_d").isNotNull()).drop("_d"))
        placed = alone.unionByName(tied).withColumn("_before", F.col("_first") + F.col("_sub")).drop("_first", "_sub")
    many = placed.select(
        "g", "_before", "n", F.col("leaf").alias("digest"), F.when(~F.col("z"), F.col("_i")).alias("id"), "forged",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PORTION}"))).alias("_p"),
    )
    within = F.sequence(F.col("_p") * PORTION, F.least(F.col("n"), (F.col("_p") + 1) * PORTION) - 1)
    # Portions of one row are dealt out before they are multiplied.
    return many.repartition("g", "_before", "_p").withColumn("_o", F.explode(within)).select(
        "g", (F.col("_before") + F.col("_o")).alias("pos"), "digest", "id", "forged"
    )


def reduce_level(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Runs (`g`, `run`, `kids`, `node`, `done`) from nodes (`g`, `pos`, `digest`, payload).

    `kids` is the slot array of a run, `node` the digest above it.  A node that
    is all of its group is `done`: nothing stands above it.
    """
    slot = F.struct(F.pmod("pos", F.lit(WIDTH)).cast("int").alias("slot"), F.col("digest"), *payload)
    runs = nodes.groupBy("g", F.expr(f"pos div {WIDTH}").alias("run")).agg(F.array_sort(F.collect_list(slot)).alias("kids"))
    done = (F.col("run") == 0) & (F.size("kids") == 1)
    above = F.sha2(F.array_join("kids.digest", "").cast("binary"), 256)
    return runs.select("*", F.when(done, F.col("kids")[0]["digest"]).otherwise(above).alias("node"), done.alias("done"))


def reduce_levels(nodes: DataFrame, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """All levels of runs from the leaves up, each written out, and the roots (`g`, `root`)."""
    levels, roots = [], None
    while True:
        runs = cut_lineage(reduce_level(nodes, payload if not levels else ()))
        levels.append(runs)
        ended = runs.filter("done").select("g", F.col("node").alias("root"))
        roots = ended if roots is None else roots.unionByName(ended)
        open_runs = runs.filter("not done")
        if open_runs.isEmpty():
            return levels, roots
        nodes = open_runs.select("g", F.col("run").alias("pos"), F.col("node").alias("digest"))


def paths(levels: list[DataFrame], starts: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """(`g`, `pos`, `digest`, payload, `path`, rest of `starts`) for every leaf.

    `path` has the digests left and right of the node on every level, from the
    leaf up.  `starts` (`g`, `path`, ...) is where the path of a group's root goes on.
    """
    rest = [c for c in starts.columns if c not in ("g", "path")]
    nodes = None
    for i in reversed(range(len(levels))):
        runs = levels[i]
        above = runs.filter("done").select("g", F.lit(0).cast("long").alias("run")).join(starts, "g")
        if nodes is not None:
            above = above.unionByName(nodes.select("g", F.col("pos").alias("run"), "path", *rest))
        kids = runs.join(above, ["g", "run"]).select("*", F.posexplode("kids").alias("_s", "_kid"))
        left = F.expr("array_join(slice(kids.digest, 1, _s), '')")
        right = F.expr(f"array_join(slice(kids.digest, _s + 2, {WIDTH}), '')")
        step = F.when(F.col("done"), F.col("path")).otherwise(
            F.concat(F.array(F.struct(left.alias("l"), right.alias("r"))), F.col("path"))
        )
        nodes = kids.select(
            "g", (F.col("run") * WIDTH + F.col("_s")).alias("pos"), F.col("_kid.digest").alias("digest"),
            *[F.col(f"_kid.{p}").alias(p) for p in (payload if i == 0 else ())], step.alias("path"), *rest,
        )
    return nodes


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda a, e: F.sha2(F.concat(e["l"], a, e["r"]).cast("binary"), 256))


def manifest(df: DataFrame, id_col: str, group_col: str, leaf: Column, forged: Column | None = None) -> DataFrame:
    """(id, group, pos, leaf, subroot, root, path, forged) of every row of `df`.

    `leaf` is the digest of a row, `forged` (or null) that of an altered one,
    carried along to be tested against the proof.  Ids are integers.  Null ids
    come first in their group and a null group before all others; rows with
    equal ids are ordered by their leaves, and equal rows are leaves of their
    own, side by side.  An empty table has no leaf, so no row is returned.
    """
    levels, subroots = reduce_levels(placed_leaves(df, id_col, group_col, leaf, forged), ["id", "forged"])
    subroots = sorted_rank(subroots.withColumnRenamed("g", "group"), ["group"], "pos")
    top = subroots.select(F.lit("").alias("g"), "pos", F.col("root").alias("digest"), "group")
    top_levels, root = reduce_levels(top, ["group"])
    starts = paths(top_levels, root.select("g", F.array().cast("array<struct<l:string,r:string>>").alias("path"), "root"), ["group"])
    starts = cut_lineage(starts.select(F.col("group").alias("g"), "path", F.col("digest").alias("subroot"), "root"))
    out = paths(levels, starts, ["id", "forged"])
    group = F.when(F.col("g") != "", F.expr("substring(g, 2)"))
    return out.select("id", group.alias("group"), "pos", F.col("digest").alias("leaf"), "subroot", "root", "path", "forged")


def verified(found: DataFrame) -> DataFrame:
    """`manifest` with `proof_sha256`, and `folded_root` recomputed from the forged leaf, or else from the leaf."""
    siblings = F.concat_ws("", F.transform("path", lambda e: F.concat(e["l"], e["r"])))
    out = found.withColumn("proof_sha256", F.sha2(siblings.cast("binary"), 256)).withColumn(
        "folded_root", folded(F.coalesce("forged", "leaf"), F.col("path"))
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(nodes: str, depth: int) -> str:
    """CTEs t1 ... t{depth}: each level of the table `nodes` (g, pos, digest), lone nodes carried on as they are."""
    parts, at = [], nodes
    for i in range(1, depth + 1):
        parts.append(f"""
{nodes}{i} AS (
  SELECT g, pos // {WIDTH} AS pos,
    CASE WHEN any_value(total) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS total FROM {at}) GROUP BY g, pos // {WIDTH})""")
        at = f"{nodes}{i}"
    return ",".join(parts)


def _climb_sql(nodes: str, depth: int, rows: str) -> str:
    """CTEs that take rows (g, at, pos, proof, folded) up the tree `nodes`, collecting siblings."""
    parts, at = [], rows
    for i in range(depth):
        level = nodes if i == 0 else f"{nodes}{i}"
        parts.append(f"""
{rows}_{i} AS (
  SELECT r.* REPLACE (r.pos // {WIDTH} AS pos, r.proof || s.l || s.r AS proof,
    CASE WHEN s.total = 1 THEN r.folded ELSE sha256(s.l || r.folded || s.r) END AS folded)
  FROM {at} r JOIN (
    SELECT g, pos, total,
      coalesce(string_agg(digest, '') OVER (PARTITION BY g, pos // {WIDTH} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(digest, '') OVER (PARTITION BY g, pos // {WIDTH} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM (SELECT *, count(*) OVER (PARTITION BY g) AS total FROM {level})) s ON r.g = s.g AND r.pos = s.pos)""")
        at = f"{rows}_{i}"
    return ",".join(parts)


def _coded_sql(text: str) -> str:
    cells = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in cells)


_CRC = """list_reduce([4294967295]::BIGINT[] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
    lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT),
    lambda c, b: list_reduce([xor(c, b)]::BIGINT[] || range(8), lambda a, i: xor(a >> 1, 3988292384::BIGINT * (a & 1))))"""
# Up to 16**6 leaves a source and 16**3 sources.
OP12_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce('g' || source, '') AS src, sha256({_coded_sql('text')}) AS leaf,
    CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN sha256({_coded_sql(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS forged
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
low AS (SELECT src AS g, pos, leaf AS digest FROM leaves),{_tree_sql("low", 6)},
top AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, digest, g AS src FROM low6),{_tree_sql("top", 3)},
up AS (SELECT src AS g, pos, '' AS proof, coalesce(forged, leaf) AS folded, doc_id, leaf FROM leaves),{_climb_sql("low", 6, "up")},
over AS (
  SELECT '' AS g, t.pos, u.proof, u.folded, u.doc_id, u.leaf, t.digest AS subroot FROM up_5 u JOIN top t ON u.g = t.src
),{_climb_sql("top", 3, "over")}
SELECT o.doc_id, o.leaf, o.subroot, t.digest AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root, o.folded = t.digest AS verified
FROM over_2 o CROSS JOIN top3 t
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    forged = F.when(fold("doc_id", 5) == 0, leaf_digest([*first, lowered]))
    found = verified(manifest(docs, "doc_id", "source", leaf_digest([*first, F.col("text")]), forged))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
