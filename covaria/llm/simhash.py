"""Near duplicates by SimHash: a join on segment popcounts, verified on the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage
from .common import components, pair_tiles, plain_names, spread_join, table, without
from .registry import query

SEED = 42
# Distinct fingerprints of a cell that are compared in one piece.
CELL_SIZE = 50_000
# Words of a long text are taken in portions of this many bytes.
PORTION = 4 << 20
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACES = np.arange(8, dtype=np.uint16) * 256
_LOW = np.uint64(0x5555555555555555)
_HALF = np.uint64(0xFFFFFFFF)


def _portions(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words between ASCII white space, in portions of bounded size."""
    start = 0
    while start < len(text):
        end = start + PORTION
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end].lower().split()
        start = end


def fingerprint(text: bytes | None, size: int = 4) -> int:
    """SimHash over the word shingles of one text, as a signed number of 64 bits."""
    counts, total, kept = np.zeros(2048, np.int64), 0, []
    digest = xxhash.xxh64_digest
    for words in _portions(text or b""):
        words = kept + words
        if len(words) < size:
            kept = words
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        shingles = [digest(line[a:b], SEED) for a, b in zip(begins[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())]
        at = np.frombuffer(b"".join(shingles), np.uint8).reshape(-1, 8) + _PLACES
        counts += np.bincount(at.ravel(), minlength=2048)
        total += len(shingles)
        kept = words[len(words) - size + 1 :]
    if not total:
        if not kept:
            return 0
        at = np.frombuffer(digest(b" ".join(kept), SEED), np.uint8) + _PLACES
        counts += np.bincount(at, minlength=2048)
        total = 1
    ones = np.einsum("ik,kj->ij", counts.reshape(8, 256), _BITS).ravel()
    return int(np.packbits(ones * 2 > total).view(">i8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """(id, fp): one row per row of `docs`.  Null texts have no words; no words give fingerprint 0."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary() if pa.types.is_large_string(b.column(1).type) else pa.binary())
            fps = np.fromiter((fingerprint(t, size) for t in (x.as_py() for x in texts)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["id", "fp"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def cells(fps: np.ndarray, distance: int) -> np.ndarray:
    """Grid cells of each fingerprint, one row each.

    The 64 bits make 32 segments of two bits with popcounts 0 to 2.  Their
    Manhattan distance is at most the Hamming distance.  Of the two halves of
    16 segments one has at most half of the distance; so two points meet in a
    cell if each visits the cells at up to half of that again.
    """
    if not 0 <= distance <= 5:
        raise ValueError("distance must be from 0 to 5")
    fps = fps.view(np.uint64)
    packed = (fps & _LOW) + ((fps >> np.uint64(1)) & _LOW)
    out = []
    for half in (0, 1):
        base = (packed >> np.uint64(32)) if half else (packed & _HALF)
        out.append(base | np.uint64(half << 32))
        if distance < 2:
            continue
        for segment in range(16):
            shift = np.uint64(2 * segment)
            value = (base >> shift) & np.uint64(3)
            up, down = base + (np.uint64(1) << shift), base - (np.uint64(1) << shift)
            tag = np.uint64(half << 32)
            none = np.uint64(1 << 40)
            out.append(np.where(value < 2, up | tag, none))
            out.append(np.where(value > 0, down | tag, none))
    return np.stack(out, axis=1).view(np.int64)


def _star(keys: np.ndarray, fps: np.ndarray, ids: np.ndarray, distance: int) -> tuple[list, list]:
    """Links that connect what is connected within one cell; each visit shrinks the rest."""
    left, right = [], []
    rest = np.arange(len(fps))
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            p = front.pop()
            near = np.bitwise_count(fps[rest] ^ fps[p]) <= distance
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), ids[p]))
                right.append(ids[found])
                front.extend(found.tolist())
                rest = rest[~near]
    return left, right


def linker(distance: int, short: int = 32):
    """For batches sorted by cell: links between fingerprints that differ in up to `distance` bits."""

    def find(keys, fps, ids):
        fps = fps.view(np.uint64)
        begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((begins, [len(keys)])))
        left, right = [], []
        small = np.repeat((sizes > 1) & (sizes <= short), sizes)
        k, f, i = keys[small], fps[small], ids[small]
        for d in range(1, min(short, len(k))):
            same = np.flatnonzero(k[d:] == k[:-d])
            if not len(same):
                break
            near = same[np.bitwise_count(f[same + d] ^ f[same]) <= distance]
            left.append(i[near])
            right.append(i[near + d])
        for at in np.flatnonzero(sizes > short):
            part = slice(begins[at], begins[at] + sizes[at])
            a, b = _star(keys[part], fps[part], ids[part], distance)
            left += a
            right += b
        if not left:
            return None
        a, b = np.concatenate(left), np.concatenate(right)
        if not len(a):
            return None
        pairs = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            now = tuple(c.to_numpy(zero_copy_only=False) for c in b.columns)
            cut = np.searchsorted(now[0], now[0][-1])  # the last cell may go on in the next batch
            if cut == 0 and (not held or held[-1][0][-1] == now[0][0]):
                held.append(now)
                continue
            done = [*held, tuple(c[:cut] for c in now)]
            out = find(*(np.concatenate(c) for c in zip(*done)))
            held = [tuple(c[cut:] for c in now)]
            if out is not None:
                yield out
        if held and (out := find(*(np.concatenate(c) for c in zip(*held)))) is not None:
            yield out

    return run


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): links between the ids of distinct fingerprints (`fps`: fp, id) that keep components whole.

    All linked pairs of a cell with up to 32 fingerprints are given; of a
    larger cell only as many as connect it, so a group of near copies gives
    few rows.  A cell with more than CELL_SIZE distinct fingerprints is cut
    into tiles in which all its pairs meet; a task holds one tile at a time.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, i = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for at in range(0, len(fp), 4096):
                c = cells(fp[at : at + 4096], distance)
                real = c != (1 << 40)
                n = real.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[real]), pa.array(np.repeat(fp[at : at + 4096], n)), pa.array(np.repeat(i[at : at + 4096], n))],
                    ["cell", "fp", "id"],
                )

    visited = fps.select("fp", "id").mapInArrow(visit, "cell long, fp long, id long")
    tiled = pair_tiles(visited, "cell", "fp", CELL_SIZE).select("tile", "fp", "id")
    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(linker(distance), "a long, b long")


def groups(
    docs: DataFrame, distance: int = 4, size: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp, component) for each row: component is the smallest id reachable over linked fingerprints.

    Rows with equal fingerprints are one node, so copies never make pairs.
    Ids are integers.  Rows without an id keep a null component and link
    nothing; rows that share an id are meant to be one document.
    Null or empty texts have fingerprint 0 and link like any other.
    An empty table gives an empty result.
    """
    seen = cut_lineage(with_fingerprints(docs, id_col, text_col, size))
    nodes = cut_lineage(
        seen.filter(F.col("id").isNotNull()).groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), seen.count()
    )
    total = nodes.agg(F.sum("n")).first()[0] or 0
    stars = components(links(nodes.select("fp", F.col("first").cast("long").alias("id")), distance).distinct())
    rooted = nodes.join(stars, nodes["first"] == stars["node"], "left").select(
        "fp", "n", F.coalesce("root", "first").alias("component")
    )
    out = spread_join(seen, rooted, ["fp"], "n", total, ["id"])
    return out.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def keep_one(
    docs: DataFrame, distance: int = 4, size: int = 4, id_col: str = "doc_id", text_col: str = "text", by_row: bool = False
) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its group; rows without an id stay.

    With `by_row` one row of each group stays, whatever the ids: that of the
    smallest id, those without one last, and of rows that share an id that of
    the smallest hash of the text.  Ids may be of any ordered type there.
    """
    if by_row:
        return _one_row(docs, distance, size, id_col, text_col)
    gone = groups(docs, distance, size, id_col, text_col).filter("id != component").select("id")
    return without(docs, gone, id_col)


def _one_row(docs: DataFrame, distance: int, size: int, id_col: str, text_col: str) -> DataFrame:
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("same"))
    seen = with_fingerprints(docs.select(key.alias("id"), F.col(text_col).alias("text")), "id", "text", size)
    # Equal rows, and rows with one fingerprint, are counted before they are shuffled.
    seen = cut_lineage(seen.groupBy("id", "fp").agg(F.count(F.lit(1)).alias("n")))
    each = seen.count()
    nodes = cut_lineage(seen.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m")), each)
    # The fingerprint itself is the node, so ids need not be numbers or unique.
    stars = components(links(nodes.select("fp", F.col("fp").alias("id")), distance).distinct())
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select("fp", "m", "first", F.coalesce("root", "fp").alias("root"))
    rooted = cut_lineage(rooted, each)
    keepers = rooted.groupBy("root").agg(F.min("first").alias("keeper"), F.count(F.lit(1)).alias("k"))
    by_fp = spread_join(rooted, keepers, ["root"], "k", rooted.count(), ["fp"]).select("fp", "m", "keeper")
    total = nodes.agg(F.sum("m")).first()[0] or 0
    met = spread_join(seen, by_fp, ["fp"], "m", total, ["id"])
    # Rows to drop, and keepers that stand there more than once.
    gone = F.col("id") != F.col("keeper")
    marks = cut_lineage(met.filter(gone | (F.col("n") > 1)).select("id.none", F.col("id.id").alias("_id"), F.col("id.same").alias("_same"), gone.alias("_drop")), each)
    plain, names = plain_names(docs)
    own, text = plain[f"c{names.index(id_col)}"], plain[f"c{names.index(text_col)}"]

    def same(side: DataFrame) -> Column:
        return own.eqNullSafe(side["_id"]) & (F.xxhash64(text) == side["_same"])

    kept = plain.join(marks, same(marks), "left_anti")
    many = marks.filter(~F.col("_drop")).select("_id", "_same")
    if not many.isEmpty():
        # Merged before the shuffle, so equal rows never meet as rows.
        kept = kept.unionByName(plain.join(many, same(many)).dropDuplicates(["_id", "_same"]).select(*plain.columns))
    return kept.toDF(*names)


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    found = groups(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )
