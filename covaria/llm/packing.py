"""Best-fit packing of token sequences into bins of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .common import table
from .registry import query
from .token_cache import encoded, public_tokenizer

LENGTHS = (512, 1024, 2048, 4096)
# Cost of a bin: its length and this many tokens for handling it.
BIN_COST = 32
# Pieces that are packed together, on average.
SHARD = 8192
PACKED = "id {id}, piece int, start_token long, n_tokens int, bin_id long, bin_length int, bin_offset int"


def mixes(lengths: Sequence[int], largest: int) -> list[list[int]]:
    """The sets of lengths that are tried: all, all but one, and each by itself, if they can hold the largest size."""
    lengths = sorted(set(lengths))
    tried = [lengths] + [[c for c in lengths if c != gone] for gone in lengths] + [[c] for c in lengths]
    out: list[list[int]] = []
    for mix in tried:
        if mix and mix[-1] >= largest and mix not in out:
            out.append(mix)
    return out


def _fill(ascending: Sequence[int], end: int, room: int) -> int:
    """What the sizes before `end` can put into a room, the largest that fits first."""
    used = 0
    while end and ascending[0] <= room - used:
        end = bisect_right(ascending, room - used, 0, end) - 1
        used += ascending[end]
    return used


def _packed(ascending: Sequence[int], mix: Sequence[int], lengths: Sequence[int], bin_cost: int) -> tuple[int, list[tuple[int, int]], list[int], list[int]]:
    """(cost, (bin, offset) of each size, opened lengths, final lengths) for sizes in ascending order and bins of `mix`."""
    rooms: list[int] = []  # rooms of open bins, sorted, each once
    bins_with: dict[int, list[int]] = {}
    filled: list[int] = []
    opened: list[int] = []
    placed = [(0, 0)] * len(ascending)
    for i in range(len(ascending) - 1, -1, -1):
        size = ascending[i]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = bins_with[room].pop()
            if not bins_with[room]:
                del bins_with[room]
                rooms.pop(at)
        else:
            best = None
            for c in mix[bisect_left(mix, size) :]:
                used = size + _fill(ascending, i, c - size)
                cost = (lengths[bisect_left(lengths, used)] + bin_cost) / used
                if best is None or cost < best[0]:
                    best = (cost, c)
            room = best[1]
            b = len(filled)
            filled.append(0)
            opened.append(room)
        placed[i] = (b, filled[b])
        filled[b] += size
        left = room - size
        if left:
            if left not in bins_with:
                insort(rooms, left)
                bins_with[left] = []
            bins_with[left].append(b)
    final = [lengths[bisect_left(lengths, n)] for n in filled]
    return sum(final) + bin_cost * len(final), placed, opened, final


def joint_fit(
    sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, bin_cost: int = BIN_COST
) -> tuple[list[tuple[int, int, int]], list[int]]:
    """((bin, length, offset) for each size, the length that each bin was opened with).  Sizes are between 1 and the largest length.

    Decreasing best fit: each size goes where it leaves the least room.  Where
    none has room, a bin opens with the length whose cost is least for each
    token that the sizes still to come can put in; of equals the shorter.  In
    the end each bin shrinks to the shortest length that holds its contents.
    All this is done for a few sets of permitted lengths (`mixes`), and the set
    with the least total cost is kept, of equals the first, so the result is
    never dearer than with one length.
    """
    lengths = sorted(set(lengths))
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i], -i))
    ascending = [sizes[i] for i in order]
    if not ascending:
        return [], []
    tried = (_packed(ascending, mix, lengths, bin_cost) for mix in mixes(lengths, ascending[-1]))
    _, placed, opened, final = min(tried, key=lambda t: t[0])
    out = [(0, 0, 0)] * len(ascending)
    for i, (b, offset) in zip(order, placed):
        out[i] = (b, final[b], offset)
    return out, opened


def best_fit(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, bin_cost: int = BIN_COST) -> list[tuple[int, int, int]]:
    """(bin, length, offset) for each size, by `joint_fit`."""
    return joint_fit(sizes, lengths, bin_cost)[0]


def pack(
    sized: DataFrame, lengths: Sequence[int] = LENGTHS, bin_cost: int = BIN_COST, shard: int = SHARD, id_col: str = "id",
    size_col: str = "n_tokens",
) -> DataFrame:
    """Pack sequences: one row per piece with its bin, the bin's length and the offset in it.

    Sequences longer than the largest length are cut into pieces of that
    length and a rest.  Null and zero sizes make one piece without a bin.
    Pieces are dealt by a hash of (id, piece) over shards of about `shard`
    pieces, and each shard is packed by itself, so tasks have one size at any
    scale and repeated runs agree.  Repeated rows are packed each.
    """
    top = max(lengths)
    kind = sized.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(size / top), F.lit(1)) - 1)
    pieces = sized.select(F.col(id_col).alias("id"), size.alias("_size"), F.explode(cuts).alias("_piece")).select(
        "id", F.col("_piece").cast("int").alias("piece"), (F.col("_piece") * top).alias("start_token"),
        F.least(F.lit(top), F.col("_size") - F.col("_piece") * top).cast("int").alias("n_tokens"),
    )
    shards = max(1, -(-pieces.count() // shard))
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("id", "piece", "n_tokens"), F.lit(shards)).cast("long"))
    schema = PACKED.format(id=kind)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "piece", "n_tokens"], kind="stable")
        full = rows["n_tokens"].to_numpy() > 0
        out = best_fit(rows["n_tokens"].to_numpy()[full].tolist(), lengths, bin_cost)
        for k, name in enumerate(("bin_id", "bin_length", "bin_offset")):
            values = pd.array([pd.NA] * len(rows), dtype="Int64")
            values[full] = [x[k] + (key[0] << 32 if k == 0 else 0) for x in out]
            rows[name] = values
        return rows[["id", "piece", "start_token", "n_tokens", "bin_id", "bin_length", "bin_offset"]]

    return dealt.groupBy("_shard").applyInPandas(run, schema)


def token_sizes(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every whole text."""
    return encoded(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), path or public_tokenizer())


def pack_documents(docs: DataFrame) -> DataFrame:
    """Whole documents by the tokens of their texts."""
    sized = cut_lineage(token_sizes(docs))  # counted for the shards, then packed
    return pack(sized).withColumnRenamed("id", "doc_id")


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"))
