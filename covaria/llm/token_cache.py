"""Token counts behind a cache of content digests: only texts that no stored count covers are encoded."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage, shared_folder
from .common import spread_join, table
from .registry import query

# Pieces whose count a worker remembers, and the longest piece that it remembers.
REMEMBERED = 600_000
PIECE = 64
LIMIT = 2048
CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Byte-level models write bytes as characters: printable ones as they are, the others from 256 on.
_KEPT = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARACTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _KEPT)}


def splits_at_blanks(tokenizer) -> bool:
    """Whether the tokenizer works on lower-cased words, each by itself: the steps that `counter` relies on."""
    made = json.loads(tokenizer.to_str())
    steps = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
    cuts = [x["type"] for x in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
    return made["model"]["type"] == "BPE" and steps == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"]


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[str], int]:
    """Counts tokens as the library does.

    A tokenizer that turns white space into blanks, never joins across them
    and drops them has for a text the sum over its pieces between blanks; the
    counts of short pieces are remembered.  Such a tokenizer ignores case, and
    a full stop or comma after a letter is a token of its own, so pieces of
    Latin-1 characters are looked up without them.  A plain word goes to the
    library's model at once.  Other tokenizers get whole texts.
    """
    # One text is short work: threads of the library's own would only wait for each other.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if not splits_at_blanks(tokenizer):
        return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)
    model = tokenizer.model
    known: dict[str, int] = {}  # by piece as it stands
    roots: dict[str, int] = {}  # by piece in lower case without its stop

    def encode(pieces: list[str]) -> list[int]:
        return [len(code) for code in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def count(text: str | None) -> int:
        pieces = (text or "").replace("\n", " ").split(" ")
        plain: dict[str, tuple[str, bool]] = {}
        other = []
        for p in {p for p in pieces if p not in known}:
            if p > "" and max(p) < "\u0100" and "<|" not in p:  # special strings keep their case
                root = p.lower()
                stop = root[-1] in ".," and root[-2:-1].isalpha()
                if stop:
                    root = root[:-1]
                if root not in roots:
                    if root.isalpha():
                        seen = root if root.isascii() else root.encode().decode("latin-1").translate(BYTE_CHARACTERS)
                        roots[root] = len(model.tokenize(seen))
                    else:
                        other.append(root)
            else:
                root, stop = p, False
                if root not in roots:
                    other.append(root)
            plain[p] = (root, stop)
        for start in range(0, len(other), 4096):
            part = other[start : start + 4096]
            roots.update(zip(part, encode(part)))
        passing = {}
        for p, (root, stop) in plain.items():
            (known if len(p) <= PIECE else passing)[p] = roots[root] + stop
        if passing:
            total = sum(known[p] if p in known else passing[p] for p in pieces)
            for p in passing:
                roots.pop(plain[p][0], None)
        else:
            total = sum(map(known.__getitem__, pieces))
        for kept in (known, roots):
            if len(kept) > REMEMBERED:
                kept.clear()
        return total

    return count


def version(path: str) -> str:
    """Digest of the tokenizer file and the library's version: other counts are never taken for these."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0" + tokenizers.__version__.encode()).hexdigest()


@lru_cache(maxsize=4)
def ignores_runs(path: str) -> bool:
    """Whether the tokenizer of a file takes any run of ASCII white space for one blank."""
    from tokenizers import Tokenizer

    return splits_at_blanks(Tokenizer.from_file(path))


def content_digest(text: Column, joined: bool = True) -> Column:
    """Digest of what the tokenizer can tell apart; null as empty.

    `joined`: runs of ASCII white space count as one blank, for tokenizers
    that take them so; others get the digest of the text as it is.
    """
    text = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ") if joined else text, 256))


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """`texts` (any columns, the last `text`) with `n_tokens` in place of the text."""
    kept = texts.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            n = pa.array([count(t.as_py()) for t in b.column(len(kept))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], [*kept, "n_tokens"])

    schema = T.StructType([*[texts.schema[c] for c in kept], T.StructField("n_tokens", T.LongType())])
    return texts.mapInArrow(run, schema)


def stored_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """One row per digest from the cache folder; an absent folder is an empty cache."""
    try:
        found = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], CACHE_SCHEMA)
    return found.filter(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, cache: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens), one row per row of `docs`.

    Digests without a stored count are encoded once each and appended to the
    folder `cache`, which outlives the session if the caller keeps it; a run
    that is repeated after a failure may append a digest again, which readers
    merge.  Null texts count as empty: 0 bytes, 0 tokens.  Null or repeated ids
    are allowed.  Texts of any length are encoded whole.
    """
    spark = docs.sparkSession
    path = path or public_tokenizer()
    tokenizer = version(path)
    joined = ignores_runs(path)
    text = F.col(text_col)
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("id"), content_digest(text, joined).alias("digest"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    ))
    wanted = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    misses = wanted.join(stored_counts(spark, cache, tokenizer), "digest", "left_anti")
    # One row of each missing digest carries its text.
    carriers = misses.select(F.col("digest").alias("_digest"), F.col("first").alias("_first"))
    texts = docs.select(content_digest(text, joined).alias("digest"), F.col(id_col).alias("_id"), text.alias("text"))
    texts = texts.join(
        carriers, (F.col("digest") == F.col("_digest")) & F.col("_id").eqNullSafe(F.col("_first")), "left_semi"
    ).select("digest", "text")
    encoded(texts, path).select("digest", F.lit(tokenizer).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = wanted.join(stored_counts(spark, cache, tokenizer), "digest").select("digest", "n", "n_tokens")
    total = rows.agg(F.count(F.lit(1))).first()[0]
    return spread_join(rows, counts, ["digest"], "n", total, ["id", "n_bytes"]).select("id", "n_bytes", "n_tokens")


@query("op3_token_counts")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    cache = f"{shared_folder(spark)}/token_counts"
    return count_tokens(table(spark, sf, "documents"), cache).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )
