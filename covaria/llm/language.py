"""Language identification: sparse multinomial logistic regression on hashed TF-IDF character n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import table
from .registry import query

ORDERS = 3
BUCKETS = 1 << 15
# The classifier is fitted on at most this many rows, those with the smallest hash of the id.
MAX_TRAIN = 3000
# Characters are counted in portions, so a long text needs bounded memory.
PORTION = 1 << 20
UNDETERMINED = "und"
# Scale of the term frequencies, which sum to this.
TF_SCALE = 64.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _true_letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, bool]:
    """Counts of hashed n-grams of one to three characters, and whether the text has a letter.

    Upper case counts as lower case, runs of other characters as blanks.
    N-grams across the border of two portions of a long text are counted too.
    """
    counts = np.zeros(BUCKETS, np.int64)
    any_letter = False
    text = text or ""
    for start in range(0, len(text), PORTION):
        # A lower-cased portion with the two characters before it.
        before = max(0, start - (ORDERS - 1))
        codes = np.frombuffer(text[before : start + PORTION].lower().encode("utf-32-le", "replace"), np.uint32)
        any_letter = any_letter or bool(_true_letters()[codes].any())
        codes = np.where(_letters()[codes], codes, np.uint32(32))
        skip = start - before
        h = np.zeros(len(codes), np.uint32)
        for order in range(1, ORDERS + 1):
            # h covers the n-gram that starts here and has `order` characters.
            n = len(codes) - order + 1
            if n <= 0:
                break
            h = (h[:n] ^ codes[order - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            new = max(0, skip - order + 1)
            counts += np.bincount((h[new:] >> np.uint32(17)).astype(np.intp), minlength=BUCKETS)
    return counts, any_letter


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each n-gram bucket, over all rows of `texts` (text), and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                df += ngram_counts(t.as_py())[0] > 0
                rows += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], rows))], ["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()  # at most BUCKETS + 1
    df, rows = np.zeros(BUCKETS), 0
    for bucket, n in sums:
        if bucket < 0:
            rows = n
        else:
            df[bucket] = n
    return df, rows


@dataclass
class LanguageModel:
    classes: list[str]
    weights: np.ndarray  # buckets x classes, IDF included
    bias: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        x = counts.astype(np.float32) * np.float32(TF_SCALE / total) if total else counts.astype(np.float32)
        z = (x @ self.weights + self.bias).astype(float) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.05,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader with L1 and L2 penalties; the bias has none."""
    z, n = np.zeros((BUCKETS, n_classes)), np.zeros((BUCKETS, n_classes))
    zb, nb = np.zeros(n_classes), np.zeros(n_classes)

    def solve(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for at, values, y in rows:
            w, b = solve(z[at], n[at], l1, l2), solve(zb, nb, 0.0, 0.0)
            s = values @ w + b
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = values[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
            sigma = (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha
            zb += p - sigma * b
            nb += p * p
    return solve(z, n, l1, l2), solve(zb, nb, 0.0, 0.0)


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, on a logarithmic grid from 1/20 to 20."""

    def loss(t: float) -> float:
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

    return min(np.exp(np.linspace(-3, 3, 121)).tolist(), key=loss) if len(y) else 1.0


def train(rows: DataFrame, max_train: int = MAX_TRAIN) -> LanguageModel | None:
    """Fit on `rows` (id, text, lang), lang and text not null.  None if there is no such row.

    The inverse document frequencies count every row.  Weights and temperature
    are fitted on the driver, from n-gram counts of at most `max_train` rows;
    every fifth of these is kept for the temperature.
    """
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    df, total = document_frequencies(rows.select("text"))
    if not total:
        return None
    idf = (np.log((1.0 + total) / (1.0 + df)) + 1.0).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (lang, text) in enumerate(zip(b.column(0), b.column(1))):
                counts, _ = ngram_counts(text.as_py())
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[k : k + 1], pa.array([at.astype(np.int32).tobytes()]), pa.array([counts[at].astype(np.int32).tobytes()]), b.column(2)[k : k + 1]],
                    ["lang", "at", "counts", "h"],
                )

    hashed = rows.select("id", F.xxhash64("id").alias("h"))
    chosen = hashed.orderBy("h", "id").limit(max_train)
    ids = F.broadcast(chosen.select(F.col("id").alias("_id"), F.col("h").alias("h")).distinct())  # at most max_train rows
    sample = rows.join(ids, F.col("id").eqNullSafe(F.col("_id"))).select("lang", "text", "h")
    seen = sample.mapInArrow(run, "lang string, at binary, counts binary, h long").orderBy("h", "lang", "at").limit(max_train).collect()
    classes = sorted({r["lang"] for r in seen})
    data = []
    for r in seen:
        at, counts = np.frombuffer(r["at"], np.int32), np.frombuffer(r["counts"], np.int32)
        if len(at):
            data.append((at, counts * (TF_SCALE / counts.sum()) * idf[at], classes.index(r["lang"])))
    held = data[::5] if len(data) >= 50 else data
    fitted = [d for k, d in enumerate(data) if k % 5] if len(data) >= 50 else data
    w, b = ftrl(fitted, len(classes))
    logits = np.array([v @ w[at] + b for at, v, _ in held]).reshape(-1, len(classes))
    t = best_temperature(logits, np.array([y for _, _, y in held], int))
    return LanguageModel(classes, (w * idf[:, None]).astype(np.float32), b.astype(np.float32), t)


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row: score is the calibrated probability of the predicted language.

    Null texts and texts without a letter are `und` with score 0, and so is
    every text if there was nothing to learn from.  Whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            langs, scores = [], []
            for t in b.column(1):
                counts, letter = ngram_counts(t.as_py())
                if m is None or not letter:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = m.probabilities(counts)
                langs.append(m.classes[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


@query("op8_language_id")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = train(docs.filter(fold("doc_id", 4) != 2).select(F.col("doc_id").alias("id"), "text", "lang"))
    found = predict(docs, model)
    return found.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
