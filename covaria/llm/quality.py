"""Quality scores: how much shorter a text gets with a zstandard dictionary of good text than with one of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import plain_names, table
from .language import fold
from .registry import query

# Bounds of what is fitted on: labelled ids, dictionary lines and calibration rows, each by label.
MAX_IDS = 10_000
MAX_UNITS = 16_000
MAX_CALIBRATION = 4_000
# Texts are compressed in blocks of this many bytes, so a long text leans on the dictionary throughout, not on itself.
BLOCK = 512
DICTIONARY = 112_640
LEVEL = 3
THRESHOLD = 0.7


def units(raw: bytes) -> list[bytes]:
    """Lines of a text, long ones in parts of BLOCK bytes: what dictionaries are built from."""
    return [line[i : i + BLOCK] for line in raw.split(b"\n") for i in range(0, len(line), BLOCK)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of at most DICTIONARY bytes; too few samples for training are taken as they are."""
    size = min(DICTIONARY, max(256, sum(map(len, samples)) // 4))
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY:]


def compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in dictionaries:
        made = zstandard.ZstdCompressionDict(raw)
        made.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False
        ))
    return out


def sizes(raw: bytes, pair: list[zstandard.ZstdCompressor]) -> tuple[int, int, int]:
    """Bytes of a whole text with the dictionary of bad text, with that of good text, and without compression."""
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    return (*(sum(len(c.compress(b)) for b in blocks) for c in pair), len(raw))


def inputs(found: np.ndarray) -> np.ndarray:
    """What the calibration sees, from rows (bad, good, plain).

    The difference of the two sizes over their sum; their mean over the plain
    size, since junk that repeats itself is short under either dictionary; the
    log of the plain size, since short texts differ by chance; and the products
    of these.  Empty texts give zeros.
    """
    bad, good, plain = found.astype(float).reshape(-1, 3).T
    x = np.stack([(bad - good) / np.maximum(1, bad + good), (bad + good) / np.maximum(1, 2 * plain), np.log1p(plain)])
    return np.stack([*x, *(x[i] * x[j] for i in range(3) for j in range(i, 3))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the first weight is the constant and is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = weight / weight.sum()
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 0.0
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (weight * (p - y)) + shrink * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9)
        step = np.linalg.solve(curve, slope)
        # Far steps are cut, so separable labels cannot throw the weights away.
        w -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class QualityModel:
    """Share of label 1, dictionaries of bad and good text, and the calibration on inputs of mean `mean` and deviation `scale`."""

    base: float
    dictionaries: tuple[bytes, bytes] | None = None
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None

    def probability(self, found: np.ndarray) -> np.ndarray:
        x = (inputs(found) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -35, 35)))


def _measured(rows: DataFrame, dictionaries: tuple[bytes, bytes]) -> DataFrame:
    """`rows` (any columns, the last the text in bytes) with `sizes` in place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(dictionaries)
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = compressors(shared.value)
        for b in batches:
            found = [sizes(t.as_py() or b"", pair) for t in b.column(len(kept))]
            made = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], [*kept, "sizes"])

    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("sizes", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(run, schema)


def _lines(rows: DataFrame) -> DataFrame:
    """(label, unit) from rows (label, text in bytes), repeats within a batch left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = set()
            for label, text in zip(b.column(0).to_pylist(), b.column(1)):
                seen.update((label, u) for u in units(text.as_py() or b""))
            labels, found = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, pa.binary())], ["label", "unit"])

    return rows.mapInArrow(run, "label int, unit binary")


def learn_dictionaries(rows: DataFrame, max_units: int = MAX_UNITS) -> dict[int, bytes]:
    """A dictionary for each label of `rows` (label, text in bytes).

    Lines of texts of both labels tell nothing and are left out; of the others
    at most `max_units` different ones, those of the smallest hash, are used:
    at most max_units * BLOCK bytes meet in the one task of a label.
    """
    one = F.min("label").alias("label"), (F.min("label") != F.max("label")).alias("mixed")
    only = _lines(rows).groupBy("unit").agg(*one).filter(~F.col("mixed")).withColumn("h", F.xxhash64("unit"))

    def train(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "dictionary": [build_dictionary(list(group.sort_values(["h", "unit"])["unit"]))]})

    # A ranking of parts before the ranking of a label: no task holds more than the parts' shares.
    part = F.pmod("h", F.lit(64))
    first = F.row_number().over(Window.partitionBy("label", part).orderBy("h", "unit"))
    then = F.row_number().over(Window.partitionBy("label").orderBy("h", "unit"))
    kept = only.withColumn("r", first).filter(F.col("r") <= max(1, max_units // 64)).withColumn("r", then).filter(F.col("r") <= max_units)
    made = kept.select("label", "h", "unit").groupBy("label").applyInPandas(train, "label int, dictionary binary")
    return {r["label"]: bytes(r["dictionary"]) for r in made.collect()}  # two rows


def train(rows: DataFrame, shares: dict[int, int], max_calibration: int = MAX_CALIBRATION) -> QualityModel:
    """Fit on `rows` (text, label), where `shares` counts all labelled rows by label.

    Rows go to the dictionaries (three of four) or to the calibration by a hash
    of their text, so copies stay together.  At most `max_calibration` rows of
    a label are calibrated on, weighted so that the labels keep their shares.
    With one label only, or none, the model gives the share of label 1.
    """
    base = shares.get(1, 0) / max(1, sum(shares.values()))
    if len([n for n in shares.values() if n]) < 2:
        return QualityModel(base)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = rows.select(F.col("label").cast("int").alias("label"), F.xxhash64("text").alias("h"), raw.alias("raw"))
    calibrating = F.pmod("h", F.lit(4)) == 3
    made = learn_dictionaries(rows.filter(~calibrating).select("label", "raw"))
    if len(made) < 2:
        return QualityModel(base)
    dictionaries = (made[0], made[1])
    seen = _measured(rows.filter(calibrating).select("label", "h", "raw"), dictionaries)
    kept = [
        r for label in (0, 1)
        for r in seen.filter(F.col("label") == label).orderBy("h", "sizes").limit(max_calibration).collect()  # four numbers a row
    ]
    y = np.array([r["label"] for r in kept])
    if len(set(y)) < 2:
        return QualityModel(base)
    x = inputs(np.array([r["sizes"] for r in kept]))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weight = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    return QualityModel(base, dictionaries, logistic((x - mean) / scale, y, weight), mean, scale)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 as column `name` at the end, from the whole text.

    Every row is scored by itself, without a shuffle.  Null and empty texts get
    the score of a text of no bytes.  With a model without dictionaries all
    rows get its share of label 1.  A column `name` of `docs` is replaced.
    """
    plain, names = plain_names(docs)
    if model.dictionaries is None:
        out = plain.withColumn("_score", F.lit(float(model.base)))
    else:
        spark = docs.sparkSession
        shared = spark.sparkContext.broadcast(model)
        seen = _measured(plain.withColumn("_raw", F.col(f"c{names.index(text_col)}").cast("binary")), model.dictionaries)

        @F.pandas_udf("double")
        def probability(found: pd.Series) -> pd.Series:
            return pd.Series(shared.value.probability(np.array(found.tolist())))

        out = seen.select(*plain.columns, probability("sizes").alias("_score"))
    kept = [i for i, n in enumerate(names) if n != name]
    return out.select(*[f"c{i}" for i in kept], "_score").toDF(*[names[i] for i in kept], name)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score at least `threshold`."""
    plain, names = plain_names(docs)
    return score(plain, model, f"c{names.index(text_col)}", "_score").filter(F.col("_score") >= threshold).drop("_score").toDF(*names)


def labelled(docs: DataFrame, labels: DataFrame, max_ids: int = MAX_IDS) -> tuple[DataFrame, dict[int, int]]:
    """Rows (text, label) that may be learned from, and the number of labelled ids by label.

    Of each label at most `max_ids` ids, those of the smallest hash, so the ids
    are broadcast.  Ids that carry both labels teach nothing and are left out.
    """
    ids = labels.filter((fold("doc_id", 4) != 2) & F.col("quality").isin(0, 1)).groupBy("doc_id")
    ids = ids.agg(F.min("quality").alias("label"), F.max("quality").alias("_most")).filter("label = _most").drop("_most")
    shares = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    kept = ids.filter("label = 0").orderBy(*order).limit(max_ids).unionByName(ids.filter("label = 1").orderBy(*order).limit(max_ids))
    kept = kept.select(F.col("doc_id").alias("_id"), "label")
    return docs.select("doc_id", "text").join(F.broadcast(kept), F.col("doc_id") == F.col("_id")).select("text", "label"), shares


@query("op11_quality")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = train(*labelled(docs, table(spark, sf, "labels")))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
