"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage
from .common import plain_names, table
from .language import fold
from .registry import query

# The classifier is fitted on at most this many labelled rows, those with the smallest hash of the id.
MAX_TRAIN = 12_000
# Terms of the lexicon, the documents that a term needs, and the least log-likelihood ratio.
LEXICON = 1000
LEAST_DOCS = 4
LEAST_RATIO = 25.0
STEMS = (4, 5, 6)
NEAR = 40
THRESHOLD = 0.7
# Words that address the reader.
SECOND_PERSON = (
    "you your yours yourself u ur "
    "du dich dir dein deine deinen deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro vuestra"
).split()
# Signs that stand for letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*._\-]+[^\W\d_]+)+")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
FEATURES = (
    "lexicon_density", "lexicon_hits", "lexicon_weight", "disguised_hits", "near_second_person", "second_person_density",
    "capitals", "loud_words", "exclamations", "questions", "punctuation", "symbols", "disguised", "stretched", "words",
)
_UPPER = bytes(range(65, 91))
_PUNCT = b".,;:'\"()-"
_SYMBOLS = b"#$%&*+@^_|~<>{}[]\\"


def document_terms(text: str) -> set[str]:
    """Words of a text in lower case, and the stems of longer words, marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms that mark label 1, with their log odds, from `rows` (text, label).

    A term counts once per document.  It needs LEAST_DOCS documents of label 1
    and a log-likelihood ratio of LEAST_RATIO.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def out():
            terms = list(seen[0].keys() | seen[1].keys())
            made = pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in seen]], ["term", "neg", "pos"]
            )
            for c in seen:
                c.clear()
            return made

        for b in batches:
            for text, label in zip(b.column(0), b.column(1)):
                seen[label.as_py()].update(document_terms(text.as_py() or ""))
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield out()
        yield out()

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    counts = rows.select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int")).mapInArrow(run, "term string, neg long, pos long")
    counts = counts.groupBy("term").agg(F.sum("pos").alias("a"), F.sum("neg").alias("b")).filter(F.col("a") >= LEAST_DOCS)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = (a + b) / F.lit(n0 + n1)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(a, share * n1) + part(b, share * n0) + part(F.lit(n1) - a, (1 - share) * n1) + part(F.lit(n0) - b, (1 - share) * n0))
    odds = F.log((a + 0.5) / (F.lit(n1) - a + 0.5)) - F.log((b + 0.5) / (F.lit(n0) - b + 0.5))
    kept = counts.select("term", ratio.alias("ratio"), odds.alias("odds")).filter((F.col("ratio") >= LEAST_RATIO) & (F.col("odds") > 1.5))
    return {r["term"]: r["odds"] for r in kept.orderBy(F.desc("ratio"), "term").limit(LEXICON).collect()}


def finder(lexicon: dict[str, float]):
    """An automaton over lexicon terms and second-person words: (kind, length, whole word, weight)."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    found: dict[str, list] = {}
    for term, weight in lexicon.items():
        plain = term.rstrip("*")
        found.setdefault(plain, []).append((0, len(plain), not term.endswith("*"), weight))
    for word in SECOND_PERSON:
        found.setdefault(word, []).append((1, len(word), True, 0.0))
    for plain, entries in found.items():
        automaton.add_word(plain, entries)
    automaton.make_automaton()
    return automaton


def _hits(automaton, low: str) -> tuple[dict[int, float], list[int]]:
    """Starts of words in the lexicon with their largest weight, and starts of second-person words."""
    hits: dict[int, float] = {}
    persons = []
    for end, entries in automaton.iter(low):
        for kind, n, whole, weight in entries:
            start = end - n + 1
            if start and low[start - 1].isalpha() or whole and end + 1 < len(low) and low[end + 1].isalpha():
                continue
            if kind:
                persons.append(start)
            else:
                hits[start] = max(weight, hits.get(start, 0.0))
    return hits, persons


def features(text: str | None, automaton) -> list[float]:
    """The values of FEATURES for one whole text; zeros for null and empty texts."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(FEATURES)
    words = text.split()
    n = max(1, len(words))
    size = len(raw)
    hits, persons = _hits(automaton, text.lower())
    near = 0
    if persons:
        places = np.array(persons)
        for start in hits:
            at = np.searchsorted(places, start)
            near += any(0 <= k < len(places) and abs(int(places[k]) - start) <= NEAR for k in (at - 1, at))
    disguised = DISGUISED.findall(text)
    bare = [re.sub(r"[*._\-]", "", d.lower().translate(LOOKALIKES)) for d in disguised]
    disguised_hits = sum(bool(_hits(automaton, d)[0]) for d in bare)
    capitals = size - len(raw.translate(None, _UPPER))
    loud = sum(map(str.isupper, words)) if capitals * 20 > size else 0
    return [
        1000.0 * len(hits) / n, float(np.log1p(len(hits))), max(hits.values(), default=0.0), float(np.log1p(disguised_hits)),
        float(np.log1p(near)), 1000.0 * len(persons) / n, 100.0 * capitals / size, 100.0 * loud / n,
        100.0 * raw.count(b"!") / size, 100.0 * raw.count(b"?") / size, 100.0 * (size - len(raw.translate(None, _PUNCT))) / size,
        100.0 * (size - len(raw.translate(None, _SYMBOLS))) / size, 1000.0 * len(disguised) / n,
        1000.0 * len(STRETCHED.findall(text)) / n, float(np.log1p(len(words))),
    ]


def with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """`rows` (any columns, the last `text`) with `x`, the array of FEATURES, in place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = finder(shared.value)
        for b in batches:
            x = [features(t.as_py(), automaton) for t in b.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(x, pa.list_(pa.float64()))], [*kept, "x"])

    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    base: float
    trees: object = None
    isotonic: object = None


def train(rows: DataFrame, max_train: int = MAX_TRAIN, rounds: int = 20, depth: int = 3) -> ToxicityModel:
    """Fit on `rows` (id, text, label), label 0 or 1.

    At most `max_train` rows are used.  The lexicon is learned from all of
    these, the trees from three of four, and the isotonic map from their
    scores of the fourth.  With one label only, or none, the model gives the
    share of label 1 everywhere.
    """
    sample = rows.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    sample = cut_lineage(sample.withColumn("h", F.xxhash64("id")).orderBy("h", "label").limit(max_train))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return ToxicityModel({}, base)
    sample = sample.repartition(8)
    lexicon = learn_lexicon(sample.select("text", "label"))
    seen = with_features(sample.select("h", F.col("label").cast("double").alias("label"), "text"), lexicon)
    seen = cut_lineage(seen).coalesce(4).withColumn("features", array_to_vector("x"))
    calibrating = F.pmod("h", F.lit(4)) == 3
    fitting = seen.filter(~calibrating)
    if fitting.select("label").distinct().count() < 2:
        return ToxicityModel(lexicon, base)
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, minInstancesPerNode=5
    ).fit(fitting)
    out = trees.transform(seen.filter(calibrating)).select("label", vector_to_array("probability")[1].alias("p"))
    isotonic = IsotonicRegression(featuresCol="p", labelCol="label").fit(out) if out.limit(1).count() else None
    return ToxicityModel(lexicon, base, trees, isotonic)


def _scored(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """`rows` (columns c0, c1, ..., the last `text`) with `score` in place of the text."""
    kept = rows.columns[:-1]
    if model.trees is None:
        return rows.select(*kept, F.lit(model.base).cast("double").alias("score"))
    seen = with_features(rows, model.lexicon).withColumn("features", array_to_vector("x"))
    raw = model.trees.transform(seen).select(*kept, vector_to_array("probability")[1].alias("p"))
    if model.isotonic is None:
        return raw.withColumnRenamed("p", "score")
    return model.isotonic.transform(raw).select(*kept, (F.col("prediction") * 0.999 + F.col("p") * 0.001).alias("score"))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row, from the whole text.

    The score is the calibrated probability with a thousandth of the trees'
    own, which orders rows that share a step of the isotonic map.  Null and
    empty texts are scored as texts without any feature.
    """
    return _scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model)


def keep_civil(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a score under the threshold; every row is judged by itself, without a shuffle."""
    plain, names = plain_names(docs)
    rows = plain.withColumn("text", F.col(f"c{names.index(text_col)}"))
    return _scored(rows, model).filter(F.col("score") < threshold).drop("score").toDF(*names)


def labelled(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(id, text, label) of the labelled rows that may be learned from; at most `max_train` ids, so they are broadcast."""
    ids = labels.filter((fold("doc_id", 3) != 1) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).withColumnRenamed("doc_id", "id")
    return docs.select(F.col("doc_id"), "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("id", "text", "label")


@query("op4_toxicity")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = train(labelled(docs, table(spark, sf, "labels")))
    return score(docs, model).select(
        F.col("id").alias("doc_id"), F.coalesce(fold("id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
