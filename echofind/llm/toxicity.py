"""Toxicity scores: gradient-boosted trees over a few dense features, calibrated by isotonic regression.

The lexicon (words and word stems, with their log odds) is learned from labelled
rows, never fixed here. Each text becomes eleven numbers; Spark's tree ensemble is
fitted on three quarters of the labelled sample and calibrated on the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import private, written

#: Labelled rows a model is fitted on at most, chosen by a hash of the id.
MAX_LABELLED = 16_000
#: Lexicon entries at most, strongest first.
MAX_LEXICON = 2_000
#: Words remembered by one task before it starts anew.
MEMO_WORDS = 200_000
STEMS = (4, 5, 6)
FEATURES = (
    "log_words", "density", "log_hits", "mean_odds", "max_odds", "near_second_person",
    "capitals", "shouted", "exclaimed", "punctuation", "obfuscated",
)
SECOND_PERSON = frozenset("you your yours u ur du dich dir dein deine ihr euch tu te toi vous votre ton ta tú ti usted vosotros".split())
# Characters that stand for letters in disguised words.
LOOKALIKES = str.maketrans("013457@$", "oieastas")
EDGES = ".,;:!?\"'()[]{}<>*_-"
_UPPER, _MARKS, _SHOUTS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b"!?"


@dataclass(frozen=True)
class Toxicity:
    """A fitted model. ``trees`` is None where the labels hold one class only: every score is then 0."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    steps: tuple[tuple[float, float], ...]


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of all rows whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def stems(words: Column) -> Column:
    """The distinct words and their stems (marked by a star)."""
    return F.array_distinct(F.concat(words, *(F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS)))


def learn_lexicon(labelled: DataFrame, least: int = 5, odds: float = 2.0) -> dict[str, float]:
    """Entries of at least ``least`` toxic texts whose presence raises the log odds by ``odds``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}@$]+"), F.lit(0)))
    bags = labelled.select("toxic", words.alias("words"))
    totals = labelled.agg(F.count_if(F.expr("toxic = 1")).alias("t"), F.count_if(F.expr("toxic = 0")).alias("n")).first()
    counts = bags.select("toxic", F.explode(stems(F.col("words"))).alias("entry")).groupBy("entry").agg(F.count_if(F.expr("toxic = 1")).alias("t"), F.count_if(F.expr("toxic = 0")).alias("n"))
    score = F.log((F.col("t") + 0.5) / (totals["t"] + 1)) - F.log((F.col("n") + 0.5) / (totals["n"] + 1))
    rows = counts.filter(F.col("t") >= least).withColumn("odds", score).filter(F.col("odds") >= odds).orderBy(F.desc("odds"), F.desc("t"), "entry").limit(MAX_LEXICON).collect()
    return {r["entry"]: r["odds"] for r in rows}


class _Words(dict):
    """Word as it stands -> (log odds, second person, shouted, obfuscated); emptied at ``MEMO_WORDS``."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def odds(self, word: str) -> float:
        known = [self.lexicon.get(word, 0.0)]
        known += [self.lexicon.get(word[:k] + "*", 0.0) for k in STEMS if len(word) > k]
        return max(known)

    def __missing__(self, raw: str):
        if len(self) >= MEMO_WORDS:
            self.clear()
        word = raw.strip(EDGES)
        low = word.lower()
        odds = self.odds(low)
        odd = bool(re.search(r"[^\W\d_][\d@$*#]+[^\W\d_]", low))
        if odd and not odds:
            odds = self.odds(low.translate(LOOKALIKES).replace("*", "").replace("#", ""))
        value = (odds, low in SECOND_PERSON, len(word) > 2 and word.isupper(), odd)
        self[raw] = value = value if any(value) else None
        return value


def text_features(text: str | None, words: dict) -> tuple[float, ...]:
    text = text or ""
    parts = text.split()
    data = text.encode()
    n = max(1, len(parts))
    size = max(1, len(data))
    lookup = words.__getitem__
    found = [(i, v) for i, v in enumerate(map(lookup, parts)) if v is not None]
    hits = [(i, v[0]) for i, v in found if v[0]]
    persons = np.array([i for i, v in found if v[1]])
    near = 0
    if hits and len(persons):
        at = np.array([i for i, _ in hits])
        k = np.searchsorted(persons, at)
        left = np.where(k > 0, at - persons[np.maximum(k - 1, 0)], 1 << 30)
        right = np.where(k < len(persons), persons[np.minimum(k, len(persons) - 1)] - at, 1 << 30)
        near = int((np.minimum(left, right) <= 3).sum())
    gone = [len(data) - len(data.translate(None, chars)) for chars in (_UPPER, _SHOUTS, _MARKS)]
    return (
        float(np.log1p(len(parts))), len(hits) / n, float(np.log1p(len(hits))), sum(o for _, o in hits) / n,
        max((o for _, o in hits), default=0.0), near / n, gone[0] / size, sum(v[2] for _, v in found) / n,
        gone[1] / size, gone[2] / size, sum(v[3] for _, v in found) / n,
    )


def features(text: Column, lexicon: dict[str, float]) -> Column:
    """A struct of the dense features of each text (null: as empty)."""

    @F.pandas_udf(", ".join(f"{name} double" for name in FEATURES))
    def computed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words(lexicon)
        for texts in batches:
            yield pd.DataFrame([text_features(t, words) for t in texts], columns=list(FEATURES), dtype="float64")

    return computed(text)


def _assembled(df: DataFrame, lexicon: dict[str, float], vector: str) -> DataFrame:
    """``df`` with its features as one ``vector``."""
    (held, *names) = private(df, "struct", *FEATURES)
    df = df.withColumn(held, features(F.col("text"), lexicon)).select("*", *(F.col(held)[n].alias(c) for n, c in zip(FEATURES, names, strict=True)))
    return VectorAssembler(inputCols=names, outputCol=vector).transform(df).drop(held, *names)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, seed: int = 11) -> Toxicity:
    """Fit on labelled rows outside the held-out third, on ``max_labelled`` at most.

    Rows without a 0/1 label and labels without a text take no part.
    """
    ids = labels.filter("toxic in (0, 1)").filter(~held_out()).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    # At most max_labelled ids of 12 bytes: a bounded broadcast.
    chosen = ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_labelled)
    sample = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(4))))
    train, rest = sample.filter("fold > 0"), sample.filter("fold = 0")
    if train.select("toxic").distinct().count() < 2:
        return Toxicity({}, None, ())
    lexicon = learn_lexicon(train)
    # The sample is bounded, so a few tasks hold its features; the trees run many jobs over them.
    ready = written(_assembled(sample, lexicon, "_features").select("_features", F.col("toxic").cast("double").alias("label"), "fold").coalesce(4)).coalesce(4).cache()
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, maxBins=32, seed=seed).fit(ready.filter("fold > 0"))
    raw = trees.transform(ready.filter("fold = 0")).select(vector_to_array("probability")[1].alias("raw"), "label")
    steps: tuple[tuple[float, float], ...] = ((0.0, 0.0), (1.0, 1.0))
    if raw.select("label").distinct().count() == 2:
        iso = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
        steps = tuple(zip(iso.boundaries.toArray().tolist(), iso.predictions.toArray().tolist(), strict=True))
    ready.unpersist()
    return Toxicity(lexicon, trees, steps)


def calibrated(raw: Column, steps: tuple[tuple[float, float], ...]) -> Column:
    """Linear between the isotonic boundaries, flat outside, plus a sliver of the raw score that orders ties."""

    @F.pandas_udf("double")
    def interpolated(values: pd.Series) -> pd.Series:
        x, y = np.array(steps).T
        return pd.Series(np.clip(np.interp(values, x, y) * 0.999 + values * 0.001, 0, 1))

    return interpolated(raw)


def score(docs: DataFrame, model: Toxicity, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 where the score reaches ``threshold``).

    Null and empty texts are scored like any other (no words, no hits), texts of any length
    whole. Repeated rows score alike, and so do texts of equal features; columns named like the new ones are
    replaced, any other name is free. An empty table stays empty.
    """
    docs = docs.drop("score", "predicted")
    if model.trees is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    vector, raw, chance, label = private(docs, "vector", "raw", "chance", "label")
    trees = model.trees.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol(chance).setPredictionCol(label)
    rated = trees.transform(_assembled(docs, model.lexicon, vector)).withColumn("score", calibrated(vector_to_array(chance)[1], model.steps))
    return rated.select(*docs.columns, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
