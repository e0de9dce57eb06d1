"""Toxicity by cumulative-link ordinal regression.

Grades: 0 for a text labelled clean; texts labelled toxic are graded 1 to
``GRADES`` by how many different telling features they hold (equal parts of the
sample).  Features, each present or not, are the words of a text, the beginnings
of words, and beginnings that two or more different words share (stems of
inflected insults).  Kept are those that are far commoner in toxic texts
(chi-square at least ``CHI2`` and ``TIMES`` the share).

One weight vector serves all thresholds: P(grade <= k) = s(t_k - w x).  The
result is the expected severity, the sum of P(grade >= k), and the probability
of any toxicity.  A text is toxic if that reaches one half.

The model is fitted on at most ``SAMPLE`` labelled rows of each class (those
with the smallest hash of their id), a documented bound, and on one of several
near copies (texts that share their ``COPIES`` least word hashes); every row is
scored on its whole text.  Without labels of both classes nothing is toxic.

Null and empty texts hold no feature.  Repeated rows give repeated rows; of
several labels of one id the highest counts; labels with nulls are skipped.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nodecast.llm.tasks import small_batches

SAMPLE, FEATURES = 3000, 1000
GRADES, CHI2, TIMES = 3, 30.0, 20.0
COPIES = 3
HEADS = (4, 5, 6, 7, 8)
"""Lengths of the word beginnings used as features."""
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Weights by feature and the ordered thresholds."""

    weights: dict[str, float]
    thresholds: list[float]

    def __post_init__(self):
        self.whole = frozenset(f for f in self.weights if f[0] != "^")
        stems = {f.lstrip("^") for f in self.weights if f[0] == "^"}
        self.heads = {n: frozenset(h for h in stems if len(h) == n) for n in HEADS}

    def severity(self, text: str) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        words = set(WORD.findall(text.lower()))
        found = sum(self.weights[w] for w in words & self.whole)
        for n, known in self.heads.items():
            if known:
                for feature in _stems([w for w in words if w[:n] in known], n):
                    found += self.weights.get(feature, 0.0)
        return [1 / (1 + float(np.exp(min(t - found, 700)))) for t in self.thresholds]


def _stems(words: list[str], n: int) -> Iterator[str]:
    """The beginnings of n letters, marked once, and twice where shared."""
    for head, times in Counter(w[:n] for w in words if len(w) >= n).items():
        yield "^" + head
        if times > 1:
            yield "^^" + head


def features(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words.union(*(_stems(words, n) for n in HEADS))


def _sample(documents: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """``key, toxic, text`` of the labelled rows to fit on, each text once."""
    known = documents.select(key).distinct()
    rated = (
        labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("toxic").alias("toxic"))
        .join(known, key, "left_semi")
    )
    order = [F.xxhash64(key), F.col(key)]
    toxic = rated.where("toxic > 0").orderBy(*order).limit(SAMPLE)
    clean = rated.where("toxic = 0").orderBy(*order).limit(SAMPLE)
    chosen = F.broadcast(toxic.unionAll(clean))  # at most 2 * SAMPLE rows
    rows = documents.select(key, F.coalesce(text, F.lit("")).alias("text")).join(chosen, key)
    # near copies share their least word hashes: one of them is enough
    words = F.split(F.lower("text"), r"\s+")
    least = [
        F.array_min(F.transform(words, lambda w, i=i: F.xxhash64(w, F.lit(i)))).alias(f"m{i}")
        for i in range(COPIES)
    ]
    grouped = rows.select(key, "toxic", "text", *least).groupBy("toxic", *(f"m{i}" for i in range(COPIES)))
    return grouped.agg(F.min(F.struct(key, "text")).alias("r")).select(f"r.{key}", "toxic", "r.text")


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    spark = small_batches(documents.sparkSession)
    sample = _sample(documents, labels, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, toxic, found = [], [], []
            for k, t, x in zip(*(c.to_pylist() for c in batch.columns)):
                own = ["", *features(x or "")]  # the empty feature counts the rows
                keys += [k] * len(own)
                toxic += [int(t > 0)] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(toxic, pa.int32()), pa.array(found)],
                ["key", "toxic", "feature"],
            )

    held = sample.mapInArrow(run, "key long, toxic int, feature string")
    counts = held.groupBy("feature").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    total = counts.where("feature = ''").first()
    if total is None or not total.bad or not total.good:
        return None
    bad, good = float(total.bad), float(total.good)
    miss_bad, miss_good = bad - F.col("bad"), good - F.col("good")
    cross = F.col("bad") * miss_good - F.col("good") * miss_bad
    chi2 = (bad + good) * cross * cross / (bad * good * (F.col("bad") + F.col("good")) * F.greatest(miss_bad + miss_good, F.lit(1.0)))
    telling = (
        counts.where("feature != ''")
        .withColumn("chi2", chi2)
        .where((F.col("chi2") >= CHI2) & (F.col("bad") / bad >= TIMES * F.col("good") / good))
        .orderBy(F.desc("chi2"), "feature")
        .limit(FEATURES)
    )
    names = [r.feature for r in telling.select("feature").collect()]  # at most FEATURES
    if not names:
        return None
    chosen = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "feature string, slot int")
    rows = (
        held.join(F.broadcast(chosen), "feature")
        .groupBy("key", "toxic")
        .agg(F.collect_set("slot").alias("slots"))
        .collect()  # at most 2 * SAMPLE rows of FEATURES slots
    )
    clean_without = int(good) - sum(1 for r in rows if not r.toxic)
    toxic_without = int(bad) - sum(1 for r in rows if r.toxic)
    slots = [r.slots for r in rows] + [[]] * (clean_without + toxic_without)
    toxic = np.array([r.toxic for r in rows] + [0] * clean_without + [1] * toxic_without)
    x = np.zeros((len(slots), len(names)), dtype=np.float32)
    for i, own in enumerate(slots):
        x[i, own] = 1
    held_features = x.sum(axis=1)
    cuts = np.quantile(held_features[toxic > 0], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic > 0, 1 + np.searchsorted(cuts, held_features, side="left"), 0)
    weights, thresholds = ordinal(x, grade, GRADES)
    return Model(dict(zip(names, weights.tolist())), thresholds.tolist())


def ordinal(x: np.ndarray, grade: np.ndarray, grades: int, rounds: int = 1500, ridge: float = 1e-5):
    """Weights and ordered thresholds by Adam on the penalised likelihood.
    Thresholds are a first value and positive steps, so they stay ordered."""
    n, width = x.shape
    values = np.zeros(width + grades)
    values[width] = 1.0
    first, second = np.zeros_like(values), np.zeros_like(values)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, rounds + 1):
        weights, steps = values[:width], np.exp(values[width + 1 :])
        cuts = np.concatenate(([values[width]], values[width] + np.cumsum(steps)))
        edges = np.concatenate(([-np.inf], cuts, [np.inf]))
        score = x @ weights.astype(np.float32)
        upper, lower = sigmoid(edges[grade + 1] - score), sigmoid(edges[grade] - score)
        upper[grade == grades], lower[grade == 0] = 1.0, 0.0
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_cut = np.array([du[grade == k].sum() - dl[grade == k + 1].sum() for k in range(grades)])
        slope = np.empty_like(values)
        slope[:width] = x.T @ (du - dl).astype(np.float32) / n + ridge * weights
        slope[width] = -by_cut.sum() / n
        slope[width + 1 :] = -np.array([by_cut[k:].sum() for k in range(1, grades)]) * steps / n
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        values -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    steps = np.exp(values[width + 1 :])
    return values[:width], np.concatenate(([values[width]], values[width] + np.cumsum(steps)))


def score(documents: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, expected_severity, severity, p_toxic, toxic`` per row; ``severity``
    is the highest grade that is at least as likely as not."""
    spark = small_batches(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # at most FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            chances = [model.severity(t.as_py() or "") if model else [0.0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([sum(c) for c in chances], pa.float64()),
                    pa.array([sum(p >= 0.5 for p in c) for c in chances], pa.int32()),
                    pa.array([c[0] for c in chances], pa.float64()),
                ],
                [key, "expected_severity", "severity", "p_toxic"],
            )

    scored = documents.select(key, text).mapInArrow(
        run, f"`{key}` long, expected_severity double, severity int, p_toxic double"
    )
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


def toxicity(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return score(documents, fit(documents, labels, key, text), key, text)
