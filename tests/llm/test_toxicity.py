"""Toxicity: held-out accuracy, the fit against its likelihood, odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from nodecast.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    model = toxicity.fit(documents, labels.where(odd))
    rest = labels.where(~odd).select("doc_id", (F.col("toxic") > 0).alias("label"))
    found = toxicity.score(documents, model).join(rest, "doc_id").groupBy("label", "toxic").count()
    counts = {(r.label, r.toxic): r["count"] for r in found.collect()}
    hit, missed = counts.get((True, True), 0), counts.get((True, False), 0)
    false, right = counts.get((False, True), 0), counts.get((False, False), 0)
    # one toxic label in eight is noise there: such texts hold nothing offensive
    assert hit / (hit + missed) >= 0.8 and false / (false + right) <= 0.005, counts


def test_ordinal_fit_orders_thresholds_and_grades():
    rnd = np.random.default_rng(1)
    x = (rnd.random((2000, 6)) < 0.4).astype(np.float32)
    weights = np.array([2.0, 1.0, 0.5, 0, 0, -1])
    grade = np.searchsorted([1.0, 2.0, 3.0], x @ weights + rnd.logistic(size=2000) * 0.5)
    found, cuts = toxicity.ordinal(x, grade, 3)
    assert (np.diff(cuts) > 0).all()
    assert found[0] > found[1] > found[2] > abs(found[3]) and found[5] < 0


def test_rows_nulls_repeats_and_clashing_names(spark):
    rnd = random.Random(6)
    filler = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    rows = []
    for i in range(400):
        words = rnd.sample(filler, 25) + (["vile", "fool"] if i % 4 == 1 else [])
        rows.append((i, " ".join(rnd.sample(words, len(words))), i % 4 == 1))
    extra = [(900, None, None), (901, "", None), (902, "vile fool " * 20000, None), (1, rows[1][1], None)]
    frame = spark.createDataFrame([(i, t, "x") for i, t, _ in rows + extra], "doc_id long, text string, toxic string")
    labels = [(i, int(x)) for i, _, x in rows] + [(5, None), (None, 1), (1, 0)]
    rated = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("vile"))
    found = toxicity.toxicity(frame, rated).collect()
    assert len(found) == 404
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].toxic == bool(x) for i, _, x in rows)
    assert not by_id[900].toxic and not by_id[901].toxic and by_id[902].toxic
    assert by_id[902].expected_severity > 0.5 > by_id[900].expected_severity
    assert not any(r.toxic for r in toxicity.toxicity(frame, rated.limit(0)).collect())
    assert toxicity.toxicity(frame.limit(0), rated).collect() == []
