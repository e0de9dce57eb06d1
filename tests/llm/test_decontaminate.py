"""Decontamination against plain window search."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from nodecast.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def plain(documents, items, window=13, share=20):
    cut = []
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        cut += [(item, w[s : s + size]) for s in range(len(w) - size + 1) if size]
    rows = []
    for key, text in documents:
        w = words(text)
        marked, names = set(), set()
        for item, phrase in cut:
            for s in range(len(w) - len(phrase) + 1):
                if w[s : s + len(phrase)] == phrase:
                    marked.update(range(s, s + len(phrase)))
                    names.add(item)
        names = sorted(str(n) for n in names if n is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        rows.append((key, len(w), len(marked), len(names), digest, bool(marked) and share * len(marked) >= len(w)))
    return rows


def order(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("bound", [None, 0])
def test_random_passages(spark, monkeypatch, bound):
    if bound is not None:  # the way beyond the broadcasts
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
        monkeypatch.setattr(decontaminate, "BROADCAST_TOKENS", bound)
    rnd = random.Random(2)
    vocabulary = ["the", "of", "É", "x1", "Straße", "b", "c"]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([0, 1, 2, 3, 4, 5, 6, 12, 13, 14, 20, 40])]
    items += [(3, items[9][1]), (100, items[9][1].upper()), (None, items[10][1]), (101, None)]
    documents = []
    for i in range(60):
        parts = [line(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            text = rnd.choice(items)[1] or ""
            parts += [text if rnd.random() < 0.7 else text[:-2], line(rnd.randint(0, 9))]
        documents.append((i, rnd.choice([" ", ", ", "\n--"]).join(parts)))
    documents += [(5, None), (5, ""), (6, documents[6][1]), (None, items[10][1]), (7, "w " * 30000 + items[11][1])]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    frame = frame.select("*", F.lit("x").alias("words"), F.lit(1).alias("n_words"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    for window in (13, 3):
        found = decontaminate.contamination(frame, bench, window, 20).collect()
        assert order(found) == order(plain(documents, items, window))


def test_beyond_the_broadcast_bound_no_texts_are_shuffled_at_each_place(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_TOKENS", 0)
    written = {}
    keep = decontaminate.materialize
    monkeypatch.setattr(decontaminate, "materialize", lambda f, name: keep(written.setdefault(name, f), name))
    documents = spark.createDataFrame([(i, "one two three four five six") for i in range(400)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "two three four five"), (8, "five four")], "item_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontaminate.contamination(documents, items, 3, 20).collect()
        plan = written["candidates"]._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 400 and {(r.n_hit, r.n_items) for r in found} == {(4, 1)}
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(token" in line]
    assert dealt and all("salt" in line for line in dealt)
    assert written["candidates"].columns == ["key", "mark", "start", "length", "phrase"]


def test_few_files_are_written_for_the_items(spark, monkeypatch):
    files = {}
    keep = decontaminate.materialize

    def counted(frame, name):
        written = keep(frame, name)
        files[name] = len(written.inputFiles())
        return written

    monkeypatch.setattr(decontaminate, "materialize", counted)
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(30)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([*enumerate(texts[:20]), (3, texts[3])], "item_id long, text string").coalesce(1)
    settings = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = decontaminate.contamination(documents, items, 13, 20).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert order(found) == order(plain(list(enumerate(texts)), list(enumerate(texts[:20]))))
    assert files.pop("hits") <= documents.rdd.getNumPartitions()
    assert sum(files.values()) <= 1 + 20  # the windows in one, the prefixes in one a shuffle partition


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.contamination(documents, items, 13, 20).collect()
    assert order(found) == plain([(1, "some words here")], [])
    full = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    assert decontaminate.contamination(documents.limit(0), full, 13, 20).collect() == []
