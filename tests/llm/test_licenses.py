"""The license scan against plain search; the method's own labels by example."""

import random

from pyspark.sql import functions as F

from nodecast.llm import licenses
from tests.llm.test_decontaminate import order, words


def plain_base(text):
    w = words(text)
    found = [
        (s, label)
        for label, phrase in licenses.BASE
        for s in range(len(w))
        if w[s : s + len(phrase.split())] == phrase.split()
    ]
    places = [s for s, _ in found]
    return (len(w), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in found})))


def test_base_phrases(spark):
    rnd = random.Random(4)
    vocabulary = "gnu general public license apache cc by mit the É".split()
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))) for _ in range(80)]
    texts += ["CC-BY (MIT) License", "Apache\nLICENSE", "cc", "", " . ", "cc by " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[4]), (9, None), (None, "MIT License")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.select("*", F.lit(1).alias("label"), F.lit("x").alias("words"))
    found = licenses.scan(frame).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert order(found.collect()) == order([(i, *plain_base(t)) for i, t in rows])
    assert licenses.scan(frame.limit(0)).collect() == []


def test_passages_survive_small_changes(spark):
    text = dict(licenses.PASSAGES)["mit-text"].split()
    changed = text[:12] + ["now", "also"] + text[12:]
    rows = [
        (1, "before " + " ".join(text) + " after"),
        (2, "before " + " ".join(changed)),
        (3, " ".join(text[:15])),
        (4, "nothing of the kind"),
    ]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].labels for i in (1, 2, 3, 4)] == ["mit-text", "mit-text", "", ""]
    assert found[1].score == 1.0 and 0.8 <= found[2].score < 1.0 and 0 < found[3].score < 0.8
    assert found[4].score == 0.0


def test_paragraphs_are_found_whatever_stands_between_them(spark):
    passages = dict(licenses.PASSAGES)
    mit = ["mit-text", "mit-rights", "mit-condition", "mit-warranty"]
    bsd = ["bsd-text", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty"]
    added = "our own words about what this file is for and who may ask us about it " * 5
    rows = [
        (1, ". ".join(passages[p].upper() for p in mit)),
        (2, passages[mit[0]] + ", " + passages[mit[1]] + ": " + added + passages[mit[2]] + added + passages[mit[3]]),
        (3, " ".join(passages[p] for p in mit if p != "mit-condition")),
        (4, "; ".join(passages[p] for p in bsd)),
        (5, "; ".join(passages[p] for p in bsd if p != "bsd-names")),
        (6, added),
    ]
    found = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1] == found[2] == ",".join(sorted(mit))
    assert found[3] == ",".join(sorted(set(mit) - {"mit-condition"}))
    assert found[4] == ",".join(sorted(bsd)) and found[5] == ",".join(sorted(set(bsd) - {"bsd-names"})) and found[6] == ""
    assert len({label for label, _ in licenses.PASSAGES}) == len(licenses.PASSAGES)
    assert all(text == " ".join(words(text)) for _, text in licenses.PASSAGES)
