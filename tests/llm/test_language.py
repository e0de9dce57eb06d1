"""Language identification: held-out accuracy, fusion by hand, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from nodecast.llm import language


def test_held_out_accuracy_from_text_alone(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = F.pmod(F.xxhash64("text"), F.lit(2)) == 1
    shown = documents.withColumn("label", F.when(odd, F.col("lang")))
    found = language.identify(shown, "label", 0.5).join(documents.where(~odd).select("doc_id", "lang"), "doc_id")
    right, total = found.agg(F.sum((F.col("language") == F.col("lang")).cast("int")), F.count("lang")).first()
    assert right / total >= 0.97


def test_pages_use_markup_and_address(spark):
    """Texts that say nothing take the language that their host mostly has."""
    rows = [(i, "the and of " * 9, "en", "http://a.example.com/x") for i in range(60)]
    rows += [(100 + i, "der die und " * 9, "de", "https://b.example.org/y?z#w") for i in range(60)]
    rows += [(200, "zzz", None, "http://a.example.com/q"), (201, "zzz", None, "https://b.example.org/")]
    rows += [(202, "zzz", "DE", "http://new.example.net"), (203, "zzz", None, "http://other.example.org")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, markup string, url string")
    found = {r.doc_id: r for r in language.identify(frame, "markup", 0.5, declared="markup", address="url").collect()}
    assert [found[i].language for i in (0, 100, 200, 201, 203)] == ["en", "de", "en", "de", "de"]
    assert found[200].confidence < found[0].confidence


def test_fusion_by_hand(spark):
    schema = "key long, evidence array<double>, n_trigrams long, declared string, suffix string, host string, parent string"
    rows = [
        (1, [-1.0, -3.0], 5, "a", "com", "x.t.com", "t.com"),
        (2, [-4.0, -2.0], 5, "b", None, "y.t.com", "t.com"),
        (3, [-2.0, -2.5], 5, "b", "com", "x.t.com", "t.com"),
        (4, [0.0, 0.0], 0, None, None, None, None),
    ]
    found = language.fuse(spark.createDataFrame(rows, schema), ["a", "b"])
    posterior = {r.key: np.array(r.posterior) for r in found.collect()}
    k = language.KAPPA
    total = np.array([2.0, 1.0])
    whole = (total + language.ALPHA) / (3 + 2 * language.ALPHA)
    parent = (np.array([2.0, 1.0]) + k * whole) / (3 + k)
    hosts = {"x": (np.array([2.0, 0.0]) + k * parent) / (2 + k), "y": (np.array([0.0, 1.0]) + k * parent) / (1 + k)}
    shown = lambda n: (np.array(n) + k * sum(n) / 3) / (total + k)
    scores = {
        1: np.exp([-1.0, -3.0]) * hosts["x"] * shown([1.0, 0.0]) * shown([2.0, 0.0]),
        2: np.exp([-4.0, -2.0]) * hosts["y"] * shown([1.0, 1.0]),
        3: np.exp([-2.0, -2.5]) * hosts["x"] * shown([1.0, 1.0]) * shown([2.0, 0.0]),
        4: whole,
    }
    for key, score in scores.items():
        assert np.allclose(posterior[key], score / score.sum())


def test_rows_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "the and of", "en"), (1, "the and of", "en"), (2, None, "en"), (3, "", None), (4, "12 %% 3", "en")]
    rows += [(5, "word " * 50000, "en"), (6, "ein Wort", None), (None, "the", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame = frame.select("*", F.lit("x").alias("host"), F.lit(1).alias("key"), F.lit(2).alias("evidence"))
    found = language.identify(frame, "lang", 0.5, declared="lang", address="host").collect()
    assert sorted(((r.doc_id, r.language) for r in found), key=str) == sorted(
        [(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (6, "en"), (None, "en")], key=str
    )
    assert language.identify(frame.limit(0), "lang", 0.5).collect() == []
    none = language.identify(frame.withColumn("lang", F.lit(None).cast("string")), "lang", 0.5).collect()
    assert len(none) == len(rows) and {r.language for r in none} == {"und"}


def test_every_label_is_a_language_and_regions_are_not(spark):
    """70 languages with words of their own; the rarest are known too."""
    letters = "abcdefghij"
    tag = lambda i: "x" + letters[i // 10] + letters[i % 10]
    words = lambda i: " ".join(f"{a}{tag(i)}{a}" for a in "klmnop") + " "
    rows = [(100 * i + k, words(i) * 3, tag(i) + ("-US" if k % 2 else "_gb")) for i in range(70) for k in range(3 if i < 66 else 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(frame, "lang", 0.5, declared="lang").collect()
    assert len(found) == len(rows) and {(r.doc_id, r.language) for r in found} == {(i, t[:3]) for i, _, t in rows}


def test_copies_of_a_text_count_once(spark):
    rows = [("the and of", "en"), ("some other words", "en"), ("der die und", "de")]
    make = lambda more: spark.createDataFrame(rows + more, "text string, lang string").repartition(4)
    once = language.fit(make([]), "text", "lang")
    often = language.fit(make([rows[0]] * 500), "text", "lang")
    assert once[0] == often[0] and np.array_equal(once[1], often[1])
