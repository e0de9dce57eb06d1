"""The pipeline: each stage against its operator or a plain version on its own input."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from nodecast.llm import bpe_codec, language, toxicity
from nodecast.llm.wordbpe import WordBpe
from tests.llm.test_decontaminate import plain
from tests.llm.test_simhash import plain_groups

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs = read("documents")
    every = {r.doc_id: r for r in docs.collect()}
    kept = [dict(every)]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == read("documents").columns
        kept.append({r.doc_id: r for r in docs.collect()})
        assert all(kept[-1][i] == every[i] for i in kept[-1]) and 0 < len(kept[-1]) <= len(kept[-2])
        docs = spark.createDataFrame(list(kept[-1].values()), read("documents").schema)

    start = read("documents")
    model = toxicity.fit(start, read("labels"))
    assert set(kept[1]) == {i for i, r in every.items() if model.severity(r.text)[0] < 0.5} != set(every)

    frame = spark.createDataFrame(list(kept[1].values()), start.schema)
    known = language.identify(frame, "lang", pipeline.LEVEL, declared="lang", address="source")
    assert set(kept[2]) == {r.doc_id for r in known.where("kept").collect()}

    groups = plain_groups([(i, r.text) for i, r in kept[2].items()])
    assert set(kept[3]) == {i for i, (_, least) in groups.items() if i == least} != set(kept[2])

    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    clean = plain([(i, r.text) for i, r in kept[3].items()], items)
    assert set(kept[4]) == {row[0] for row in clean if not row[-1]}

    texts = [kept[4][i].text for i in sorted(kept[4])]
    ids = bpe_codec.encode_texts(WordBpe(public_tokenizers.path(pipeline.TOKENIZER)), texts)
    found = pipeline.run(spark, FOLDER).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_tokens) for r in found] == list(zip(sorted(kept[4]), map(len, ids)))


def test_rows_with_nulls_stay_or_go_by_rule(spark, tmp_path):
    start = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "The words of the one", "en", "s", 20)]
    docs = start.unionByName(spark.createDataFrame(odd, start.schema)).withColumn("toxic", F.lit("x"))
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert None in ids
        assert (9001 in ids) == (name == "toxicity")
    assert pipeline.encoded(spark, docs, FOLDER).where("doc_id IS NULL").count() == 1


def test_each_row_is_judged_by_its_own_text(spark):
    """Repeated rows leave one, an id shared with a rejected row saves or costs
    nothing, and rows without an id are rejected like others."""
    start = spark.read.parquet(f"{FOLDER}/documents.parquet")
    schema, rows = start.schema, start.collect()
    model = toxicity.fit(start, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    bad = next(r for r in rows if model.severity(r.text)[0] >= 0.5)
    good = next(r for r in rows if model.severity(r.text)[0] < 0.5)
    passage = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first().text

    def after(stage, own):
        made = start.where("false").unionByName(spark.createDataFrame(own, schema))
        return sorted(((r.doc_id, r.text) for r in stage(spark, made, FOLDER).collect()), key=str)

    def row(doc_id, text):
        return (doc_id, text, good.lang, good.source, len(text))

    others = [tuple(r) for r in rows]
    shared = after(pipeline.without_toxic, [*others, row(9001, good.text), row(9001, bad.text), row(None, bad.text)])
    assert [t for i, t in shared if i == 9001] == [good.text] and all(i is not None for i, _ in shared)
    known = after(pipeline.in_known_language, [*others, row(9001, good.text), row(9001, "12 %"), row(None, "12 %")])
    assert [t for i, t in known if i == 9001] == [good.text] and all(i is not None for i, _ in known)
    copies = [row(9003, good.text), row(9002, good.text), row(9002, good.text), row(None, good.text), row(None, bad.text), row(None, bad.text)]
    assert after(pipeline.one_of_each_group, copies) == sorted([(9002, good.text), (None, bad.text)], key=str)
    clean = after(pipeline.without_benchmark, [row(9001, "clean words"), row(9001, passage), row(None, passage)])
    assert clean == [(9001, "clean words")]
