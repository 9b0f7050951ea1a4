"""Each stage of the pipeline against a plain version on what the stage before kept."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from recall_lens.llm import language, toxicity
from tests.llm.test_near_duplicates import plain as plain_groups
from tests.llm.test_repeats import plain as plain_repeats

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "toxicity", "near_duplicates", "substring_dedup", "packing"]

    kept = stages["language_id"](spark, docs, FOLDER).cache()
    assert kept.schema == docs.schema
    names = {r.doc_id: r.lang_pred for r in language.identify(docs, language.learn(docs)).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, n in names.items() if n != "und"}

    clean = stages["toxicity"](spark, kept, FOLDER).cache()
    model = toxicity.learn(kept, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.grade(kept, model).collect() if r.toxic}
    assert bad and {r.doc_id for r in clean.collect()} == {r.doc_id for r in kept.collect()} - bad

    single = stages["near_duplicates"](spark, clean, FOLDER).cache()
    groups = plain_groups([(r.doc_id, r.text) for r in clean.collect()])
    assert {r.doc_id for r in single.collect()} == {doc for doc, _, root, _ in groups if doc == root}

    new = stages["substring_dedup"](spark, single, FOLDER).cache()
    texts = {r.doc_id: r.text for r in single.collect()}
    removed = {doc: gone for doc, _, gone, _ in plain_repeats(list(texts.items()))}
    assert new.count() == len(texts) and new.schema == docs.schema
    for r in new.collect():
        assert len(r.text.split()) == len(texts[r.doc_id].split()) - removed[r.doc_id] and r.n_chars == len(r.text)
        assert removed[r.doc_id] or r.text == texts[r.doc_id]

    pieces = stages["packing"](spark, new, FOLDER).collect()
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    key = lambda rows: Counter((r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in rows)
    assert key(pieces) == key(whole) and {r.doc_id for r in pieces} == set(texts)
    assert len({r.sequence_id for r in pieces}) == len({r.sequence_id for r in whole})


def test_awkward_documents_pass_all_stages(spark, awkward, tmp_path):
    folder = str(tmp_path / "tables")
    awkward.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 1), (5, 0, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    empty = str(tmp_path / "empty")
    awkward.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_unlabelled_documents_stay(spark, awkward):
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.keep_languages(spark, unlabelled, FOLDER)
    assert kept.schema == unlabelled.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, 4, 5, 6, 6, 7, 8, 9])
